"""Column functions: key clean-up, missing values, numbers and dates."""

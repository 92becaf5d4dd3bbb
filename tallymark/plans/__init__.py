"""The three reconciliations, each a set of DataFrame functions."""

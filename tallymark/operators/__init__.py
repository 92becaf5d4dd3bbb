"""DataFrame operators shared by the reconciliation plans."""

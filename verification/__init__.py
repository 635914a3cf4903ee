"""The registered queries, their SQL and the inputs derived from the test data. The package doesn't need them."""

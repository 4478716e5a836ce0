"""Domain tables derived from the test data, registered queries and their SQL."""

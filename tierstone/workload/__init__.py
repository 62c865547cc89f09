"""The trade history derived from the given tables, and the queries run on it."""

"""Views of the given tables that play the plant's tables, the queries on them, and their SQL twins."""

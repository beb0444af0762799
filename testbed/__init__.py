"""The engine's inputs derived from the given tables, and the queries over them."""

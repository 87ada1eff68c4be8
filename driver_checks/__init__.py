"""Check queries: findings derived from the given tables, the product's jobs over them, and an independent SQL oracle."""

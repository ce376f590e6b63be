"""Column functions: text, ratings, numbers and key hashes."""

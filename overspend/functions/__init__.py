"""Column expressions: text, contract fields, times and scores."""

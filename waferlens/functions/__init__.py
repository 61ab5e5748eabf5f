"""Column expressions: predicates, cleaning and scalar functions."""

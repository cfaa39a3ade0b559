"""Column expressions and text recognisers."""

"""Whole jobs over the trial schema, put together from the operators."""

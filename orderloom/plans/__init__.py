"""Whole queries and the batch day run, composed from the operators."""

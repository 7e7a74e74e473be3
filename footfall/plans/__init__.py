"""Batch jobs made of operators and table writes."""

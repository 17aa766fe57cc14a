"""Queries on the TPC-H-style test tables, each with an equivalent SQL text where one exists."""

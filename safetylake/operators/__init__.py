"""Operators on DataFrames: quality rules, dedupe, cleaning, gold tables, queries, change feed, paging."""

"""Loan-tape analytics on Spark: monthly loan files in, one row per loan with nested timelines out."""

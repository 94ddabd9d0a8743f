"""Queries over the given tables, one per operator, each with the SQL that must give the same rows where SQL can."""

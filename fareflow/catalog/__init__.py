"""Registered queries: every operator on the given tables, with an SQL oracle where SQL can say it."""

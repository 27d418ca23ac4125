"""Registered queries on the test tables, each with its SQL counterpart where SQL can say it."""

"""Registered queries over the supplied test tables, with a SQL twin where SQL can say it."""

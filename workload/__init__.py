"""Queries of the engine on the test tables, with the SQL they are checked against."""

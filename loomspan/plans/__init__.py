"""Queries: operators bound to the test tables, with the SQL each must agree with."""

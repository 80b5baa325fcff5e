"""The operators run over the test tables, with the SQL that states the same results."""

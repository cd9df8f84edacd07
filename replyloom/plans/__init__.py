"""Queries over the test tables, their SQL counterparts, and file-to-file jobs."""

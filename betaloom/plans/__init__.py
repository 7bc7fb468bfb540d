"""Queries over the test tables, their SQL, and the step runner."""

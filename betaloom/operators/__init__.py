"""Relational operators over site-by-sample matrices, annotations and results."""

"""Operators for preparing text for language models.  Nothing else in the library imports this."""

"""Operators for preparing training text: tokens, duplicates, leaks, quality, language and likelihood."""

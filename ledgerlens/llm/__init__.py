"""Operators that prepare training text: quality, duplicates, secrets, licences, mixing, tokens."""

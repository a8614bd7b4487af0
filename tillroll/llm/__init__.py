"""Operators that prepare training text: scoring, matching, formatting, tokens, packing."""

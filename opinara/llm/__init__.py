"""Operators for preparing training text: ten operators, each in its own module."""

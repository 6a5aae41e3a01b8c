"""Operators that prepare training text: one module each, plus shared word, block and token helpers."""

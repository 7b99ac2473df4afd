"""Operators for preparing training corpora; nothing else in the library imports this package.

Row identity, nulls and clashing names are handled alike everywhere: an operator
selects the columns it reads, treats a null text as empty, and prefixes its own
working columns with ``__pw_`` where it has to keep the caller's columns.
"""

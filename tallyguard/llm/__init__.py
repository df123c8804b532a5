"""Operators for preparing training text: de-duplication, filters, mixing and tokens.

Nothing else in the library imports this subpackage.
"""

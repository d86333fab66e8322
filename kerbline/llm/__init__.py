"""Operators and queries for large training-text tables.

Nothing outside this folder imports it. See the README in this folder for methods, limits and
measured figures.
"""

"""Operators of a training-data pipeline: url and text filters, duplicate removal, search and tokens.

Every module holds one operator with its own general interface; ``queries`` registers the
queries that apply them to whole tables. Nothing else in the library imports this package.
"""

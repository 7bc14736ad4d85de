"""Operators of a training-data pipeline over documents, pages and conversations.

Nothing else in the package imports this folder.
"""

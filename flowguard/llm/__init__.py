"""Operators of a training-data pipeline over documents, embeddings, labels and benchmark items.

One module per operator; ``queries`` registers one query per operator over its whole table.
Nothing else in the library imports this subpackage.
"""

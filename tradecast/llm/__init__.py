"""Operators of a training-data pipeline over the ``documents``, ``labels`` and
``embeddings`` tables.

One module per operator; ``queries`` registers the thin ``opN_*`` queries.
Nothing else in the library imports this package.
"""

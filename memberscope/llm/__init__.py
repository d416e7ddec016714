"""Training-data operators: tokens, packing, search, filters and near
duplicates over the ``documents``, ``pages`` and ``embeddings`` tables.

Nothing outside this package imports it; ``__spark_entry__`` adds its queries
when the package is present.
"""

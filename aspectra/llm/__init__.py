"""Training-data operators: search, near-duplicates, filters, mixing, packing, web archives.

Nothing outside this package imports it; ``queries.py`` holds the registered queries and
``corpus_pipeline.py`` at the top of the repository chains five of the operators.
"""

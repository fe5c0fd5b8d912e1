"""Training-data operators: one module per operator, ``queries`` holds the registered queries.

Nothing outside this package imports it; ``corpus_pipeline.py`` and ``__spark_entry__.py`` use it.
"""

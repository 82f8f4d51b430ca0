"""Training-data operators: one module an operator, queries in ``registry``.

Nothing outside this subpackage (and ``corpus_pipeline.py``) imports it.
"""

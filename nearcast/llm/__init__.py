"""Operators of a large-scale training-data pipeline (documents, pages, embeddings).

One module per operator; ``queries.py`` registers one query per operator.
Nothing outside this package (and ``corpus_pipeline.py``) imports it.
"""

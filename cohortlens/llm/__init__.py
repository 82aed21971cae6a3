"""Training-data operators: mixing, near-duplicates, nearest neighbours, toxicity,
n-gram scoring, secrets, packing, WARC, language and exact search.

Nothing outside this subpackage (and ``corpus_pipeline.py``) imports it.
"""

"""Operators for large text corpora: cleaning, deduplication, search and mixing.

Nothing outside this package imports it; its queries are listed in
``fathomseq.llm.queries``.
"""

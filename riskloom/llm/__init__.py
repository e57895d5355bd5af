"""Operators of a training-data pipeline: one module per operator.

``decontaminate`` (1), ``licenses`` (2), ``token_counts`` (3),
``quality`` (4), ``token_files`` (5), ``simhash`` (6), ``suffix_dedup``
(7), ``bm25_packing`` (8), ``warc`` (9), ``toxicity`` (10),
``ranked_search`` (11), ``conversation_trie`` (12), ``langid`` (13). The
thin registered queries live in ``queries``, their DuckDB SQL in
``oracle``. Nothing outside this package imports it.
"""

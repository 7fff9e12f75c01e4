"""Operators of a training-data pipeline. Nothing else in the library imports this package.

Each module holds one operator with a general interface and the thin ``opN_`` query over the given
tables. ``load()`` returns all queries and the SQL of those that SQL can express.
"""

import importlib

MODULES = {
    "suffix_dedup": "op1_suffix_array_dedup",
    "warc": "op2_warc",
    "bpe": "op3_bpe",
    "jaccard": "op4_ngram_jaccard",
    "substring": "op5_substring_dedup",
    "quality": "op6_quality_classifier",
    "decontaminate": "op7_decontamination",
    "token_counts": "op8_token_counts",
    "secrets": "op9_secret_scans",
    "neighbours": "op10_neighbours",
    "prefix_trie": "op11_prefix_trie",
    "mixing": "op12_source_mix",
    "collocations": "op13_collocations",
}


def load():
    """(queries, oracles) of this package."""
    queries, oracles = {}, {}
    for module, name in MODULES.items():
        m = importlib.import_module(f"voltide.llm.{module}")
        queries[name] = m.query
        if getattr(m, "ORACLE_SQL", None):
            oracles[name] = m.ORACLE_SQL
    return queries, oracles

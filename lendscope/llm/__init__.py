"""Operators of a training-data pipeline, with their check queries and oracle SQL.

The subpackage is self-contained: nothing else in the library imports it.
"""

from . import (
    ann,
    bpe,
    centroids,
    collocations,
    exact_dedup,
    near_dedup,
    packing,
    piece_bpe,
    quality,
    sharding,
    substring_dedup,
    token_counts,
    token_output,
)

_MODULES = (bpe, token_counts, packing, exact_dedup, quality, substring_dedup, sharding, token_output, ann, near_dedup,
            collocations, centroids, piece_bpe)


def queries():
    return {name: fn for m in _MODULES for name, (fn, _) in m.QUERIES.items()}


def oracle_sql():
    return {name: sql for m in _MODULES for name, (_, sql) in m.QUERIES.items() if sql}

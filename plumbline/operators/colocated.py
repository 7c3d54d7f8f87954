"""Two tables stored in buckets of their common key, so that joins on it shuffle neither.

Buckets alone would put all rows of a hot key in one task, and adaptive
execution splits shuffles only. So a bucket is made of (key, piece): the rows of
a hot key are dealt over as many pieces as it has ``HOT_ROWS``, and its lookup
row is stored once for each of them. Every other key has the single piece 0.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame

from plumbline.operators.salting import HOT_ROWS, HotKeys, dealt, repeated
from plumbline.sources.tables import TableStore

PIECE = "_piece"


def colocate(
    store: TableStore,
    rows: tuple[str, DataFrame],
    lookup: tuple[str, DataFrame],
    key: str,
    spread_by: Column,
    buckets: int,
    hot_rows: int = HOT_ROWS,
    further: Sequence[tuple[str, DataFrame]] = (),
) -> tuple[DataFrame, ...]:
    """Stores the named tables in ``buckets`` by ``key`` and piece and returns them as stored.

    ``rows`` may have many rows of a key, ``lookup`` and the ``further`` lookups few. The hot keys of
    ``rows`` are counted once and stored beside them. Rows without a key are
    kept and meet nothing.
    """
    hot = HotKeys.find(rows[1], key, store.keep, f"hot_keys.{rows[0].replace('.', '_')}", hot_rows)
    by = (key, PIECE)
    pieces = dealt(rows[1], key, spread_by, PIECE, hot, hot_rows)
    copies = [(name, repeated(found, key, PIECE, hot, hot_rows)) for name, found in (lookup, *further)]
    return tuple(
        store.replace(name, placed, buckets=buckets, bucket_by=by) for name, placed in [(rows[0], pieces), *copies]
    )


def common_key(left: DataFrame, right: DataFrame, key: str) -> list[str]:
    """The columns to join two frames on: ``key``, and the piece where both are stored by it."""
    return [key, PIECE] if PIECE in left.columns and PIECE in right.columns else [key]

"""Corpus-wide lookups of many small keys, packed in few rows.

Documents are dealt to batches by a hash of the row. A batch sends its distinct
keys to buckets of the key space, as arrays; a bucket sees every batch's keys
and answers each batch in the order it asked. So a key that a third of all
documents hold costs a bucket one entry per batch, and the engine moves a few
rows per batch and bucket instead of one per key. Both numbers follow the bytes
of text, so neither a batch nor a bucket grows with the corpus.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from plumbline.llm.tables import row_hash

BATCH = "__batch"


def text_bytes(docs: DataFrame, text: str) -> int:
    size = F.octet_length(F.col(text)).cast("bigint")
    return int(docs.agg(F.sum(size)).first()[0] or 0)


def parts(total: int, each: int) -> int:
    return max(1, -(-total // each))


def batch_of(docs: DataFrame, batches: int) -> Column:
    """Batch of a row. Repeated rows share one; no other value decides alone."""
    return F.pmod(row_hash(*[F.col(f"`{c}`") for c in docs.columns]), F.lit(batches)).cast("int")


def bucket_of(hashes: np.ndarray, buckets: int) -> np.ndarray:
    """Bucket of each key from its high bits, the low 32 being left to tell keys apart."""
    return ((hashes >> np.uint64(40)) * np.uint64(buckets)) >> np.uint64(24)


def bucket_bounds(sorted_buckets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Buckets present and where each begins, with the end appended."""
    first = np.ones(len(sorted_buckets), dtype=bool)
    first[1:] = sorted_buckets[1:] != sorted_buckets[:-1]
    at = np.flatnonzero(first)
    return sorted_buckets[at], np.append(at, len(sorted_buckets))


def squeezed(array: np.ndarray) -> bytes:
    return pa.compress(array.tobytes(), codec="zstd", asbytes=True)


def loose(data: bytes, size: int, kind) -> np.ndarray:
    """The ``size`` values of an array that ``squeezed`` packed."""
    kind = np.dtype(kind)
    return np.frombuffer(pa.decompress(data, size * kind.itemsize, codec="zstd", asbytes=True), kind)

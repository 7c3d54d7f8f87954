"""Stupid-backoff scores of documents from counts over all other documents."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F, types as T

from plumbline.llm import exchange, packed

_ORDER = packed.mix64(np.arange(1, 17, dtype=np.uint64))  # tells orders apart


def _spare_bits(buckets: int) -> np.uint64:
    """Low bits of a key that need not travel: its bucket and 48 bits more tell it apart."""
    return np.uint64(max(0, 16 - (buckets.bit_length() - 1)))


def _planes(array: np.ndarray) -> bytes:
    """``array`` packed byte place by byte place, as high bytes are mostly alike."""
    return exchange.squeezed(np.ascontiguousarray(array.view(np.uint8).reshape(-1, array.itemsize).T))


def _read_planes(data: bytes, size: int, kind) -> np.ndarray:
    width = np.dtype(kind).itemsize
    flat = exchange.loose(data, size * width, np.uint8).reshape(width, size)
    return np.ascontiguousarray(flat.T).reshape(-1).view(kind)


def _ascending(keys: np.ndarray) -> bytes:
    """Sorted keys as their differences: the low four bytes as they are, the high ones packed."""
    steps = np.diff(keys, prepend=np.uint64(0))
    low, high = steps.astype(np.uint32), (steps >> np.uint64(32)).astype(np.uint32)
    return len(keys).to_bytes(8, "little") + low.tobytes() + _planes(high)


def _read_ascending(data: bytes) -> np.ndarray:
    size = int.from_bytes(data[:8], "little")
    low = np.frombuffer(data, np.uint32, size, 8).astype(np.uint64)
    high = _read_planes(data[8 + 4 * size :], size, np.uint32).astype(np.uint64)
    return np.cumsum(high << np.uint64(32) | low, dtype=np.uint64)


class _Grams:
    """The n-grams of a batch of texts: distinct keys, and the key at each place."""

    def __init__(self, table: pa.Table, text: str, order: int):
        column = table.column(text).combine_chunks()
        data, offsets = packed.utf8(column if isinstance(column, pa.Array) else pa.array([], pa.string()))
        data = packed.LOWER[data]
        starts, ends, self.firsts = packed.spans(data, offsets, packed.WORD[data])
        words = packed.span_hashes(data, starts, ends)
        self.text = packed.owners(self.firsts)
        n = len(words)
        hashes = [np.full(n, _ORDER[0])]  # order 0: every word
        self.ok = [np.ones(n, dtype=bool)]
        for size in range(1, order + 1):
            # The gram that ends at a place, where its text has begun by then.
            grams = np.zeros(n, np.uint64)
            found = packed.window_hashes(words, size)
            grams[size - 1 :] = packed.mix64(found ^ _ORDER[size])
            self.ok.append(np.arange(n) - self.firsts[:-1][self.text] >= size - 1)
            hashes.append(grams)
        flat = np.concatenate([h[ok] for h, ok in zip(hashes, self.ok)])
        self.keys, inverse, self.counts = np.unique(flat, return_inverse=True, return_counts=True)
        inverse = inverse.reshape(-1)
        self.at = []
        for ok in self.ok:
            place = np.full(n, -1)
            place[ok], inverse = inverse[: int(ok.sum())], inverse[int(ok.sum()) :]
            self.at.append(place)

    def by_bucket(self, buckets: int):
        return exchange.bucket_bounds(exchange.bucket_of(self.keys, buckets))

    def own(self, size: int) -> np.ndarray:
        """How often the text itself has the gram at each place."""
        ok = self.ok[size]
        pair = self.text[ok] * len(self.keys) + self.at[size][ok]
        _, inverse, counts = np.unique(pair, return_inverse=True, return_counts=True)
        out = np.zeros(len(ok), dtype=np.int64)
        out[ok] = counts[inverse.reshape(-1)]
        return out


def _count(text: str, order: int, buckets: int):
    def run(table: pa.Table) -> pa.Table:
        batch = table.column(exchange.BATCH)[0].as_py()
        grams = _Grams(table, text, order)
        names, bounds = grams.by_bucket(buckets)
        keys = grams.keys >> _spare_bits(buckets)
        counts = grams.counts.astype(np.uint32)
        return pa.table(
            {
                "bucket": pa.array(names.astype(np.int32)),
                "batch": pa.array(np.full(len(names), batch, np.int32)),
                "keys": pa.array([_ascending(keys[a:b]) for a, b in zip(bounds, bounds[1:])], pa.binary()),
                "counts": pa.array([_planes(counts[a:b]) for a, b in zip(bounds, bounds[1:])], pa.binary()),
            }
        )

    return run


def _add(table: pa.Table) -> pa.Table:
    keys, counts = [], []
    for packed_keys, n in zip(table.column("keys").to_pylist(), table.column("counts").to_pylist()):
        keys.append(_read_ascending(packed_keys))
        counts.append(_read_planes(n, len(keys[-1]), np.uint32))
    _, inverse = np.unique(np.concatenate(keys), return_inverse=True)
    inverse = inverse.reshape(-1)
    total = np.zeros(int(inverse.max()) + 1, dtype=np.int64)
    np.add.at(total, inverse, np.concatenate(counts).astype(np.int64))
    first = np.concatenate([[0], np.cumsum([len(k) for k in keys])])
    answers = [_planes(total[inverse[a:b]]) for a, b in zip(first, first[1:])]
    return pa.table({"batch": table.column("batch"), "bucket": table.column("bucket"), "totals": pa.array(answers, pa.binary())})


def _score(text: str, order: int, buckets: int, penalty: float, names: list[str]):
    def run(table: pa.Table, answers: pa.Table) -> pa.Table:
        out = {name: table.column(name) for name in names}
        if not table.num_rows:
            none = pa.array([], pa.int64())
            return pa.table({**out, "n_words": none, "n_backed_off": none, "score": pa.array([], pa.float64())})
        grams = _Grams(table, text, order)
        told = dict(zip(answers.column("bucket").to_pylist(), answers.column("totals").to_pylist()))
        names_, bounds = grams.by_bucket(buckets)
        totals = np.zeros(len(grams.keys), dtype=np.int64)
        for name, a, b in zip(names_, bounds, bounds[1:]):
            totals[a:b] = _read_planes(told[int(name)], b - a, np.int64)
        # Counts in the other texts, of each gram that ends at a place.
        others = [np.where(ok, totals[at] - grams.own(k), 0) for k, (at, ok) in enumerate(zip(grams.at, grams.ok))]
        context = [others[0]] + [np.concatenate([[0], c[:-1]]) for c in others[1:]]
        n_words = np.diff(grams.firsts)
        value = np.zeros(len(grams.text))
        open_ = np.ones(len(grams.text), dtype=bool)
        factor = np.ones(len(grams.text))
        backed_off = np.zeros(len(grams.text), dtype=bool)
        for size in range(order, 0, -1):
            fits = open_ & grams.ok[size]
            seen = fits & (others[size] > 0)
            below = others[0] if size == 1 else context[size - 1]
            value[seen] = factor[seen] * others[size][seen] / below[seen]
            open_ &= ~seen
            factor[fits & ~seen] *= penalty
            if size == order:
                backed_off = fits & ~seen
        value[open_] = factor[open_] / (others[0][open_] + 1)
        logs = np.zeros(len(value) + 1)
        np.cumsum(np.log(value), out=logs[1:])
        sums = [np.log(value[a:b]).sum() for a, b in zip(grams.firsts, grams.firsts[1:])]
        mean = [None if n == 0 else float(s / n) for s, n in zip(sums, n_words)]
        out["n_words"] = pa.array(n_words)
        out["n_backed_off"] = pa.array(packed.sums(backed_off, grams.firsts))
        out["score"] = pa.array(mean, pa.float64())
        return pa.table(out)

    return run


def score(
    docs: DataFrame,
    text: str = "text",
    order: int = 2,
    penalty: float = 0.4,
    batch_bytes: int = 4 * 2**20,
    bucket_bytes: int = 4 * 2**20,
) -> DataFrame:
    """Columns of ``docs`` but the text, with ``n_words``, ``n_backed_off`` and ``score``.

    ``score`` is the mean natural logarithm of stupid backoff over the words of
    a text (lower-cased, split at white space). A word's gram counts in all
    other rows divided by its context's counts there; a gram unseen elsewhere
    goes to the next shorter one times ``penalty``, and a word unseen
    elsewhere counts 1 among all words. ``n_backed_off`` counts grams of full
    order that are unseen elsewhere. Input columns so named are replaced.

    All rows enter the counts, copies too, and a row's own counts are taken
    out of its score. Count tables are partitioned by the hash of the gram and
    joined to each batch's distinct grams. NULL and empty texts have no words
    and a NULL score. ``docs`` must be the same rows whenever it is read.
    """
    added = ["n_words", "n_backed_off", "score"]
    docs = docs.select(*[F.col(f"`{c}`") for c in docs.columns if c.lower() not in added])
    total = exchange.text_bytes(docs, text)
    batches, buckets = exchange.parts(total, batch_bytes), exchange.parts(total, bucket_bytes)
    by_batch = docs.withColumn(exchange.BATCH, exchange.batch_of(docs, batches)).groupBy(exchange.BATCH)
    counted = by_batch.applyInArrow(
        _count(text, order, buckets), "bucket int, batch int, keys binary, counts binary"
    )
    totals = counted.groupBy("bucket").applyInArrow(_add, "batch int, bucket int, totals binary")
    kept = [field for field in docs.schema.fields if field.name != text]
    schema = T.StructType(
        kept
        + [T.StructField("n_words", T.LongType()), T.StructField("n_backed_off", T.LongType()), T.StructField("score", T.DoubleType())]
    )
    return by_batch.cogroup(totals.groupBy("batch")).applyInArrow(
        _score(text, order, buckets, penalty, [f.name for f in kept]), schema
    )

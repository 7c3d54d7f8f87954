"""Ranked lexical search: item tiles times document tiles, as dense float64 products.

One pass over the documents keeps, per document, its number of terms and the
counts of those terms that any item holds. A second one, over that small table,
scores: the terms of a tile of items form a compact vocabulary; the impacts of a
tile of documents fill a dense matrix over it; one BLAS product gives the
scores of all pairs of the two tiles. Weights and impacts are integers, and the
vocabulary of a tile is cut where the sum of an item's products could reach
2**53, so each product is exact whatever order BLAS adds in.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F, types as T

from plumbline.llm import packed, words
from plumbline.llm.tables import row_hash, stored

MOST_IMPACT = 10**6  # an impact is below it
_EXACT = 2**53 - 1
_TILE_ITEMS = 256
_TILE_COLUMNS = 4096
_TILE_DOCUMENTS = 512
_MERGE_WAYS = 64


@dataclass
class Tile:
    """Weights of some items (rows) for some terms (columns, sorted), small enough to add up exactly."""

    items: np.ndarray
    terms: np.ndarray
    weights: np.ndarray


def tiles(counts: list[dict[int, int]], weight: np.ndarray, limit: int = _EXACT // MOST_IMPACT) -> list[Tile]:
    """Tiles over all items, ``counts`` being the terms of each with repeats.

    Within a tile the weights of an item add up to ``limit`` at most. A term
    whose repeats alone weigh more is dealt to several tiles. Tiles of the same
    items follow one another; their products are added as integers.
    """
    out = []
    for first in range(0, len(counts), _TILE_ITEMS):
        numbers = np.arange(first, min(first + _TILE_ITEMS, len(counts)))
        columns: list[tuple[int, dict[int, int]]] = []  # term, weight by item
        by_term: dict[int, dict[int, int]] = {}
        for row, number in enumerate(numbers):
            for term, n in counts[number].items():
                by_term.setdefault(term, {})[row] = n
        for term in sorted(by_term):
            left, each = by_term[term], int(weight[term])
            if each == 0:
                continue
            most = max(1, limit // each)
            while left:
                columns.append((term, {row: min(n, most) * each for row, n in left.items()}))
                left = {row: n - most for row, n in left.items() if n > most}
        at = 0
        while at < len(columns) or at == 0:
            sums, end, seen = Counter(), at, set()
            while end < len(columns) and end - at < _TILE_COLUMNS and columns[end][0] not in seen:
                more = columns[end][1]
                if end > at and any(sums[row] + w > limit for row, w in more.items()):
                    break
                sums.update(more)
                seen.add(columns[end][0])
                end += 1
            dense = np.zeros((len(numbers), end - at))
            for place, (_, more) in enumerate(columns[at:end]):
                for row, w in more.items():
                    dense[row, place] = w
            out.append(Tile(numbers, np.array([t for t, _ in columns[at:end]], np.int64), dense))
            at = end
            if at >= len(columns):
                break
    return out


def _count_terms(known, doc_id: str, text: str):
    """Per document with terms: their number, and the counts of those that an item holds."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        get = known.value.get
        n_known = max(1, len(known.value))
        for whole in batches:
            for batch in packed.chunks(whole, text):
                sizes, found = [], []
                for owner, document in enumerate(batch.column(text).to_pylist()):
                    size = 0
                    for piece in words.pieces(document):
                        size += len(piece)
                        numbers = np.fromiter((get(w, -1) for w in piece), np.int64, len(piece))
                        found.append(numbers[numbers >= 0] + owner * n_known)
                    sizes.append(size)
                keys, tf = np.unique(np.concatenate(found) if found else np.zeros(0, np.int64), return_counts=True)
                ends = np.searchsorted(keys, np.arange(len(sizes) + 1) * n_known)
                columns = [
                    batch.column(doc_id),
                    pa.array(sizes, pa.int64()),
                    pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(keys % n_known, pa.int32())),
                    pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(tf, pa.int64())),
                ]
                out = pa.RecordBatch.from_arrays(columns, names=["id", "n", "terms", "tf"])
                yield out.filter(pa.array(np.array(sizes) > 0))

    return run


def impacts(tf: np.ndarray, n: np.ndarray, documents: int, length: int) -> np.ndarray:
    """Impact of a term that occurs ``tf`` times among ``n``, in units of ``MOST_IMPACT``."""
    if len(n) and int(n.max()) * 75 * documents >= 2**63:  # beyond 64 bits: with Python's integers
        share = np.array([75 * int(x) * documents // length for x in n], np.int64)
    else:
        share = 75 * n * documents // length
    return (1_000_000_000 * tf) // (1000 * tf + 8 * (100 - 75 + share))


class _Best:
    """The k best of each item so far: higher scores first, then lower ids, NULL last."""

    def __init__(self, items: int, k: int):
        self.k = k
        self.kept: list[list[tuple]] = [[] for _ in range(items)]
        self.least = np.ones(items, np.int64)  # a candidate must reach it

    def add(self, items: np.ndarray, scores: np.ndarray, ids: list) -> None:
        """Scores of a tile of documents in the order of their ids."""
        for row in np.flatnonzero((scores >= self.least[items][:, None]).any(axis=1)):
            item = int(items[row])
            places = np.flatnonzero(scores[row] >= self.least[item])
            places = places[np.argsort(-scores[row, places], kind="stable")][: self.k]
            more = [(-int(scores[row, p]), ids[p] is None, ids[p]) for p in places]
            best = sorted([*self.kept[item], *more], key=lambda e: e[:2] if e[1] else e)[: self.k]
            self.kept[item] = best
            if len(best) == self.k:
                self.least[item] = -best[-1][0]


def _score(known, k: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        plan = known.value
        best = _Best(plan["items"], k)
        kind = None
        for whole in batches:
            kind = whole.column("id").type
            for at in range(0, whole.num_rows, _TILE_DOCUMENTS):
                batch = whole.slice(at, _TILE_DOCUMENTS)
                ids = batch.column("id").to_pylist()
                order = sorted(range(len(ids)), key=lambda i: (1,) if ids[i] is None else (0, ids[i]))
                batch = batch.take(pa.array(order, pa.int64()))
                ids = [ids[i] for i in order]
                sizes = np.array(batch.column("terms").value_lengths(), np.int64)
                owner = np.repeat(np.arange(len(ids)), sizes)
                terms = np.array(batch.column("terms").flatten(), np.int64)
                n = np.array(batch.column("n"), np.int64)
                impact = impacts(np.array(batch.column("tf").flatten(), np.int64), n[owner], *plan["corpus"])
                scores = None
                for number, tile in enumerate(plan["tiles"]):
                    if len(tile["terms"]):
                        place = np.minimum(np.searchsorted(tile["terms"], terms), len(tile["terms"]) - 1)
                        here = tile["terms"][place] == terms
                        dense = np.zeros((len(tile["terms"]), len(ids)))
                        dense[place[here], owner[here]] = impact[here]
                        part = (tile["weights"] @ dense).astype(np.int64)
                    else:
                        part = np.zeros((len(tile["items"]), len(ids)), np.int64)
                    scores = part if scores is None else scores + part
                    following = plan["tiles"][number + 1] if number + 1 < len(plan["tiles"]) else None
                    if following is None or following["items"][0] != tile["items"][0]:
                        best.add(tile["items"], scores, ids)
                        scores = None
        found = [(item, e[2], -e[0]) for item, kept in enumerate(best.kept) for e in kept]
        if found:
            columns = [pa.array([f[0] for f in found], pa.int64()), pa.array([f[1] for f in found], kind)]
            yield pa.RecordBatch.from_arrays([*columns, pa.array([f[2] for f in found], pa.int64())], names=["item", "id", "score"])

    return run


def _item_words(text: str | None) -> Counter:
    found = Counter()
    for piece in words.pieces(text):
        found.update(piece)
    return found


def _search_block(docs: DataFrame, items: list[tuple], doc_id: str, text: str, k: int) -> DataFrame:
    spark = docs.sparkSession
    number: dict[bytes, int] = {}
    counts = [
        {number.setdefault(word, len(number)): n for word, n in _item_words(item_text).items()} for _, item_text in items
    ]
    id_type = docs.schema[doc_id].dataType
    schema = T.StructType(
        [
            T.StructField("id", id_type),
            T.StructField("n", T.LongType()),
            T.StructField("terms", T.ArrayType(T.IntegerType())),
            T.StructField("tf", T.ArrayType(T.LongType())),
        ]
    )
    narrow = docs.select(F.col(f"`{doc_id}`"), F.col(f"`{text}`"))
    counted = stored(
        narrow.mapInArrow(_count_terms(spark.sparkContext.broadcast(number), doc_id, text), schema), "search-terms"
    )
    n_docs, length = counted.agg(F.count("*"), F.sum("n")).first()
    holders = counted.select(F.explode("terms").alias("term")).groupBy("term").count().collect()
    weight = np.zeros(max(1, len(number)), np.int64)
    for term, df in holders:
        weight[term] = math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df + 1)))
    plan = {
        "items": len(items),
        "corpus": (int(n_docs), int(length or 1)),
        "tiles": [vars(tile) for tile in tiles(counts, weight)],
    }
    kept = T.StructType(
        [T.StructField("item", T.LongType()), T.StructField("id", id_type), T.StructField("score", T.LongType())]
    )
    found = counted.where(F.size("terms") > 0).mapInArrow(_score(spark.sparkContext.broadcast(plan), k), kept)
    order = [F.desc("score"), F.asc_nulls_last("id")]
    found = found.withColumn("way", F.pmod(F.spark_partition_id(), F.lit(_MERGE_WAYS)))
    for keys in (["item", "way"], ["item"]):
        found = found.withColumn("rank", F.row_number().over(Window.partitionBy(*keys).orderBy(*order)))
        found = found.where(F.col("rank") <= k)
    return found.drop("way")


def search(
    docs: DataFrame,
    items: DataFrame,
    k: int = 10,
    doc_id: str = "doc_id",
    text: str = "text",
    item_id: str = "item_id",
    item_text: str = "text",
    most_words: int = 500_000,
) -> DataFrame:
    """The ``k`` best documents of every item: item_id, rank (from 1), doc_id, score (long).

    All documents are scored for all items. Equal scores go by ascending id,
    NULL ids last; a document without any term of an item has no row for it.
    Repeated documents all count and may all be found; items equal in id and
    text count once, items of one id and different texts are ranked apart.
    NULL and empty texts hold no term; empty tables give no rows.

    Items go to the executors in blocks of about ``most_words`` words, as many
    blocks as it takes, each with a pass over the documents; statistics cover
    all documents. A task keeps ``k`` rows an item, and these are merged in two
    steps, so no task sees an item's rows of all tasks at once. Nothing is
    broadcast that grows with the documents.
    """
    picked = items.select(F.col(f"`{item_id}`").alias("item_id"), F.col(f"`{item_text}`").alias("text")).distinct()
    per_text = F.size(F.split(F.coalesce("text", F.lit("")), "[^0-9A-Za-z\\x{80}-\\x{10FFFF}]+")).cast("bigint")
    blocks = max(1, -(-int(picked.agg(F.sum(per_text)).first()[0] or 0) // most_words))
    out = None
    for block in range(blocks):
        part = picked.where(F.pmod(row_hash("item_id", "text"), F.lit(blocks)) == block)
        rows = [(row["item_id"], row["text"]) for row in part.collect()]
        id_type = picked.schema["item_id"].dataType
        names = docs.sparkSession.createDataFrame(
            [(i, row[0]) for i, row in enumerate(rows)],
            T.StructType([T.StructField("item", T.LongType()), T.StructField("item_id", id_type)]),
        )
        found = _search_block(docs, rows, doc_id, text, k).join(names, "item")
        found = found.select("item_id", F.col("rank").cast("int").alias("rank"), F.col("id").alias("doc_id"), "score")
        out = found if out is None else out.unionByName(found)
    return out

"""Importance resampling: documents drawn by how much their n-grams resemble a target.

Features are hashed by CRC-32. Words that are frequent in the corpus have their
exact CRC states broadcast, and pairs of the most frequent ones their states and
buckets; every other feature takes its CRC directly, by running the register
over the bytes that follow. Both ways give the same buckets, so totals are exact
whatever the head holds.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F, types as T

from plumbline.llm import packed, words
from plumbline.llm.tables import stored

BUCKETS = 10_000
HEAD_WORDS = 4096
PAIR_WORDS = 1024
LEAST_WORDS = 20
_TABLE_LENGTHS = 64
_FLUSH_WORDS = 2_000_000


# --- CRC-32 of joined strings -------------------------------------------------


def _byte_table() -> np.ndarray:
    table = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        table = np.where(table & 1, (table >> 1) ^ np.uint32(0xEDB88320), table >> 1)
    return table


def _through(tables: np.ndarray, x: np.ndarray) -> np.ndarray:
    """Registers ``x`` moved by one linear map, given as its images of four single bytes."""
    return tables[0][x & 255] ^ tables[1][(x >> 8) & 255] ^ tables[2][(x >> 16) & 255] ^ tables[3][x >> 24]


def _moves() -> tuple[np.ndarray, np.ndarray]:
    """Maps of a register over 0 to 64 zero bytes, and over 2**k of them."""
    bytes_, unit = _byte_table(), np.arange(256, dtype=np.uint32)
    near = [np.stack([unit << np.uint32(8 * k) for k in range(4)])]
    for _ in range(_TABLE_LENGTHS):
        near.append(bytes_[near[-1] & 255] ^ (near[-1] >> 8))
    far = [near[1]]
    for _ in range(32):
        far.append(_through(far[-1], far[-1]))
    return np.stack(near), np.stack(far)


NEAR, FAR = _moves()
_FLAT = NEAR.ravel()


def moved(state: np.ndarray, length: np.ndarray) -> np.ndarray:
    """CRC states after ``length`` further zero bytes each; XOR the CRC of the real bytes to append them."""
    near = np.minimum(length, _TABLE_LENGTHS)
    at = near * 1024
    out = _FLAT[at + (state & 255)]
    out ^= _FLAT[at + 256 + ((state >> 8) & 255)]
    out ^= _FLAT[at + 512 + ((state >> 16) & 255)]
    out ^= _FLAT[at + 768 + (state >> 24)]
    rest = np.flatnonzero(length > _TABLE_LENGTHS)
    if len(rest):
        more, part = (length - near)[rest], out[rest]
        for k in range(int(more.max()).bit_length()):
            odd = (more >> k) & 1 == 1
            part[odd] = _through(FAR[k], part[odd])
        out[rest] = part
    return out


_BLANK = np.uint32(crc32(b" "))


# --- features -----------------------------------------------------------------


def _find_head(text: str, share: int):
    """Per task, the words that make up one in ``share`` of its words, with their counts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen, n = Counter(), 0

        def frequent() -> pa.RecordBatch:
            kept = [(w, c) for w, c in seen.items() if c * share >= n]
            columns = [pa.array([w for w, _ in kept], pa.binary()), pa.array([c for _, c in kept], pa.int64())]
            return pa.RecordBatch.from_arrays(columns, names=["word", "n"])

        for batch in batches:
            for document in batch.column(text).to_pylist():
                for piece in words.pieces(document):
                    seen.update(piece)
                    n += len(piece)
                if n > _FLUSH_WORDS:
                    yield frequent()
                    seen, n = Counter(), 0
        if n:
            yield frequent()

    return run


def head_words(docs: DataFrame, text: str = "text", most: int = HEAD_WORDS) -> list[bytes]:
    """The most frequent words over all documents, at most ``most``.

    A word that makes up one in 4 * ``most`` of all words does so in some task,
    so no such word is missed. The choice costs or saves time and changes no result.
    """
    found = docs.select(F.col(f"`{text}`")).mapInArrow(_find_head(text, 4 * most), "word binary, n bigint")
    top = found.groupBy("word").agg(F.sum("n").alias("n")).orderBy(F.desc("n"), "word").limit(most)
    return [bytes(row["word"]) for row in top.collect()]


def head_tables(head: list[bytes], pair_words: int = PAIR_WORDS, buckets: int = BUCKETS) -> dict:
    """CRC states of the head's words, and states and buckets of all pairs of its first ones."""
    state = np.array([crc32(w) for w in head], np.uint32)
    length = np.array([len(w) for w in head], np.int64)
    after_blank = _after_blank(state, length)
    n = min(pair_words, len(head))
    first, second = np.repeat(np.arange(n), n), np.tile(np.arange(n), n)
    pairs = moved(state[first], 1 + length[second]) ^ after_blank[second]
    return {
        "number": {w: i for i, w in enumerate(head)}, "state": state, "length": length, "after_blank": after_blank,
        "pair_words": n, "pair_state": pairs, "pair_bucket": (pairs % np.uint32(buckets)).astype(np.int16 if buckets < 2**15 else np.int64),
    }


def _after_blank(state: np.ndarray, length: np.ndarray) -> np.ndarray:
    """CRC of a blank and the word."""
    return moved(np.full(len(state), _BLANK), length) ^ state


def features(texts: list[str | None], head: dict, buckets: int = BUCKETS) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Words of each text, and the bucket and text of every run of one to three words."""
    get = head["number"].get
    counts, numbers, states, lengths = [], [], [], []
    for document in texts:
        n = 0
        for piece in words.pieces(document):
            n += len(piece)
            number = np.fromiter((get(w, -1) for w in piece), np.int64, len(piece))
            state, length = np.empty(len(piece), np.uint32), np.empty(len(piece), np.int64)
            known = number >= 0
            state[known], length[known] = head["state"][number[known]], head["length"][number[known]]
            tail = [piece[i] for i in np.flatnonzero(~known)]
            state[~known] = np.fromiter(map(crc32, tail), np.uint32, len(tail))
            length[~known] = np.fromiter(map(len, tail), np.int64, len(tail))
            numbers.append(number)
            states.append(state)
            lengths.append(length)
        counts.append(n)
    n_words = np.array(counts, np.int64)
    if not numbers:
        return n_words, np.zeros(0, np.int64), np.zeros(0, np.int64), n_words
    number, state, length = np.concatenate(numbers), np.concatenate(states), np.concatenate(lengths)
    owner = np.repeat(np.arange(len(n_words)), n_words)
    tail = np.flatnonzero(number < 0)
    after_blank = np.empty(len(number), np.uint32)
    known = np.flatnonzero(number >= 0)
    after_blank[known] = head["after_blank"][number[known]]
    after_blank[tail] = _after_blank(state[tail], length[tail])
    size = np.uint32(buckets)
    out, of = [(state % size).astype(np.int64)], [owner]

    two = np.flatnonzero(owner[:-1] == owner[1:])
    low = head["pair_words"]
    frequent = (number[two] >= 0) & (number[two] < low) & (number[two + 1] >= 0) & (number[two + 1] < low)
    pair_state, pair_bucket = np.empty(len(number), np.uint32), np.empty(len(number), np.int64)
    at = two[frequent]
    key = number[at] * low + number[at + 1]
    pair_state[at], pair_bucket[at] = head["pair_state"][key], head["pair_bucket"][key]
    at = two[~frequent]
    pair_state[at] = moved(state[at], 1 + length[at + 1]) ^ after_blank[at + 1]
    pair_bucket[at] = pair_state[at] % size
    out.append(pair_bucket[two])
    of.append(owner[two])

    three = np.flatnonzero(owner[:-2] == owner[2:])
    last = moved(pair_state[three], 1 + length[three + 2]) ^ after_blank[three + 2]
    out.append((last % size).astype(np.int64))
    of.append(owner[three])
    return n_words, np.concatenate(out), np.concatenate(of), np.maximum(0, 3 * n_words - 3) + (n_words == 1)


def _total(known, text: str, buckets: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(buckets, np.int64)
        for whole in batches:
            for batch in packed.chunks(whole, text):
                total += np.bincount(features(batch.column(text).to_pylist(), known.value, buckets)[1], minlength=buckets)
        held = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(held, pa.int64()), pa.array(total[held], pa.int64())], names=["bucket", "n"])

    return run


def bucket_totals(docs: DataFrame, head, text: str = "text", buckets: int = BUCKETS) -> np.ndarray:
    """Features in each bucket over all documents. At most one row per bucket leaves a task."""
    counted = docs.select(F.col(f"`{text}`")).mapInArrow(_total(head, text, buckets), "bucket bigint, n bigint")
    out = np.zeros(buckets, np.int64)
    for row in counted.groupBy("bucket").agg(F.sum("n").alias("n")).collect():
        out[row["bucket"]] = row["n"]
    return out


def gains(corpus: np.ndarray, target: np.ndarray) -> np.ndarray:
    """Thousandths of the log ratio of each bucket's smoothed share in the target and in the corpus."""
    n, s, t = len(corpus), int(corpus.sum()), int(target.sum())
    return np.array(
        [math.floor(1000 * math.log((int(b) + 1) * (s + n) / ((int(a) + 1) * (t + n)))) for a, b in zip(corpus, target)],
        np.int64,
    )


def _weigh(known, text: str, names: list[str], buckets: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        head, gain = known.value["head"], known.value["gains"]
        for whole in batches:
            for batch in packed.chunks(whole, text):
                n_words, bucket, owner, n = features(batch.column(text).to_pylist(), head, buckets)
                order = np.argsort(owner, kind="stable")
                total = np.concatenate([[0], np.cumsum(gain[bucket[order]])])
                ends = np.concatenate([[0], np.cumsum(n)])
                weight = total[ends[1:]] - total[ends[:-1]]
                more = [pa.array(x, pa.int64()) for x in (n_words, n, weight)]
                columns = [batch.column(c) for c in names]
                yield pa.RecordBatch.from_arrays([*columns, *more], names=[*names, *_MEASURES])

    return run


_MEASURES = ["__ir_words", "__ir_features", "__ir_weight"]


def noise(doc_id: str, seed: int) -> Column:
    """Gumbel noise in thousandths, from the hash of the seed and the id; NULL counts as empty."""
    key = F.concat(F.lit(f"{seed}:"), F.coalesce(F.col(f"`{doc_id}`").cast("string"), F.lit("")))
    h = F.conv(F.substring(F.sha2(key, 256), 1, 8), 16, 10).cast("double")
    return F.floor(-1000 * F.log(-F.log((h + 0.5) / 4294967296.0))).cast("bigint")


def kth_largest(rows: DataFrame, value: str, k: int, bins: int = 1024) -> int | None:
    """The ``k``-th largest value of an integral column, by counts in ever finer bins."""
    low, high = rows.agg(F.min(value), F.max(value)).first()
    if low is None or k < 1:
        return None
    while low < high:
        width = -(-(high - low + 1) // bins)
        inside = rows.where(F.col(value).between(low, high))
        place = F.floor((F.col(value) - F.lit(low)) / F.lit(width)).cast("bigint")
        counts = dict(inside.groupBy(place.alias("bin")).count().collect())
        for at in sorted(counts, reverse=True):
            if k <= counts[at]:
                low, high = low + at * width, min(high, low + (at + 1) * width - 1)
                break
            k -= counts[at]
        else:
            return low
    return low


def ranked(rows: DataFrame, most: int, order: list[Column], name: str) -> DataFrame:
    """``rows`` with their place in ``order`` from 1, NULL beyond ``most``.

    One range exchange sorts; the rows of a task are numbered where they lie, and
    the counts of earlier tasks, a row for each, are added.
    """
    parts = max(1, int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    place = F.monotonically_increasing_id()  # task in the bits above 33, row below
    lying = rows.repartitionByRange(parts, *order).sortWithinPartitions(*order).withColumn("__place", place)
    lying = stored(lying, "ranked")
    task = F.shiftright("__place", 33)
    starts, total = {}, 0
    for row in sorted(lying.groupBy(task.alias("task")).count().collect()):
        starts[row["task"]] = total
        total += row["count"]
    first = F.lit(",".join(str(starts.get(i, 0)) for i in range(max(starts, default=-1) + 1)))
    first = F.get(F.split(first, ",").cast("array<bigint>"), task.cast("int"))
    at = first + F.col("__place").bitwiseAND(F.lit(2**33 - 1)) + 1
    return lying.withColumn(name, F.when(at <= most, at)).drop("__place")


def score(
    docs: DataFrame,
    target: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    target_text: str = "text",
    seed: int = 42,
    buckets: int = BUCKETS,
    most_head: int = HEAD_WORDS,
    keep: list[str] | None = None,
) -> DataFrame:
    """``docs`` with ``n_words``, ``n_features``, ``weight`` and ``score`` (all long).

    Words are runs of a-z, 0-9 and everything beyond ASCII after lower-casing
    A-Z; features all runs of one to three of them. ``weight`` sums the gains of
    a document's features, ``score`` adds Gumbel noise that the seed and the id
    decide. NULL and empty texts have no words and weight 0; NULL ids share one
    noise. Repeated rows are scored alike. Other columns stay, or those in
    ``keep``, which needs the id; input columns named like a result are
    replaced. With an empty target all gains come from the corpus alone.

    Three passes over the texts, none of them a shuffle of features: the head,
    the bucket totals, the weights. Driver and broadcasts hold the head and the
    buckets, whose sizes are parameters.
    """
    context = docs.sparkSession.sparkContext
    head = head_tables(head_words(docs, text, most_head), buckets=buckets)
    known = context.broadcast(head)
    corpus, wanted = (bucket_totals(f, known, t, buckets) for f, t in ((docs, text), (target, target_text)))
    known = context.broadcast({"head": head, "gains": gains(corpus, wanted)})
    results = ["n_words", "n_features", "weight", "score"]
    carried = [f for f in docs.drop(*results).schema.fields if keep is None or f.name in keep]
    names = [f.name for f in carried]
    schema = T.StructType([*carried, *(T.StructField(m, T.LongType()) for m in _MEASURES)])
    needed = docs.select(*[F.col(f"`{c}`") for c in dict.fromkeys([*names, text])])
    weighed = needed.mapInArrow(_weigh(known, text, names, buckets), schema)
    return weighed.withColumnsRenamed(dict(zip(_MEASURES, results))).withColumn(
        "score", F.col("weight") + noise(doc_id, seed)
    )


def resample(scored: DataFrame, percent: int = 5, least_words: int = LEAST_WORDS, doc_id: str = "doc_id") -> DataFrame:
    """Scored documents with ``rank`` (long): 1, 2, 3... for those drawn, else NULL.

    Of the documents with ``least_words`` words and more, ``percent`` of a
    hundred are drawn, rounded down: the highest scores, on a tie the lower id,
    NULL ids last. Drawing the highest of weight plus Gumbel noise is drawing
    without replacement in proportion to exp(weight). An input column ``rank``
    is replaced. Only rows that may be drawn are sorted.
    """
    rows = stored(scored.drop("rank"), "importance")
    may = rows.where(F.col("n_words") >= least_words)
    most = percent * may.count() // 100
    least = kth_largest(may, "score", most)
    if least is None:
        return rows.withColumn("rank", F.lit(None).cast("bigint"))
    order = [F.desc("score"), F.asc_nulls_last(f"`{doc_id}`")]
    reach = (F.col("n_words") >= least_words) & (F.col("score") >= F.lit(least))
    drawn = ranked(rows.where(reach), most, order, "rank")
    return rows.where(~reach).withColumn("rank", F.lit(None).cast("bigint")).unionByName(drawn)

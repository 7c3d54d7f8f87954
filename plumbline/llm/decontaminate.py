"""Benchmark decontamination: word windows of benchmark items found in documents."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F, types as T

from plumbline.llm import packed
from plumbline.llm.tables import in_small_batches, stored

# Words are runs of a-z, 0-9 and everything beyond ASCII, after lower-casing A-Z.
_IS_WORD = np.zeros(256, dtype=bool)
_IS_WORD[[*range(0x30, 0x3A), *range(0x61, 0x7B), *range(0x80, 0x100)]] = True
_FOLD = bytes(int(packed.LOWER[b]) if _IS_WORD[packed.LOWER[b]] else 0x20 for b in range(256))

# Helper columns, so that a table may have columns of any name.
N_WORDS, MARKS, ITEMS = "__dc_words", "__dc_marks", "__dc_items"


def words_of(text: str | None) -> list[bytes]:
    return [] if text is None else text.encode().translate(_FOLD).split()


class WindowSet:
    """Hash set of benchmark windows, with the words behind each hash."""

    def __init__(self, items: list[tuple[str, str]], size: int):
        self.vocabulary: dict[bytes, int] = {}
        self.ids: list[str] = []
        self.words: list[np.ndarray] = []
        found: dict[int, list[tuple[int, int, int]]] = {}  # length -> (hash, item, place)
        for item, text in items:
            words = words_of(text)
            if not words:
                continue
            numbers = np.array(
                [self.vocabulary.setdefault(word, len(self.vocabulary)) for word in words], np.int64
            )
            length = min(size, len(words))
            hashes = packed.window_hashes(numbers.astype(np.uint64), length)
            found.setdefault(length, []).extend(
                (int(h), len(self.ids), place) for place, h in enumerate(hashes)
            )
            self.ids.append(item)
            self.words.append(numbers)
        self.by_length = {}
        for length, entries in found.items():
            entries.sort()
            hashes = np.array([e[0] for e in entries], np.uint64)
            seen = np.zeros(2**20, dtype=bool)
            seen[hashes >> np.uint64(44)] = True
            self.by_length[length] = (hashes, [e[1:] for e in entries], seen)

    def hits(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray, list[set[str]], list[np.ndarray]]:
        """Words and hit words of each text, the items found, and a flag per word."""
        split = [words_of(text) for text in texts]
        counts = np.array([len(words) for words in split], np.int64)
        firsts = np.concatenate([[0], np.cumsum(counts)])
        get = self.vocabulary.get
        numbers = np.fromiter(
            (get(word, -1) for words in split for word in words), np.int64, int(firsts[-1])
        )
        hit = np.zeros(len(numbers) + 1, dtype=np.int32)
        items: list[set[str]] = [set() for _ in texts]
        unknown = np.concatenate([[0], np.cumsum(numbers < 0)])
        for length, (hashes, entries, seen) in self.by_length.items():
            n = len(numbers) - length + 1
            if n <= 0:
                continue
            windows = packed.window_hashes(numbers.astype(np.uint64), length)
            likely = seen[windows >> np.uint64(44)]
            likely &= unknown[length:] == unknown[:n]
            likely &= packed.windows_inside(firsts, length, n)
            places = np.flatnonzero(likely)
            left = np.searchsorted(hashes, windows[places], side="left")
            right = np.searchsorted(hashes, windows[places], side="right")
            for place, a, b in zip(places[right > left], left[right > left], right[right > left]):
                window = numbers[place : place + length]
                owner = int(np.searchsorted(firsts, place, side="right")) - 1
                for item, start in entries[a:b]:  # verified word by word
                    if np.array_equal(window, self.words[item][start : start + length]):
                        items[owner].add(self.ids[item])
                        hit[place] += 1
                        hit[place + length] -= 1
        flags = np.cumsum(hit)[:-1] > 0
        return counts, packed.sums(flags, firsts), items, [flags[a:b] for a, b in zip(firsts, firsts[1:])]


def _window_count(benchmark: DataFrame, text: str) -> int:
    """An upper bound of the windows: one per word."""
    words = F.size(F.split(F.coalesce(F.col(text), F.lit("")), "[^0-9A-Za-z\\x{80}-\\x{10FFFF}]+"))
    return int(benchmark.agg(F.sum(words.cast("bigint"))).first()[0] or 0)


def scan(
    docs: DataFrame,
    benchmark: DataFrame,
    text: str = "text",
    size: int = 10,
    item_id: str = "item_id",
    item_text: str = "text",
    most_windows: int = 2_000_000,
) -> DataFrame:
    """``docs`` with marks of what benchmark items they contain, in columns of their own (``__dc_...``).

    See ``report`` and ``clean`` for what follows from them. The
    benchmark goes to the executors as a hash set of at most ``most_windows``
    windows. A larger benchmark is cut by item hash into blocks that each stay
    below, and the documents pass one block after the other, stored between.

    NULL texts have no words; NULL items match nothing; repeated items and
    documents are all reported. All columns stay as they are.
    """
    blocks = max(1, -(-_window_count(benchmark, item_text) // most_windows))
    out = docs.withColumns(
        {
            N_WORDS: F.lit(0).cast("bigint"),
            MARKS: F.lit(None).cast("binary"),
            ITEMS: F.array().cast("array<string>"),
        }
    )
    for block in range(blocks):
        part = benchmark.select(
            F.coalesce(F.col(item_id).cast("string"), F.lit("")), F.col(item_text)
        ).where(F.pmod(F.xxhash64(F.col(item_id), F.col(item_text)), F.lit(blocks)) == block)
        known = docs.sparkSession.sparkContext.broadcast(
            vars(WindowSet([(row[0], row[1]) for row in part.collect()], size))
        )
        out = in_small_batches(out).mapInArrow(_scanner(known, text), out.schema)
        if blocks > 1 and block < blocks - 1:
            out = stored(out, "decontamination")
    return out


def _scanner(known, text: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        windows = WindowSet([], 1)
        vars(windows).update(known.value)
        for whole in batches:
            for batch in packed.chunks(whole, text):
                counts, hit, items, flags = windows.hits(batch.column(text).to_pylist())
                before = batch.column(MARKS).to_pylist()
                had = batch.column(ITEMS).to_pylist()
                marks = []
                for old, new, n in zip(before, flags, hit):
                    bits = np.packbits(new).tobytes() if n else None
                    if bits is not None and old is not None:
                        bits = bytes(a | b for a, b in zip(bits, old))
                    marks.append(bits if bits is not None else old)
                found = [sorted({*a, *b}) for a, b in zip(had, items)]
                columns = dict(zip(batch.schema.names, batch.columns))
                columns[N_WORDS] = pa.array(counts, pa.int64())
                columns[MARKS] = pa.array(marks, pa.binary())
                columns[ITEMS] = pa.array(found, pa.list_(pa.string()))
                yield pa.RecordBatch.from_arrays(list(columns.values()), names=list(columns))

    return run


def hit_count(marks: Column) -> Column:
    """Hit words of a document: set bits of its marks."""
    bits = F.regexp_replace(F.hex(marks), "[^1-9A-F]", "")
    # A hexadecimal digit stands for four words.
    ones = {1: "1248", 2: "3569AC", 3: "7BDE", 4: "F"}
    parts = [
        F.length(F.regexp_replace(bits, f"[^{digits}]", "")) * n for n, digits in ones.items()
    ]
    return F.coalesce(sum(parts[1:], parts[0]), F.lit(0)).cast("bigint")


def report(scanned: DataFrame, doc_id: str = "doc_id") -> DataFrame:
    """Per document: words, hit words, items found, a digest of the items, contaminated."""
    items = F.sort_array(ITEMS)
    return scanned.select(
        F.col(doc_id).alias("doc_id"),
        F.col(N_WORDS).alias("n_words"),
        hit_count(F.col(MARKS)).alias("n_hit"),
        F.size(ITEMS).cast("bigint").alias("n_items"),
        F.sha2(F.array_join(items, ","), 256).alias("items_sha256"),
        (hit_count(F.col(MARKS)) > 0).alias("contaminated"),
    )


def clean(scanned: DataFrame, text: str = "text", drop_from: float = 0.5) -> DataFrame:
    """Documents without their hit words; dropped where hit words reach ``drop_from`` of all.

    A run of hit words is cut out from its first to its last byte; what stands
    around it stays as it is. Documents without a hit are unchanged.
    """
    hit = scanned.where(
        F.col(MARKS).isNull() | (hit_count(F.col(MARKS)) < drop_from * F.col(N_WORDS))
    )
    kept = [field for field in hit.schema.fields if field.name not in (N_WORDS, MARKS, ITEMS)]
    return in_small_batches(hit).mapInArrow(_cutter(text, [f.name for f in kept]), T.StructType(kept))


def _cut(text: str, marks: bytes) -> str:
    data = text.encode()
    array = packed.LOWER[np.frombuffer(data, np.uint8)]
    starts, ends, _ = packed.spans(array, np.array([0, len(array)]), _IS_WORD[array])
    flags = np.unpackbits(np.frombuffer(marks, np.uint8), count=len(starts)).astype(bool)
    change = np.diff(np.concatenate([[0], flags.astype(np.int8), [0]]))
    out, at = [], 0
    for first, end in zip(np.flatnonzero(change == 1), np.flatnonzero(change == -1)):
        out.append(data[at : starts[first]])
        at = int(ends[end - 1])
    return b"".join([*out, data[at:]]).decode()


def _cutter(text: str, names: list[str]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            marks = batch.column(MARKS).to_pylist()
            kept = batch.select(names)
            if any(mark is not None for mark in marks):
                texts = batch.column(text).to_pylist()
                texts = [t if m is None else _cut(t, m) for t, m in zip(texts, marks)]
                place = names.index(text)
                kept = kept.set_column(place, text, pa.array(texts, pa.string()))
            yield kept

    return run

"""Quality rules on repeated text, from suffix arrays of each document's words."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F, types as T

from plumbline.llm import packed
from plumbline.llm.tables import in_small_batches

_SYMBOL = np.zeros(256, dtype=bool)
_SYMBOL[[ord(mark) for mark in "#*$%&|<>"]] = True


@dataclass(frozen=True)
class Limits:
    """A document with words fails the base rules below ``least_words`` or above
    ``base_percent`` of words in repeated windows of ``window`` words. The suffix
    array rejects it where maximal repeats of at least ``window`` words cover more
    than ``cover_percent`` of its words, or one repeat is longer than ``longest``."""

    window: int = 8
    least_words: int = 20
    base_percent: int = 30
    cover_percent: int = 30
    longest: int = 100


COLUMNS = [
    ("n_words", "bigint"), ("word_chars", "bigint"), ("n_symbols", "bigint"),
    ("n_dup_lines", "bigint"), ("n_repeat_words", "bigint"), ("longest_repeat", "bigint"),
    ("base_failed", "boolean"), ("kept", "boolean"),
]


def _repeated_windows(words: np.ndarray, firsts: np.ndarray, size: int) -> np.ndarray:
    """Places whose window of ``size`` words occurs again in the same text."""
    hashes = packed.window_hashes(words, size)
    if not len(hashes):
        return np.zeros(0, np.int64)
    text = packed.owners(firsts)[: len(hashes)].astype(np.uint64)
    hashes = packed.mix64(hashes + text * np.uint64(0xA0761D6478BD642F))
    places = np.flatnonzero(packed.windows_inside(firsts, size, len(hashes)))
    # Most windows are alone in a table of slots; only the others are sorted.
    bits = max(10, min(24, len(places).bit_length() + 2))
    slots = (hashes[places] >> np.uint64(64 - bits)).astype(np.int64)
    places = places[np.bincount(slots, minlength=2**bits)[slots] > 1]
    order = np.argsort(hashes[places], kind="stable")
    sorted_hashes = hashes[places][order]
    same = sorted_hashes[1:] == sorted_hashes[:-1]
    again = np.zeros(len(places), dtype=bool)
    again[1:] |= same
    again[:-1] |= same
    return np.sort(places[order][again])


def _window_ranks(words: np.ndarray, firsts: np.ndarray, places: np.ndarray, text: np.ndarray, size: int) -> np.ndarray:
    """Ranks of ``places`` by text, then by each of their next ``size`` words; a text's end comes first."""
    last = firsts[1:][text]
    keys = [text.astype(np.uint64)]
    for ahead in range(size):
        at = places + ahead
        keys.append(np.where(at < last, words[np.minimum(at, len(words) - 1)], np.uint64(0)))
    order = np.lexsort(keys[::-1])
    new = np.zeros(len(places), dtype=bool)
    for key in keys:
        new[1:] |= key[order][1:] != key[order][:-1]
    rank = np.empty(len(places), dtype=np.int64)
    rank[order] = np.cumsum(new)
    return rank


def longest_repeats(words: np.ndarray, firsts: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Suffixes that share at least ``size`` words with another of the same text.

    Returns their places and, for each, the length of the longest prefix that
    occurs elsewhere in its text: the larger of the longest common prefixes
    with both neighbours in the suffix array. The array holds only suffixes
    whose first ``size`` words repeat, as no other one has a neighbour within
    an interval of that length, and what follows their windows, as the words
    there still order the suffixes before them. It is sorted by prefix
    doubling: ``level[k]`` ranks the suffixes by their first ``size * 2**k``
    words, word by word in the order of their hashes.
    """
    places = _repeated_windows(words, firsts, size)
    if not len(places):
        return places, places
    text_of = packed.owners(firsts)
    text = text_of[places]
    every = np.union1d(places, places[places + size < firsts[1:][text]] + size)
    levels = [_window_ranks(words, firsts, every, text_of[every], size)]
    reach = size
    while True:
        rank = levels[-1]
        if int(rank.max()) + 1 == len(every):
            break
        # Suffixes that share all words so far are followed by one of ``every`` or the text's end.
        follower = np.minimum(np.searchsorted(every, every + reach), len(every) - 1)
        found = (every[follower] == every + reach) & (text_of[every[follower]] == text_of[every])
        second = np.where(found, rank[follower] + 1, 0)
        _, joint = np.unique(rank * (len(every) + 1) + second, return_inverse=True)
        levels.append(joint.reshape(-1).astype(np.int64))
        reach *= 2
    order = np.argsort(levels[-1][np.searchsorted(every, places)], kind="stable")
    a, b = places[order][:-1].copy(), places[order][1:].copy()
    last = firsts[1:][text[order]]
    same_text = text[order][1:] == text[order][:-1]
    common = np.zeros(len(a), dtype=np.int64)
    for depth in range(len(levels) - 1, -1, -1):
        x, y = np.searchsorted(every, a + common), np.searchsorted(every, b + common)
        x, y = np.minimum(x, len(every) - 1), np.minimum(y, len(every) - 1)
        equal = same_text & (every[x] == a + common) & (every[y] == b + common)
        equal &= levels[depth][x] == levels[depth][y]
        common = np.where(equal, common + size * 2**depth, common)
    # Fewer than ``size`` words are left to compare one by one.
    for _ in range(size - 1):
        x, y = a + common, b + common
        ok = same_text & (common >= size) & (x < last[:-1]) & (y < last[1:])
        ok &= words[np.minimum(x, len(words) - 1)] == words[np.minimum(y, len(words) - 1)]
        if not ok.any():
            break
        common = common + ok
    best = np.zeros(len(places), dtype=np.int64)
    best[:-1] = common
    best[1:] = np.maximum(best[1:], common)
    out = np.zeros(len(places), dtype=np.int64)
    out[order] = best
    return places, out


def measure(column: pa.Array, limits: Limits) -> list[pa.Array]:
    """All measures of a chunk of texts, in the order of ``COLUMNS``."""
    data, offsets = packed.utf8(column)
    inside = packed.WORD[data]
    starts, ends, firsts = packed.spans(data, offsets, inside)
    words = packed.span_hashes(data, starts, ends)
    n_words = np.diff(firsts)
    word_chars = packed.sums(inside & ((data & 0xC0) != 0x80), offsets)
    symbols = packed.sums(_SYMBOL[data], offsets)
    # Lines with a word that equal an earlier one of their text.
    line_starts, line_ends, line_firsts = packed.spans(data, offsets, data != 0x0A)
    has_word = np.diff(np.searchsorted(starts, np.append(line_starts, len(data)))) > 0
    line_text = packed.owners(line_firsts)
    lines = packed.span_hashes(data, line_starts, line_ends)[has_word]
    line_text = line_text[has_word]
    order = np.lexsort((lines, line_text))
    again = np.zeros(len(lines), dtype=bool)
    again[1:] = (lines[order][1:] == lines[order][:-1]) & (line_text[order][1:] == line_text[order][:-1])
    dup_lines = np.bincount(line_text[order][again], minlength=len(n_words))
    places, lengths = longest_repeats(words, firsts, limits.window)
    repeat = packed.sums(packed.covered(places, lengths, len(words)), firsts)
    longest = np.zeros(len(n_words), dtype=np.int64)
    np.maximum.at(longest, packed.owners(firsts)[places], lengths)
    failed = (n_words < limits.least_words) | (100 * repeat > limits.base_percent * n_words)
    kept = ~failed & (100 * repeat <= limits.cover_percent * n_words) & (longest <= limits.longest)
    numbers = (n_words, word_chars, symbols, dup_lines, repeat, longest)
    return [pa.array(x.astype(np.int64)) for x in numbers] + [pa.array(failed), pa.array(kept)]


def assess(docs: DataFrame, text: str = "text", limits: Limits = Limits()) -> DataFrame:
    """``docs`` with the measures and verdict of ``COLUMNS``; input columns so named are replaced.

    Each text is measured whole and alone, in one pass without a shuffle. NULL
    and empty texts have no words and fail. Ties and repeated rows do not
    matter. Memory is bounded by a chunk of texts or the longest single one.
    """
    return _measured(docs.drop(*[name for name, _ in COLUMNS]), text, limits, "")


def _measured(docs: DataFrame, text: str, limits: Limits, prefix: str) -> DataFrame:
    names = [f"{prefix}{name}" for name, _ in COLUMNS]
    measures = ", ".join(f"{name} {kind}" for name, (_, kind) in zip(names, COLUMNS))
    schema = T.StructType(docs.schema.fields + T.StructType.fromDDL(measures).fields)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in packed.chunks(whole, text):
                found = measure(batch.column(text), limits)
                yield pa.RecordBatch.from_arrays(
                    [*batch.columns, *found], names=[*batch.schema.names, *names]
                )

    return in_small_batches(docs).mapInArrow(run, schema)


def keep(docs: DataFrame, text: str = "text", limits: Limits = Limits()) -> DataFrame:
    """The documents that pass, with their own columns, whatever their names."""
    measured = _measured(docs, text, limits, "__rp_")
    return measured.where("__rp_kept").select(*[F.col(f"`{name}`") for name in docs.columns])

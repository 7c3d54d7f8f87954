"""Byte-level BPE: whole pre-tokens by a minimal perfect hash, all others by merging.

A text is cut into pre-tokens by one pass over its characters' classes. A
pre-token that is in the vocabulary itself is resolved by a minimal perfect hash
over the vocabulary, checked byte by byte. Any other one is merged from its
bytes: they stand in a linked list, and a heap holds the ranks of neighbours.
Distinct pre-tokens are merged once per batch and remembered per worker.
"""

from __future__ import annotations

import base64
import re
from collections.abc import Iterator
from heapq import heapify, heappop, heappush

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, types as T

from plumbline.llm import packed

# The only split that is built in; fixed value of the public byte-level vocabularies.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
_LETTER, _NUMBER, _SPACE = 1, 2, 3
_ENDINGS_1 = [ord(c) for c in "stmd"]
_ENDINGS_2 = [(ord(a), ord(b)) for a, b in ("re", "ve", "ll")]
_KEYS_PER_BUCKET = 4
_STEP = np.uint64(0x9E3779B97F4A7C15)
_MOST_REMEMBERED = 300_000
# A space between two ASCII letters begins a pre-token whatever stands around it.
_SAFE_CUT = re.compile(r"(?<=[A-Za-z]) (?=[A-Za-z])")
_PIECE_CHARACTERS = 2**20


def read_ranks(path: str) -> dict[bytes, int]:
    """Token bytes and ids of a rank file: one base64 token and its id on a line."""
    with open(path, "rb") as lines:
        return {base64.b64decode(token): int(rank) for token, rank in (line.split() for line in lines if line.strip())}


def character_classes() -> np.ndarray:
    """Class of every code point, as the tokenizer library itself has it."""
    import tiktoken

    every = "".join(map(chr, [*range(0xD800), *range(0xE000, 0x110000)]))
    single = {bytes([b]): b for b in range(256)}
    out = np.zeros(0x110000, np.uint8)
    for kind, pattern in ((_LETTER, r"\p{L}+"), (_NUMBER, r"\p{N}+"), (_SPACE, r"\s+")):
        matching = tiktoken.Encoding("class", pat_str=pattern, mergeable_ranks=single, special_tokens={})
        out[[ord(c) for c in bytes(matching.encode_ordinary(every)).decode()]] = kind
    return out


# --- vocabulary ---------------------------------------------------------------


def _slots(hashes: np.ndarray, shifts: np.ndarray, slots: int) -> np.ndarray:
    """Slot of each key: a negative shift names it, any other one is mixed into the hash."""
    moved = packed.mix64(hashes + shifts.astype(np.uint64) * _STEP) % np.uint64(slots)
    return np.where(shifts < 0, -shifts - 1, moved.astype(np.int64))


def perfect_hash(hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Shift of every bucket and key of every slot, as many slots as keys.

    Buckets are placed from the fullest on, each with the first shift that sends
    its keys to free slots; a single key takes a free slot by name.
    """
    n = len(hashes)
    buckets = max(1, n // _KEYS_PER_BUCKET)
    of = (hashes % np.uint64(buckets)).astype(np.int64)
    order = np.argsort(of, kind="stable")
    starts = np.searchsorted(of[order], np.arange(buckets + 1))
    sizes = np.diff(starts)
    shifts, key_at, free = np.zeros(buckets, np.int64), np.full(n, -1, np.int64), np.ones(n, bool)
    for bucket in np.argsort(-sizes, kind="stable"):
        keys = order[starts[bucket] : starts[bucket + 1]]
        if len(keys) < 2:
            break
        first = 0
        while True:
            tried = np.arange(first, first + 64)
            to = _slots(hashes[keys][None, :], np.repeat(tried[:, None], len(keys), 1), n)
            line = np.sort(to, axis=1)
            good = free[to].all(axis=1) & (line[:, 1:] != line[:, :-1]).all(axis=1)
            if good.any():
                at = int(np.argmax(good))
                shifts[bucket], key_at[to[at]], free[to[at]] = tried[at], keys, False
                break
            first += 64
            if first > 2**24:
                raise ValueError("two tokens of the vocabulary share a hash")
    singles = np.flatnonzero(sizes == 1)
    open_slots = np.flatnonzero(free)[: len(singles)]
    shifts[singles] = -open_slots - 1
    key_at[open_slots] = order[starts[singles]]
    return shifts, key_at


def tables(ranks: dict[bytes, int]) -> dict[str, np.ndarray]:
    """The vocabulary as arrays for the workers; their size follows the rank file alone."""
    missing = [b for b in range(256) if bytes([b]) not in ranks]
    if missing:
        raise ValueError(f"the vocabulary lacks the bytes {missing}")
    tokens = sorted(ranks, key=ranks.get)
    lengths = np.array([len(t) for t in tokens], np.int64)
    ends = np.cumsum(lengths)
    data = np.frombuffer(b"".join(tokens), np.uint8)
    hashes = packed.span_hashes(data, ends - lengths, ends)
    shifts, key_at = perfect_hash(hashes)
    ids = np.array([ranks[t] for t in tokens], np.int64)
    pairs = {}
    for token, rank in ranks.items():
        for cut in range(1, len(token)):
            left, right = ranks.get(token[:cut]), ranks.get(token[cut:])
            if left is not None and right is not None:
                pairs[left << 32 | right] = rank
    place = np.full(int(ids.max()) + 1, -1, np.int64)
    place[ids] = np.arange(len(ids))
    return {
        "data": data, "starts": ends - lengths, "lengths": lengths, "ids": ids, "hashes": hashes,
        "shifts": shifts, "key_at": key_at, "place": place,
        "bytes": np.array([ranks[bytes([b])] for b in range(256)], np.int64),
        "pair_keys": np.fromiter(pairs, np.int64, len(pairs)),
        "pair_ranks": np.fromiter(pairs.values(), np.int64, len(pairs)),
    }


def merged(piece: bytes, pairs: dict[int, int], single: list[int]) -> list[int]:
    """Ids of one pre-token: the lowest-ranked neighbours are joined first, the leftmost on a tie."""
    ids = [single[b] for b in piece]
    n = len(ids)
    after, before = list(range(1, n + 1)), list(range(-1, n - 1))
    get = pairs.get
    heap = []
    for at in range(n - 1):
        rank = get(ids[at] << 32 | ids[at + 1])
        if rank is not None:
            heap.append(rank * n + at)
    heapify(heap)
    while heap:
        rank, at = divmod(heappop(heap), n)
        to = after[at]
        if ids[at] < 0 or to >= n or get(ids[at] << 32 | ids[to]) != rank:
            continue  # one of the two has been joined otherwise
        ids[at], ids[to] = rank, -1
        behind = after[at] = after[to]
        if behind < n:
            before[behind] = at
            rank = get(ids[at] << 32 | ids[behind])
            if rank is not None:
                heappush(heap, rank * n + at)
        ahead = before[at]
        if ahead >= 0:
            rank = get(ids[ahead] << 32 | ids[at])
            if rank is not None:
                heappush(heap, rank * n + ahead)
    return [i for i in ids if i >= 0]


# --- pre-tokens ---------------------------------------------------------------


def pre_tokens(data: np.ndarray, offsets: np.ndarray, classes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First byte of every pre-token of ``PATTERN``, and the first pre-token of every text."""
    if not len(data):
        return np.zeros(0, np.int64), np.zeros(len(offsets), np.int64)
    points = np.frombuffer(data.tobytes().decode().encode("utf-32-le"), np.uint32)
    at_byte = np.flatnonzero((data & 0xC0) != 0x80)
    n = len(points)
    kind = classes[points]
    edge = np.zeros(n + 4, bool)
    edge[np.searchsorted(at_byte, offsets)] = True
    edge[n:] = True
    begins = edge[:n].copy()
    begins[1:] |= kind[1:] != kind[:-1]
    # The last of some white space before other characters stands alone; a blank goes with them.
    last = np.flatnonzero((kind[:-1] == _SPACE) & (kind[1:] != _SPACE) & ~edge[1:n])
    begins[last] = True
    begins[last[points[last] == 0x20] + 1] = False
    # An apostrophe that begins a pre-token takes the letters of a short ending.
    quote = np.flatnonzero((points[:-1] == 0x27) & begins[:-1] & ~edge[1:n])
    one = quote[np.isin(points[quote + 1], _ENDINGS_1)]
    far = quote[~edge[quote + 2]]
    two = np.zeros(len(far), bool)
    for a, b in _ENDINGS_2:
        two |= (points[far + 1] == a) & (points[far + 2] == b)
    two = far[two]
    begins[one + 1] = False
    begins[two + 1] = begins[two + 2] = False
    for end in (one + 2, two + 3):
        begins[end[end < n]] = True
    starts = at_byte[begins]
    return starts, np.searchsorted(starts, offsets)


def _same(a: np.ndarray, a_starts: np.ndarray, b: np.ndarray, b_starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Whether spans of two byte arrays are equal, byte by byte."""
    if not len(lengths):
        return np.zeros(0, bool)
    first = np.cumsum(lengths) - lengths
    place = np.arange(int(lengths.sum()), dtype=np.int64) - np.repeat(first, lengths)
    equal = a[place + np.repeat(a_starts, lengths)] == b[place + np.repeat(b_starts, lengths)]
    return np.logical_and.reduceat(equal, first)


def _gathered(values: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """The spans of ``values`` one after the other."""
    first = np.cumsum(lengths) - lengths
    return values[np.arange(int(lengths.sum()), dtype=np.int64) + np.repeat(starts - first, lengths)]


class Coder:
    """Encodes and decodes with tables that a worker keeps from task to task."""

    def __init__(self, known: dict):
        self.t = known
        if "pairs" not in known:
            known["pairs"] = dict(zip(known["pair_keys"].tolist(), known["pair_ranks"].tolist()))
            known["memo"] = {}
        self.single = known["bytes"].tolist()

    def whole(self, data: np.ndarray, starts: np.ndarray, lengths: np.ndarray, hashes: np.ndarray) -> np.ndarray:
        """Id of every pre-token that is a token, else -1."""
        t = self.t
        shifts = t["shifts"][(hashes % np.uint64(len(t["shifts"]))).astype(np.int64)]
        key = t["key_at"][_slots(hashes, shifts, len(t["key_at"]))]
        likely = np.flatnonzero((t["hashes"][key] == hashes) & (t["lengths"][key] == lengths))
        found = _same(data, starts[likely], t["data"], t["starts"][key[likely]], lengths[likely])
        ids = np.full(len(starts), -1, np.int64)
        ids[likely[found]] = t["ids"][key[likely[found]]]
        return ids

    def encode(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts and the first id of each."""
        starts, firsts = pre_tokens(data, offsets, self.t["classes"])
        if not len(starts):
            return np.zeros(0, np.int64), np.zeros(len(offsets), np.int64)
        lengths = np.diff(np.append(starts, len(data)))
        hashes = packed.span_hashes(data, starts, starts + lengths)
        ids = self.whole(data, starts, lengths, hashes)
        counts = np.ones(len(ids), np.int64)
        missed = np.flatnonzero(ids < 0)
        if len(missed):
            _, where, which = np.unique(hashes[missed], return_index=True, return_inverse=True)
            model = missed[where]
            odd = lengths[model[which]] != lengths[missed]
            same = np.flatnonzero(~odd)
            equal = _same(data, starts[missed[same]], data, starts[model[which[same]]], lengths[missed[same]])
            odd[same[~equal]] = True
            which[odd] = len(model) + np.arange(int(odd.sum()))  # another text with the hash of a model
            model = np.append(model, missed[odd])
            pieces = self._merged(data.tobytes(), starts[model].tolist(), lengths[model].tolist())
            sizes = np.array([len(p) for p in pieces], np.int64)
            flat = np.fromiter((i for p in pieces for i in p), np.int64, int(sizes.sum()))
            counts[missed] = sizes[which]
        ends = np.cumsum(counts)
        out = np.repeat(ids, counts)
        if len(missed):
            out[out < 0] = _gathered(flat, (np.cumsum(sizes) - sizes)[which], sizes[which])
        return out, np.concatenate([[0], ends])[firsts]

    def _merged(self, data: bytes, starts: list[int], lengths: list[int]) -> list[list[int]]:
        memo, pairs, single = self.t["memo"], self.t["pairs"], self.single
        out = []
        for start, length in zip(starts, lengths):
            piece = data[start : start + length]
            ids = memo.get(piece)
            if ids is None:
                ids = merged(piece, pairs, single)
                if length <= 64:
                    if len(memo) >= _MOST_REMEMBERED:
                        memo.clear()
                    memo[piece] = ids
            out.append(ids)
        return out

    def decode(self, ids: np.ndarray, firsts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Bytes of all id sequences and the first byte of each. An unknown id is refused."""
        t = self.t
        if len(ids) and (int(ids.min()) < 0 or int(ids.max()) >= len(t["place"])):
            raise ValueError("an id is not in the vocabulary")
        place = t["place"][ids]
        if (place < 0).any():
            raise ValueError("an id is not in the vocabulary")
        lengths = t["lengths"][place]
        return _gathered(t["data"], t["starts"][place], lengths), np.concatenate([[0], np.cumsum(lengths)])[firsts]


def _pieces(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """A single long text cut where a pre-token begins in any case, about every 2**20 characters."""
    text = data.tobytes().decode()
    cuts, at = [0], _PIECE_CHARACTERS
    while at < len(text) and (found := _SAFE_CUT.search(text, at)):
        cuts.append(found.start())
        at = found.start() + _PIECE_CHARACTERS
    cuts.append(len(text))
    return [np.frombuffer(text[a:b].encode(), np.uint8) for a, b in zip(cuts, cuts[1:])]


def _encode_batch(coder: Coder, column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    data, offsets = packed.utf8(column)
    if len(column) > 1 or len(data) <= packed.CHUNK_BYTES:
        return coder.encode(data, offsets)
    parts = [coder.encode(p, np.array([0, len(p)]))[0] for p in _pieces(data, offsets)]
    ids = np.concatenate(parts)
    return ids, np.array([0, len(ids)])


def _shared(docs: DataFrame, ranks_path: str):
    known = tables(read_ranks(ranks_path))
    known["classes"] = character_classes()
    return docs.sparkSession.sparkContext.broadcast(known)


def _with(docs: DataFrame, drop: list[str], name: str, kind: T.DataType) -> tuple[DataFrame, T.StructType]:
    kept = docs.drop(*drop, name)
    return kept, T.StructType([*kept.schema.fields, T.StructField(name, kind)])


def encode(
    docs: DataFrame, ranks_path: str, text: str = "text", ids: str = "ids", packed_ids: bool = False, keep_text: bool = True
) -> DataFrame:
    """``docs`` with the token ids of ``text``, by the ranks in the file ``ranks_path``.

    ``ids`` is an array of int, or with ``packed_ids`` little-endian unsigned
    32-bit integers, the form of token files. No special token is made: their
    strings are ordinary text. NULL and empty texts have no ids. All other
    columns stay; an input column named like the result is replaced, and the
    text goes unless ``keep_text``.

    No shuffle: each batch is encoded where it is read. The vocabulary, a few
    megabytes that do not grow with the data, is read on the driver and
    broadcast. A text beyond a megabyte is encoded in pieces.
    """
    known = _shared(docs, ranks_path)
    out, schema = _with(docs, [], ids, T.BinaryType() if packed_ids else T.ArrayType(T.IntegerType()))
    if not keep_text:
        schema = T.StructType([f for f in schema if f.name != text])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = Coder(known.value)
        for whole in batches:
            for batch in packed.chunks(whole, text):
                found, firsts = _encode_batch(coder, batch.column(text))
                if packed_ids:
                    values = pa.py_buffer(found.astype("<u4"))
                    column = pa.Array.from_buffers(
                        pa.binary(), batch.num_rows, [None, pa.py_buffer((firsts * 4).astype(np.int32)), values]
                    )
                else:
                    column = pa.ListArray.from_arrays(pa.array(firsts, pa.int32()), pa.array(found, pa.int32()))
                names = [n for n in batch.schema.names if keep_text or n != text]
                yield pa.RecordBatch.from_arrays([*(batch.column(n) for n in names), column], names=[*names, ids])

    return out.mapInArrow(run, schema)


def decode(tokens: DataFrame, ranks_path: str, ids: str = "ids", decoded: str = "decoded") -> DataFrame:
    """``tokens`` with the bytes that the ids stand for, NULL ids giving none.

    ``ids`` is of either form that ``encode`` gives. The bytes need not be whole
    characters, as ids may come from anywhere. An id outside the vocabulary
    fails the job. An input column named like the result is replaced.
    """
    known = _shared(tokens, ranks_path)
    out, schema = _with(tokens, [], decoded, T.BinaryType())
    is_packed = isinstance(tokens.schema[ids].dataType, T.BinaryType)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = Coder(known.value)
        for batch in batches:
            at = 0
            while at < batch.num_rows:
                part = batch.slice(at, 256)
                at += 256
                values, firsts = _loose(part.column(ids), is_packed)
                data, starts = coder.decode(values, firsts)
                column = pa.Array.from_buffers(
                    pa.large_binary(), part.num_rows, [None, pa.py_buffer(starts.astype(np.int64)), pa.py_buffer(data)]
                ).cast(pa.binary())
                yield pa.RecordBatch.from_arrays([*part.columns, column], names=[*part.schema.names, decoded])

    return out.mapInArrow(run, schema)


def _loose(column: pa.Array, is_packed: bool) -> tuple[np.ndarray, np.ndarray]:
    """Ids of all rows and the first of each."""
    if is_packed:
        data, offsets = packed.utf8(column)
        return np.frombuffer(data.tobytes(), "<u4").astype(np.int64), offsets // 4
    sizes = np.array(column.value_lengths().fill_null(0), np.int64)
    return np.array(column.flatten(), np.int64), np.concatenate([[0], np.cumsum(sizes)])

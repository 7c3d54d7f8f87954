"""Removal of long repeats across documents with a run-length compressed index.

Every window of ``size`` bytes is filed under its least 24-byte hash, so equal
windows meet in one bucket wherever they stand. Four steps follow:

1. Batches of documents name the keys of their windows; buckets tell which
   keys occur in two documents.
2. Batches send the stretches under such keys, each distinct one once with the
   least document that holds it.
3. A bucket builds a run-length compressed Burrows-Wheeler transform of its
   distinct stretches, sampled at the ends of runs, and streams every stretch
   through it from right to left. The row reached after at least ``size``
   bytes lies in the rows that share them, whose least document is known.
4. Batches mark the windows that a smaller document holds, and cut them.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F, types as T

from plumbline.llm import exchange, packed

KMER = 24  # shorter strings recur by chance, longer ones cut more and smaller stretches
CHUNK = 2**20  # bytes of text worked on at a time, in batches and in buckets
NO_ID = np.int64(2**63 - 1)  # NULL ids come after all others
_P = np.uint64(0xD1342543DE82EF95)
_P_INVERSE = np.uint64(pow(0xD1342543DE82EF95, -1, 2**64))
_VALUES = np.random.default_rng(50).integers(1, 2**63, 256, dtype=np.uint64)


class RunLengthIndex:
    """Run-compressed Burrows-Wheeler transform of strings, each closed by its own mark.

    Rows are suffixes in order; marks sort first, in order of their strings.
    Kept are the runs of the transform (head, start, rows of the same head
    before it), the owner sampled at the first and last row of every run, and
    the least owner of each group of rows that share their first ``size``
    bytes.
    """

    def __init__(self, data: np.ndarray, lengths: np.ndarray, owner: np.ndarray, size: int):
        n_strings = len(lengths)
        ends = np.cumsum(lengths + 1) - 1  # place of each mark
        n = int(ends[-1]) + 1
        text = np.zeros(n, dtype=np.int64)
        inside = np.ones(n, dtype=bool)
        inside[ends] = False
        text[inside] = data.astype(np.int64) + 1
        string = np.repeat(np.arange(n_strings), lengths + 1)
        left = ends[string] - np.arange(n)  # bytes before the mark
        # Suffixes by their first 7 bytes, then by twice as many, and so on.
        key = np.zeros(n, dtype=np.int64)
        padded = np.append(text, np.zeros(7, dtype=np.int64))
        for k in range(7):
            key = key * 257 + np.where(left >= k, padded[k : k + n], 0)
        levels = {7: np.unique(key, return_inverse=True)[1].reshape(-1)}
        reach = 7
        rank = levels[7]
        while True:
            follower = np.minimum(np.arange(n) + reach, n - 1)
            second = np.where(left >= reach, rank[follower] + n_strings, string)
            joint, inverse = np.unique(rank * (n + n_strings + 1) + second, return_inverse=True)
            rank = inverse.reshape(-1)
            reach *= 2
            levels[reach] = rank
            if len(joint) == n:
                break
        rows = np.empty(n, dtype=np.int64)
        rows[rank] = np.arange(n)
        # The transform and its runs.
        before = np.where(rows > 0, text[rows - 1], 0)
        first = np.ones(n, dtype=bool)
        first[1:] = before[1:] != before[:-1]
        self.run_start = np.flatnonzero(first)
        self.head = before[self.run_start]
        run_length = np.diff(np.append(self.run_start, n))
        by_head = np.argsort(self.head, kind="stable")
        earlier = np.empty(len(by_head), dtype=np.int64)
        # Rows of smaller heads and of earlier runs with the same head: where the run maps to.
        earlier[by_head] = np.cumsum(run_length[by_head]) - run_length[by_head]
        self.target = earlier
        run_end = np.append(self.run_start[1:], n) - 1
        self.sample = np.stack([owner[string[rows[self.run_start]]], owner[string[rows[run_end]]]])
        # Groups of rows that share their first ``size`` bytes.
        long = left[rows] >= size
        a, b = rows[:-1], rows[1:]
        same = long[:-1] & long[1:]
        at = 0
        for step in sorted((s for s in levels if s <= size), reverse=True):
            while at + step <= size:
                x, y = np.minimum(a + at, n - 1), np.minimum(b + at, n - 1)
                same &= levels[step][x] == levels[step][y]
                at += step
        for place in range(at, size):
            same &= text[np.minimum(a + place, n - 1)] == text[np.minimum(b + place, n - 1)]
        group_first = np.ones(n, dtype=bool)
        group_first[1:] = ~same
        self.group_start = np.flatnonzero(group_first)
        self.group_least = np.minimum.reduceat(owner[string[rows]], self.group_start)
        self.lengths = lengths
        self.size = size

    def step(self, rows: np.ndarray) -> np.ndarray:
        """Rows of the suffixes that are one byte longer to the left."""
        run = np.searchsorted(self.run_start, rows, side="right") - 1
        return self.target[run] + rows - self.run_start[run]

    def least_owners(self) -> np.ndarray:
        """For each string in turn, the least owner of the ``size`` bytes from each place on.

        All strings stream through the index together, a byte a step: the
        matching statistic of a place is the row reached and the bytes
        matched so far.
        """
        windows = self.lengths - self.size + 1
        end = np.cumsum(windows) + self.size - 1  # where a string's last window would follow
        out = np.empty(int(windows.sum()), dtype=np.int64)
        active = np.arange(len(self.lengths))
        rows = active.copy()
        for matched in range(1, int(self.lengths.max()) + 1):
            going = self.lengths[active] >= matched
            active, rows = active[going], self.step(rows[going])
            if matched >= self.size:
                group = np.searchsorted(self.group_start, rows, side="right") - 1
                out[end[active] - matched] = self.group_least[group]
        return out


def _least_hashes(data: np.ndarray, size: int) -> np.ndarray:
    """Least hash of the 24-byte strings in each window of ``size`` bytes."""
    if len(data) < size:
        return np.zeros(0, np.uint32)
    wide = data.astype(np.uint64)
    for step in (1, 2, 4):
        wide = wide[:-step] | wide[step:] << np.uint64(8 * step)
    n = len(data) - KMER + 1
    mixed = wide[:n].copy()
    for place in range(8, KMER, 8):
        mixed = mixed * np.uint64(0x9E3779B97F4A7C15) + wide[place : place + n]
        mixed ^= mixed >> np.uint64(29)
    mixed ^= mixed >> np.uint64(32)
    mixed *= np.uint64(0xBF58476D1CE4E5B9)
    hashes = (mixed >> np.uint64(32)).astype(np.uint32)
    width, reach = size - KMER + 1, 1
    while 2 * reach <= width:
        hashes = np.minimum(hashes[:-reach], hashes[reach:])
        reach *= 2
    return hashes if reach == width else np.minimum(hashes[: -(width - reach)], hashes[width - reach :])


def _hashes_between(
    data: np.ndarray, start: np.ndarray, end: np.ndarray, powers: np.ndarray, inverse: np.ndarray
) -> np.ndarray:
    """Hash of the bytes from each start to its end; spans may overlap."""
    sums = np.zeros(len(data) + 1, dtype=np.uint64)
    np.cumsum(_VALUES[data] * powers[: len(data)], out=sums[1:])
    value = (sums[end] - sums[start]) * inverse[start] if len(start) else np.zeros(0, np.uint64)
    return packed.mix64(value + (end - start).astype(np.uint64))


def _chunk_stretches(
    data: np.ndarray, offsets: np.ndarray, size: int, powers: np.ndarray, inverse: np.ndarray
) -> list[np.ndarray]:
    """Start, end, text, key and hash of each run of windows with one key in a few texts."""
    key = _least_hashes(data, size)
    n = len(key)
    # A window is whole if its text has ``size`` bytes from there on.
    ok = np.ones(n + 1, dtype=bool)
    ok[n] = False
    for end in offsets[1:]:
        ok[max(0, end - size + 1) : end] = False
    first = np.zeros(n + 1, dtype=bool)
    first[:n] = True
    first[1:n] = key[1:] != key[:-1]
    begins = np.zeros(n + 1, dtype=bool)
    begins[offsets[offsets <= n]] = True
    before = np.zeros(n + 1, dtype=bool)
    before[1:] = ok[:-1]
    change = first | begins | ~before
    start = np.flatnonzero(ok & change)
    after = np.ones(n + 1, dtype=bool)
    after[:-1] = change[1:] | ~ok[1:]
    end = np.flatnonzero(ok & after) + size
    text = np.searchsorted(offsets, start, side="right") - 1
    return [start, end, text, key[start], _hashes_between(data, start, end, powers, inverse)]


class _Stretches:
    """The windows of a batch of texts, in stretches under one key.

    The texts are worked through a few at a time, so that arrays of several
    times their size stay small. What comes out does not depend on the order
    of the rows, but for the places.
    """

    def __init__(self, table: pa.Table, doc_id: str, text: str, size: int, buckets: int):
        column = table.column(text).combine_chunks()
        self.data, self.offsets = packed.utf8(column if isinstance(column, pa.Array) else pa.array([], pa.string()))
        ids = table.column(doc_id).to_pylist()
        self.ids = np.array([NO_ID if x is None else x for x in ids], dtype=np.int64)
        self.size, self.buckets = size, buckets
        longest = max(CHUNK, int(np.diff(self.offsets).max(initial=0)))
        powers, inverse = packed.powers(longest, _P), packed.powers(longest, _P_INVERSE)
        found, a = [], 0
        while a < len(ids):
            b = int(np.searchsorted(self.offsets, self.offsets[a] + CHUNK, side="right")) - 1
            b = min(max(b, a + 1), len(ids))
            low = self.offsets[a]
            part = _chunk_stretches(self.data[low : self.offsets[b]], self.offsets[a : b + 1] - low, size, powers, inverse)
            part[0] += low
            part[1] += low
            part[2] += a
            found.append(part)
            a = b
        self.start, self.end, self.text, key, self.hash = (np.concatenate(x) for x in zip(*found))
        wide = packed.mix64(key.astype(np.uint64))
        self.key = exchange.bucket_of(wide, buckets) << np.uint64(32) | key
        self.keys, self.inverse = np.unique(self.key, return_inverse=True)
        self.inverse = self.inverse.reshape(-1)

    def in_two_texts(self) -> np.ndarray:
        """Whether documents with different ids in this batch hold a key."""
        ids = self.ids[self.text]
        least = np.full(len(self.keys), NO_ID)
        most = np.full(len(self.keys), -NO_ID - 1)
        np.minimum.at(least, self.inverse, ids)
        np.maximum.at(most, self.inverse, ids)
        return least < most

    def surroundings(self) -> np.ndarray:
        """Distinct stretches under each key, beyond the first."""
        order = np.lexsort((self.hash, self.inverse))
        new = np.ones(len(order), dtype=bool)
        new[1:] = (self.inverse[order][1:] != self.inverse[order][:-1]) | (self.hash[order][1:] != self.hash[order][:-1])
        return np.bincount(self.inverse[order][new], minlength=len(self.keys)) - 1

    def shared(self, answers: pa.Table) -> None:
        """Keeps the stretches under keys that buckets report; those of frequent keys by window."""
        shared = np.zeros(len(self.keys), dtype=bool)
        often = np.zeros(len(self.keys), dtype=bool)
        names, bounds = exchange.bucket_bounds(self.keys >> np.uint64(32))
        reports = {row["bucket"]: row for row in answers.to_pylist()}
        for name, a, b in zip(names, bounds, bounds[1:]):
            row = reports[int(name)]
            shared[a:b] = np.unpackbits(np.frombuffer(row["shared"], np.uint8), count=b - a)
            often[a:b] = np.unpackbits(np.frombuffer(row["often"], np.uint8), count=b - a)
        keep, single = shared[self.inverse], (shared & often)[self.inverse]
        rest = keep & ~single
        start, end, text, key = self.start[rest], self.end[rest], self.text[rest], self.key[rest]
        hashes = self.hash[rest]
        if single.any():
            # A key in very many different surroundings: each window goes by its own hash.
            n = (self.end - self.start - self.size + 1)[single]
            first = np.cumsum(n) - n
            more = np.repeat(self.start[single], n) + np.arange(int(n.sum())) - np.repeat(first, n)
            own = self._hashes(more)
            hashes = np.append(hashes, own)
            bucket = exchange.bucket_of(own, self.buckets) << np.uint64(32)
            start, end = np.append(start, more), np.append(end, more + self.size)
            text = np.append(text, np.repeat(self.text[single], n))
            key = np.append(key, bucket | own & np.uint64(0xFFFFFFFF))
        order = np.lexsort((hashes, key))
        self.start, self.end, self.text = start[order], end[order], text[order]
        key, hashes = key[order], hashes[order]
        new = np.ones(len(key), dtype=bool)
        new[1:] = (key[1:] != key[:-1]) | (hashes[1:] != hashes[:-1])
        #: distinct stretches: their first occurrence, key, hash and least id
        self.distinct = np.flatnonzero(new)
        self.which = np.cumsum(new) - 1
        self.string_key, self.string_hash = key[new], hashes[new]
        ids = self.ids[self.text]
        self.least = np.minimum.reduceat(ids, self.distinct) if len(ids) else ids

    def _hashes(self, start: np.ndarray) -> np.ndarray:
        """Hash of the window at each place."""
        weights = packed.powers(self.size, _P)
        out = np.empty(len(start), dtype=np.uint64)
        for a in range(0, len(start), 8192):
            at = start[a : a + 8192, None] + np.arange(self.size)
            out[a : a + 8192] = (_VALUES[self.data[at]] * weights).sum(axis=1, dtype=np.uint64)
        return packed.mix64(out + np.uint64(self.size))

    def bytes_of(self, strings: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        start, end = self.start[self.distinct[strings]], self.end[self.distinct[strings]]
        length = end - start
        first = np.cumsum(length) - length
        at = np.repeat(start - first, length) + np.arange(int(length.sum()))
        return self.data[at], length


def _name_keys(doc_id: str, text: str, size: int, buckets: int):
    def run(table: pa.Table) -> pa.Table:
        batch = table.column(exchange.BATCH)[0].as_py()
        found = _Stretches(table, doc_id, text, size, buckets)
        two = found.in_two_texts()
        names, bounds = exchange.bucket_bounds(found.keys >> np.uint64(32))
        low = found.keys.astype(np.uint32)
        around = np.minimum(found.surroundings(), 65535).astype(np.uint16)
        return pa.table(
            {
                "bucket": pa.array(names.astype(np.int32)),
                "batch": pa.array(np.full(len(names), batch, np.int32)),
                "keys": pa.array([low[a:b].tobytes() for a, b in zip(bounds, bounds[1:])], pa.binary()),
                "two": pa.array([np.packbits(two[a:b]).tobytes() for a, b in zip(bounds, bounds[1:])], pa.binary()),
                "around": pa.array([exchange.squeezed(around[a:b]) for a, b in zip(bounds, bounds[1:])], pa.binary()),
            }
        )

    return run


def _tell_shared(often: int):
    def run(table: pa.Table) -> pa.Table:
        keys = [np.frombuffer(x, np.uint32) for x in table.column("keys").to_pylist()]
        counts = np.array([len(k) for k in keys])
        two = np.concatenate(
            [np.unpackbits(np.frombuffer(x, np.uint8), count=n) for x, n in zip(table.column("two").to_pylist(), counts)]
        )
        around = np.concatenate(
            [exchange.loose(x, n, np.uint16) for x, n in zip(table.column("around").to_pylist(), counts)]
        )
        _, inverse, n = np.unique(np.concatenate(keys), return_inverse=True, return_counts=True)
        inverse = inverse.reshape(-1)
        shared = (n > 1) | (np.bincount(inverse, weights=two) > 0)
        many = np.bincount(inverse, weights=around) >= often
        first = np.concatenate([[0], np.cumsum(counts)])
        flags = [(shared[inverse[a:b]], many[inverse[a:b]]) for a, b in zip(first, first[1:])]
        return pa.table(
            {
                "batch": table.column("batch"),
                "bucket": table.column("bucket"),
                "shared": pa.array([np.packbits(x).tobytes() for x, _ in flags], pa.binary()),
                "often": pa.array([np.packbits(x).tobytes() for _, x in flags], pa.binary()),
            }
        )

    return run


def _send_stretches(doc_id: str, text: str, size: int, buckets: int):
    schema = pa.schema(
        [("bucket", pa.int32()), ("batch", pa.int32()), ("n", pa.int32()), ("n_bytes", pa.int64()), ("body", pa.binary()), ("lengths", pa.binary()), ("keys", pa.binary()), ("least", pa.binary())]
    )

    def run(table: pa.Table, answers: pa.Table) -> pa.Table:
        if not table.num_rows or not answers.num_rows:
            return schema.empty_table()
        batch = table.column(exchange.BATCH)[0].as_py()
        found = _Stretches(table, doc_id, text, size, buckets)
        found.shared(answers)
        names, bounds = exchange.bucket_bounds(found.string_key >> np.uint64(32))
        rows = []
        for name, a, b in zip(names, bounds, bounds[1:]):
            body, length = found.bytes_of(np.arange(a, b))
            low = found.string_key[a:b].astype(np.uint32)
            low = np.diff(low, prepend=np.uint32(0))  # sorted: differences pack better
            meta = (length.astype(np.uint32), low, found.least[a:b])
            rows.append((int(name), batch, int(b - a), len(body), exchange.squeezed(body), *map(exchange.squeezed, meta)))
        return pa.table([pa.array(x, f.type) for x, f in zip(zip(*rows), schema)] if rows else schema.empty_table().columns, schema=schema)

    return run


def _find_holders(size: int):
    def run(table: pa.Table) -> pa.Table:
        rows = table.to_pylist()
        n = [row["n"] for row in rows]
        unpack = lambda name, kind: [exchange.loose(row[name], row["n"], kind) for row in rows]
        lengths_of = [x.astype(np.int64) for x in unpack("lengths", np.uint32)]
        length = np.concatenate(lengths_of)
        key = np.concatenate([np.cumsum(x, dtype=np.uint32) for x in unpack("keys", np.uint32)])
        least = np.concatenate(unpack("least", np.int64))
        bodies = [exchange.loose(row["body"], row["n_bytes"], np.uint8) for row in rows]
        longest = max(CHUNK, *map(len, bodies), int(length.max()))
        table_of = [packed.powers(longest, _P), packed.powers(longest, _P_INVERSE)]
        ends_of = [np.cumsum(x) for x in lengths_of]
        hashes = np.concatenate(
            [_hashes_between(x, e - n, e, *table_of) for x, n, e in zip(bodies, lengths_of, ends_of)]
        )
        data = np.concatenate(bodies)
        order = np.lexsort((hashes, key))
        new = np.ones(len(order), dtype=bool)
        new[1:] = (key[order][1:] != key[order][:-1]) | (hashes[order][1:] != hashes[order][:-1])
        at = np.flatnonzero(new)
        which = np.empty(len(order), dtype=np.int64)
        which[order] = np.cumsum(new) - 1
        one = order[at]  # one row of each distinct stretch
        holder = np.minimum.reduceat(least[order], at)
        # A stretch that is alone under its key shares no window with another.
        _, group, several = np.unique(key[one], return_inverse=True, return_counts=True)
        mixed = np.flatnonzero(several[group.reshape(-1)] > 1)
        least_of: list[np.ndarray] = [np.zeros(0, np.int64)]
        start = np.cumsum(length) - length
        # Keys are worked through some at a time: no window spans two of them.
        until = np.cumsum(length[one[mixed]])
        names = key[one[mixed]]
        last = np.ones(len(mixed), dtype=bool)
        last[:-1] = names[1:] != names[:-1]
        ends_of_keys = np.flatnonzero(last) + 1
        a = 0
        while a < len(mixed):
            done = until[a - 1] if a else 0
            fits = ends_of_keys[(ends_of_keys > a) & (until[ends_of_keys - 1] - done <= CHUNK)]
            b = int(fits[-1]) if len(fits) else int(ends_of_keys[np.searchsorted(ends_of_keys, a, side="right")])
            pick = one[mixed[a:b]]
            lengths = length[pick]
            first = np.cumsum(lengths) - lengths
            body = data[np.repeat(start[pick] - first, lengths) + np.arange(int(lengths.sum()))]
            if len(body) > len(table_of[0]):
                table_of = [packed.powers(len(body), _P), packed.powers(len(body), _P_INVERSE)]
            # Stretches without a window that another one has need no index.
            n_windows = lengths - size + 1
            first_window = np.cumsum(n_windows) - n_windows
            at = np.repeat(first - first_window, n_windows) + np.arange(int(n_windows.sum()))
            _, same, times = np.unique(_hashes_between(body, at, at + size, *table_of), return_inverse=True, return_counts=True)
            met = np.add.reduceat((times > 1)[same.reshape(-1)], first_window, dtype=np.int64) > 0
            out = np.repeat(holder[mixed[a:b]], n_windows)
            if met.any():
                index = RunLengthIndex(body[np.repeat(met, lengths)], lengths[met], holder[mixed[a:b]][met], size)
                out[np.repeat(met, n_windows)] = index.least_owners()
            least_of.append(out)
            a = b
        # Runs of windows with one least document: one run for a stretch that is alone.
        flat = np.concatenate(least_of)
        windows = length[one[mixed]] - size + 1
        first = np.cumsum(windows) - windows
        change = np.ones(len(flat), dtype=bool)
        change[1:] = flat[1:] != flat[:-1]
        change[first] = True
        at = np.flatnonzero(change)
        in_string = np.searchsorted(first, at, side="right") - 1
        n_runs = np.ones(len(one), dtype=np.int64)
        n_runs[mixed] = np.bincount(in_string, minlength=len(mixed))
        run_ends = np.repeat(length[one] - size + 1, n_runs)
        run_ids = np.repeat(holder, n_runs)
        of_mixed = np.repeat(several[group.reshape(-1)] > 1, n_runs)
        run_ends[of_mixed] = np.append(at[1:], len(flat))[: len(at)] - first[in_string]
        run_ids[of_mixed] = flat[at]
        run_first = np.cumsum(n_runs) - n_runs
        answers, place = [], 0
        for count in n:
            asked = which[place : place + count]
            place += count
            runs = n_runs[asked]
            at = np.repeat(run_first[asked] - (np.cumsum(runs) - runs), runs) + np.arange(int(runs.sum()))
            packed_runs = (runs.astype(np.int32), run_ends[at].astype(np.int32), run_ids[at])
            answers.append([len(at), *map(exchange.squeezed, packed_runs)])
        columns = list(zip(*answers))
        return pa.table(
            {
                "batch": table.column("batch"),
                "bucket": table.column("bucket"),
                "n_runs": pa.array(columns[0], pa.int32()),
                **{name: pa.array(x, pa.binary()) for name, x in zip(("runs", "ends", "ids"), columns[1:])},
            }
        )

    return run


def _cut(doc_id: str, text: str, size: int, buckets: int, names: list[str], keep_bytes: bool):
    def run(table: pa.Table, told: pa.Table) -> pa.Table:
        """``told`` has both kinds of answers: on keys and on stretches."""
        rows = table.num_rows
        if not rows:
            return pa.table({name: table.column(name) for name in names}).slice(0, 0)
        found = _Stretches(table, doc_id, text, size, buckets)
        marks = np.zeros(len(found.data), dtype=bool)
        kinds = told.column("kind").to_pylist()
        on_keys = told.filter(pa.array([kind == 0 for kind in kinds], pa.bool_()))
        if on_keys.num_rows:
            found.shared(on_keys)
            bucket = (found.string_key >> np.uint64(32)).astype(np.int64)
            answers = {row["bucket"]: row for row in told.to_pylist() if row["kind"] == 1}
            by_bucket, bounds = exchange.bucket_bounds(bucket)
            runs, ends, ids = [], [], []
            for name, a, b in zip(by_bucket, bounds, bounds[1:]):
                row = answers[int(name)]
                runs.append(exchange.loose(row["runs"], b - a, np.int32))
                ends.append(exchange.loose(row["ends"], row["n_runs"], np.int32))
                ids.append(exchange.loose(row["ids"], row["n_runs"], np.int64))
            if runs:
                runs, ends, ids = np.concatenate(runs), np.concatenate(ends).astype(np.int64), np.concatenate(ids)
                first = np.cumsum(runs) - runs
                begin = np.concatenate([[0], ends[:-1]])
                begin[first] = 0
                # Runs of each occurrence of a stretch.
                n = runs[found.which].astype(np.int64)
                at = np.repeat(first[found.which] - (np.cumsum(n) - n), n) + np.arange(int(n.sum()))
                owner = np.repeat(found.ids[found.text], n)
                start = np.repeat(found.start, n)
                hit = ids[at] < owner
                a, b = (start + begin[at])[hit], (start + ends[at])[hit] + size - 1
                marks = packed.covered(a, b - a, len(found.data))
        n_removed = packed.sums(marks, found.offsets)
        starts, ends, firsts = packed.spans(found.data, found.offsets, marks)
        data, offsets = found.data, found.offsets
        kept = []
        for a, b, gone in zip(offsets, offsets[1:], n_removed):
            body = data[a:b]
            kept.append((body[~marks[a:b]] if gone else body).tobytes())
        out = {name: table.column(name) for name in names}
        out["n_bytes"] = pa.array(np.diff(offsets))
        out["n_removed"] = pa.array(n_removed)
        out["n_spans"] = pa.array(np.diff(firsts))
        out["kept_sha256"] = pa.array([hashlib.sha256(x).hexdigest() for x in kept], pa.string())
        if keep_bytes:
            out["kept"] = pa.array(kept, pa.binary())
            base = offsets[packed.owners(firsts)] if len(starts) else starts
            pairs = np.stack([starts - base, ends - base], axis=1) if len(starts) else np.zeros((0, 2), np.int64)
            out["removed"] = pa.array([pairs[a:b].tolist() for a, b in zip(firsts, firsts[1:])], pa.list_(pa.list_(pa.int64())))
        return pa.table(out)

    return run


def remove_repeats(
    docs: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    size: int = 50,
    keep_bytes: bool = True,
    batch_bytes: int = 8 * 2**20,
    bucket_bytes: int = 4 * 2**20,
    often: int = 4096,
) -> DataFrame:
    """Removes what a document shares with one of a smaller id, in strings of ``size`` bytes.

    Returns the columns of ``docs`` but the text, with ``n_bytes``,
    ``n_removed``, ``n_spans``, ``kept_sha256`` and, with ``keep_bytes``,
    ``kept`` (remaining bytes) and ``removed`` ([start, end) of each run);
    input columns so named are replaced. Strings are judged on the input.

    NULL texts are empty. NULL ids come after all others; rows with equal ids
    remove nothing from one another. Texts shorter than ``size`` stay whole.
    ``docs`` must be the same rows whenever it is read, as from stored tables.

    A batch's texts and a bucket's stretches are worked on whole, both of
    bounded size: copies of a stretch count once per batch, and a key with
    ``often`` different stretches is split by window.
    """
    if size < KMER:
        raise ValueError(f"size must be at least {KMER}")
    added = ["n_bytes", "n_removed", "n_spans", "kept_sha256"] + ["kept", "removed"] * keep_bytes
    docs = docs.select(*[F.col(f"`{c}`") for c in docs.columns if c.lower() not in added])
    total = exchange.text_bytes(docs, text)
    batches, buckets = exchange.parts(total, batch_bytes), exchange.parts(total, bucket_bytes)
    dealt = docs.withColumn(exchange.BATCH, exchange.batch_of(docs, batches))
    by_batch = dealt.groupBy(exchange.BATCH)

    named = by_batch.applyInArrow(
        _name_keys(doc_id, text, size, buckets), "bucket int, batch int, keys binary, two binary, around binary"
    )
    shared = named.groupBy("bucket").applyInArrow(
        _tell_shared(often), "batch int, bucket int, shared binary, often binary"
    )
    sent = by_batch.cogroup(shared.groupBy("batch")).applyInArrow(
        _send_stretches(doc_id, text, size, buckets),
        "bucket int, batch int, n int, n_bytes bigint, body binary, lengths binary, keys binary, least binary",
    )
    held = sent.groupBy("bucket").applyInArrow(
        _find_holders(size), "batch int, bucket int, n_runs int, runs binary, ends binary, ids binary"
    )
    told = shared.withColumn("kind", F.lit(0)).unionByName(
        held.withColumn("kind", F.lit(1)), allowMissingColumns=True
    )
    kept = [field for field in docs.schema.fields if field.name != text]
    counts = [T.StructField(name, T.LongType()) for name in added[:3]] + [T.StructField("kept_sha256", T.StringType())]
    if keep_bytes:
        counts += [
            T.StructField("kept", T.BinaryType()),
            T.StructField("removed", T.ArrayType(T.ArrayType(T.LongType()))),
        ]
    return by_batch.cogroup(told.groupBy("batch")).applyInArrow(
        _cut(doc_id, text, size, buckets, [f.name for f in kept], keep_bytes), T.StructType(kept + counts)
    )

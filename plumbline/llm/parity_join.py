"""Shingle-set similarity join by parity sketches.

Sets with Jaccard similarity of at least 85 % differ in a bounded number of
shingles. Every shingle is XOR-ed into one of ``m`` cells of a sketch, so the
number of cells in which two sketches differ is at most the number of
differing shingles. With ``m`` above that bound at least one cell agrees, and
an equi-join on cells finds every pair. A finer sketch of single bits bounds
the difference from below by its Hamming distance and drops most false pairs;
the rest is verified on the sets themselves.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from plumbline.llm import key_filter, packed
from plumbline.llm.components import components
from plumbline.llm.tables import free_shuffles, in_small_batches, row_hash, stored

SHINGLE, PERCENT = 4, 85
STARS = 2  # rounds in which a cell's classes are compared with one of them
CROWDED = 64  # classes up to which a cell has one such round: comparing them pair by pair costs no more
BLOCK = 4096  # classes of a cell compared pair by pair in one task
CELL_BITS = 48  # of a cell's key; unrelated cells that agree in them cost a comparison and no result
SHARED, OWN = 2, 1  # marks of a set's cell
PARTS = 255  # tasks that classes of a cell met within a batch are dealt to


def most_different(total: int | np.ndarray, percent: int = PERCENT):
    """Greatest symmetric difference of two linked sets whose sizes add up to ``total``."""
    return (100 - percent) * total // (100 + percent)


def bands(longest: int, percent: int = PERCENT) -> np.ndarray:
    """Edges of size bands: linked sets lie in one band or in neighbouring ones."""
    edges = [1]
    while edges[-1] <= longest:
        edges.append(max(edges[-1] + 1, -(-edges[-1] * 100 // percent)))
    edges.append(max(edges[-1] + 1, -(-edges[-1] * 100 // percent)))
    edges.append(max(edges[-1] + 1, -(-edges[-1] * 100 // percent)))
    return np.array(edges, dtype=np.int64)


def shingle_sets(column: pa.Array, size: int = SHINGLE) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct shingle hashes of each text, flat, and the first of each text."""
    data, offsets = packed.utf8(column)
    data = packed.LOWER[data]
    starts, ends, firsts = packed.spans(data, offsets, packed.WORD[data])
    words = packed.span_hashes(data, starts, ends)
    counts = np.diff(firsts)
    hashes = packed.window_hashes(words, size)
    places = np.flatnonzero(packed.windows_inside(firsts, size, len(hashes)))
    text = packed.owners(firsts)[places]
    values = hashes[places]
    for length in range(1, size):  # shorter texts are one shingle
        short = np.flatnonzero(counts == length)
        if len(short):
            whole = packed.window_hashes(words, length)[firsts[short]]
            text = np.append(text, short)
            values = np.append(values, packed.mix64(whole + np.uint64(length)))
    order = np.lexsort((values, text))
    text, values = text[order], values[order]
    new = np.ones(len(values), dtype=bool)
    new[1:] = (values[1:] != values[:-1]) | (text[1:] != text[:-1])
    text, values = text[new], values[new]
    return values, np.searchsorted(text, np.arange(len(counts) + 1))


def set_hashes(values: np.ndarray, firsts: np.ndarray) -> np.ndarray:
    """64-bit hash of each set."""
    spread = packed.mix64(values ^ np.uint64(0x5851F42D4C957F2D))
    total = np.zeros(len(spread) + 1, dtype=np.uint64)
    np.cumsum(spread, out=total[1:])
    sums = total[firsts[1:]] - total[firsts[:-1]]
    return packed.mix64(sums + np.diff(firsts).astype(np.uint64)).view(np.int64)


def sketches(values: np.ndarray, firsts: np.ndarray) -> list[bytes]:
    """Parity bits of each set: one per shingle, rounded up to a power of two.

    Sketches are shuffled with every candidate, so they are short: unrelated
    sets still differ in about half of the bits, a third being allowed at 80 %.
    """
    counts = np.diff(firsts)
    bits = np.array([max(64, 1 << int(n - 1).bit_length()) if n else 0 for n in counts], np.int64)
    start = np.concatenate([[0], np.cumsum(bits)])
    place = packed.mix64(values ^ np.uint64(0x2545F4914F6CDD1D))
    place = (place & np.repeat(bits - 1, counts).astype(np.uint64)).astype(np.int64)
    place += np.repeat(start[:-1], counts)
    odd = (np.bincount(place, minlength=int(start[-1])) & 1).astype(np.uint8)
    packed_bits = np.packbits(odd, bitorder="little").tobytes()
    return [packed_bits[a // 8 : b // 8] for a, b in zip(start, start[1:])]


def cell_keys(values: np.ndarray, firsts: np.ndarray, percent: int = PERCENT) -> tuple[np.ndarray, np.ndarray]:
    """Keys of each set's cells, in its own band and the next larger one, and their set.

    Cells are ranges of the shingle hash, so sorted sets need no further sort.
    Empty cells give no key, unless a set fills so few cells that two such
    sets might agree in empty cells alone. The lowest bit of a key is that of
    its band: with the size of a set it tells whether the band is its own.
    """
    counts = np.diff(firsts)
    if not len(values):
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    edges = bands(int(counts.max()), percent)
    own = np.searchsorted(edges, counts, side="right") - 1
    spread = packed.mix64(values ^ np.uint64(0x9FB21C651E98DF25))
    high = values >> np.uint64(32)
    keys, sets = [], []
    for band in (own, own + 1):
        bound = most_different(2 * (edges[band + 1] - 1), percent)
        cells = np.where((bound > 0) & (counts > 0), bound + 1 + bound // 32 + 1, 0)
        owner = np.repeat(np.arange(len(counts)), counts)
        cell = ((high * cells[owner].astype(np.uint64)) >> np.uint64(32)).astype(np.int64)
        first = np.ones(len(values), dtype=bool)
        first[1:] = (cell[1:] != cell[:-1]) | (owner[1:] != owner[:-1])
        at = np.flatnonzero(first)
        used = cells[owner[at]] > 0
        xor = np.bitwise_xor.reduceat(spread, at)
        place = packed.mix64((band[owner[at]] << 32 | cell[at]).astype(np.uint64))
        low = (band[owner[at]] & 1).astype(np.uint64)
        keys.append(packed.mix64(xor[used] ^ place[used]) & ~np.uint64(1) | low[used])
        sets.append(owner[at][used])
        filled = np.bincount(owner[at][used], minlength=len(counts))
        for few in np.flatnonzero((cells > 0) & (filled <= bound)):
            empty = np.setdiff1d(np.arange(cells[few]), cell[firsts[few] : firsts[few + 1]])
            place = packed.mix64((band[few] << 32 | empty).astype(np.uint64))
            key = packed.mix64(place ^ np.uint64(0xE7037ED1A0B428DB))
            keys.append(key & ~np.uint64(1) | np.uint64(int(band[few]) & 1))
            sets.append(np.full(len(empty), few))
    return np.concatenate(keys), np.concatenate(sets)


def own_cells(keys: np.ndarray, counts: np.ndarray, percent: int = PERCENT) -> np.ndarray:
    """Whether each key is of a cell in the own band of its set, which has ``counts`` shingles.

    Two sets of a band meet in its own cells; in those of the next band they need no second look.
    """
    if not len(keys):
        return np.zeros(0, dtype=bool)
    own = np.searchsorted(bands(int(counts.max()), percent), counts, side="right") - 1
    return (own & 1) == (keys & keys.dtype.type(1)).astype(np.int64)


def _describe(batches: Iterator[pa.RecordBatch], size: int) -> Iterator[pa.RecordBatch]:
    for whole in batches:
        for batch in packed.chunks(whole, "text"):
            values, firsts = shingle_sets(batch.column("text"), size)
            counts = np.diff(firsts)
            names = pa.array(set_hashes(values, firsts), mask=counts == 0)
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(c) for c in ("row", "doc_id")), pa.array(counts), names, pa.array(sketches(values, firsts), pa.binary())],
                names=["row", "doc_id", "n", "cls", "sketch"],
            )


def _cells(batches: Iterator[pa.RecordBatch], size: int, percent: int) -> Iterator[pa.RecordBatch]:
    """Cells of each set. Where sets of a batch meet in one, it is marked ``SHARED``.

    Then one of them stands for the batch in part 0, which finds out if other
    batches have the cell; the others need not go there. ``OWN`` marks a cell
    of the set's own band, or, where a set stands for others, of one of theirs.
    """
    seen: set[int] = set()  # sets already sent by this task: copies add nothing
    for whole in batches:
        for batch in packed.chunks(whole, "text"):
            values, firsts = shingle_sets(batch.column("text"), size)
            names = set_hashes(values, firsts)
            keys, sets = cell_keys(values, firsts, percent)
            new = np.array([not (name in seen or seen.add(name)) for name in names.tolist()], dtype=bool)
            if len(seen) > 2_000_000:
                seen.clear()
            kept = new[sets]
            keys &= np.uint64((1 << CELL_BITS) - 1)
            own = own_cells(keys[kept], np.diff(firsts)[sets[kept]], percent)
            keys, classes = keys[kept].view(np.int64), names[sets[kept]]
            order = np.argsort(keys)
            keys, classes, own = keys[order], classes[order], own[order]
            repeated = np.zeros(len(keys) + 1, dtype=bool)
            repeated[1:-1] = keys[1:] == keys[:-1]
            at = np.flatnonzero(~repeated[:-1])
            if len(at):
                own[at] = np.logical_or.reduceat(own, at)
            part = np.where(repeated[:-1], 1 + classes % PARTS, 0).astype(np.int16)
            marks = (SHARED * (repeated[:-1] | repeated[1:]) + OWN * own).astype(np.int8)
            yield pa.RecordBatch.from_arrays(
                [pa.array(classes), pa.array(keys), pa.array(part), pa.array(marks)],
                names=["cls", "h", "part", "marks"],
            )


def _sets(batches: Iterator[pa.RecordBatch], size: int, known) -> Iterator[pa.RecordBatch]:
    """Sets of the rows that may be wanted, so that no text needs to be shuffled."""
    for whole in batches:
        likely = key_filter.may_hold(known.value, whole.column("row").to_numpy())
        for batch in packed.chunks(whole.filter(pa.array(likely)), "text"):
            values, firsts = shingle_sets(batch.column("text"), size)
            flat = values.tobytes()
            yield pa.RecordBatch.from_arrays(
                [
                    *(batch.column(c) for c in ("row", "doc_id")),
                    pa.array([flat[8 * a : 8 * b] for a, b in zip(firsts, firsts[1:])], pa.binary()),
                ],
                names=["row", "doc_id", "members"],
            )


def _folded(sketch: bytes, width: int) -> np.ndarray:
    bits = np.frombuffer(sketch, np.uint64)
    while len(bits) > width:
        bits = bits[: len(bits) // 2] ^ bits[len(bits) // 2 :]
    return bits


def _may_link(sizes_a, sizes_b, distance, percent: int) -> np.ndarray:
    return distance <= most_different(sizes_a + sizes_b, percent)


def _near(batches: Iterator[pa.RecordBatch], percent: int) -> Iterator[pa.RecordBatch]:
    """Pairs whose sketches leave a link possible."""
    for batch in batches:
        sizes = [batch.column(c).to_numpy(zero_copy_only=False) for c in ("na", "nb")]
        left, right = batch.column("sa").to_pylist(), batch.column("sb").to_pylist()
        distance = np.zeros(batch.num_rows, dtype=np.int64)
        for place, (x, y) in enumerate(zip(left, right)):
            width = min(len(x), len(y)) // 8
            distance[place] = np.bitwise_count(_folded(x, width) ^ _folded(y, width)).sum()
        close = _may_link(*sizes, distance, percent)
        yield batch.select(["a", "b"]).filter(pa.array(close))


def _verified(batches: Iterator[pa.RecordBatch], percent: int) -> Iterator[pa.RecordBatch]:
    """Pairs whose sets are similar, with the size of their intersection."""
    for batch in batches:
        left, right = batch.column("ma").to_pylist(), batch.column("mb").to_pylist()
        linked = []
        for x, y in zip(left, right):
            x, y = np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64)
            both = np.concatenate([x, y])
            both.sort()
            common = int((both[1:] == both[:-1]).sum())
            linked.append(100 * common >= percent * (len(x) + len(y) - common))
        yield batch.select(["a", "b"]).filter(pa.array(linked, pa.bool_()))


def _groups(batches: Iterator[pa.RecordBatch]) -> Iterator[dict[str, np.ndarray | list]]:
    """Consecutive rows with equal (h, i, j), each group of at most two blocks."""
    rest = None
    for batch in batches:
        table = pa.Table.from_batches([batch])
        table = table if rest is None else pa.concat_tables([rest, table]).combine_chunks()
        keys = np.stack([table.column(c).to_numpy() for c in ("h", "i", "j")])
        change = np.flatnonzero((keys[:, 1:] != keys[:, :-1]).any(axis=0)) + 1
        bounds = [0, *change.tolist()]
        for a, b in zip(bounds, bounds[1:]):
            yield table.slice(a, b - a).to_pydict()
        rest = table.slice(bounds[-1])
    if rest is not None and rest.num_rows:
        yield rest.to_pydict()


def _apart(batches: Iterator[pa.RecordBatch], percent: int) -> Iterator[pa.RecordBatch]:
    """Pairs of one cell in different components whose sketches leave a link possible."""
    for group in _groups(batches):
        width = min(len(s) for s in group["sketch"]) // 8
        bits = np.stack([_folded(s, width) for s in group["sketch"]])
        size, label = np.array(group["n"]), np.array(group["label"])
        above = ~own_cells(np.array(group["h"]), size, percent)
        names, block = np.array(group["cls"]), np.array(group["block"])
        a, b = [], []
        for place in range(len(names) - 1):
            rest = slice(place + 1, None)
            open_ = (label[rest] != label[place]) & ((group["i"][0] == group["j"][0]) | (block[rest] != block[place]))
            open_ &= ~(above[rest] & above[place])
            at = np.flatnonzero(open_) + place + 1
            distance = np.bitwise_count(bits[at] ^ bits[place]).sum(axis=1, dtype=np.int64)
            at = at[_may_link(size[at], size[place], distance, percent)]
            a.append(np.full(len(at), names[place]))
            b.append(names[at])
        if a and sum(map(len, a)):
            x, y = np.concatenate(a), np.concatenate(b)
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.minimum(x, y)), pa.array(np.maximum(x, y))], names=["a", "b"]
            )


def _links(pairs: DataFrame, members: DataFrame, percent: int) -> DataFrame:
    left = members.select(F.col("cls").alias("a"), F.col("members").alias("ma"))
    right = members.select(F.col("cls").alias("b"), F.col("members").alias("mb"))
    return pairs.join(left, "a").join(right, "b").select("a", "b", "ma", "mb").mapInArrow(
        partial(_verified, percent=percent), "a bigint, b bigint"
    )


def _classes(
    docs: DataFrame, doc_id: str, text: str, size: int = SHINGLE, percent: int = PERCENT
) -> tuple[DataFrame, DataFrame]:
    """Rows (row, doc_id, n, cls) and the label of every class that is linked to another.

    Rows with equal shingle sets are one class and linked. Of the classes that
    share a cell, one at random is compared with all others, once, and ``STARS``
    times in cells of more than ``CROWDED`` classes, whose pairs are many;
    the others of a cell, where that leaves them in different components, are
    compared pair by pair in blocks of ``BLOCK`` classes, sketches first. A
    cell that is of no class's own band is left out, the classes being of one
    band and meeting in the cells of that. So no link is lost and
    no cell, not even one that a third of all rows share, is gathered in one
    task: a cell sends one class per batch to the task that finds whether it is
    shared, its counts combine before they are shuffled, and its classes meet
    them in a plain join, which adaptive execution can split. A row without
    words has a NULL class.
    """
    rows = in_small_batches(docs).select(
        F.col(doc_id).alias("doc_id"), F.col(text).alias("text")
    ).withColumn("row", row_hash("doc_id", "text"))
    id_type = rows.schema["doc_id"].dataType.simpleString()
    context = docs.sparkSession.sparkContext
    described = stored(
        rows.select("row", "doc_id", "text")
        .mapInArrow(partial(_describe, size=size), f"row bigint, doc_id {id_type}, n bigint, cls bigint, sketch binary"),
        "parity-rows",
    )
    info = described.where("cls IS NOT NULL").groupBy("cls").agg(
        F.first("n").alias("n"), F.min(F.struct("row", "doc_id", "sketch")).alias("least")
    ).select("cls", "n", "least.row", "least.doc_id", "least.sketch")
    info = stored(info, "parity-classes")

    in_part = Window.partitionBy("h", "part")
    cells = stored(
        rows.select("text")
        .mapInArrow(partial(_cells, size=size, percent=percent), "cls bigint, h bigint, part smallint, marks tinyint")
        .withColumns(
            {
                "least": F.min("cls").over(in_part),
                "most": F.max("cls").over(in_part),
                "shared": F.max(F.col("marks").bitwiseAND(SHARED) > 0).over(in_part),
                "owned": F.max(F.col("marks").bitwiseAND(OWN) > 0).over(in_part),
            }
        )
        .where("(shared OR least < most) AND (owned OR part != 0)")
        .groupBy("h", "cls")
        .agg(F.max(F.col("marks").bitwiseAND(OWN) > 0).alias("own")),
        "parity-cells",
    )
    free_shuffles(docs.sparkSession)

    def near(pairs: DataFrame) -> DataFrame:
        left = info.select(F.col("cls").alias("a"), F.col("n").alias("na"), F.col("sketch").alias("sa"))
        right = info.select(F.col("cls").alias("b"), F.col("n").alias("nb"), F.col("sketch").alias("sb"))
        return pairs.join(left, "a").join(right, "b").select("a", "b", "na", "nb", "sa", "sb").mapInArrow(
            partial(_near, percent=percent), "a bigint, b bigint"
        )

    def members(pairs: DataFrame) -> DataFrame:
        wanted = pairs.select(F.explode(F.array("a", "b")).alias("cls")).distinct()
        chosen = wanted.join(info, "cls").select("cls", F.col("row").alias("of"), F.col("doc_id").alias("id"))
        chosen = stored(chosen, "parity-chosen")
        known = context.broadcast(key_filter.bitmap(chosen, "of"))
        sets = rows.select("row", "doc_id", "text").mapInArrow(
            partial(_sets, size=size, known=known), f"row bigint, doc_id {id_type}, members binary"
        )
        found = sets.join(chosen, _same_row("row", "doc_id", "of", "id")).dropDuplicates(["cls"])
        return stored(found.select("cls", "members"), "parity-sets")

    def open_cells(
        among: DataFrame, labels: DataFrame | None, seeds: range, least_size: int = 2
    ) -> tuple[DataFrame, DataFrame]:
        """Of the cells ``among`` those that are not all in one component, with their size and centres; and their classes."""
        if labels is None:
            labelled = among.withColumn("label", F.col("cls"))
        else:
            labelled = among.join(labels.withColumnRenamed("node", "cls"), "cls", "left").withColumn(
                "label", F.coalesce("label", "cls")
            )
        centres = [
            F.min(F.struct(F.xxhash64(F.lit(seed), "h", "cls").alias("by"), "cls", "label", "own")).alias(f"centre_{seed}")
            for seed in seeds
        ]
        names = [f"centre_{seed}" for seed in seeds]
        several = stored(
            labelled.groupBy("h")
            .agg(
                F.min("label").alias("least"), F.max("label").alias("most"),
                F.count("*").alias("size"), F.max("own").alias("owned"), *centres,
            )
            .where((F.col("least") < F.col("most")) & F.col("owned") & (F.col("size") >= least_size))
            .select("h", "size", *names),
            "parity-open",
        )
        return several, labelled.join(several, "h").select("h", "cls", "label", "own", "size", *names)

    links, labels, among = None, None, cells
    for seed in range(STARS):
        several, opened = open_cells(among, labels, range(seed, seed + 1))
        opened = opened.withColumnRenamed(f"centre_{seed}", "centre")
        if seed == 0:
            # Stored, so that the plan knows how few they are.
            crowded = stored(several.where(F.col("size") > CROWDED).select("h"), "parity-crowded")
            among = cells.join(crowded, "h", "left_semi")
        stars = opened.where("label != centre.label AND (own OR centre.own)")
        pairs = stars.select(
            F.least("cls", "centre.cls").alias("a"), F.greatest("cls", "centre.cls").alias("b")
        ).distinct()
        pairs = stored(near(pairs), "parity-stars")
        free_shuffles(docs.sparkSession)
        found = stored(_links(pairs, members(pairs), percent), "parity-links")
        free_shuffles(docs.sparkSession)
        links = found if links is None else links.union(found)
        labels = components(links)

    # The centres have been compared with all others, which settles cells of two.
    rest = open_cells(cells, labels, range(STARS), least_size=3)[1]
    for seed in range(STARS):
        rest = rest.where((F.col("cls") != F.col(f"centre_{seed}.cls")) | (F.lit(seed > 0) & (F.col("size") <= CROWDED)))
    split = (
        rest.withColumn("blocks", F.ceil(F.col("size") / F.lit(BLOCK)).cast("int"))
        .withColumn("block", F.pmod(F.xxhash64("cls"), F.col("blocks")).cast("int"))
        .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
        .select(
            "h", F.least("block", "other").alias("i"), F.greatest("block", "other").alias("j"), "block", "cls", "label"
        )
        .join(info.select("cls", "n", "sketch"), "cls")
        .select("h", "i", "j", "block", "cls", "label", "n", "sketch")
    )
    apart = stored(
        split.repartition("h", "i", "j")
        .sortWithinPartitions("h", "i", "j")
        .mapInArrow(partial(_apart, percent=percent), "a bigint, b bigint")
        .distinct(),
        "parity-apart",
    )
    free_shuffles(docs.sparkSession)
    more = stored(_links(apart, members(apart), percent), "parity-links")
    free_shuffles(docs.sparkSession)
    labels = components(links.union(more)).withColumnRenamed("node", "cls")
    return described.drop("sketch"), labels


def _same_row(row: str, doc_id: str, other_row: str, other_id: str) -> Column:
    """Equal hash and id: at this number of rows a hash alone may stand for two of them."""
    return (F.col(row) == F.col(other_row)) & F.col(doc_id).eqNullSafe(F.col(other_id))


def _labelled(per_class: DataFrame, labels: DataFrame) -> DataFrame:
    return per_class.join(labels, "cls", "left").withColumn("label", F.coalesce("label", "cls"))


def similar(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Every row of ``docs`` (its id) with ``n_shingles`` and ``component_id``.

    Rows without words (NULL, empty) link with nothing: ``n_shingles`` is 0 and
    the component their own id. NULL ids take part and never name a component
    that has another id. Repeated rows and ids are each returned; equal ids
    alone are no link.
    """
    described, labels = _classes(docs, doc_id, text)
    lowest = _labelled(
        described.where("cls IS NOT NULL").groupBy("cls").agg(F.min("doc_id").alias("lowest")), labels
    )
    named = lowest.groupBy("label").agg(F.min("lowest").alias("component_id"))
    by_class = lowest.join(named, "label").select("cls", "component_id")
    return described.join(by_class, "cls", "left").select(
        "doc_id",
        F.col("n").alias("n_shingles"),
        F.coalesce("component_id", "doc_id").alias("component_id"),
    )


def keep_one(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", size: int = SHINGLE, percent: int = PERCENT
) -> DataFrame:
    """One row per component: the one with the least id. Rows without words all stay.

    Two rows are linked whose sets of ``size`` words have a Jaccard of at least
    ``percent``.

    Components are told apart by their texts: rows of different components
    stay although their ids are equal or NULL. A NULL id comes after all
    others. Among rows with the least id, the least by a hash of id and text
    stays, and of rows equal in both the least by a hash of all columns.
    """
    described, labels = _classes(docs, doc_id, text, size, percent)
    first = F.min(F.struct(F.col("doc_id").isNull().alias("unnamed"), "doc_id", "row")).alias("first")
    per_class = described.where("cls IS NOT NULL").groupBy("cls").agg(first)
    kept = (
        _labelled(per_class, labels)
        .groupBy("label")
        .agg(F.min("first").alias("first"))
        .select(F.col("first.row").alias("__pj_of"), F.col("first.doc_id").alias("__pj_id"))
    )
    kept = stored(kept, "parity-kept")
    # A row that stays and has no equal one needs no further look; a bitmap of
    # all others tells most of them, so that few texts are shuffled.
    copies = described.where("cls IS NOT NULL").groupBy("row", "doc_id").agg(F.count("*").alias("copies"))
    unsure = copies.join(kept, _same_row("row", "doc_id", "__pj_of", "__pj_id"), "left").where(
        "__pj_of IS NULL OR copies > 1"
    )
    known = docs.sparkSession.sparkContext.broadcast(key_filter.bitmap(unsure, "row"))
    free_shuffles(docs.sparkSession)

    columns = [F.col(f"`{c}`") for c in docs.columns]
    words = F.coalesce(F.regexp_like(F.col(text), F.lit(r"[^\x20\x09-\x0D]")), F.lit(False))
    one = Window.partitionBy("__pj_row", doc_id).orderBy("__pj_key")
    marked = docs.withColumn("__pj_row", row_hash(doc_id, text))
    marked = marked.withColumn("__pj_unsure", words & key_filter.flag(known, "__pj_row"))
    looked_at = (
        marked.where("__pj_unsure")
        .withColumn("__pj_key", row_hash(*columns))
        .join(kept, _same_row("__pj_row", doc_id, "__pj_of", "__pj_id"))
        .withColumn("__pj_place", F.row_number().over(one))
        .where("__pj_place = 1")
    )
    return looked_at.select(*columns).union(marked.where("NOT __pj_unsure").select(*columns))

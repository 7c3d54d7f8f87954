"""Sharding by histogram sort: splitters from exact byte counts, then one exchange."""

from __future__ import annotations

from bisect import bisect_left
from decimal import Decimal

from pyspark.sql import Column, DataFrame, Window, functions as F

from plumbline.llm.tables import row_hash, stored

# A rank is key * 2**60 plus 60 bits of a hash of the row; NULL keys come first.
_TIE = 2**60
_FIRST = -(2**63) - 1
_BEYOND = 10**38 - 1
_RANK, _SIZE, _BUCKET = "__hs_rank", "__hs_size", "__hs_bucket"


def _rank(key: Column, columns: list[str]) -> Column:
    place = F.coalesce(key.cast("decimal(20,0)"), F.lit(Decimal(_FIRST)).cast("decimal(20,0)"))
    tie = F.shiftrightunsigned(row_hash(*[F.col(f"`{c}`") for c in columns]), 4)
    moved = (place - F.lit(Decimal(_FIRST)).cast("decimal(20,0)")).cast("decimal(21,0)")
    return (moved * F.lit(Decimal(_TIE)).cast("decimal(19,0)") + tie.cast("decimal(19,0)")).cast(
        "decimal(38,0)"
    )


def _literal(values: list[int]) -> Column:
    """A constant array of decimals. One string is folded once; a call per value would be slow."""
    return F.split(F.lit(",".join(map(str, values))), ",").cast("array<decimal(38,0)>")


def _place(rows: DataFrame, bounds: list[int], name: str) -> DataFrame:
    """Adds how many of the sorted ``bounds`` are at most the row's rank, by binary search."""
    steps = max(1, len(bounds).bit_length())
    padded = _literal(bounds + [_BEYOND] * (2**steps - 1 - len(bounds)))
    rows = rows.withColumn(name, F.lit(0))
    for step in reversed([2**k for k in range(steps)]):
        passed = F.get(padded, F.col(name) + (step - 1)) <= F.col(_RANK)
        rows = rows.withColumn(name, F.when(passed, F.col(name) + step).otherwise(F.col(name)))
    return rows


def _histogram(narrow: DataFrame, bounds: list[int]) -> dict[int, tuple[int, int, int, int]]:
    """Bytes, rows, least and greatest rank between bounds. One row per bound reaches the driver."""
    counted = (
        _place(narrow, bounds, _BUCKET)
        .groupBy(_BUCKET)
        .agg(F.sum(_SIZE), F.count("*"), F.min(_RANK), F.max(_RANK))
    )
    return {row[0]: (int(row[1]), row[2], int(row[3]), int(row[4])) for row in counted.collect()}


def find_splitters(
    narrow: DataFrame, buckets: int, tolerance: float = 0.0, probes: int = 64
) -> list[int]:
    """Ranks that cut the rows into ``buckets`` runs of equal bytes.

    A row belongs to bucket ``floor(bytes before it * buckets / all bytes)``.
    Every splitter has an interval that holds it. A round counts the exact
    bytes below ``probes`` candidates in each open interval and narrows it. An
    interval closes once it holds one distinct rank, or no more bytes than
    ``tolerance`` of a bucket. Only histograms reach the driver, at most
    ``buckets * probes`` rows.
    """
    whole = narrow.agg(F.sum(_SIZE), F.min(_RANK), F.max(_RANK)).first()
    if whole[1] is None:
        return []
    total, low, high = max(1, int(whole[0])), int(whole[1]), int(whole[2])
    # splitter -> [lowest, highest candidate, exact bytes below the lowest]
    intervals = {i: [low, high + 1, 0] for i in range(1, buckets)}
    done: dict[int, int] = {}
    while intervals:
        points = sorted(
            {
                a + (b - a) * k // (probes + 1)
                for a, b in {(a, b) for a, b, _ in intervals.values()}
                for k in range(probes + 2)
            }
        )
        bins = _histogram(narrow, points)
        below, ends = 0, []
        for place in range(len(points) + 1):  # bin ``place`` ends at points[place]
            below += bins.get(place, (0,))[0]
            ends.append(below)
        for i, (a, b, _) in list(intervals.items()):
            first, last = bisect_left(points, a), bisect_left(points, b)
            # the first candidate with enough bytes below it; b always has
            reached = next(p for p in range(first, last + 1) if ends[p] * buckets >= i * total or p == last)
            if reached == first:
                done[i] = points[first]
                del intervals[i]
                continue
            size, rows, least, most = bins.get(reached, (0, 0, 0, 0))
            if rows == 0 or least == most or size * buckets <= tolerance * total:
                done[i] = points[reached]
                del intervals[i]
            else:
                intervals[i] = [least, most + 1, ends[reached - 1]]
    return [done[i] for i in range(1, buckets)]


def histogram_sort(
    rows: DataFrame,
    key: str,
    size: Column,
    shards: int,
    tolerance: float = 0.0,
    probes: int = 64,
    piece_bytes: int = 256 * 2**20,
    most_buckets: int = 2**14,
) -> DataFrame:
    """Rows sorted by an integral ``key`` over ``shards`` of equal bytes.

    Adds ``shard`` (int, from 0), ``slot`` (long, position within the shard
    from 0) and keeps all columns; input columns of these names are replaced.

    The histograms read a narrow stored copy, 24 bytes a row. Splitters cut a
    shard further into pieces of about ``piece_bytes``, so that one exchange
    deals the rows and no task sorts a whole shard; the exact counts of the
    last histogram say where each piece starts in its shard.

    NULL keys sort first. Rows with one key, also a third of all rows, are cut
    by a hash of all their columns; rows equal in every column stay together.
    NULL sizes count 0. An empty table stays empty.
    """
    columns = rows.columns
    ranked = rows.withColumns(
        {_RANK: _rank(F.col(key), columns), _SIZE: F.coalesce(size.cast("bigint"), F.lit(0))}
    )
    narrow = stored(ranked.select(_RANK, _SIZE), "histogram")
    total = narrow.agg(F.sum(_SIZE)).first()[0] or 0
    pieces = max(1, min(-(-total // (piece_bytes * shards)), most_buckets // shards))
    splitters = find_splitters(narrow, shards * pieces, tolerance, probes)
    counts = _histogram(narrow, splitters)
    starts, run = [], 0
    for bucket in range(shards * pieces):
        run = 0 if bucket % pieces == 0 else run
        starts.append(run)
        run += counts.get(bucket, (0, 0))[1]
    in_bucket = Window.partitionBy(_BUCKET).orderBy(_RANK)
    start = F.get(F.split(F.lit(",".join(map(str, starts))), ",").cast("array<bigint>"), F.col(_BUCKET))
    kept = [F.col(f"`{c}`") for c in columns if c.lower() not in ("shard", "slot")]
    return _place(ranked.drop(_SIZE), splitters, _BUCKET).select(
        *kept,
        F.expr(f"cast({_BUCKET} div {pieces} as int)").alias("shard"),
        (F.row_number().over(in_bucket) - 1 + start).cast("bigint").alias("slot"),
    )

"""Mixing sources to target weights with a multivariate-hypergeometric splitting tree."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

import numpy as np
from pyspark.sql import Column, DataFrame, Window, functions as F

from plumbline.llm.tables import row_hash, stored

WORD = r"[^\x20\x09-\x0D]+"
_SOURCE, _SIZE, _KEY, _BLOCK = "__mx_source", "__mx_size", "__mx_key", "__mx_block"
MOST_SOURCES = 100_000


def n_words(text: Column) -> Column:
    """Words of a text; NULL has none."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("bigint")


def cyclic_weights(names: Sequence[str | None], cycle: Sequence[float] = (1, 2, 3)) -> dict:
    """Weights that repeat over the sources in code-point order, NULL last."""
    order = sorted(names, key=lambda name: (name is None, name or ""))
    return {name: cycle[place % len(cycle)] for place, name in enumerate(order)}


def targets(
    sizes: Mapping[str | None, int], weights: Mapping, share: float = 1.0, limit: float = 3.0
) -> dict[str | None, float]:
    """Words wanted of each source: its share by weight, at most ``limit`` times its size.

    What a source cannot give is shared again by weight among the others.
    """
    wanted, capped = {}, {}
    left = share * sum(sizes.values())
    while len(capped) < len(sizes):
        still = [name for name in sizes if name not in capped]
        weight = sum(weights[name] for name in still)
        wanted = {name: left * weights[name] / weight if weight else 0.0 for name in still}
        above = [name for name in still if wanted[name] > limit * sizes[name]]
        if not above:
            break
        for name in above:
            capped[name] = float(limit * sizes[name])
            left -= capped[name]
            wanted.pop(name)
    return {**wanted, **capped}


def splitting_tree(quotas: Sequence[int], shards: int, seed: int) -> np.ndarray:
    """Draws of each source per shard: rows are shards, columns sources.

    A node holds a quota of draws per source and a run of shards. It splits
    both: the left half gets the number of draws its shards are due, with the
    sources distributed multivariate-hypergeometrically, the right half the
    rest. So columns add up to the quotas, and shards differ by one draw.
    """
    quotas = np.asarray(quotas, dtype=np.int64)
    out = np.zeros((shards, len(quotas)), dtype=np.int64)
    if quotas.sum() >= 10**9:
        raise ValueError("more than 10**9 block draws: use fewer blocks")

    def split(left: int, right: int, held: np.ndarray) -> None:
        if right - left == 1:
            out[left] = held
            return
        middle = (left + right) // 2
        take = int(held.sum()) * (middle - left) // (right - left)
        rng = np.random.default_rng([seed, left, right])
        drawn = rng.multivariate_hypergeometric(held, take, method="marginals")
        split(left, middle, drawn)
        split(middle, right, held - drawn)

    if len(quotas):
        split(0, shards, quotas)
    return out


def _units(docs: DataFrame, source: str, size: Column, blocks: int) -> DataFrame:
    """``docs`` with source, size, a key of its own and a block within its source."""
    key = row_hash(*[F.col(f"`{c}`") for c in docs.columns])
    return docs.withColumns(
        {
            _SOURCE: F.coalesce(F.concat(F.lit("s"), F.col(source).cast("string")), F.lit("n")),
            _SIZE: F.coalesce(size.cast("bigint"), F.lit(0)),
            _KEY: key,
            _BLOCK: F.pmod(F.xxhash64(F.lit(1), key), F.lit(blocks)).cast("int"),
        }
    )


def plan_draws(
    units: DataFrame,
    weights: Mapping | None = None,
    share: float = 1.0,
    limit: float = 3.0,
    shards: int = 16,
    seed: int = 7,
) -> DataFrame:
    """What every block of every source gives.

    One row per (source, block): ``full`` (shards that get one copy each of
    the whole block), ``part`` (shard of a further, last copy or NULL),
    ``cut`` (documents up to this key belong to that copy; NULL: all),
    ``closing`` (key of the source's document that closes the gap to the
    target), ``source_size`` and ``target``.

    A source is passed over ``floor(target / size)`` times, and the rest is
    filled block by block in permuted order; the block in which it ends gives
    documents as far as they fit. Only totals per source reach the driver.
    """
    spark = units.sparkSession
    units = stored(units.select(_SOURCE, _SIZE, _KEY, _BLOCK), "mix-units")
    blocks = stored(
        units.groupBy(_SOURCE, _BLOCK).agg(F.sum(_SIZE).alias("words")), "mix-blocks"
    )
    if blocks.select(_SOURCE).distinct().count() > MOST_SOURCES:
        raise ValueError(f"more than {MOST_SOURCES} sources: group them first")
    totals = blocks.groupBy(_SOURCE).agg(F.sum("words"), F.count("*")).collect()
    sizes = {row[0][1:] if row[0] != "n" else None: int(row[1]) for row in totals}
    wanted = targets(sizes, weights or cyclic_weights(list(sizes)), share, limit)
    label = {name: "n" if name is None else f"s{name}" for name in sizes}
    passes = {name: int(wanted[name] // size) if (size := sizes[name]) else 0 for name in sizes}
    per_source = spark.createDataFrame(
        [
            (label[n], sizes[n], float(wanted[n]), passes[n], float(wanted[n] - passes[n] * sizes[n]))
            for n in sizes
        ],
        f"{_SOURCE} string, source_size bigint, target double, passes int, rest double",
    )
    in_order = Window.partitionBy(_SOURCE).orderBy(F.xxhash64(F.lit(seed), _SOURCE, _BLOCK), _BLOCK)
    until = F.sum("words").over(in_order.rowsBetween(Window.unboundedPreceding, 0))
    filled = stored(
        blocks.join(per_source, _SOURCE)
        .withColumn("until", until)
        .withColumn("open", F.col("rest") - (F.col("until") - F.col("words")))
        .withColumn("whole", (F.col("until") <= F.col("rest")) & (F.col("words") > 0))
        .withColumn("broken", ~F.col("whole") & (F.col("open") > 0) & (F.col("words") > 0)),
        "mix-filled",
    )
    # The one block per source in which the rest ends, document by document.
    order_key = F.xxhash64(F.lit(seed), F.col(_KEY))
    document = Window.partitionBy(_SOURCE).orderBy("order_key")
    reached = F.sum("size").over(document.rowsBetween(Window.unboundedPreceding, 0))
    cuts = stored(
        units.join(filled.where("broken").select(_SOURCE, _BLOCK, "open"), [_SOURCE, _BLOCK])
        .groupBy(_SOURCE, _BLOCK, "open", order_key.alias("order_key"))
        .agg(F.sum(_SIZE).alias("size"))
        .withColumn("reached", reached)
        .groupBy(_SOURCE, F.col(_BLOCK).alias("broken_block"), "open")
        .agg(
            F.max(F.when(F.col("reached") <= F.col("open"), F.col("order_key"))).alias("cut"),
            F.max(F.when(F.col("reached") <= F.col("open"), F.col("reached"))).alias("got"),
        )
        .withColumn("left", F.col("open") - F.coalesce("got", F.lit(0))),
        "mix-cuts",
    )
    # What is then left goes to the one unused document whose size comes nearest.
    unused = ~F.col("whole") & (
        (F.col(_BLOCK) != F.col("broken_block")) | F.col("cut").isNull() | (order_key > F.col("cut"))
    )
    miss = F.abs(F.col(_SIZE) - F.col("left"))
    together = units.groupBy(_SOURCE, _BLOCK, _KEY).agg(F.sum(_SIZE).alias(_SIZE))  # equal rows share a key
    closing = (
        together.join(filled.select(_SOURCE, _BLOCK, "whole"), [_SOURCE, _BLOCK])
        .join(cuts, _SOURCE)
        .where(unused & (miss < F.col("left")))
        .groupBy(_SOURCE)
        .agg(F.min(F.struct(miss, _KEY))[_KEY].alias("closing"))
    )
    ends = cuts.join(closing, _SOURCE, "left").select(_SOURCE, "cut", "closing")
    filled = filled.join(ends, _SOURCE, "left").withColumn(
        "last", F.col("whole") | (F.col("broken") & F.col("cut").isNotNull())
    )
    draws = stored(
        filled.withColumn("n", F.col("passes") + F.col("last").cast("int")).select(
            _SOURCE, _BLOCK, "passes", "n", "last", "broken", "cut", "closing", "source_size", "target"
        ),
        "mix-draws",
    )
    quotas = dict(draws.groupBy(_SOURCE).agg(F.sum("n")).collect())
    names = sorted(quotas)
    ends = np.cumsum(splitting_tree([quotas[n] for n in names], shards, seed), axis=0)
    ranges = spark.createDataFrame(
        [(name, [int(e) for e in ends[:, place]]) for place, name in enumerate(names)],
        f"{_SOURCE} string, ends array<bigint>",
    )
    # Permuted draws of a source: disjoint ranges of their order go to the shards.
    permuted = Window.partitionBy(_SOURCE).orderBy(
        F.xxhash64(F.lit(seed + 1), _SOURCE, _BLOCK, "pass"), _BLOCK, "pass"
    )
    dealt = (
        draws.where("n > 0")
        .select(_SOURCE, _BLOCK, "passes", F.explode(F.sequence(F.lit(1), "n")).alias("pass"))
        .withColumn("place", F.row_number().over(permuted) - 1)
        .join(ranges, _SOURCE)
        .withColumn("shard", F.size(F.filter("ends", lambda end: end <= F.col("place"))))
        .groupBy(_SOURCE, _BLOCK)
        .agg(
            F.sort_array(
                F.collect_list(F.when(F.col("pass") <= F.col("passes"), F.col("shard")))
            ).alias("full"),
            F.max(F.when(F.col("pass") > F.col("passes"), F.col("shard"))).alias("part"),
        )
    )
    cut = F.when(F.col("broken"), F.col("cut")).alias("cut")
    return stored(
        draws.select(_SOURCE, _BLOCK, "source_size", "target", cut, "closing").join(
            dealt, [_SOURCE, _BLOCK], "left"
        ),
        "mix-plan",
    )


def _joined(units: DataFrame, plan: DataFrame, seed: int, bound: int = 200_000) -> DataFrame:
    """Units with the shards of their copies. The plan is broadcast up to ``bound`` rows."""
    names = {c: f"__mx_{c}" for c in ("source_size", "target", "cut", "closing", "full", "part")}
    plan = plan.withColumnsRenamed(names)
    plan = F.broadcast(plan) if plan.count() <= bound else plan
    within = F.col("__mx_cut").isNull() | (F.xxhash64(F.lit(seed), F.col(_KEY)) <= F.col("__mx_cut"))
    shards = F.concat(
        F.coalesce("__mx_full", F.array().cast("array<int>")),
        F.when(F.col("__mx_part").isNotNull() & within, F.array("__mx_part")).otherwise(
            F.array().cast("array<int>")
        ),
        F.when(F.col("__mx_closing") == F.col(_KEY), F.array(F.lit(0))).otherwise(
            F.array().cast("array<int>")
        ),
    )
    return units.join(plan, [_SOURCE, _BLOCK], "left").withColumn("__mx_shards", shards)


def mix_report(
    docs: DataFrame, source: str, size: Column, blocks: int = 4096, seed: int = 7, **settings
) -> DataFrame:
    """Every row of ``docs`` with ``size``, ``source_size``, ``target``, ``copies``, ``taken`` and ``shards``.

    ``shards`` has the output shard of every copy, in ascending order, as the
    splitting tree dealt them. See ``mix``; input columns of these names are replaced.
    """
    units = _units(docs, source, size, blocks)
    plan = plan_draws(units, seed=seed, **settings)
    out = {
        "size": F.col(_SIZE),
        "source_size": F.col("__mx_source_size"),
        "target": F.col("__mx_target"),
        "copies": F.size("__mx_shards"),
        "taken": F.col(_SIZE) * F.size("__mx_shards"),
        "shards": F.sort_array("__mx_shards"),
    }
    kept = [c for c in docs.columns if c.lower() not in out]
    return _joined(units, plan, seed).select(
        *[F.col(f"`{c}`") for c in kept], *[value.alias(name) for name, value in out.items()]
    )


def mix(
    docs: DataFrame, source: str, size: Column, blocks: int = 4096, seed: int = 7, **settings
) -> DataFrame:
    """The mixed corpus: one row per copy, dealt to shards and shuffled within each.

    Columns are those of ``docs``. Sources (NULL is one) get ``targets``; no
    document is used more than ``limit`` times, since no pass is. Blocks are
    ``blocks`` hashed parts of a source, so a source with a third of all rows
    is spread like any other. Documents of size 0 follow their block. Rows
    equal in every column share one decision. An empty table stays empty.
    Reruns give the same rows, as all draws come from ``seed`` and hashes.
    """
    units = _units(docs, source, size, blocks)
    plan = plan_draws(units, seed=seed, **settings)
    copies = _joined(units, plan, seed).select(
        *[F.col(f"`{c}`") for c in docs.columns], _KEY, _BLOCK, F.posexplode("__mx_shards").alias("__mx_copy", "__mx_shard")
    )
    place = F.xxhash64(F.lit(seed + 2), "__mx_shard", "__mx_copy", _KEY)
    return (
        copies.withColumn("__mx_place", place)
        .repartition("__mx_shard", _BLOCK)
        .sortWithinPartitions("__mx_shard", "__mx_place")
        .select(*[F.col(f"`{c}`") for c in docs.columns])
    )

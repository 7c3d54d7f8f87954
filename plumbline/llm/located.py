"""Matches of a pattern with their places, in DataFrame functions alone."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, functions as F

NO_SPANS = "array<struct<start:int,end:int,value:string>>"


def no_spans() -> Column:
    return F.array().cast(NO_SPANS)


def matches(text: Column, pattern: Column) -> Column:
    """Leftmost, non-overlapping matches."""
    return F.regexp_extract_all(text, pattern, F.lit(0))


# Matches are placed in blocks, so that no step copies more than a block's worth.
_BLOCK = 256
# Surroundings are cut out of segments of a text, and these out of pieces of so
# many segments, as a long text is slow to count through.
_SEGMENT, _SEGMENTS = 1024, 64


def _bound(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of ``value``, which is computed once however often ``body`` names it."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def _placed(pieces: Column) -> Column:
    """Spans of a block's pieces, the first beginning at 0, and the length of all."""

    def add(state: Column, piece: Column) -> Column:
        first = state["at"] + F.length(piece["b"])
        last = first + F.length(piece["v"])
        span = F.struct(first.alias("start"), last.alias("end"), piece["v"].alias("value"))
        return F.struct(last.alias("at"), F.concat(state["out"], F.array(span)).alias("out"))

    return F.aggregate(pieces, F.struct(F.lit(0).alias("at"), no_spans().alias("out")), add)


def _begins(blocks: Column) -> Column:
    """Where each block begins: the lengths of all before it."""
    start = F.struct(F.lit(0).alias("at"), F.array().cast("array<int>").alias("out"))

    def add(state: Column, block: Column) -> Column:
        return F.struct(
            (state["at"] + block["at"]).alias("at"), F.concat(state["out"], F.array(state["at"])).alias("out")
        )

    return F.aggregate(blocks, start, add, lambda state: state["out"])


def located(text: Column, pattern: Column, found: Column) -> Column:
    """Start, end (exclusive, both in code points from 0) and value of each of ``found``.

    ``found`` are the non-empty ``matches``; what stands between them comes
    from a split at the same pattern, so lengths add up to places. The work
    grows with the text and, but for copying within blocks, with the matches.
    """
    between = F.split(text, pattern, -1)
    pieces = F.zip_with(F.slice(between, 1, F.size(found)), found, lambda b, v: F.struct(b.alias("b"), v.alias("v")))

    def in_blocks(every: Column) -> Column:
        numbers = F.sequence(F.lit(0), F.floor((F.size(every) - 1) / _BLOCK).cast("int"))
        return F.transform(numbers, lambda i: _placed(F.slice(every, i * _BLOCK + 1, F.lit(_BLOCK))))

    def moved(block: Column, begin: Column) -> Column:
        return F.transform(
            block["out"],
            lambda s: F.struct(
                (s["start"] + begin).alias("start"), (s["end"] + begin).alias("end"), s["value"].alias("value")
            ),
        )

    spans = _bound(_bound(pieces, in_blocks), lambda blocks: F.flatten(F.zip_with(blocks, _begins(blocks), moved)))
    return F.when(F.size(found) > 0, spans).otherwise(no_spans())


def around(text: Column, spans: Column, before: int, after: int) -> Column:
    """Each of ``spans`` as ``span``, with up to ``before`` and ``after`` code points on its sides."""

    def begin(i: Column, size: int) -> Column:
        return F.greatest(i * size - before, F.lit(0))

    def piece(i: Column) -> Column:
        size = _SEGMENT * _SEGMENTS
        cut = F.substring(text, begin(i, size) + 1, i * size - begin(i, size) + (size + after))
        return F.struct(i.alias("first"), cut.alias("text"))

    def segments_of(p: Column) -> Column:
        offset = begin(p["first"], _SEGMENT * _SEGMENTS)

        def segment(j: Column) -> Column:
            i = p["first"] * _SEGMENTS + j
            first = begin(i, _SEGMENT)
            return F.substring(p["text"], first - offset + 1, i * _SEGMENT - first + (_SEGMENT + after))

        return F.transform(F.sequence(F.lit(0), F.lit(_SEGMENTS - 1)), segment)

    def with_sides(segments: Column) -> Column:
        def sides(s: Column) -> Column:
            of_start, of_end = F.floor(s["start"] / _SEGMENT).cast("int"), F.floor(s["end"] / _SEGMENT).cast("int")
            first = F.greatest(s["start"] - before, F.lit(0))

            def cut(of: Column, at: Column, length: Column) -> Column:
                return F.substring(F.get(segments, of), at - begin(of, _SEGMENT) + 1, length)

            return F.struct(
                s.alias("span"),
                cut(of_start, first, s["start"] - first).alias("before"),
                cut(of_end, s["end"], F.lit(after)).alias("after"),
            )

        return F.transform(spans, sides)

    numbers = F.sequence(F.lit(0), F.floor(F.length(text) / (_SEGMENT * _SEGMENTS)).cast("int"))
    segments = F.flatten(F.transform(F.transform(numbers, piece), segments_of))
    return F.when(F.size(spans) > 0, _bound(segments, with_sides)).otherwise(F.transform(spans, lambda s: F.struct(s.alias("span"), F.lit("").alias("before"), F.lit("").alias("after"))))


def written(kind: str, spans: Column) -> Column:
    """``kind:start:end`` of each span."""
    return F.transform(
        spans, lambda s: F.concat_ws(":", F.lit(kind), s["start"].cast("string"), s["end"].cast("string"))
    )

"""Personal data, and words that give it away.

Patterns find e-mail and IP addresses, card and phone numbers. Words that stand
next to such a value in several texts are then weighed by information content:
the pointwise mutual information of word and value tells how much of the value
(its information content) the word discloses. Words above a threshold are
personal data too, where they occur with the value or wherever they occur.
DataFrame functions only.
"""

from __future__ import annotations

from functools import partial

from pyspark.sql import Column, DataFrame, functions as F

from plumbline.llm.located import around, located, matches, no_spans, written
from plumbline.llm.tables import stored

# Possessive quantifiers and a guard against starts within a run that has
# failed already keep the search linear; neither changes what is found.
PATTERNS = {
    "email": r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?:\G|(?<![0-9]))[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
_HINTS = {"email": "@", "ip": ".", "card": "", "phone": "+"}
_TERM = r"\p{L}{3,}+"
_REACH = 400  # code points from a value within which a word counts as next to it
_ROUND = 200_000  # terms broadcast at once


def _digits(value: Column) -> Column:
    return F.regexp_replace(value, "[^0-9]", "")


def _luhn(digits: Column) -> Column:
    backwards = F.reverse(digits)

    def add(total: Column, place: Column) -> Column:
        digit = F.substring(backwards, place, F.lit(1)).cast("int")
        twice = F.when(digit > 4, digit * 2 - 9).otherwise(digit * 2)
        return total + F.when(place % 2 == 0, twice).otherwise(digit)

    places = F.sequence(F.lit(1), F.length(digits))
    return F.when(F.length(digits) > 0, F.aggregate(places, F.lit(0), add) % 10 == 0).otherwise(False)


def _valid(kind: str, value: Column) -> Column:
    if kind == "ip":
        return value.rlike(r"^(?:0*(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[0-9]{1,2})(?:\.|$)){4}$")
    digits = _digits(value)
    if kind == "card":
        return F.when(F.length(digits).between(13, 19), _luhn(digits)).otherwise(False)
    return F.length(digits).between(9, 15) if kind == "phone" else F.lit(True)


def find(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Per row: ``doc_id``, ``text`` and an array of spans per kind."""
    out = docs.select(
        F.col(doc_id).alias("doc_id"), F.coalesce(F.col(text).cast("string"), F.lit("")).alias("text")
    )
    for kind, pattern in PATTERNS.items():
        hint, none = _HINTS[kind], F.array().cast("array<string>")
        found = matches(F.col("text"), F.lit(pattern))
        found = F.when(F.contains(F.col("text"), F.lit(hint)), found).otherwise(none) if hint else found
        out = out.withColumn(f"m_{kind}", found)
    for kind, pattern in PATTERNS.items():
        valid = partial(_valid, kind)
        some = F.exists(f"m_{kind}", lambda value: valid(value))
        spans = located(F.col("text"), F.lit(pattern), F.col(f"m_{kind}"))
        spans = F.when(some, F.filter(spans, lambda s: valid(s["value"])))
        out = out.withColumn(kind, F.coalesce(spans, no_spans()))
    return out.drop(*[f"m_{kind}" for kind in PATTERNS])


def _terms(text: Column) -> Column:
    return matches(F.lower(text), F.lit(_TERM))


def _near(side: Column, words: int, reach: int, own_line: bool = True) -> Column:
    """Terms up to ``words`` before and after a span, wholly within ``reach``, and on its line if ``own_line``.

    ``side`` has the span and one code point more than ``reach`` on each side:
    letters at that edge belong to a word that reaches beyond it, or are one
    too far.
    """
    before, after = side["before"], side["after"]
    before = F.when(F.length(before) > reach, F.regexp_replace(before, r"^\p{L}+", "")).otherwise(before)
    after = F.when(F.length(after) > reach, F.regexp_replace(after, r"\p{L}++\z", "")).otherwise(after)
    if own_line:
        before, after = F.substring_index(before, "\n", -1), F.substring_index(after, "\n", 1)
    left, right = _terms(before), _terms(after)
    size = F.least(F.size(left), F.lit(words))
    nearest = F.when(size > 0, F.slice(left, -size, size)).otherwise(left)
    return F.array_distinct(F.concat(nearest, F.slice(right, 1, words)))


def disclosing(
    found: DataFrame, texts: DataFrame, words: int = 5, support: int = 3, threshold: float = 0.9
) -> DataFrame:
    """(entity, term) where the term gives away at least ``threshold`` of the entity.

    ``found`` has ``entity``, ``near``, ``doc`` (row hash) and ``copy`` (text
    hash); ``texts`` the text of every document. With document counts,
    information is log2(N / n(entity)) and disclosure
    log2(N n(entity, term) / (n(entity) n(term))). A pair needs ``support``
    different texts. Term counts cover every word of every document; all
    counts combine before they are shuffled.
    """
    pairs = found.select("entity", "doc", "copy", F.explode("near").alias("term")).distinct()
    joint = (
        pairs.groupBy("entity", "term", "copy")
        .agg(F.count("*").alias("n"))
        .groupBy("entity", "term")
        .agg(F.sum("n").alias("n_both"), F.count("*").alias("copies"))
        .where(F.col("copies") >= support)
    )
    joint = stored(joint, "disclosure-pairs")
    entities = (
        found.select("entity", "doc", "copy").distinct().groupBy("entity").agg(F.count("*").alias("n_entity"))
    )
    terms = (
        texts.select(F.explode(F.array_distinct(_terms(F.col("text")))).alias("term"))
        .groupBy("term")
        .agg(F.count("*").alias("n_term"))
    )
    total = texts.agg(F.count("*").alias("n"))
    n = F.lit(float(total.first()[0]))
    information = F.log2(n / F.col("n_entity"))
    disclosed = F.log2(n * F.col("n_both") / (F.col("n_entity") * F.col("n_term")))
    return (
        joint.join(entities, "entity")
        .join(terms, "term")
        .where((information > 0) & (disclosed >= threshold * information))
        .select("entity", "term")
    )


def _terms_held(texts: DataFrame, terms: DataFrame) -> DataFrame:
    """``doc`` and the ``terms`` among the words of its ``text``, where there are any.

    The terms are broadcast in rounds, so that no word's documents gather in a task.
    """
    terms = stored(terms.distinct(), "disclosure-terms")
    rounds = max(1, -(-terms.count() // _ROUND))
    words = texts.select("doc", F.explode(F.array_distinct(_terms(F.col("text")))).alias("term"))
    found = None
    for turn in range(rounds):
        some = terms.where(F.pmod(F.xxhash64("term"), F.lit(rounds)) == turn)
        hits = words.join(F.broadcast(some), "term")
        found = hits if found is None else found.union(hits)
    return found.groupBy("doc").agg(F.sort_array(F.collect_set("term")).alias("terms"))


def _mask(text: Column, spans: Column) -> Column:
    """``text`` with each span replaced by its kind in brackets."""
    start = F.struct(F.lit(0).alias("at"), F.lit("").alias("out"))

    def add(state: Column, s: Column) -> Column:
        gap = F.substring(text, state["at"] + 1, s["start"] - state["at"])
        fresh = s["start"] >= state["at"]
        out = F.when(fresh, F.concat(state["out"], gap, F.lit("["), s["kind"], F.lit("]"))).otherwise(state["out"])
        return F.struct(F.greatest(state["at"], s["end"]).alias("at"), out.alias("out"))

    ordered = F.array_sort(spans)
    return F.aggregate(
        ordered, start, add, lambda s: F.concat(s["out"], F.substring(text, s["at"] + 1, F.length(text)))
    )


def sanitise(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", everywhere: bool = False, **limits
) -> DataFrame:
    """Per row of ``docs``: ``doc_id``, ``n_email``, ``n_ip``, ``n_card``, ``n_phone``,
    ``base_sha256``, ``n_term``, ``spans`` and ``sanitised``.

    ``spans`` lists kind:start:end (code points, end exclusive) by kind, the
    four first and ``term`` last, then start. Words next to a value are the
    ``words`` (5) on either side of it within ``reach`` (400) code points, on
    any line unless ``own_line``. ``sanitised`` is the text with
    every span generalised to its kind in brackets, NULL where nothing was
    found. A term counts where it occurs as a whole run of letters outside the
    other spans: in every row if ``everywhere``, else in rows that hold the
    entity it discloses.

    NULL and empty texts hold nothing. Repeated rows and ids are each
    returned; copies count as documents but not as support. Other columns are
    left behind.
    """
    kinds = list(PATTERNS)
    all_spans = F.flatten(F.array(*[_entities(k) for k in kinds]))
    held = stored(
        find(docs, doc_id, text)
        .withColumn("any", F.size("email") + F.size("ip") + F.size("card") + F.size("phone") > 0)
        .select(
            "doc_id",
            *kinds,
            F.when(F.col("any"), F.col("text")).alias("text"),
            "any",
            F.xxhash64("doc_id", "text").alias("doc"),
            F.when(F.col("any"), F.xxhash64("text")).alias("copy"),
        ),
        "disclosure-found",
    )
    with_spans = held.where("any")
    words, reach, own_line = limits.pop("words", 5), limits.pop("reach", _REACH), limits.pop("own_line", False)
    near = stored(
        with_spans.withColumn("all", all_spans)
        .select("doc", "copy", F.explode(around(F.col("text"), F.col("all"), reach + 1, reach + 1)).alias("s"))
        .select("doc", "copy", "s.span.entity", _near(F.col("s"), words, reach, own_line).alias("near")),
        "disclosure-near",
    )
    texts = docs.select(
        F.col(doc_id).alias("doc_id"), F.coalesce(F.col(text).cast("string"), F.lit("")).alias("text")
    ).withColumn("doc", F.xxhash64("doc_id", "text"))
    pairs = disclosing(near, texts, words, **limits)
    without = held.where("NOT any")
    if everywhere:
        terms = stored(_terms_held(texts, pairs.select("term")), "disclosure-rows")
        terms_alone = stored(terms.join(with_spans.select("doc"), "doc", "left_anti"), "disclosure-alone")
        alone = texts.join(terms_alone, "doc").select("doc_id", *[no_spans().alias(k) for k in kinds], "text", "doc", "terms")
        rest = without.join(terms_alone, "doc", "left_anti")
    else:
        terms = (
            near.select("doc", "entity").distinct().join(pairs, "entity")
            .groupBy("doc").agg(F.sort_array(F.collect_set("term")).alias("terms"))
        )
        alone, rest = None, without
    pattern = F.concat(F.lit(r"(?iu)(?<!\p{L})(?:"), F.array_join("terms", "|"), F.lit(r")(?!\p{L})"))
    base = F.concat(*[F.transform(k, lambda s: F.struct(s["start"], s["end"])) for k in kinds])
    spanned = with_spans.join(terms, "doc", "left").select("doc_id", *kinds, "text", "doc", "terms")
    clear = (
        (spanned if alone is None else spanned.union(alone))
        .withColumn("pattern", pattern)
        .withColumn("m_term", F.when(F.col("terms").isNotNull(), matches(F.col("text"), F.col("pattern"))))
        .withColumn("base", base)
        .withColumn(
            "term",
            F.when(
                F.size("m_term") > 0,
                F.filter(
                    located(F.col("text"), F.col("pattern"), F.col("m_term")),
                    lambda s: ~F.exists("base", lambda b: (s["start"] < b["end"]) & (s["end"] > b["start"])),
                ),
            ).otherwise(no_spans()),
        )
        .select("doc_id", *kinds, "text", "term")
    )
    rest = rest.select("doc_id", *kinds, "text", no_spans().alias("term"))
    listed = F.flatten(F.array(*[written(k, F.col(k)) for k in kinds]))
    masked = F.flatten(F.array(*[_kinds(k) for k in [*kinds, "term"]]))
    return clear.union(rest).select(
        "doc_id",
        *[F.size(k).cast("bigint").alias(f"n_{k}") for k in kinds],
        F.sha2(F.array_join(listed, ","), 256).alias("base_sha256"),
        F.size("term").cast("bigint").alias("n_term"),
        F.array_join(F.concat(listed, written("term", F.col("term"))), ",").alias("spans"),
        _mask(F.col("text"), masked).alias("sanitised"),
    )


def _entities(kind: str) -> Column:
    def entity(s: Column) -> Column:
        name = F.concat(F.lit(f"{kind}:"), _identity(kind, s["value"]))
        return F.struct(name.alias("entity"), s["start"].alias("start"), s["end"].alias("end"))

    return F.transform(kind, entity)


def _kinds(kind: str) -> Column:
    return F.transform(
        kind, lambda s: F.struct(s["start"].alias("start"), s["end"].alias("end"), F.lit(kind).alias("kind"))
    )


def _identity(kind: str, value: Column) -> Column:
    """One spelling for each protected value."""
    return _digits(value) if kind in ("card", "phone") else F.lower(value)

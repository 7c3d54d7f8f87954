"""Secret scan: candidate strings, and a random forest that removes false findings.

DataFrame functions and the forest of Spark's own library only.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.ml.classification import RandomForestClassificationModel, RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, functions as F

from plumbline.llm.located import around, located, matches
from plumbline.llm.tables import row_hash, stored

# Words before an assigned secret, beginnings of well-known tokens.
_WORDS = r"(?:token|secret|password|passwd|pwd|api_?key|apikey|access_?key|private_?key|credential|auth|bearer)"
KEYWORDS = f"(?i){_WORDS}"
_ASSIGNS = _WORDS + r"(?:[_-]\w{1,12})?\W{0,3}(?:=>|:=|[=:])"
ASSIGNED = rf"(?i)(?:{_ASSIGNS}|{_WORDS}\W{{0,3}}\s)\W{{0,3}}$"
_BEGIN, _END = (rf"-----{side}\x20[A-Z0-9\x20]{{0,30}}PRIVATE\x20KEY(?:\x20BLOCK)?-----" for side in ("BEGIN", "END"))
_LINES = r"(?:(?:\s|\\[nr]){1,8}(?:[A-Za-z0-9+/]{16,}+={0,2}|[A-Z][A-Za-z-]{2,20}:\x20[^\r\n]{0,80}))*+"
_BLOCK = rf"{_BEGIN}(?:[A-Za-z0-9+/=\s:,.()\\-]*?{_END}|{_LINES})"
_RUN, _PADDING = "[A-Za-z0-9+/_-]", r"(?:={1,2}+(?![A-Za-z0-9+/_=-]))?"
_MARKS = "+/_=-.@!#$%^*~?:"
_FREE = "[A-Za-z0-9+/_@!#$%^*~-]"
# The first lookbehind is cheap and fails at nearly every place.
_VALUE = rf"(?<=[=:]>?[\s\"'`]{{0,3}})(?<=(?i:{_ASSIGNS})[\s\"'`]{{0,3}}){_FREE}(?:{_FREE}|[.?:](?={_FREE})){{3,}}+{_PADDING}"
# A key block, the value assigned to a keyword, or a long run; "=" only ends one.
CANDIDATE = rf"{_BLOCK}|{_VALUE}|{_RUN}{{20,}}+{_PADDING}"
KNOWN = (
    r"(?<![A-Za-z0-9])(?:(?:AKIA|ASIA)[A-Z0-9]{16}(?![A-Za-z0-9])|gh[pousr]_[A-Za-z0-9]{36}|github_pat_\w{22}"
    r"|glpat-[\w-]{20}|xox[abprs]-[A-Za-z0-9-]{10}|[sr]k_(?:live|test)_[A-Za-z0-9]{16}|AIza[\w-]{35}|npm_[A-Za-z0-9]{36})"
    r"|^-----BEGIN"
)
_BEFORE, _AFTER = 48, 24
_TERM = r"[a-z]{3,}+"
FEATURES = [
    "length", "digits", "uppers", "marks", "switches", "transition", "coverage",
    "keyword", "assigned", "quoted", "known", "path_rate", "word_rate",
]


@dataclass
class CorpusModel:
    """What the corpus says about letters and words."""

    #: log of the share of each letter after each letter (27 * 27, other marks last)
    transitions: list[float]
    #: words in at least a share of documents
    dictionary: DataFrame


def candidates(docs: DataFrame, text: str = "text", path: str | None = None) -> DataFrame:
    """One row per candidate: ``row``, ``start``, ``end``, ``value``, ``path`` and both contexts."""
    body = F.coalesce(F.col(text).cast("string"), F.lit(""))
    where = F.col(path).cast("string") if path else F.lit(None).cast("string")
    found = docs.select(
        row_hash(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), body.alias("body"), F.coalesce(where, F.lit("")).alias("path")
    ).withColumn("found", matches(F.col("body"), F.lit(CANDIDATE)))
    spans = located(F.col("body"), F.lit(CANDIDATE), F.col("found"))
    found = found.where(F.size("found") > 0).withColumn("spans", spans)
    sides = around(F.col("body"), F.col("spans"), _BEFORE, _AFTER)
    return found.select("row", "path", F.explode(sides).alias("s")).select(
        "row", "path", "s.span.start", "s.span.end", "s.span.value", "s.before", "s.after"
    )


def _letter(value: Column, place: Column) -> Column:
    code = F.ascii(F.substring(value, place, F.lit(1))) - 97
    return F.when(code.between(0, 25), code).otherwise(26)


def corpus_model(docs: DataFrame, text: str = "text", share: float = 0.001) -> CorpusModel:
    """Letter transitions and dictionary from the words of all documents."""
    words = matches(F.lower(F.coalesce(F.col(text).cast("string"), F.lit(""))), F.lit(_TERM))
    counts = stored(
        docs.select(F.explode(F.array_distinct(words)).alias("term")).groupBy("term").agg(F.count("*").alias("n")),
        "secret-words",
    )
    n_docs = max(1, docs.count())
    places = F.sequence(F.lit(1), F.length("term") - 1)
    pairs = (
        counts.select("n", F.explode(F.transform(places, lambda i: _letter(F.col("term"), i) * 27 + _letter(F.col("term"), i + 1))).alias("pair"))
        .groupBy("pair").agg(F.sum("n").alias("n"))
    )
    table = [1.0] * (27 * 27)  # at most 26 * 26 rows come back
    for pair, n in pairs.collect():
        table[pair] += n
    sums = [sum(table[27 * a : 27 * a + 27]) for a in range(27)]
    import math

    logs = [math.log(table[i] / sums[i // 27]) for i in range(27 * 27)]
    return CorpusModel(logs, counts.where(F.col("n") >= share * n_docs).select("term"))


def _value_features(found: DataFrame, model: CorpusModel) -> DataFrame:
    """Features of the string alone, once per distinct value."""
    logs = F.split(F.lit(",".join(repr(x) for x in model.transitions)), ",").cast("array<double>")
    low = F.lower("value")
    n = F.length("value")
    steps = F.aggregate(
        F.sequence(F.lit(1), n - 1),
        F.lit(0.0),
        lambda total, i: total + F.get(logs, _letter(low, i) * 27 + _letter(low, i + 1)),
    )
    kinds = F.translate(
        "value",
        "abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789" + _MARKS,
        "a" * 26 + "A" * 26 + "0" * 10 + "-" * len(_MARKS),
    )
    count = lambda keep: F.length(F.regexp_replace(kinds, f"[^{keep}]", ""))
    squeezed = F.regexp_replace(kinds, r"(.)\1+", "$1")
    values = found.select("value").distinct().select(
        "value",
        n.cast("double").alias("length"),
        (count("0") / n).alias("digits"),
        (count("A") / n).alias("uppers"),
        (count("\\-") / n).alias("marks"),
        ((F.length(squeezed) - 1) / n).alias("switches"),
        (steps / (n - 1)).alias("transition"),
    )
    pieces = values.select("value", "length", F.explode(matches(low, F.lit(_TERM))).alias("term"))
    covered = (
        pieces.join(model.dictionary, "term")
        .groupBy("value")
        .agg((F.sum(F.length("term")) / F.first("length")).alias("coverage"))
    )
    return values.join(covered, "value", "left").fillna(0.0, ["coverage"])


def _context(found: DataFrame) -> DataFrame:
    flag = lambda condition: F.when(condition, 1.0).otherwise(0.0)
    return found.select(
        "*",
        flag(F.col("before").rlike(KEYWORDS)).alias("keyword"),
        flag(F.col("before").rlike(r"[=:]\W{0,3}$")).alias("assigned"),
        flag(F.col("before").rlike("[\"'`]$") & F.col("after").rlike("^[\"'`]")).alias("quoted"),
        flag(F.col("value").rlike(KNOWN)).alias("known"),
        F.lower(F.regexp_extract("before", r"([A-Za-z_]+)\W*$", 1)).alias("word"),
    )


def labelled(found: DataFrame, most: int = 20_000) -> DataFrame:
    """Findings with a ``label``, as a stand-in for reviewed ones.

    A string assigned to a keyword is a secret unless it has no digit; so are
    tokens of a known beginning and key blocks, wherever they stand.
    ``most`` findings, chosen by hash, bound the training; everything else
    covers all documents.
    """
    secret = F.col("before").rlike(ASSIGNED) & F.col("value").rlike("[0-9]") | F.col("value").rlike(KNOWN)
    return (
        found.withColumn("label", F.when(secret, 1.0).otherwise(0.0))
        .orderBy(F.xxhash64(F.lit(3), "value", "before"), "row", "start")
        .limit(most)
    )


@dataclass
class Forest:
    """A trained forest with the rates of the labelled findings."""

    corpus: CorpusModel
    path_rates: DataFrame
    word_rates: DataFrame
    prior: float
    model: RandomForestClassificationModel | None


def _rates(findings: DataFrame, column: str, prior: float, weight: float = 5.0) -> DataFrame:
    """Share of secrets per value, drawn to ``prior`` where findings are few."""
    rate = (F.sum("label") + weight * prior) / (F.count("*") + weight)
    return findings.groupBy(column).agg(rate.alias(f"{column}_rate"))


def _features(found: DataFrame, forest: Forest) -> DataFrame:
    joined = (
        _context(found)
        .join(_value_features(found, forest.corpus), "value")
        .join(forest.path_rates, "path", "left")
        .join(forest.word_rates, "word", "left")
        .fillna(forest.prior, ["path_rate", "word_rate"])
    )
    return VectorAssembler(inputCols=FEATURES, outputCol="features").transform(joined)


def train(findings: DataFrame, corpus: CorpusModel, trees: int = 20, depth: int = 6, seed: int = 11) -> Forest:
    """A forest from labelled findings (``candidates`` with ``label`` 0.0 or 1.0).

    Findings of one label give a forest that always says the same.
    """
    findings = stored(findings, "secret-findings")
    total, positive = findings.agg(F.count("*"), F.sum("label")).first()
    prior = float(positive or 0) / max(1, total)
    with_word = _context(findings)
    forest = Forest(
        corpus,
        stored(_rates(with_word, "path", prior), "secret-paths"),
        stored(_rates(with_word, "word", prior), "secret-near"),
        prior,
        None,
    )
    if 0 < prior < 1:
        rows = stored(_features(findings, forest).select("features", "label"), "secret-training")
        learner = RandomForestClassifier(
            numTrees=trees, maxDepth=depth, seed=seed, featureSubsetStrategy="sqrt", cacheNodeIds=False
        )
        forest.model = learner.fit(rows)
    return forest


def judge(found: DataFrame, forest: Forest) -> DataFrame:
    """``candidates`` with the ``probability`` of being a secret."""
    if forest.model is None:
        return found.withColumn("probability", F.lit(forest.prior))
    judged = forest.model.transform(_features(found, forest))
    return judged.select(*found.columns, vector_to_array("probability")[1].alias("probability"))


def scan(
    docs: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    path: str | None = None,
    findings: DataFrame | None = None,
    at_least: float = 0.5,
) -> DataFrame:
    """Per row of ``docs``: ``doc_id``, ``n_candidates``, ``n_secrets`` and ``secret_spans``.

    ``secret_spans`` lists start:end (code points, end exclusive) of candidates
    with a probability of ``at_least``, by start. ``findings`` are labelled
    candidates to learn from; without them ``labelled`` derives some, and
    ``KNOWN`` ones count whatever the forest says, as few may be in training.

    NULL and empty texts have no candidates, NULL paths count as one path.
    Rows equal in every column are each returned with the same findings.
    Other columns are left behind.
    """
    found = stored(candidates(docs, text, path).distinct(), "secret-candidates")
    forest = train(labelled(found) if findings is None else findings, corpus_model(docs, text))
    secret = F.col("probability") >= at_least
    if findings is None:
        secret = secret | F.col("value").rlike(KNOWN)
    spans = F.sort_array(F.collect_list(F.when(secret, F.struct("start", "end"))))
    per_row = (
        judge(found, forest)
        .groupBy("row")
        .agg(F.count("*").alias("n_candidates"), F.count_if(secret).alias("n_secrets"), spans.alias("spans"))
    )
    rows = docs.select(F.col(doc_id).alias("doc_id"), row_hash(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"))
    place = lambda s: F.concat_ws(":", s["start"].cast("string"), s["end"].cast("string"))
    return rows.join(per_row, "row", "left").select(
        "doc_id",
        F.coalesce("n_candidates", F.lit(0)).cast("bigint").alias("n_candidates"),
        F.coalesce("n_secrets", F.lit(0)).cast("bigint").alias("n_secrets"),
        F.coalesce(F.array_join(F.transform("spans", place), ","), F.lit("")).alias("secret_spans"),
    )

"""Registered queries and the pipeline over the smallest test tables."""

from collections import Counter

import brute
import corpus_pipeline
import numpy as np
import pyarrow.parquet as pq
import pytest
from compare import connect, difference
from test_llm_operators import plain_scores

from plumbline.llm import licences, mixing
from plumbline.llm.oracle import LLM_SQL
from plumbline.llm.queries import QUERIES
from plumbline.llm.tables import stored

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def documents():
    return pq.read_table(f"{FOLDER}/documents.parquet").to_pylist()


def rows(frame, *names):
    return Counter(tuple(r) for r in frame.select(*names).collect())


@pytest.mark.parametrize("name", sorted(LLM_SQL))
def test_query_equals_sql(spark, name):
    assert difference(QUERIES[name](spark, FOLDER), connect(FOLDER), LLM_SQL[name]) is None


@pytest.mark.parametrize(
    "name, names, plain",
    [
        ("op4_run_length_dedup", ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"], brute.repeats),
        ("op7_disclosure", ["doc_id", "n_email", "n_ip", "n_card", "n_phone", "base_sha256"], brute.personal),
        ("op9_parity_join", ["doc_id", "n_shingles", "component_id"], brute.similar),
        ("op10_histogram_sort", ["doc_id", "size", "text_crc32", "shard", "slot"], brute.shards),
    ],
)
def test_query_equals_plain_version(spark, documents, name, names, plain):
    pairs = [(r["doc_id"], r["text"]) for r in documents]
    assert rows(QUERIES[name](spark, FOLDER), *names) == Counter(plain(pairs))


def test_backoff_of_order_3(spark, documents):
    got = {r["doc_id"]: r["score"] for r in QUERIES["op6_backoff_scores"](spark, FOLDER).collect()}
    want = dict(zip([r["doc_id"] for r in documents], plain_scores([r["text"] for r in documents], order=3)))
    assert got.keys() == want.keys()
    assert all((got[d] is None) == (s is None) and (s is None or abs(got[d] - s) < 2e-6) for d, s in want.items())


@pytest.mark.parametrize("name", ["op3_secret_scan", "op7_disclosure", "op10_histogram_sort"])
def test_native_plans(spark, name):
    plan = QUERIES[name](spark, FOLDER)._jdf.queryExecution().executedPlan().toString()
    assert not any(word in plan for word in ("Python", "Pandas", "Arrow", "Cartesian", "NestedLoop"))


def test_all_rows_come_back(spark, documents):
    for name in ("op1_mix_sources", "op3_secret_scan", "op8_licences"):
        assert QUERIES[name](spark, FOLDER).count() == len(documents)


def test_pipeline(spark, documents):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    text = {r["doc_id"]: r for r in documents}
    stages = dict(corpus_pipeline.STAGES)

    kept = stages["quality_rules"](spark, docs, FOLDER)
    good = {q[0] for q in brute.quality([(i, r["text"]) for i, r in text.items()]) if q[-1]}
    assert kept.columns == docs.columns and {r["doc_id"] for r in kept.collect()} == good

    single = stages["near_duplicates"](spark, kept, FOLDER)
    roots = {root for _, _, root in brute.similar([(i, text[i]["text"]) for i in sorted(good)], size=5, percent=80)}
    assert single.columns == docs.columns and sorted(r["doc_id"] for r in single.collect()) == sorted(roots)

    items = [(r["item_id"], r["text"]) for r in pq.read_table(f"{FOLDER}/benchmark.parquet").to_pylist()]
    found = {d: (n, hit) for d, n, hit, *_ in brute.decontaminate([(i, text[i]["text"]) for i in sorted(roots)], items)}
    clean = stages["decontamination"](spark, single, FOLDER)
    left = {r["doc_id"]: r for r in clean.collect()}
    assert clean.columns == docs.columns and set(left) == {d for d, (n, hit) in found.items() if 2 * hit < n or not hit}
    for doc, row in left.items():
        words = len(brute.bench_words(row["text"]))
        assert words == found[doc][0] - found[doc][1] and row["n_chars"] == len(row["text"])

    mixed = stages["mixing"](spark, clean, FOLDER)
    copies = Counter(r["doc_id"] for r in mixed.collect())
    sizes, taken = Counter(), Counter()
    for doc, row in left.items():
        n = len(brute.re.findall(brute.SPACES, row["text"]))
        sizes[row["source"]] += n
        taken[row["source"]] += n * copies[doc]
    want = mixing.targets(sizes, mixing.cyclic_weights(list(sizes)))
    assert mixed.columns == docs.columns and max(copies.values()) <= 3
    assert abs(sum(taken.values()) - sum(want.values())) < 0.05 * sum(want.values())

    sharded = stages["sharding"](spark, mixed, FOLDER)
    assert sharded.columns == [*docs.columns, "shard", "slot"] and sharded.count() == sum(copies.values())
    slots = {(r["shard"], r["slot"]) for r in sharded.collect()}
    assert len(slots) == sum(copies.values())


def test_mix_goes_through_its_tree(spark, documents, monkeypatch):
    """The query shows the shards that the tree dealt, and each source's draws spread over them."""
    got = QUERIES["op1_mix_sources"](spark, FOLDER).collect()
    assert all(len(r["shards"]) == r["copies"] and r["taken"] == r["size"] * r["copies"] for r in got)
    by_shard = Counter(s for r in got for s in r["shards"])
    assert len(by_shard) == 16 and max(by_shard.values()) <= 3 * min(by_shard.values()) + 10
    monkeypatch.setattr(mixing, "splitting_tree", lambda quotas, shards, seed: np.array([quotas] + [[0] * len(quotas)] * (shards - 1)))
    broken = QUERIES["op1_mix_sources"](spark, FOLDER).collect()
    assert {s for r in broken for s in r["shards"]} == {0}


ODD = "text string, n_words string, hit_words int, found_items string, kept string, n_chars bigint, doc_id bigint, source string, row string, `__place` string, extra array<int>"


def test_stages_keep_every_column(spark):
    """Odd rows and clashing names go through all stages; empty tables too."""
    text = " ".join(f"word{i}" for i in range(60))
    rows = [
        (text, "mine", 1, "f", "k", len(text), 1, "s", "r", "p", [1]), (text, "mine", 1, "f", "k", len(text), 1, "s", "r", "p", [1]),
        (text + " more", None, None, None, None, None, None, None, None, None, None), (None, "mine", 2, "g", "k", 5, 2, "s", "r", "p", []),
        ("", "x", 3, "h", "k", 0, None, None, "r", "p", None), (text.replace("word", "other"), "n", 4, "i", "j", len(text) + 60, 3, "t", "r", "p", [2]),
    ]
    for docs in (spark.createDataFrame(rows, ODD), spark.createDataFrame(rows[:0], ODD)):
        whole = {tuple(map(str, r)) for r in docs.collect()}
        for name, stage in corpus_pipeline.STAGES:
            columns = docs.columns
            docs = stored(stage(spark, docs, FOLDER), f"test-{name}")
            assert docs.columns == (columns if name != "sharding" else [*columns, "shard", "slot"])
            if name != "sharding":
                assert {tuple(map(str, r)) for r in docs.collect()} <= whole
        assert docs.count() > 0 if whole else docs.count() == 0


def test_pipeline_run(spark):
    assert corpus_pipeline.run(spark, FOLDER).count() > 0


def test_licences_equal_plain_version(spark, documents):
    """The query over its table; sentences in and out of order, near and far, over every rule."""
    names = ["doc_id", "n_sentences", "n_licences", "licences", "licence_spans"]
    pairs = [(r["doc_id"], r["text"]) for r in documents]
    tables = licences.SENTENCES, licences.RULES, licences.MOST_BETWEEN
    assert rows(QUERIES["op8_licences"](spark, FOLDER), *names) == Counter(brute.licences(pairs, *tables))
    rng, made = np.random.default_rng(5), []
    wording = lambda name: rng.choice(np.atleast_1d(licences.SENTENCES[name]))
    for name, wanted in licences.RULES:
        for turn in range(4):
            parts = [str(wording(identifier)) for identifier in wanted]
            if turn == 1:
                parts = parts[::-1]
            if turn == 2:
                parts.insert(int(rng.integers(len(parts) + 1)), str(wording(rng.choice(list(licences.SENTENCES)))))
            gap = " ".join(["filler"] * int(rng.choice([0, 3, 120, 121])))
            made.append((len(made), f" {gap} ".join(p.title() if turn == 3 else p for p in parts)))
    made += [(-1, None), (-2, ""), (-3, "licensed under the")]
    frame = spark.createDataFrame(made, "doc_id bigint, text string")
    want = brute.licences(made, *tables)
    assert rows(licences.scan(frame), *names) == Counter(want)
    assert len({row[3] for row in want}) > 30


def test_mix_equals_plain_targets(spark, documents):
    """Sizes and targets as worked out plainly; a document has its source's passes or one more; reruns agree."""
    want = brute.mixing_targets([(r["doc_id"], r["source"], r["text"]) for r in documents])
    got = QUERIES["op1_mix_sources"](spark, FOLDER).collect()
    assert len(got) == len(want)
    taken, source = Counter(), {r["doc_id"]: r["source"] for r in documents}
    for r in got:
        size, whole, target = want[r["doc_id"]]
        assert (r["size"], r["source_size"]) == (size, whole) and abs(r["target"] - target) < 1e-6 * whole
        assert r["copies"] in (int(r["target"] // whole), int(r["target"] // whole) + 1) and r["copies"] <= 3
        assert r["taken"] == size * r["copies"]
        taken[source[r["doc_id"]]] += r["taken"]
    for name, words in taken.items():
        own = [want[d] for d, s in source.items() if s == name]
        # The draw stops before a document that does not fit, or takes one that comes nearer.
        assert abs(words - own[0][2]) <= max(size for size, *_ in own) / 2
    again = rows(QUERIES["op1_mix_sources"](spark, FOLDER), "doc_id", "copies", "taken")
    assert again == Counter((r["doc_id"], r["copies"], r["taken"]) for r in got)

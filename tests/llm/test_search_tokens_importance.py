"""Lexical search, byte-level BPE and importance resampling against plain versions."""

import random
from collections import Counter
from zlib import crc32

import brute
import numpy as np
import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F

from plumbline.llm import byte_bpe, importance, lexical_search, packed
from plumbline.llm.queries import QUERIES

FOLDER = "/root/testdata/sf0.001"
public_tokenizers = pytest.importorskip("public_tokenizers")
RANKS = public_tokenizers.path("byte_bpe_50k.tiktoken")


def read(name, *columns):
    return [tuple(r.values()) for r in pq.read_table(f"{FOLDER}/{name}.parquet", columns=list(columns)).to_pylist()]


def collected(frame, *names):
    return Counter(tuple(r) for r in frame.select(*names).collect())


def pairs(frame):
    return [tuple(r) for r in frame.select("doc_id", "text").collect()]


# --- registered queries -----------------------------------------------------------


def test_search_query(spark):
    want = brute.search(read("documents", "doc_id", "text"), read("benchmark", "item_id", "text"))
    got = QUERIES["op11_lexical_search"](spark, FOLDER)
    assert dict(got.dtypes) == {"item_id": "bigint", "rank": "int", "doc_id": "bigint", "score": "bigint"}
    assert collected(got, "item_id", "rank", "doc_id", "score") == Counter(want) and want


def test_token_query(spark):
    want = brute.tokens(read("documents", "doc_id", "text"), RANKS, public_tokenizers.PATTERN)
    got = QUERIES["op12_byte_bpe"](spark, FOLDER)
    assert collected(got, "doc_id", "n_tokens", "ids_sha256", "decoded_sha256") == Counter(want)


def test_importance_query(spark):
    want = brute.importance(read("documents", "doc_id", "text"), [t for (t,) in read("benchmark", "text")])
    got = QUERIES["op13_importance"](spark, FOLDER)
    assert [t for _, t in got.dtypes] == ["bigint"] * 5
    assert collected(got, "doc_id", "n_features", "weight", "score", "rank") == Counter(want)


# --- lexical search ---------------------------------------------------------------


@pytest.fixture(scope="module")
def items(spark):
    rows = [("a", "ab ba cad the dab dab Dab"), ("b", "Hut"), ("c", None), (None, "ink é"), ("d", ""), ("b", "ñ ü jam"), ("b", "Hut")]
    return spark.createDataFrame(rows, "item_id string, text string")


def plain_search(docs, items, k):
    rows = [tuple(r) for r in items.distinct().collect()]
    return Counter(brute.search(pairs(docs), rows, k))


@pytest.mark.parametrize("sizes", [(256, 4096, 512), (2, 3, 4)])
def test_search(docs, items, monkeypatch, sizes):
    for name, size in zip(("_TILE_ITEMS", "_TILE_COLUMNS", "_TILE_DOCUMENTS"), sizes):
        monkeypatch.setattr(lexical_search, name, size)
    got = collected(lexical_search.search(docs, items, k=5), "item_id", "rank", "doc_id", "score")
    assert got == plain_search(docs, items, 5)


def test_search_in_blocks(docs, items):
    got = lexical_search.search(docs, items, k=70, most_words=3)
    assert collected(got, "item_id", "rank", "doc_id", "score") == plain_search(docs, items, 70)


def test_search_of_odd_and_empty_tables(odd, empty, items):
    got = lexical_search.search(odd, items, k=8)
    assert collected(got, "item_id", "rank", "doc_id", "score") == plain_search(odd, items, 8)
    assert lexical_search.search(empty, items).count() == 0
    assert lexical_search.search(odd, items.limit(0)).count() == 0


def test_ties_go_by_id_and_the_best_document_decides(spark, items):
    rows = [(str(i).zfill(3), "Hut jam") for i in random.Random(2).sample(range(400), 400)] + [("999", "Hut")]
    docs = spark.createDataFrame(rows, "doc_id string, text string").repartition(7)
    got = lexical_search.search(docs, items.where("text = 'Hut'"), k=4).orderBy("rank").collect()
    assert [r["doc_id"] for r in got] == ["999", "000", "001", "002"]


def test_products_stay_exact():
    """Tiles are cut where an item's sum could leave the integers that doubles hold."""
    counts = [{0: 7, 1: 1, 2: 30}, {1: 3}, {}]
    weight = np.array([5, 9, 2, 4])
    got = lexical_search.tiles(counts, weight, limit=20)
    total = np.zeros((3, 4), np.int64)
    for tile in got:
        assert tile.weights.sum(axis=1).max() <= 20 and len(set(tile.terms)) == len(tile.terms)
        for column, term in enumerate(tile.terms):
            total[tile.items, term] += tile.weights[:, column].astype(np.int64)
    assert total.tolist() == [[35, 9, 60, 0], [0, 27, 0, 0], [0, 0, 0, 0]]


def test_scores_beyond_2_53(spark):
    """One item whose exact scores no double holds; two documents differ by little."""
    docs = spark.createDataFrame(
        [(1, "rare " * 3), (2, "rare " * 3 + "x"), *[(i, "other words") for i in range(3, 3000)]], "doc_id bigint, text string"
    )
    items = spark.createDataFrame([("long", "rare " * 2_000_000)], "item_id string, text string")
    got = lexical_search.search(docs, items, k=2)
    want = brute.search([tuple(r) for r in docs.collect()], [("long", "rare")], 2)
    want = Counter((item, rank, doc, score * 2_000_000) for item, rank, doc, score in want)
    assert collected(got, "item_id", "rank", "doc_id", "score") == want and max(r[3] for r in want) > 2**53


# --- byte-level BPE ---------------------------------------------------------------


@pytest.fixture(scope="module")
def coder():
    known = byte_bpe.tables(byte_bpe.read_ranks(RANKS)) | {"classes": byte_bpe.character_classes()}
    return byte_bpe.Coder(known)


@pytest.fixture(scope="module")
def library():
    import tiktoken

    ranks = byte_bpe.read_ranks(RANKS)
    return tiktoken.Encoding("plain", pat_str=byte_bpe.PATTERN, mergeable_ranks=ranks, special_tokens={})


def encoded(coder, texts):
    data, offsets = packed.utf8(pa.array(texts, pa.string()))
    ids, firsts = coder.encode(data, offsets)
    return [ids[a:b].tolist() for a, b in zip(firsts, firsts[1:])]


PARTS = st.sampled_from([*"'strevmlld \n\t\r12²½Ⅷ漢é#.,\0 　\U0001F600Aßñ", "'s", "'ll", "  ", "the", " 're", "ing", "<|endoftext|>"])


@settings(max_examples=300, deadline=None)
@given(st.lists(st.lists(PARTS, max_size=30).map("".join), min_size=1, max_size=5))
def test_tokens_like_the_library(coder, library, texts):
    got = encoded(coder, texts)
    assert got == [library.encode_ordinary(t) for t in texts]
    flat = np.array([i for ids in got for i in ids], np.int64)
    firsts = np.concatenate([[0], np.cumsum([len(i) for i in got])])
    data, starts = coder.decode(flat, firsts)
    assert [data[a:b].tobytes().decode() for a, b in zip(starts, starts[1:])] == texts


def test_every_token_is_found_whole(coder):
    """The minimal perfect hash names each token of the vocabulary, in as many slots as tokens."""
    t = coder.t
    assert sorted(t["key_at"]) == list(range(len(t["ids"])))
    got = coder.whole(t["data"], t["starts"], t["lengths"], t["hashes"])
    assert (got == t["ids"]).all()
    other = packed.span_hashes(t["data"][::-1].copy(), t["starts"], t["starts"] + t["lengths"])
    reverse = coder.whole(t["data"][::-1].copy(), t["starts"], t["lengths"], other)
    back = t["data"][::-1].tobytes()
    ranks = {t["data"][a : a + n].tobytes(): i for a, n, i in zip(t["starts"], t["lengths"], t["ids"])}
    assert all(got == ranks.get(back[a : a + n], -1) for a, n, got in zip(t["starts"], t["lengths"], reverse))


def test_equal_hashes_are_told_apart(coder, library, monkeypatch):
    monkeypatch.setattr(packed, "span_hashes", lambda data, starts, ends: (ends - starts).astype(np.uint64) % np.uint64(2))
    texts = ["qqzzx xxyyq wwqqx", "zzqqx the cat", "漢字漢 字漢字"]
    assert encoded(coder, texts) == [library.encode_ordinary(t) for t in texts]


def test_long_texts_in_pieces(coder, library, monkeypatch):
    monkeypatch.setattr(byte_bpe, "_PIECE_CHARACTERS", 50)
    monkeypatch.setattr(packed, "CHUNK_BYTES", 100)
    rng = random.Random(3)
    text = "".join(rng.choice(["word", " ", "  ", "'s", "é", "\n", " and", "1", "!"]) for _ in range(3000))
    ids, firsts = byte_bpe._encode_batch(coder, pa.array([text]))
    assert ids.tolist() == library.encode_ordinary(text) and firsts.tolist() == [0, len(ids)]


def test_a_very_long_word(coder, library):
    text = "abracadabra" * 30_000
    assert encoded(coder, [text])[0] == library.encode_ordinary(text)


@pytest.mark.parametrize("packed_ids", [False, True])
def test_round_trip(spark, odd, empty, library, packed_ids):
    clash = odd.withColumn("ids", F.lit("mine")).withColumn("decoded", F.lit("mine"))
    tokens = byte_bpe.encode(clash, RANKS, packed_ids=packed_ids)
    back = byte_bpe.decode(tokens, RANKS).collect()
    assert len(back) == odd.count() and set(tokens.columns) == {*odd.columns, "ids", "decoded"}
    for row in back:
        ids = np.frombuffer(row["ids"], "<u4").tolist() if packed_ids else row["ids"]
        assert bytes(row["decoded"]).decode() == (row["text"] or "") and ids == library.encode_ordinary(row["text"] or "")
        assert row["size"] == 1 and row["shard"] == "a"
    assert byte_bpe.decode(byte_bpe.encode(empty, RANKS), RANKS).count() == 0


def test_unknown_ids_are_refused(spark):
    with pytest.raises(Exception, match="not in the vocabulary"):
        byte_bpe.decode(spark.sql("select array(50256) as ids"), RANKS).collect()
    assert byte_bpe.decode(spark.sql("select cast(null as array<int>) as ids"), RANKS).first()["decoded"] == b""


# --- importance resampling --------------------------------------------------------

WORDS = st.lists(st.sampled_from(["a", "the", "é" * 40, "x" * 200, "of", "y" * 65, "ab12"]), max_size=12).map(" ".join)


@settings(max_examples=100, deadline=None)
@given(st.lists(WORDS, min_size=1, max_size=4), st.integers(0, 5), st.integers(0, 4))
def test_features(texts, head, pair_words):
    """The buckets are those of the joined strings, whatever the head holds."""
    known = importance.head_tables([w.encode() for w in ["the", "a", "é" * 40, "of", "y" * 65][:head]], pair_words, 997)
    n_words, bucket, owner, n = importance.features(texts, known, 997)
    for i, text in enumerate(texts):
        want = Counter(crc32(g.encode()) % 997 for g in brute.grams(text))
        assert Counter(bucket[owner == i].tolist()) == want and n[i] == sum(want.values())
        assert n_words[i] == len(brute.bench_words(text))


def plain_importance(docs, target):
    return Counter(brute.importance(pairs(docs), target))


@pytest.mark.parametrize("most_head", [0, 3, 4096])
def test_importance(spark, docs, most_head):
    target = ["ab ba cad dab ece", None, "", "hut ink jam kit"]
    frame = spark.createDataFrame([(t,) for t in target], "text string")
    got = importance.resample(importance.score(docs, frame, most_head=most_head))
    want = plain_importance(docs, target)
    assert collected(got, "doc_id", "n_features", "weight", "score", "rank") == want
    assert max(r[4] or 0 for r in want) >= 2


def test_importance_of_odd_and_empty_tables(spark, odd, empty):
    target = ["ab ba cad"]
    frame = spark.createDataFrame([(t,) for t in target], "text string")
    clash = odd.withColumn("score", F.lit("mine")).withColumn("rank", F.lit("mine"))
    got = importance.resample(importance.score(clash, frame), percent=60)
    want = Counter(brute.importance(pairs(odd), target, percent=60))
    assert collected(got, "doc_id", "n_features", "weight", "score", "rank") == want
    assert set(got.columns) == {*odd.columns, "n_features", "weight", "score", "rank"}
    assert importance.resample(importance.score(empty, frame)).count() == 0
    only = importance.resample(importance.score(odd, frame.limit(0)), percent=60)
    assert collected(only, "doc_id", "n_features", "weight", "score", "rank") == Counter(brute.importance(pairs(odd), [], percent=60))


def test_kth_largest(spark):
    values = [random.Random(4).randint(-10**7, 10**7) for _ in range(500)] + [5] * 300
    rows = spark.createDataFrame([(v,) for v in values], "v bigint")
    for k in (1, 2, 250, 400, 799, 800):
        assert importance.kth_largest(rows, "v", k, bins=7) == sorted(values, reverse=True)[k - 1]
    assert importance.kth_largest(rows, "v", 0) is None


def test_ranks_of_ties(spark):
    rows = spark.range(5000).select((F.col("id") % 3).alias("score"), F.col("id").alias("doc_id"))
    got = importance.ranked(rows, 4000, [F.desc("score"), F.asc("doc_id")], "rank").collect()
    order = sorted(((r["score"], r["doc_id"]) for r in got), key=lambda r: (-r[0], r[1]))
    place = {pair: i for i, pair in enumerate(order, 1)}
    assert all(r["rank"] == (p if (p := place[r["score"], r["doc_id"]]) <= 4000 else None) for r in got)

"""Lexical search, periodic runs and the token store against plain Python."""

import random
import zlib

import numpy as np
import plainly
import public_tokenizers as P
import pytest
from pyspark.sql import functions as F
from test_llm_operators import AWKWARD, JSON, awkward, documents, empty, multiset, pairs, some  # noqa: F401
from tokenizers import Tokenizer

from laborlens.llm import lexical, periodic, queries, token_store

ITEMS = [
    (1, "line two is here, and LONG enough"), (2, None), (3, ""), (4, "the same line again and again"), (5, "passage3word zzz"),
    (6, "nothing-of-this_stands anywhere"), (7, "Two words one"), (7, "sit 12 lorem7"), (None, "one"), (8, "éè ñ €"), (8, "éè ñ €"),
]


@pytest.fixture(scope="module")
def items(spark):
    return spark.createDataFrame(ITEMS, "item_id long, text string").withColumn("score", F.lit("clash"))


def test_lexical_search(some, items, spark, sf):  # noqa: F811
    got = [tuple(r) for r in lexical.search(some, items).collect()]
    assert sorted(got, key=str) == sorted(plainly.lexical(pairs(some), ITEMS), key=str)
    bench = spark.read.parquet(f"{sf}/benchmark.parquet")
    want = plainly.lexical(pairs(some), [(r.item_id, r.text) for r in bench.collect()])
    assert sorted(map(tuple, lexical.search(some, bench).collect()), key=str) == sorted(want, key=str)


@pytest.mark.parametrize("share", [0.0, 0.3, 2.0])
def test_lexical_search_skips_nothing_that_counts(spark, monkeypatch, share):
    """Small blocks, several segments and passes; ties, common and rare terms, few and many short lists."""
    monkeypatch.setattr(lexical, "SEGMENT_DOCS", 64)
    monkeypatch.setattr(lexical, "BLOCK", 4)
    monkeypatch.setattr(lexical, "STRIDE", 16)
    monkeypatch.setattr(lexical, "PASS_PAIRS", 40)
    monkeypatch.setattr(lexical, "SHORT_SHARE", share)
    rng = random.Random(3)

    def text(n):
        return " ".join(f"t{min(int(rng.paretovariate(0.6)), 400)}" for _ in range(n))

    rows = [(i, text(rng.randint(1, 30))) for i in range(600)] + [(1000 + i, "t1 t2 t3 t5") for i in range(40)]
    asked = [(i, text(8)) for i in range(20)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    got = lexical.search(docs, spark.createDataFrame(asked, "item_id long, text string"), most=5).collect()
    assert sorted(map(tuple, got)) == sorted(plainly.lexical(rows, asked, 5))


def test_blocks_are_skipped():
    """Long lists of a block that can't reach the threshold are not read."""
    query = lexical.Query([(1, 10), (1, 20)])
    query.weigh(np.array([3, 600]), 1000)
    docs = np.arange(512)
    row = {
        "doc_ids": docs, "lengths": np.full(512, 10).tobytes(), "terms": np.array([0, 1], "<i4").tobytes(),
        "sizes": np.array([1, 512], "<i4").tobytes(), "docs": np.r_[300, docs].astype("<i4").tobytes(),
        "tfs": np.ones(513, "<i4").tobytes(),
    }
    index = lexical.Index(row, query, 1000, 10_000)
    top = int(index.scores[0] + index.scores[1])
    assert index.item_bounds(query).tolist() == [top]
    index.scores[1 + 128 :][:128] = -(1 << 40)  # would show if that block were read
    found, scores = index.best(query, 0, 1, top)
    assert found.tolist() == [300] and scores.tolist() == [top]


def test_periodic_runs(some):  # noqa: F811
    rows = [(i, t) for i, t in pairs(some) if len((t or "").split()) < 3000]
    short = some.filter(F.size(F.split(F.coalesce("text", F.lit("")), " ")) < 3000)
    got = multiset(periodic.report(periodic.make_periodic(short)).collect())
    want = multiset(plainly.periodic_report(i, t) for i, t in rows)
    assert want == got


def test_long_periodic_texts(spark):
    rows = [(1, "a " * 50_000), (2, "a b c " * 20_000 + "d"), (3, "x " + "y z " * 6), (4, None), (5, " ".join(f"w{i}" for i in range(60_000)) + " end" * 12)]
    got = {r.doc_id: r for r in periodic.find_runs(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    runs = {i: [tuple(x) for x in r.runs] for i, r in got.items()}
    assert runs == {1: [(0, 50_000, 1)], 2: [(0, 60_000, 3)], 3: [(1, 12, 2)], 4: [], 5: [(60_000, 12, 1)]}
    assert [got[i].collapsed_text for i in (1, 2, 3, 4)] == ["a", "a b c d", "x y z", ""] and got[4].n_words == 0


@pytest.mark.parametrize("seed", range(6))
def test_runs_of_random_words(seed):
    """Several documents at once, few different words, every least length; runs overlap and touch document ends."""
    rng = random.Random(seed)
    for _ in range(150):
        docs = [[rng.randrange(rng.choice([1, 2, 3])) for _ in range(rng.randint(0, 50))] for _ in range(3)]
        docs.append([rng.randrange(4) for _ in range(rng.randint(1, 9))] * rng.randint(1, 7))
        least = rng.choice([2, 3, 5, 8, 12])
        word = np.array([x for d in docs for x in d], np.uint64)
        owner = np.repeat(np.arange(4), list(map(len, docs)))
        want, base = [], 0
        for d in docs:
            want += [(base + s, base + s + n, q) for s, n, q in plainly.periodic(d, least)]
            base += len(d)
        assert list(zip(*(x.tolist() for x in periodic.runs_of(word, owner, least)))) == want


def test_token_store(some, tmp_path):  # noqa: F811
    tokenizer = Tokenizer.from_file(JSON)
    token_store.write(some, f"{tmp_path}/store", JSON, P.PATTERN, segment_ids=20_000)
    spark = some.sparkSession
    got = token_store.read_documents(spark, f"{tmp_path}/store").collect()
    want = [(i, tokenizer.encode(t or "", add_special_tokens=False).ids + [0]) for i, t in pairs(some)]
    assert multiset((r.doc_id, zlib.crc32(r.ids)) for r in got) == multiset((i, zlib.crc32(np.array(x, "<u4").tobytes())) for i, x in want)
    start = 0
    for r in sorted(got, key=lambda r: r.start):
        assert r.start == start and len(r.ids) == 4 * r.n_tokens
        start += r.n_tokens
    in_order = [r.doc_id for r in sorted(got, key=lambda r: r.start)]
    assert in_order == sorted(in_order, key=lambda i: (i is not None, i or 0))
    files = token_store.manifest(spark, f"{tmp_path}/store").collect()
    assert sum(r.n_ids for r in files) == start and len(files) > 1
    # Any token by its place, without its document.
    every = np.concatenate([np.frombuffer(r.ids, "<u4") for r in sorted(got, key=lambda r: r.start)])
    places = [0, start - 1, start, -1, None, *np.random.RandomState(1).randint(0, start, 300).tolist(), 5, 5]
    asked = spark.createDataFrame([(p, "x") for p in places], "position long, token_id string")
    found = token_store.tokens_at(asked, f"{tmp_path}/store").collect()
    expect = [(p, int(every[p]) if p is not None and 0 <= p < start else None) for p in places]
    assert multiset(found) == multiset(expect)


@pytest.mark.parametrize("high", [1, 2, 200, 50_257, 1 << 32])
def test_directly_addressable_codes(high):
    rng = np.random.RandomState(4)
    for n in (1, 7, 255, 256, 257, 5000):
        ids = (rng.random_sample(n) ** 6 * high).astype(np.uint64).astype(np.uint32)
        segment = token_store.Segment(token_store.encode(ids, [None, 5], [1, n - 1], 3, 4) + b"\n")
        assert (segment.all() == ids).all() and (segment.task, segment.number, segment.n_ids) == (3, 4, n)
        places = rng.randint(0, n, 400)
        assert (segment.at(places) == ids[places]).all() and (segment.at(np.arange(n)) == ids).all()
        owner, known, counts = segment.documents()
        assert known.tolist() == [False, True] and owner[1] == 5 and counts.tolist() == [1, n - 1]
    with pytest.raises(IndexError):
        segment.at(np.array([n]))


def test_widths_are_the_best():
    """No other split of the bits gives fewer bytes."""
    ids = (np.random.RandomState(2).random_sample(60_000) ** 4 * 4000).astype(np.uint32)
    widths, size = token_store.level_widths(ids), len(token_store.encode(ids, [1], [len(ids)]))
    assert sum(widths) == 12 and len(widths) > 1 and size < len(ids) * 12 / 8
    original = token_store.level_widths
    try:
        for other in ([12], [4, 4, 4], [8, 4], [4, 8]):
            token_store.level_widths = lambda _, other=other: other
            assert len(token_store.encode(ids, [1], [len(ids)])) >= size - 200
    finally:
        token_store.level_widths = original


def test_empty(spark, empty, items, tmp_path):  # noqa: F811
    assert lexical.search(empty, items).count() == 0
    none = spark.createDataFrame([], "item_id long, text string")
    assert lexical.search(spark.createDataFrame(AWKWARD, "doc_id long, text string, source string"), none).count() == 0
    assert periodic.report(periodic.make_periodic(empty)).count() == 0
    token_store.write(empty, f"{tmp_path}/none", JSON, P.PATTERN)
    assert token_store.read_documents(spark, f"{tmp_path}/none").count() == 0
    asked = spark.createDataFrame([(0,)], "position long")
    assert [r.token_id for r in token_store.tokens_at(asked, f"{tmp_path}/none").collect()] == [None]


def test_store_query(spark, sf):
    """The registered query's columns against ids made here."""
    tokenizer, start, want = Tokenizer.from_file(JSON), 0, []
    docs = spark.read.parquet(f"{sf}/documents.parquet").orderBy("doc_id").collect()
    for r in docs:
        ids = np.array([*tokenizer.encode(r.text or "", add_special_tokens=False).ids, 0], "<u4")
        want.append((r.doc_id, start, len(ids), zlib.crc32(ids.tobytes())))
        start += len(ids)
    assert sorted(map(tuple, queries.QUERIES["op13_token_store"](spark, sf).collect())) == want

from __future__ import annotations

import itertools
import random
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import types as T

from helpers import awkward, documents, sentence
from tabkit.llm import jaccard, near_vectors
from tabkit.llm.common import SpanHasher
from tabkit.llm.graph import components


def roots(nodes, links):
    up = {n: n for n in nodes}

    def root(x):
        while up[x] != x:
            x = up[x]
        return x

    for a, b in links:
        a, b = root(a), root(b)
        up[max(a, b)] = min(a, b)
    return {n: root(n) for n in nodes}


def shingles(text):
    words = (text or "").encode().lower().split()
    if not words:
        return set()
    return {tuple(words)} if len(words) < 5 else {tuple(words[i : i + 5]) for i in range(len(words) - 4)}


def linked(a, b):
    both = len(a & b)
    return both > 0 and 100 * both >= 80 * (len(a) + len(b) - both)


def brute_force(rows):
    sets = {i: shingles(t) for i, t in rows}
    return sets, roots(sets, [(a, b) for a, b in itertools.combinations(sets, 2) if linked(sets[a], sets[b])])


def near_copies(seed, families, copies):
    """Families of edited copies about the threshold, chains and exact copies among them."""
    draw, texts = random.Random(seed), []
    for _ in range(families):
        base = sentence(draw, "en", draw.randint(5, 120)).split()
        for _ in range(draw.randint(1, copies)):
            words = list(base)
            for _ in range(draw.randint(0, max(1, len(words) // 25))):
                words[draw.randrange(len(words))] = f"new{draw.randint(0, 9999)}"
            texts.append(" ".join(words))
            if draw.random() < 0.3:
                base = words
    draw.shuffle(texts)
    return list(enumerate(texts, start=100))


@pytest.mark.parametrize("chunk", [jaccard.CHUNK_SHINGLES, 600])
def test_jaccard_equals_brute_force(spark, chunk):
    rows = near_copies(1, 12, 14)
    sets, expected = brute_force(rows)
    docs = documents(spark, [(i, t, "en") for i, t in rows])
    got = {r["doc_id"]: r for r in jaccard.jaccard_components(docs, chunk=chunk).collect()}
    assert {i: r["n_shingles"] for i, r in got.items()} == {i: len(s) for i, s in sets.items()}
    assert {i: r["component_id"] for i, r in got.items()} == expected
    assert len(set(expected.values())) < len(expected) - 20


def test_large_family_around_a_hub(spark):
    """Copies linked with their original only, spread over many chunks."""
    draw = random.Random(8)
    base = [f"w{i}" for i in range(100)]
    rows = [(500, " ".join(base))]
    for k in range(40):
        words = list(base)
        for at in draw.sample(range(0, 100, 5), 2):
            words[at] = f"x{k}y{at}"
        rows.append((k, " ".join(words)))
    _, expected = brute_force(rows)
    docs = documents(spark, [(i, t, "en") for i, t in rows])
    got = {r["doc_id"]: r["component_id"] for r in jaccard.jaccard_components(docs, chunk=700).collect()}
    assert got == expected


def test_linked_sets_always_share_a_block():
    draw, bounds = np.random.default_rng(2), jaccard.size_classes()
    for _ in range(3000):
        n = int(draw.integers(4, 60))
        base = np.unique(draw.integers(0, 1 << 60, n).astype(np.uint64))
        other = base.copy()
        for _ in range(int(draw.integers(0, 1 + n // 9))):
            other[int(draw.integers(0, len(other)))] = draw.integers(0, 1 << 60)
        if draw.random() < 0.5:
            other = other[: len(other) - int(draw.integers(0, 1 + n // 9))]
        other = np.unique(other)
        # whichever shingles count as frequent
        frequent = np.unique(np.concatenate([base, other])[draw.random(len(base) + len(other)) < draw.random()])
        a, b = set(base.tolist()), set(other.tolist())
        if a != b and linked(a, b):
            keys = [set(jaccard.block_keys(x, bounds, frequent).tolist()) for x in (base, other)]
            assert keys[0] & keys[1]


def test_frequent_shingles_come_last(spark, monkeypatch):
    passage = " ".join(f"p{i}" for i in range(30))
    rows = [(i, " ".join(f"d{i}w{k}" for k in range(40)) + " " + passage, "en") for i in range(60)]
    docs = documents(spark, rows).coalesce(1)
    frequent = jaccard.frequent_shingles(jaccard.measured(docs))
    shared = set(jaccard.shingle_set(SpanHasher(), passage).tolist())
    assert set(frequent.tolist()) == shared
    assert jaccard.block_links(jaccard.blocks(docs, frequent, "text", "doc_id", 5, 80)).count() == 0


def test_tree_never_misses():
    draw = np.random.default_rng(4)
    sets = [np.unique(draw.integers(0, 120, int(draw.integers(5, 90))).astype(np.uint64)) for _ in range(300)]
    sizes = np.array([len(s) for s in sets])
    points = jaccard.group_counts(sets, sizes)
    tree = jaccard.CountTree(sizes, points)
    for i in range(0, 300, 7):
        found = set(tree.search(int(sizes[i]), points[i]).tolist())
        wanted = {j for j in range(300) if linked(set(sets[i].tolist()), set(sets[j].tolist()))}
        assert wanted <= found


def test_shingles_of_long_and_odd_texts(spark):
    hasher = SpanHasher()
    for row in awkward(spark).collect():
        assert len(jaccard.shingle_set(hasher, row["text"])) == len(shingles(row["text"]))
    assert jaccard.shingle_set(hasher, "A b\x0bC\x1cd").tolist() == jaccard.shingle_set(hasher, "a B c\x1cD").tolist()


def test_jaccard_of_awkward_rows(spark):
    got = jaccard.jaccard_components(awkward(spark)).collect()
    assert len(got) == 15
    by = defaultdict(set)
    for r in got:
        by[r["doc_id"]].add((r["n_shingles"], r["component_id"]))
    assert by[1] == {(0, 1)} and by[3] == {(0, 3)} and by[4] == {(1, 4)}
    assert by[11] == {(3, 11)} and by[12] == {(3, 11)}
    assert {c for _, c in by[None]} == {None}
    assert jaccard.jaccard_components(awkward(spark).limit(0)).count() == 0


def test_rows_without_id_are_in_no_component(spark):
    text = "five words or more are needed for some shingles"
    rows = [(None, text, "en")] * 3 + [(7, text, "en"), (9, text, "en"), (None, "alone with other words than they have", "en")]
    got = sorted((r["doc_id"] or -1, r["component_id"] or -1) for r in jaccard.jaccard_components(documents(spark, rows)).collect())
    assert got == [(-1, -1)] * 4 + [(7, 7), (9, 7)]


def test_links_of_a_hub_are_split(spark, monkeypatch):
    """With thresholds to match, adaptive execution splits the join of a node's many links."""
    from conftest import plan_of

    from tabkit.llm import graph

    monkeypatch.setattr(graph, "FEW_NODES", 0)
    small = {
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "1k", "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.1",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "2k", "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    }
    before = {k: spark.conf.get(k, None) for k in small}
    try:
        for k, v in small.items():
            spark.conf.set(k, v)
        links = spark.range(1, 60_000, 1, 6).selectExpr("id AS a", "if(id % 3 = 0, id - 1, 0) AS b")
        joined = graph._large_star(links)
        joined.collect()
        assert "skew=true" in plan_of(joined).replace("isSkewJoin=true", "skew=true")
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def test_components_of_a_long_path(spark):
    links = [(i, i + 1) for i in range(60)] + [(100, 200), (300, 200), (7, 7)]
    frame = spark.createDataFrame(links, "a long, b long")
    got = {r["node"]: r["component"] for r in components(frame).collect()}
    assert got == {**{i: 0 for i in range(61)}, 100: 100, 200: 100, 300: 100}


VECTORS = T.StructType(
    [
        T.StructField("vec_id", T.LongType()),
        T.StructField("embedding", T.ArrayType(T.FloatType())),
        T.StructField("id", T.StringType()),
        T.StructField("weight", T.StringType()),
    ]
)


@pytest.mark.parametrize("cell, block", [(4096, 4096), (60, 25)])
def test_near_vectors_equal_brute_force(spark, cell, block):
    draw = np.random.default_rng(6)
    base = draw.normal(size=(60, 16))
    rows = np.concatenate([base] + [base[:30] + draw.normal(size=(30, 16)) * s for s in (0.05, 0.15, 0.25, 0.35)])
    rows = np.concatenate([rows, rows[:20]]).astype(np.float32)
    frame = spark.createDataFrame([(i, x.tolist(), "a", "b") for i, x in enumerate(rows)], VECTORS)
    unit = rows.astype(float) / np.linalg.norm(rows.astype(float), axis=1, keepdims=True)
    close = unit @ unit.T >= 0.95
    np.fill_diagonal(close, False)
    expected = roots(range(len(rows)), zip(*np.nonzero(close)))
    got = {r["vec_id"]: r for r in near_vectors.near_duplicates(frame, cell_vectors=cell, block=block).collect()}
    assert {i: r["n_links"] for i, r in got.items()} == dict(enumerate(close.sum(axis=1).tolist()))
    assert {i: r["component_id"] for i, r in got.items()} == expected
    assert all(r["kept"] == (i == expected[i]) for i, r in got.items())
    assert close.sum() > 100


def test_near_vectors_of_awkward_rows(spark):
    nan, inf = float("nan"), float("inf")
    rows = [
        (1, None), (2, []), (3, [0.0, 0.0]), (4, [nan, 1.0]), (5, [inf, 1.0]), (6, [None, 1.0]), (7, [1.0, 0.0]),
        (8, [2.0, 0.0]), (9, [1.0, 0.0, 0.0]), (10, [1e-38, 0.0]), (11, [-1.0, 0.0]), (None, [1.0, 0.0]), (12, [1.0, 0.0]),
    ]
    frame = spark.createDataFrame([(i, v, "a", "b") for i, v in rows], VECTORS)
    got = {r["vec_id"]: (r["n_links"], r["component_id"], r["kept"]) for r in near_vectors.near_duplicates(frame).collect()}
    for i in (1, 2, 3, 4, 5, 6, 9, 11):
        assert got[i] == (0, i, True)
    assert got[7] == (3, 7, True) and got[8] == got[10] == got[12] == (3, 7, False)
    assert got[None][:2] == (0, None)
    assert near_vectors.near_duplicates(frame.limit(0)).count() == 0


def test_duplicate_counts_are_weighted():
    assert Counter(near_vectors._chunk(np.arange(9000), 3, 1).tolist()).most_common()[-1][1] > 2500

"""Top-k search, hard negatives and the filter audit against plain versions."""

from __future__ import annotations

import math
import random
import re
from itertools import permutations

import numpy as np
import pytest
from pyspark.sql import functions as F

from motorpulse.llm import filter_audit, hard_negatives, topk_search, vector_blocks
from motorpulse.llm.queries import QUERIES

VECTORS = "vec_id long, embedding array<double>, label int, row string, `a b` string"


@pytest.fixture(params=["one block", "many blocks"])
def blocks(request, monkeypatch):
    if request.param == "many blocks":
        monkeypatch.setattr(vector_blocks, "LEAST_ROWS", 40)
        monkeypatch.setattr(vector_blocks, "MOST_NUMBERS", 90 * 14)
        monkeypatch.setattr(vector_blocks, "QUERY_NUMBERS", 3 * 14)


def _vectors(seed: int) -> list[tuple]:
    """Clustered vectors with copies, ties, zeros, sparse and short ones, and unusable rows."""
    rng = np.random.default_rng(seed)
    centres = rng.standard_normal((6, 12))
    rows = []
    for k in range(400):
        v = centres[k % 6] + rng.standard_normal(12) * 0.4
        v[rng.random(12) < 0.3] = 0
        rows.append((k, v.tolist(), None if k % 31 == 5 else int(k % 4)))
    hot = rows[12][1]
    rows += [(k, hot, 1) for k in range(400, 520)]
    odd = [None, [], [0.0] * 12, [1.5, -2.0], [1.0, None], [1.0, math.nan], [math.inf], [1.0] * 14, [1e300] * 2, [-1e300]]
    rows += [(600 + 50 * k, v, k % 3) for k, v in enumerate(odd)]
    rows += [(100, rows[3][1], 2), (100, rows[3][1], 2), (None, rows[5][1], 1), (None, None, 0)]
    return [(*r, "clash", "x") for r in rows]


def _ints(vector, factor):
    if vector is None or any(x is None or not math.isfinite(x) for x in vector):
        return None
    held = [factor * x for x in vector]
    return [2**63 - 1 if x >= 2**63 else -(2**63) if x <= -(2**63) else math.floor(x) for x in held]


def _score(a, b):
    return min(max(sum(x * y for x, y in zip(a, b)), -(2**63)), 2**63 - 1)


def _best(found, k):
    return sorted(found, key=lambda f: (-f[0], f[1] is None, f[1] or 0))[:k]


def _sorted(rows):
    return sorted(map(tuple, rows), key=lambda r: [(v is not None, v) for v in r])


@pytest.mark.parametrize("seed", [1, 2])
def test_search_equals_brute_force(spark, blocks, seed):
    rows = _vectors(seed)
    df = spark.createDataFrame(rows, VECTORS).repartition(5)
    ours = topk_search.search(df, F.col("vec_id") % 50 == 0, k=7)
    known = [(r[0], w) for r in rows if (w := _ints(r[1], 1024)) is not None]
    expected = []
    for n, (query, a) in enumerate(known):
        if query is not None and query % 50 == 0:
            found = [(_score(a, b), i) for m, (i, b) in enumerate(known) if m != n]
            expected += [(query, k, i, s) for k, (s, i) in enumerate(_best(found, 7), 1)]
    assert ours.columns == ["query_id", "rank", "vec_id", "score"]
    assert _sorted(ours.collect()) == _sorted(expected)


def test_postings_hold_every_weight_and_no_zero():
    weights, lengths = np.array([3, 0, -1, 0, 0, 5, 7]), np.array([3, 0, 2, 2])
    lists = topk_search.postings(weights, lengths)
    assert {t: dict(zip(r.tolist(), w.tolist())) for t, (r, w) in lists.items()} == {0: {0: 3, 3: 5}, 1: {3: 7}, 2: {0: -1}}
    assert topk_search.accumulate(np.array([2, 0, 10, 4]), lists, 4).tolist() == [-4, 0, 0, 10]
    assert topk_search.postings(np.array([], int), np.array([0, 0])) == {}


def _hard(rows, anchors):
    known = [(r[0], str(r[2]), w) for r in rows if r[2] is not None and (w := _ints(r[1], 256)) is not None]
    out = []
    for n, (anchor, label, a) in enumerate(known):
        if anchor is None or anchor % anchors:
            continue
        scored = [(_score(a, b), i, other == label) for m, (i, other, b) in enumerate(known) if m != n]
        for p, positive in _best([(s, i) for s, i, same in scored if same], 5):
            inside = [(s, i) for s, i, same in scored if not same and 30 * p <= 100 * s <= 90 * p]
            for k, (s, i) in enumerate(_best(inside, 10), 1):
                out.append((anchor, positive, k, i, p, s))
    return out


@pytest.mark.parametrize("seed", [3, 4])
def test_hard_negatives_equal_brute_force(spark, blocks, seed):
    rows = _vectors(seed)
    df = spark.createDataFrame(rows, VECTORS).repartition(5)
    ours = hard_negatives.mine(df, F.col("vec_id") % 20 == 0, F.col("label"))
    expected = _hard(rows, 20)
    assert expected and _sorted(ours.collect()) == _sorted(expected)


def test_bounds_hold_every_score():
    rng = np.random.default_rng(8)
    for spread in (1e-4, 0.3, 3.0):
        vectors = np.floor(256 * (rng.standard_normal(20) + spread * rng.standard_normal((300, 20))))
        vectors[7] = 0
        vectors[8] = -vectors[9]
        vectors[10] = vectors[9]
        chosen = hard_negatives.directions_of(vectors[:50])
        norms, angles = hard_negatives._angles(vectors, chosen)
        for k in range(len(vectors)):
            low, high = hard_negatives.bounds(norms[k], angles[k], norms, angles)
            scores = vectors @ vectors[k]
            assert (low <= scores).all() and (scores <= high).all()


def test_angles_spare_most_rows_of_tight_clusters(spark, monkeypatch):
    """Where rows lie close to the directions, most are never scored; the result is whole."""
    rng = np.random.default_rng(5)
    centres = np.eye(8)[np.arange(600) % 8] * 2
    vectors = np.floor(256 * (centres + 0.05 * rng.standard_normal((600, 8))))
    chosen = hard_negatives.directions_of(vectors[:200])
    norms, angles = hard_negatives._angles(vectors, chosen)
    low, high = hard_negatives.bounds(norms[0], angles[0], norms, angles)
    window = 0.3 * 4 * 256**2, 0.9 * 4 * 256**2
    assert ((high >= window[0]) & (low <= window[1])).mean() < 0.3


@pytest.mark.parametrize("name", ["op11_topk", "op13_hard_negatives"])
def test_searches_of_empty_tables(spark, folder, name):
    spark.createDataFrame([], VECTORS).write.parquet(f"{folder}/embeddings.parquet")
    assert QUERIES[name](spark, folder).collect() == []


def _audit(docs, labels):
    known, out = {}, []
    for doc, text, _ in docs:
        if doc is not None:
            known[text or ""] = min(doc, known.get(text or "", doc))
    good = {d for d, q, _ in labels if q == 1 and d is not None}
    toxic = {d for d, _, t in labels if t == 1 and d is not None}
    facts = []
    for doc, text, lang in docs:
        text = text or ""
        words = re.findall(r"[^\x20\x09-\x0D]+", text)
        fails = {
            "A": len(words) < 100,
            "B": 100 * len(set(words)) < 80 * len(words),
            "C": 100 * len(re.findall("[A-Z]", text)) > 10 * len(text),
            "D": bool(re.search(r"[#$%&*|]", text)),
            "E": doc is not None and known[text] < doc,
        }
        facts.append((lang or "", fails, doc in good, doc in toxic))
    for part in {f[0] for f in facts}:
        mine, rows, shares = [f for f in facts if f[0] == part], [], dict.fromkeys("ABCDE", 0)
        for order in permutations("ABCDE"):
            left = mine
            for step, x in enumerate(order, 1):
                gone = [f for f in left if f[1][x]]
                left = [f for f in left if not f[1][x]]
                shares[x] += len(gone)
                failing = [f for f in mine if f[1][x]]
                alone = sum(sum(f[1].values()) == 1 for f in failing)
                lost = sum(f[2] for f in gone), sum(f[3] for f in gone)
                rows.append([part, "".join(order), step, len(left), len(gone), len(failing) - len(gone), alone, *lost])
        out += [(*r, shares[r[1][r[2] - 1]]) for r in rows]
    return out


COLUMNS = "part filter_order step kept removed redundant unique_fails good_lost toxic_lost shapley".split()


@pytest.mark.parametrize("shuffled", [False, True])
def test_audit_equals_brute_force(spark, monkeypatch, shuffled):
    monkeypatch.setattr(filter_audit, "HOT_ROWS", 6)  # many parts of a hot text
    if shuffled:
        monkeypatch.setattr(filter_audit, "BROADCAST_KEYS", 0)
    rng = random.Random(3)
    pool = [f"w{k}" for k in range(400)] + ["Été", "ÀB", "日本", "AB", "C", "#x", "a\x0bb", " ", "\u0085"]
    texts = [None, "", " \t\n", "A", "é" * 9 + "A", "é" * 10 + "A", "one|two", "x " * 30_000]
    for _ in range(60):
        n = rng.choice([3, 99, 100, 101, 150])
        texts.append(rng.choice([" ", "\t", "\n ", "\r"]).join(rng.choices(pool, k=n)))
    docs = [(k, rng.choice(texts), rng.choice(["en", "de", None, ""])) for k in range(300)]
    docs += [(k, texts[20], "en") for k in range(300, 360)]  # a hot text
    docs += [(5, texts[9], "en"), (5, texts[9], "en"), (5, texts[10], "fr"), (None, texts[20], "fr"), (None, None, None)]
    labels = [(k, rng.randrange(2), rng.randrange(2)) for k in range(0, 360, 2)]
    labels += [(5, 1, None), (5, 0, 1), (None, 1, 1), (9999, 1, 1), (7, None, None)]
    rows = [(*d, "clash", k) for k, d in enumerate(docs)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, hash string, bits int").repartition(7)
    known = spark.createDataFrame(labels, "doc_id long, quality int, toxic int").withColumn("n", F.lit(1))
    ours = filter_audit.audit(df, known).select(*COLUMNS).collect()
    expected = _audit(docs, labels)
    assert len(expected) == 4 * 600 and _sorted(ours) == _sorted(expected)


def test_audit_of_empty_tables(spark):
    docs = spark.createDataFrame([], "doc_id long, text string, lang string")
    labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert filter_audit.audit(docs, labels).collect() == []
    one = docs.union(spark.createDataFrame([(1, "a", "en")], docs.schema))
    assert filter_audit.audit(one, labels).agg(F.count("*"), F.sum("kept")).first() == (600, 240)  # until A is applied

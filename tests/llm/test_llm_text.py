"""BPE, token counts, quality, language and fingerprints against plain versions."""

from __future__ import annotations

import hashlib
import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from motorpulse.llm import bpe, fingerprints, language_id, quality, token_counts
from motorpulse.llm.queries import QUERIES, tokenizer_file

ODD = [
    None,
    "",
    "   \n",
    "It's I'LL 12½² ¾ don't",
    "<|endoftext|>hi <|startoftext|><|ENDOFTEXT|> <|endoftext|",
    "İstanbul ΣΊΣΥΦΟΣ ǅ á x\u0085y\x1cz q ſ­",
    "日本語テキスト 🎉🎉 \x00\x01",
    "a" * 3000,
    "ab" * 900 + " x" * 50,
    "!!!???" * 300,
    "It's I'LL 12½² ¾ don't",
]


def _docs(spark, texts, **more):
    rows = [(k, t, "junk", *more.values()) for k, t in enumerate(texts)]
    names = ", ".join(f"{c} string" for c in ["ids", *more])
    return spark.createDataFrame(rows, f"doc_id long, text string, {names}")


def test_encode_equals_the_library(spark):
    from tokenizers import Tokenizer

    library = Tokenizer.from_file(tokenizer_file())
    rng = random.Random(1)
    letters = "abcdefgh étßİſΣσς'0123 \n\t½<|>endoftx́̇ \u0085\x1c.!"
    texts = ODD + ["".join(rng.choice(letters) for _ in range(rng.randrange(80))) for _ in range(400)]
    both = bpe.decode(bpe.encode(_docs(spark, texts), tokenizer_file()), tokenizer_file())
    assert both.columns == ["doc_id", "text", "ids", "decoded"]
    for row in both.collect():
        ids = library.encode(row["text"] or "", add_special_tokens=False).ids
        assert row["ids"] == ids, row["text"]
        assert row["decoded"] == library.decode(ids, skip_special_tokens=False)


def test_proposals_are_verified_and_not_trusted(spark):
    with open(tokenizer_file(), encoding="utf-8") as f:
        tokenizer = bpe.Tokenizer(f.read())
    rng = random.Random(2)
    words = [bytes(rng.choice(b"aeinrst") for _ in range(rng.randrange(1, 60))) for _ in range(3000)]
    merged = [tokenizer.merge(w) for w in words]
    assert tokenizer.encode_words(words) == merged
    proposed = [tokenizer.propose(w) for w in words]
    assert 0 < sum(p != m for p, m in zip(proposed, merged)) < len(words)


def test_decode_passes_over_what_is_no_token(spark):
    rows = [(1, [320, None, 10**6, 256]), (2, None), (3, [])]
    docs = spark.createDataFrame(rows, "doc_id long, ids array<int>")
    found = {r[0]: r[1] for r in bpe.decode(docs, tokenizer_file()).select("doc_id", "decoded").collect()}
    assert found[2] == found[3] == "" and len(found[1].split(" ")) == 2


def test_piece_counts_are_those_of_greedy_cutting(spark):
    rng = random.Random(3)
    for _ in range(60):
        make = lambda n: {"".join(rng.choice("ab") for _ in range(rng.randrange(1, n))) for _ in range(6)}
        first, later = make(5), make(4)
        count = token_counts.PieceCounter(first, later)
        for _ in range(60):
            word = "".join(rng.choice("ab") for _ in range(rng.randrange(9)))
            assert count(word) == _greedy(word, first, later)


def _greedy(word, first, later):
    pieces, at = 0, 0
    while at < len(word):
        known = later if at else first
        end = next((e for e in range(len(word), at, -1) if word[at:e] in known), None)
        if end is None:
            return None
        pieces, at = pieces + 1, end
    return pieces


def test_counts_of_documents(spark):
    with open(tokenizer_file(), encoding="utf-8") as f:
        tokenizer = bpe.Tokenizer(f.read())
    cut = bpe.Splitter(tokenizer)
    found = token_counts.count_pieces(_docs(spark, ODD), tokenizer_file()).orderBy("doc_id").collect()
    assert len(found) == len(ODD)
    for text, row in zip(ODD, found):
        words = cut(text) if text else []
        pieces = [1 if isinstance(w, int) else len(tokenizer.propose(w.encode())) for w in words]
        assert (row["n_words"], row["n_pieces"], row["n_uncut"]) == (len(words), sum(pieces), 0)


def test_fingerprints_of_multisets(spark):
    texts = ["A b.\nC d. E f.", "C d.\nE f.\nA b.", "A b.", "C d.\nE f.", None, " \n", "A b.\nA b.", "x" * 100_000]
    made = fingerprints.fingerprints(_docs(spark, texts), ["doc_id"])
    lanes = {r["doc_id"]: r["lanes"] for r in made.collect()}
    assert lanes[0] == lanes[1] and lanes[4] == lanes[5] == [0] * (fingerprints.LANES + 1)
    pair = spark.createDataFrame([(lanes[2], lanes[3], lanes[0])], "a array<long>, b array<long>, c array<long>")
    row = pair.select(
        fingerprints.insert(F.col("a"), F.col("b")) == F.col("c"),
        fingerprints.delete(F.col("c"), F.col("b")) == F.col("a"),
        fingerprints.likeness(F.col("c"), F.col("c")),
        fingerprints.likeness(F.col("a"), F.col("c")),
    ).first()
    assert row[0] and row[1] and row[2] == 1.0 and 0.3 < row[3] < 0.9
    # The sum of two equal pieces is twice the vector, modulo the lanes.
    assert lanes[6] == [2 * x % fingerprints.MODULUS for x in lanes[2]]


def test_next_document_and_edit(spark):
    rng = random.Random(4)
    texts = [None, "", "é", "ab", "🎉🎉🎉", *("w. " * rng.randrange(60) + str(k) for k in range(40))]
    rows = [(k * 10 - 30, t) for k, t in enumerate(texts)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    found = {r["doc_id"]: r for r in fingerprints.compare_with_next(docs).collect()}
    assert len(found) == len(rows)
    for k, (doc_id, text) in enumerate(rows):
        text, after = text or "", rows[(k + 1) % len(rows)][1] or ""
        half = len(text) // 2
        edited = text[: len(text) - half] + after[:half]
        assert found[doc_id]["n_chars"] == len(text)
        assert found[doc_id]["edited_sha256"] == hashlib.sha256(edited.encode()).hexdigest()
        if edited == text:
            assert found[doc_id]["near_edited"] == 1.0
    alone = fingerprints.compare_with_next(spark.createDataFrame([(5, "ab. cd.")], "doc_id long, text string"))
    assert [r["near_next"] for r in alone.collect()] == [1.0]
    assert fingerprints.compare_with_next(docs.limit(0)).count() == 0


def test_null_and_repeated_ids_keep_their_rows(spark):
    rows = [(None, "x. y."), (None, None), (1, "a."), (1, "a."), (2, "b.")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    assert fingerprints.compare_with_next(docs).count() == len(rows)


@pytest.mark.parametrize("bin_rows, max_bins", [(256, 1 << 16), (4, 1 << 16), (1, 7)])
def test_next_document_among_crowded_ids(spark, monkeypatch, bin_rows, max_bins):
    """A third without id, a third of one id, many equal in both, in bins of any size."""
    monkeypatch.setattr(fingerprints, "BIN_ROWS", bin_rows)
    monkeypatch.setattr(fingerprints, "MAX_BINS", max_bins)
    rng = random.Random(9)
    text = lambda k: " ".join(f"w{rng.randrange(9)} x{k % 13}." for _ in range(k % 7))
    rows = [(rng.choice([None, 5, k, -k, (1 << 63) - 1 - k // 30]), text(k)) for k in range(120)]
    rows += [(None, "one. two."), (5, "three. four five.")] * 25 + [((1 << 63) - 1, None)] * 12
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(6)
    rows = [(i, t or "") for i, t in rows]
    md5 = lambda t: hashlib.md5(t.encode()).hexdigest()
    rows.sort(key=lambda r: (r[0] is None, r[0] or 0, md5(r[1]), r[1]))
    expected = Counter()
    for k, (doc_id, text) in enumerate(rows):
        after, half = rows[(k + 1) % len(rows)][1], len(text) // 2
        edited = text[: len(text) - half] + after[:half]
        expected[doc_id, len(text), hashlib.sha256(edited.encode()).hexdigest(), text == after] += 1
    found = fingerprints.compare_with_next(docs).collect()
    assert Counter((r["doc_id"], r["n_chars"], r["edited_sha256"]) for r in found) == Counter(
        {k[:3]: sum(n for j, n in expected.items() if j[:3] == k[:3]) for k in expected}
    )
    alike = sum(n for k, n in expected.items() if k[3])
    assert sum(r["near_next"] == 1.0 for r in found) >= alike
    binned, crowded = fingerprints._binned(docs, "doc_id", "text")
    assert crowded == (bin_rows < 256)


def test_language_of_held_out_documents(spark, sf_dir):
    table = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "lang")
    found = QUERIES["op10_language"](spark, sf_dir).join(table, "doc_id").collect()
    assert len(found) == table.count()
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 4 == 2) for r in found)
    held = [r for r in found if r["held_out"] and r["lang"]]
    assert sum(r["lang"] == r["lang_pred"] for r in held) >= 0.97 * len(held)
    assert all(0 <= r["score"] <= 1 for r in found)


def test_language_of_odd_texts(spark):
    taught = _docs(spark, ["the cat and the dog", "le chat et le chien", None, "x"], lang=None)
    taught = taught.withColumn("lang", F.element_at(F.array(F.lit("en"), F.lit("fr"), F.lit("en"), F.lit(None)), (F.col("doc_id") + 1).cast("int")))
    learned = language_id.learn(taught)
    assert sorted(learned) == ["en", "fr"]
    odd = _docs(spark, [None, "", "12 !?", "the dog", "le chien " * 30_000, "the dog"], score=None)
    found = [(r["lang_pred"], r["score"]) for r in language_id.identify(odd, learned).orderBy("doc_id").collect()]
    assert [f[0] for f in found] == ["und", "und", "und", "en", "fr", "en"] and found[3] == found[5]
    assert {r["lang_pred"] for r in language_id.identify(odd, {}).collect()} == {"und"}
    assert language_id.learn(taught.limit(0)) == {}
    assert language_id.identify(odd.limit(0), learned).count() == 0


def test_odd_column_names_and_kinds_go_through(spark):
    rows = [(1, "ein Text mit Worten"), (2, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumns(
        {"a`b": F.lit(1), "x.y": F.struct(F.lit(2).alias("with space")), "lang": F.lit("de")}
    )
    learned = language_id.learn(docs)
    named = language_id.identify(docs, learned)
    assert named.columns == [*docs.columns, "lang_pred", "score"] and named.count() == 2
    both = bpe.decode(bpe.encode(docs, tokenizer_file()), tokenizer_file())
    assert both.columns == [*docs.columns, "ids", "decoded"] and both.count() == 2
    model = quality.learn(docs, spark.createDataFrame([(1, 1, 0)], "doc_id long, quality int, toxic int"))
    assert quality.rate(docs, model).columns == [*docs.columns, "expected_grade", "p_best"]


def test_language_stage_rejects_foreign_and_junk_texts(spark, sf_dir):
    import corpus_pipeline

    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select(*corpus_pipeline.COLUMNS)
    rng = random.Random(9)
    planted = [
        "Wszyscy ludzie rodzą się wolni i równi pod względem swej godności i swych praw. Są oni obdarzeni rozumem",
        "Kaikki ihmiset syntyvät vapaina ja tasavertaisina arvoltaan ja oikeuksiltaan. Heille on annettu järki",
        "Все люди рождаются свободными и равными в своем достоинстве и правах",
        "".join(rng.choice("abcdefghijklmnopqrstuvwxyz   ") for _ in range(400)),
        "for (int i = 0; i < n; i++) { sum += arr[i] * weights[i]; if (sum > max) return null; }",
        "".join(rng.choice("ABCDEFGHIJKLMNOPabcdefghijklmnop0123456789+/") for _ in range(600)),
        "q", "12", "", None,
    ]
    rows = [(-1 - k, t, None, "x", 0) for k, t in enumerate(planted)]
    both = docs.unionByName(spark.createDataFrame(rows, docs.schema))
    kept = {r["doc_id"] for r in corpus_pipeline.language_stage(spark, both, sf_dir).select("doc_id").collect()}
    clean = {r["doc_id"] for r in docs.select("doc_id").collect()}
    assert min(kept) >= 0 and len(kept) >= 0.995 * len(clean), (min(kept), len(kept), len(clean))


def test_language_limits_come_from_all_documents(spark, monkeypatch):
    import corpus_pipeline

    # One document would set no limit but the least there is.
    monkeypatch.setattr(language_id, "SCORED_DOCS", 1, raising=False)
    rng = random.Random(3)
    words = "garden window summer winter letter dinner silver stream market butter".split()
    texts = [" ".join(rng.choices(words, k=40)) for _ in range(61)]
    others = [["".join(rng.choices("bcdfghjklmnpqrstvwz", k=6)) for _ in range(8)] for _ in range(40)]
    texts += [" ".join([*other, rng.choice(words)]) for other in others]  # fifty-four letters
    lang = F.when(F.col("doc_id") < 61, "en")
    docs = _docs(spark, texts, source="x", n_chars="0").withColumn("lang", lang).select(*corpus_pipeline.COLUMNS)
    named = language_id.sized(language_id.identify(docs, language_id.learn(docs))).collect()
    assert {r["text_size"] for r in named} == {5} and {r["lang_pred"] for r in named} == {"en"}
    least = sorted(round(r["score"], 4) for r in named if r["lang"])[30] / 2
    kept = {r["doc_id"] for r in corpus_pipeline.language_stage(spark, docs, "").select("doc_id").collect()}
    assert kept == {r["doc_id"] for r in named if r["score"] >= least}
    assert any(language_id.LEAST_SCORE <= r["score"] < least for r in named)


def test_language_vectors_are_sums_of_bound_letters(spark):
    import numpy as np

    vectors, table = language_id.GramVectors(), language_id.letter_table()
    text, total = " abca bca ", np.zeros(language_id.DIMENSIONS)
    for k in range(len(text) - 2):
        vector = np.ones(language_id.DIMENSIONS)
        for place, letter in enumerate(reversed(text[k : k + 3])):
            vector *= vectors._letter(ord(letter), place)
        total += vector
    assert (vectors.bundle(*language_id.grams_of("Abca, BCA", table)) == total).all()


def _ordinal_rows(n, seed=5):
    rng = np.random.default_rng(seed)
    rows, marks = [], []
    for _ in range(n):
        words = rng.choice(40, 12, replace=False)
        score = (words < 5).sum() - (words >= 35).sum() + rng.normal() * 0.3
        columns = np.append(words, quality.BUCKETS + 2 * quality.SHAPES + 2)
        marks.append(int(rng.choice([0, 0, 0, 1, 2, 5])))
        grade = int(score > -0.5) + int(score > 0.5)
        rows.append((columns, np.ones(13), min(grade, 1) if marks[-1] else grade))
    return rows, np.array(marks)


def test_ordinal_model_orders_grades():
    rows, marks = _ordinal_rows(900)
    model = quality.fit(rows[:600], marks=marks[:600])
    assert model.thresholds[0] < model.thresholds[1] and (model.steps >= 0).all()
    tails = model.tails(np.array([model.weights[c] @ v for c, v, _ in rows[600:]]), marks[600:])
    grades = np.array([g for *_, g in rows[600:]])
    assert (tails[:, 0] >= tails[:, 1]).all()
    assert ((tails > 0.5).sum(axis=1) == grades).mean() > 0.7


def test_slope_of_the_likelihood_is_its_derivative():
    rows, marks = _ordinal_rows(60)
    loss = quality.Likelihood(rows, marks, 3)
    params = np.random.default_rng(2).normal(size=len(loss.start())) * 0.3
    params[2 : 2 + len(quality.MARK_STEPS)] **= 2  # never below 0
    _, slope = loss(params)
    for k in range(len(params)):
        step = np.zeros_like(params)
        step[k] = 1e-5
        numeric = (loss(params + step)[0] - loss(params - step)[0]) / 2e-5
        assert math.isclose(numeric, slope[k], rel_tol=1e-4, abs_tol=1e-7), k


def test_fit_goes_down_to_where_no_direction_is_better():
    rows, marks = _ordinal_rows(300)
    loss = quality.Likelihood(rows, marks, 3)
    model = quality.fit(rows, marks=marks)
    steps = np.log(np.diff(model.thresholds))
    params = np.concatenate([model.thresholds[:1], steps, model.steps, model.weights[loss.used].astype(float)])
    rng = np.random.default_rng(3)
    for _ in range(20):
        away = rng.normal(size=len(params))
        assert loss(params)[0] <= loss(params + 0.3 * away / np.linalg.norm(away))[0] + 1e-4


def _rated_documents():
    import duckdb

    path = "/root/testdata/sf0.1"
    return duckdb.sql(
        f"SELECT d.doc_id, text, quality, toxic FROM '{path}/documents.parquet' d "
        f"JOIN '{path}/labels.parquet' USING (doc_id) ORDER BY doc_id"
    ).fetchall()


RATED = "doc_id long, text string, quality int, toxic int"


def _kind(row):
    return "bad" if not row["quality"] else "toxic" if row["toxic"] else "clean"


@pytest.fixture(scope="module")
def held_out(spark):
    """Documents whose labels are held out, and the model of the others."""
    table = spark.createDataFrame(_rated_documents(), RATED)
    taught = table.where("doc_id % 3 > 0")
    return table.where("doc_id % 3 = 0"), quality.learn(taught, taught)


def test_quality_of_held_out_documents(held_out):
    held, model = held_out
    shares = Counter((_kind(r), r["p_best"] >= quality.KEEP_FROM) for r in quality.rate(held, model).collect())
    kept = {k: shares[k, True] / (shares[k, True] + shares[k, False]) for k in ("bad", "toxic", "clean")}
    assert kept["clean"] > 0.98 and kept["bad"] < 0.03 and kept["toxic"] < 0.1, kept


def test_clean_documents_with_new_words_stay(spark, held_out):
    held, model = held_out
    rng = random.Random(4)
    clean = [r["text"] or "" for r in held.where("quality = 1 AND toxic = 0").limit(200).collect()]
    new = lambda: "".join(rng.choices("abcdefghijklmnopqrstuvwxyzéü", k=rng.randrange(2, 11)))
    rows = [(n, f"{t} {' '.join(new() for _ in range(n))}") for t in clean for n in (0, 100, 1000, 5000)]
    rated = quality.rate(spark.createDataFrame(rows, "n int, text string"), model)
    kept = {r["n"]: r["kept"] / 200 for r in rated.groupBy("n").agg(F.count_if(F.col("p_best") >= quality.KEEP_FROM).alias("kept")).collect()}
    assert min(kept[n] for n in (100, 1000, 5000)) >= kept[0] - 0.02, kept


def test_one_mark_does_not_decide(held_out):
    _, model = held_out
    scores = np.array([-8.0, 0.0, 8.0, 20.0]) + model.thresholds[-1]
    none, one, many = (model.tails(scores, np.full(4, m))[:, -1] for m in (0, 1, 9))
    assert (none > one).all() and (one > many).all() and one[-1] > 0.9


def test_rates_equal_a_plain_computation(spark, sf_dir):
    docs, labels = (spark.read.parquet(f"{sf_dir}/{n}.parquet") for n in ("documents", "labels"))
    model = quality.learn(docs, labels)
    found = quality.rate(docs.select("doc_id", "text"), model).collect()
    assert len(found) == docs.count()
    for row in found:
        text = row["text"] or ""
        tokens = re.findall(r"\w+|[^\w\s]+", text)
        words = [t.lower() for t in tokens]
        parts = {p for w in words for p in (w, "4" + w[:4], "5" + w[:5])}
        score = sum(float(model.weights[c]) for c in {xxhash.xxh32_intdigest(p) % quality.BUCKETS for p in parts})
        columns, values, _ = quality.Features()(row["text"])
        others = columns >= quality.BUCKETS
        score += float(model.weights[columns[others]] @ values[others])
        keys = {xxhash.xxh64_intdigest(p) - 2**63 for w in set(words) if w[0].isalnum() for p in ([w] if len(w) < 6 else [w, "5" + w[:5]])}
        raised = sum(s for s, n in zip(model.steps, quality.MARK_STEPS) if len(keys & model.marks) >= n)
        tails = [1 / (1 + math.exp(t - score)) for t in (model.thresholds[0], model.thresholds[1] + raised)]
        assert math.isclose(row["p_best"], tails[1], rel_tol=1e-3, abs_tol=1e-6)
        assert math.isclose(row["expected_grade"], sum(tails), rel_tol=1e-3, abs_tol=1e-6)


def test_telling_columns_and_marks_equal_plain_counts(spark, sf_dir):
    docs, labels = (spark.read.parquet(f"{sf_dir}/{n}.parquet") for n in ("documents", "labels"))
    made = quality._features(quality.sample(docs, labels)).collect()
    totals = Counter(r["grade"] for r in made)
    there = {k: Counter(c for r in made if r["grade"] == k for c in r["columns"]) for k in range(3)}
    telling = set()
    for column in set().union(*there.values()):
        n = sum(there[k][column] for k in there)
        shares = [min(0.99, max(0.01, totals[k] / len(made))) for k in range(3)]
        off = any(abs(there[k][column] / n - s) >= quality.LEAST_Z * math.sqrt(s * (1 - s) / n) for k, s in enumerate(shares))
        if column >= quality.BUCKETS or (n >= quality.LEAST_DOCS and off):
            telling.add(column)
    frame = quality._features(quality.sample(docs, labels))
    assert set(quality._telling(frame, totals).tolist()) == telling
    for j, marks in enumerate(quality._marks(frame)):
        kept = [r for r in made if r["fold"] != j]
        below, best = (Counter(k for r in kept if r["grade"] == g for k in r["keys"]) for g in (1, 2))
        least = quality.MARK_DOCS if j == quality.FOLDS else quality.MARK_DOCS * 3 // 4
        assert marks == {k for k, n in below.items() if n >= least and n >= quality.MARK_SHARE * (n + best[k])}


def test_quality_of_odd_inputs(spark):
    labels = spark.createDataFrame([(1, 1, 0), (1, 0, 0), (None, 1, 1), (2, None, 1)], "doc_id long, quality int, toxic int")
    docs = _docs(spark, [None, "good text", "", "good text", "w " * 200_000], p_best=None)
    model = quality.learn(docs, labels)
    found = quality.rate(docs, model)
    rows = found.orderBy("doc_id").collect()
    assert found.columns == ["doc_id", "text", "ids", "expected_grade", "p_best"] and len(rows) == 5
    assert rows[1]["p_best"] == rows[3]["p_best"] and rows[0]["p_best"] == rows[2]["p_best"]
    empty = quality.rate(docs.limit(0), quality.learn(docs.limit(0), labels.limit(0)))
    assert empty.count() == 0


@pytest.mark.parametrize("name", ["op1_bpe", "op3_token_counts"])
def test_queries_cover_every_document(spark, sf_dir, name):
    found = QUERIES[name](spark, sf_dir)
    assert found.count() == spark.read.parquet(f"{sf_dir}/documents.parquet").count()

import random
import sys
import zlib
from pathlib import Path

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

sys.path.insert(0, str(Path(__file__).resolve().parent))
import brute  # noqa: E402

from ledgerloom.llm import katz, quality, toxicity  # noqa: E402


def two():
    return F.crc32(F.col("doc_id").cast("string").cast("binary")) % 7 == 2


def held(i):
    return zlib.crc32(str(i).encode()) % 7 == 2


@pytest.mark.parametrize("slice_", [300, 8_000_000])
def test_katz_matches_brute_force(spark, monkeypatch, slice_):
    monkeypatch.setattr(katz, "SLICE", slice_)
    r = random.Random(1)
    texts = ["the of " * 40, "", None, "the"] + [" ".join(r.choice("the of a b c d e f g".split() + [f"w{r.randrange(300)}"]) for _ in range(r.randrange(1, 60))) for _ in range(80)]
    rows = [(i, t) for i, t in enumerate(texts)] + [(3, "the")]
    want = sorted(brute.katz([(i, t, held(i)) for i, t in rows], katz.K, katz.discounts, katz.KEPT))
    got = sorted(tuple(x) for x in katz.score(spark.createDataFrame(rows, "doc_id long, text string").repartition(3), two()).collect())
    assert [g[:5] for g in got] == [w[:5] for w in want]
    assert np.allclose([g[5:] for g in got], [w[5:] for w in want], atol=1e-6)


def test_unseen_followers_of_a_frequent_word_stay_in_many_partitions(spark, monkeypatch):
    written = {}

    def stage(df, label, *apart):
        written["counted"] = df.persist()
        return written["counted"]

    monkeypatch.setattr(katz, "stage", stage)
    the = "the"
    rows = [(i, " ".join(f"{the} w{i * 20 + k}" for k in range(40))) for i in range(60)]
    want = sorted(brute.katz([(i, t, held(i)) for i, t in rows], katz.K, katz.discounts, katz.KEPT))
    got = sorted(tuple(x) for x in katz.score(spark.createDataFrame(rows, "doc_id long, text string"), two()).collect())
    assert np.allclose([g[5:] for g in got], [w[5:] for w in want], atol=1e-6)
    h = katz.tokens(pa.array([the]))[0][0]
    asks = np.zeros(1000, int)
    for x in written["counted"].where("kind = 2").collect():
        asks[x.to] += (katz.unpack(bytes(x.packed))[0] == h).sum()
    assert (asks > 0).sum() > 20 and asks.max() < asks.sum() / 5
    written["counted"].unpersist()


def test_katz_without_training_rows_null_ids_and_empty(spark):
    docs = spark.createDataFrame([(None, "a b"), (4, None)], "doc_id long, text string")
    for x in katz.score(docs, F.lit(True)).collect():
        assert (x.n_known, x.train_tokens, x.base_score, x.score) == (0, 0, 0.0, 0.0)
    assert {x.doc_id for x in katz.score(docs, two()).collect()} == {None, 4}
    assert katz.score(docs.limit(0), two()).collect() == []


def test_discounts():
    kept = katz.discounts([1000, 300, 150, 90, 60, 40])
    assert ((0 < kept) & (kept < np.arange(1, 6))).all()
    assert (katz.discounts([0] * 6) == np.arange(1, 6) - katz.KEPT).all()


def test_packed_arrays_come_back():
    x = [np.array([3, 3, 2**63 + 5], np.uint64), np.array([9, 1], np.uint16), np.zeros(0, np.int64), np.array([1.5, -2]), np.array([True, False])]
    for a, b in zip(x, katz.unpack(katz.pack(*x)), strict=True):
        assert a.dtype == b.dtype and (a == b).all()


def test_network_gradients():
    rng = np.random.default_rng(0)
    p = {k: v.astype(float) for k, v in toxicity.fresh(rng).items()}
    vectors, place = rng.standard_normal((9, toxicity.INPUTS)), rng.integers(0, 9, (5, 3))
    mask, y = np.arange(5)[:, None] < np.array([5, 2, 4]), np.array([1.0, 0, 1])

    def loss(v):
        x = v[place]
        q = toxicity._sigmoid(toxicity.forward(p, x @ p["left_w"] + p["left_b"], x @ p["right_w"] + p["right_b"], mask))
        return -(y * np.log(q) + (1 - y) * np.log(1 - q)).mean()

    g, d, _ = toxicity.gradients(p, vectors, place, mask, y)
    for x, grad in [(p[k], g[k]) for k in g] + [(vectors, d)]:
        i = tuple(rng.integers(0, s) for s in x.shape)
        was = x[i]
        x[i] = was + 0.01
        up = loss(vectors)
        x[i] = was - 0.01
        down = loss(vectors)
        x[i] = was
        assert abs(grad[i] - (up - down) / 0.02) < 1e-4


def toxic_texts(n, seed):
    r = random.Random(seed)
    rows = []
    for i in range(n):
        w = [f"{r.choice('abcdefgh')}{r.randrange(200)}" for _ in range(r.randrange(5, 120))]
        bad = i % 4 == 0
        if bad:
            w[r.randrange(len(w))] = r.choice(["vile", "nasty", "grublow", "grubnid"])
        rows.append((i, " ".join(w), int(bad)))
    return rows


def test_toxicity_on_held_out_rows(spark):
    rows = toxic_texts(900, 4)
    docs = spark.createDataFrame([(i, t, 1.0) for i, t, _ in rows] + [(9000, "", 0.0), (9001, None, 0.0), (None, "vile", 0.0)], "doc_id long, text string, score double")
    labels = spark.createDataFrame([(i, y) for i, _, y in rows] + [(None, 1), (9000, None)], "doc_id long, toxic int")
    fold = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 != 0
    found = {x.doc_id: x.score for x in toxicity.score(docs, labels, fold).collect()}
    out = [(y, found[i] >= 0.5) for i, _, y in rows if zlib.crc32(str(i).encode()) % 5 == 0]
    assert np.mean([y == p for y, p in out]) > 0.97
    assert found[9000] == found[9001] < 0.5 and len(found) == 903
    none = toxicity.score(docs, labels.where("toxic = 0"), fold).select("score").distinct().collect()
    assert [x.score for x in none] == [0.0]
    assert toxicity.score(docs.limit(0), labels, fold).collect() == []


def test_the_sample_is_bounded_in_rows_and_bytes(spark):
    repeated = [(1, f"text {k}") for k in range(300)]
    docs = spark.createDataFrame([*repeated, (2, "x" * 500), (3, None), (4, "vile"), (5, "nasty"), (6, "plain words")], "doc_id long, text string")
    known = spark.createDataFrame([(i, int(i in (4, 5))) for i in range(1, 8)], "doc_id long, __label int")
    rows = lambda *limits: sorted(tuple(x.values()) for x in toxicity._sample(docs, known, "doc_id", "text", *limits).to_pylist())
    assert rows(10, 100, 1000) == [("nasty", 1), ("plain words", 0), ("text 0", 0), ("vile", 1)]
    assert [t for t, _ in rows(10, 1000, 10_000)].count("x" * 500) == 1
    assert sum(len(t) for t, y in rows(10, 100, 8) if y) <= 8 and len(rows(10, 100, 8)) < 4
    assert len(rows(1, 100, 1000)) <= 2


def test_windows_overlap_and_cover():
    start, n, text = toxicity.windows(np.array([0, 0, 3, 103]))
    assert text[0] == 1 and set(text) == {1, 2}
    covered = {i for s, k in zip(start, n) for i in range(s, s + k)}
    assert covered == set(range(103)) and (n <= toxicity.WINDOW).all()


def quality_rows():
    r = random.Random(5)
    rows = []
    for i in range(600):
        words = [r.choice("the of plain words in a sentence with others".split()) + r.choice("abcdefg") for _ in range(r.randrange(8, 60))]
        good = i % 5 > 0
        if not good:
            words = [w + "###" for w in words] if i % 2 else [w.upper() + "!!" for w in words]
        rows.append((i, " ".join(words), f"s{i % 7}", "en", int(good)))
    return rows


def test_quality_and_shrinkage(spark):
    rows = quality_rows()
    docs = spark.createDataFrame([x[:4] for x in rows] + [(None, None, None, None), (7000, "", "new", None), (1, rows[1][1], "s1", "en")], "doc_id long, text string, source string, lang string")
    labels = spark.createDataFrame([(x[0], x[4]) for x in rows if x[0] % 2], "doc_id long, quality int")
    found = quality.score(docs, labels).collect()
    assert len(found) == 603 and found[0].asDict().keys() == {"doc_id", "text", "source", "lang", "quality_score"}
    got = {x.doc_id: x.quality_score for x in found}
    assert np.mean([(got[x[0]] >= 0.5) == x[4] for x in rows if x[0] % 2 == 0]) > 0.98
    assert all(x.quality_score == 1.0 for x in quality.score(docs, labels.where("quality = 1")).collect())
    assert quality.score(docs.limit(0), labels).collect() == []
    site = lambda s, path, n, p: [(s, path, float(np.log(p / (1 - p))))] * n
    scored = spark.createDataFrame(site("big", "a", 200, 0.9) + site("bad", "a", 200, 0.1) + site("tiny", "a", 1, 0.1), "source string, lang string, l double")
    shift, mean = quality.posteriors(scored, "source", "lang", "l")
    by = {x["__site"]: x["__shift"] for x in shift.collect()}
    assert by["bad"] < by["tiny"] < 0 < by["big"] and 0.4 < mean < 0.6


def test_a_repeated_labelled_id_is_learned_once(spark):
    rows = quality_rows()
    docs = spark.createDataFrame([x[:2] for x in rows], "doc_id long, text string")
    again = docs.unionByName(spark.createDataFrame([(1, rows[1][1])] * 500, docs.schema))
    labels = spark.createDataFrame([(x[0], x[4]) for x in rows], "doc_id long, quality int")
    a, b = (quality.train(d, labels, "doc_id", "text", "quality") for d in (docs, again))
    assert all(np.allclose(x, y) for x, y in zip(a, b, strict=True))


def test_features_of_odd_texts():
    x = quality.features(pa.array([None, "", " ", "word", "|" * 9, "é" * 4000]))
    assert x.shape[0] == 6 and np.isfinite(x).all() and (x[0] == x[1]).all()

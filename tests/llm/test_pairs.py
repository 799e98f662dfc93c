import random
import sys
from pathlib import Path

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

sys.path.insert(0, str(Path(__file__).resolve().parent))
import brute  # noqa: E402

from ledgerloom.llm import graph, partenum, text  # noqa: E402


def near_copies(seed, groups=14, each=5, size=90):
    r = random.Random(seed)
    out = []
    for _ in range(groups):
        base = [f"w{r.randrange(4000)}" for _ in range(r.randrange(1, size))]
        for _ in range(each):
            w = list(base)
            for _ in range(r.randrange(4)):
                w[r.randrange(len(w))] = f"x{r.randrange(9999)}"
            out.append(" ".join(w[: len(w) - (r.random() < 0.3)]))
    return out


def test_words_and_shingles():
    texts = ["One two  THREE\x0bfour x five six", "", None, " \t", "a b", "É É"]
    w = text.words(pa.array(texts))
    assert np.diff(w.first).tolist() == [len(brute.lower_words(t)) for t in texts]
    h, first = text.shingles(w.hashes, w.first)
    assert np.diff(first).tolist() == [len(brute.shingles(t)) for t in texts]
    before, text.CHUNK = text.CHUNK, 5
    try:
        assert (text.words(pa.array(texts)).hashes == w.hashes).all()
    finally:
        text.CHUNK = before


def test_linked_sets_share_a_signature_and_as_many_as_asked():
    texts = near_copies(1, 40)
    h, first = partenum.shingle_sets(pa.array(texts))
    sig, of = partenum.signatures(h, first)
    sets, few, n = [set(brute.shingles(t)) for t in texts], partenum.sparse(h, first), np.diff(first)
    mine = [set(sig[of == i].tolist()) for i in range(len(texts))]
    links = 0
    for i, s in enumerate(sets):
        for j in range(i):
            if s and 5 * len(s & sets[j]) >= 4 * len(s | sets[j]):
                links += 1
                need = 1 if few[i] and few[j] else int(partenum.agreements(n[i : i + 1], n[j : j + 1])[0])
                assert len(mine[i] & mine[j]) >= need
                assert need >= 1 and (few[i] or len(mine[i] & mine[j]) >= partenum.least_agreements(n[i : i + 1])[0])
    assert links > 50


@pytest.mark.parametrize("small", [64, 1])
def test_join_matches_brute_force(spark, monkeypatch, small):
    monkeypatch.setattr(partenum, "SMALL", small)
    monkeypatch.setattr(partenum, "BLOCK", 8)
    texts = near_copies(2)
    texts += texts[:9] + ["", None, "  ", "one two", "ONE  two", "long " * 3000, "long " * 3000]
    rows = list(enumerate(texts))
    found = partenum.join(spark.createDataFrame(rows, "doc_id long, text string").repartition(3)).collect()
    assert {r.doc_id: r.component_id for r in found} == brute.classes(rows)
    assert {r.doc_id: r.n_shingles for r in found} == {i: len(brute.shingles(t)) for i, t in rows}


def test_repeated_and_null_ids_and_extra_columns(spark):
    rows = [(5, "a b c d e f", 1), (5, "g h i j k l", 2), (2, "a b c d e f", 3), (9, "g h i j k l", 4), (None, "a b c d e f", 5), (7, "alone in the world of words", 6)]
    docs = spark.createDataFrame(rows, "doc_id int, text string, sig int").withColumnRenamed("sig", "id")
    found = sorted((r.doc_id or -1, r.component_id) for r in partenum.join(docs).collect())
    assert found == [(-1, None), (2, 2), (5, 2), (5, 2), (7, 7), (9, 2)]
    kept = partenum.keep_one(docs).collect()
    assert sorted(r.id for r in kept) == [3, 5, 6]
    assert partenum.join(docs.limit(0)).collect() == [] and partenum.keep_one(docs.limit(0)).collect() == []


@pytest.mark.parametrize("small", [64, 1])
def test_an_id_with_texts_of_unequal_sizes_is_compared_by_each(spark, monkeypatch, small):
    monkeypatch.setattr(partenum, "SMALL", small)
    monkeypatch.setattr(partenum, "PART", 10)
    r = random.Random(4)
    text = lambda n: " ".join(f"w{r.randrange(9000)}" for _ in range(n))
    rows = []
    for i in range(12):
        long, short = text(104), text(14)
        rows += [(10 * i + 5, short), (10 * i + 5, long), (10 * i + 9, long + " end"), (10 * i + 7, short + " x"), (10 * i + 3, long.replace("w1", "v1", 1))]
    found = partenum.join(spark.createDataFrame(rows, "doc_id long, text string").repartition(4)).collect()
    want = brute.classes(rows)
    assert {x.doc_id: x.component_id for x in found} == want and len(set(want.values())) < len(want)


def test_components(spark):
    r = random.Random(3)
    edges = [(r.randrange(80), r.randrange(80)) for _ in range(60)] + [(i + 100, i + 101) for i in range(30)] + [(1, 1), (None, 4)]
    parent = {}

    def root(x):
        parent.setdefault(x, x)
        return x if parent[x] == x else root(parent[x])

    for a, b in edges:
        if a is not None and a != b:
            x, y = root(a), root(b)
            parent[max(x, y)] = min(x, y)
    found = {x.id: x.root for x in graph.components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert found == {x: root(x) for x in list(parent)}


def test_filter_passes_every_id(spark):
    ids = spark.range(0, 3000, 3)
    test = graph.filter_of(ids, "id")
    passed = {r.id for r in spark.range(3000).where(test(F.col("id"))).collect()}
    assert passed >= set(range(0, 3000, 3)) and len(passed) < 1100

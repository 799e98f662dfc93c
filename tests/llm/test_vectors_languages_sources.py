"""Codebooks, language profiles and the divergence audit against plain versions."""

import random
import sys
from collections import Counter, defaultdict
from pathlib import Path

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

sys.path[:0] = [str(Path(__file__).resolve().parent), str(Path(__file__).resolve().parent.parent)]
import brute  # noqa: E402
import oracle  # noqa: E402

from ledgerloom.llm import codebooks, divergence, hyper, queries, topk  # noqa: E402

SMALL = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", ["op6_impact_topk", "op11_ball_codebooks", "op13_level_products"])
def test_queries_match_their_sql(spark, monkeypatch, name):
    monkeypatch.setattr(oracle, "TABLES", ["documents", "embeddings"])
    found = oracle.difference(queries.QUERIES[name](spark, SMALL), oracle.connect(SMALL), queries.ORACLES[name])
    assert found is None, found


def whole_codes(rows, parts, entries, rounds, scale=1024):
    """[(id, codes, error)] and codebooks by full searches in whole numbers."""
    rows = [(i, [int(np.floor(scale * x)) for x in v]) for i, v in rows if v is not None and all(x is not None and np.isfinite(x) for x in v)]
    length = max(1, -(-max((len(v) for _, v in rows), default=0) // parts))
    rows = [(i, v + [0] * (parts * length - len(v))) for i, v in rows]
    cut = lambda v: [v[p * length : (p + 1) * length] for p in range(parts)]
    books = [list(b) for b in zip(*[cut(v) for _, v in sorted(rows, key=lambda r: (r[0] is None, r[0] or 0, r[1]))[:entries]])]
    far = lambda a, b: sum((x - y) ** 2 for x, y in zip(a, b))
    near = lambda p, x: min((far(x, e), n) for n, e in enumerate(books[p]))
    for _ in range(rounds):
        members = defaultdict(list)
        for _, v in rows:
            for p, x in enumerate(cut(v)):
                members[p, near(p, x)[1]].append(x)
        for (p, e), m in members.items():
            books[p][e] = [sum(c) // len(m) for c in zip(*m)]
    found = [[near(p, x) for p, x in enumerate(cut(v))] for _, v in rows]
    return [(i, bytes(n for _, n in f), sum(d for d, _ in f)) for (i, _), f in zip(rows, found)], books


@pytest.mark.parametrize(("step", "size", "entries", "dims", "scale"), [(1, 3, 9, 8, 1024), (512, 400, 40, 8, 1024), (1, 2, 256, 6, 1024), (7, 3000, 30, 8, 1 << 14)])
def test_codes_match_full_search(spark, step, size, entries, dims, scale):
    """Small grids make ties and equal entries; the last case is too large for 64-bit floats."""
    r = random.Random(size)
    rows = [(r.randrange(400), [r.randrange(-size, size) * step / 1024 for _ in range(dims)]) for _ in range(300)]
    rows += [rows[0], rows[1], (None, [0.5] * dims), (500, None), (501, [float("nan")] * dims), (502, [None] * dims), (503, [float("-inf")] * dims), (504, [0.25] * 3), (505, [])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>").repartition(3)
    got, books = codebooks.encode(df, parts=4, entries=entries, rounds=3, scale=scale)
    want, want_books = whole_codes(rows, 4, entries, 3, scale)
    assert sorted((str(x.vec_id), bytes(x.code), x.error) for x in got.collect()) == sorted((str(i), c, e) for i, c, e in want)
    assert [b.tolist() for b in books] == want_books


def test_balls_compare_less_and_find_the_same():
    rng = np.random.default_rng(3)
    centres = rng.integers(-5000, 5000, (40, 6))
    x = centres[rng.integers(0, 40, 4000)] + rng.integers(-200, 200, (4000, 6))
    balls = codebooks.Balls(centres)
    codes, _ = balls.assign(x, None)
    shifted = centres + np.where(np.arange(40)[:, None] < 20, rng.integers(-50, 50, (40, 6)), 0)
    moved = codebooks.Balls(shifted, (shifted != centres).any(1))
    found, far = moved.assign(x, codes)
    d = ((x[:, None] - shifted) ** 2).sum(2)
    assert (found == d.argmin(1)).all() and (far == d.min(1)).all()


def test_codes_of_nothing_and_of_large_components(spark):
    empty = spark.createDataFrame([(1, None)], "vec_id long, embedding array<float>")
    for df in (empty, empty.limit(0)):
        got, books = codebooks.encode(df)
        assert got.collect() == [] and got.columns == ["vec_id", "code", "error"] and books.shape[1] == 0
    with pytest.raises(ValueError, match="exactly"):
        codebooks.encode(spark.createDataFrame([(1, [1e9])], "vec_id long, embedding array<double>"))
    clash = spark.createDataFrame([(1, [1.0, 2.0], "a", "b")], "vec_id long, embedding array<double>, code string, `row` string")
    got, _ = codebooks.encode(clash, parts=2)
    assert [(x.vec_id, x["row"], bytes(x.code), x.error) for x in got.collect()] == [(1, "b", b"\0\0", 0)]


def test_bundles_are_sums_of_bound_letters(monkeypatch):
    texts = ["Ab c", None, "", "7 -", "ÉÉé x", "日本語の文 text", "a"] + ["the the of"] * 20
    want = []
    for t in texts:
        s = " " + " ".join("".join(c.lower() if c.isalpha() else " " for c in t or "").split()) + " "
        total = np.zeros(64, int)
        for i in range(len(s) - 2) if s.strip() else []:
            v = [np.roll(hyper._signs(np.array([ord(c)]), 64)[0], 2 - k) for k, c in enumerate(s[i : i + 3])]
            total += v[0] * v[1] * v[2]
        want.append(total)
    for piece, together, counted in ((1 << 22, 2048, 1 << 22), (5, 3, 1)):
        monkeypatch.setattr(hyper, "_PIECE", piece)
        monkeypatch.setattr(hyper, "_TOGETHER", together)
        monkeypatch.setattr(hyper, "_COUNTED", counted)
        assert (hyper.bundles(texts, 64) == np.array(want)).all()


def test_languages_of_held_out_texts(spark):
    r = random.Random(5)
    parts = {"aa": "th er ing on and", "bb": "sch ein ung die lich", "cc": "qué ión los ado par"}
    text = lambda lang: " ".join("".join(r.choices(parts[lang].split(), k=r.randrange(1, 4))) for _ in range(r.randrange(3, 60)))
    rows = [(i, text(lang), lang) for i, lang in enumerate(r.choices(list(parts), k=300))]
    rows += [(300, None, "aa"), (301, "", "bb"), (302, "12 !", "zz"), (303, "ein die", None), (None, "losado", "cc"), (300, "theron", "aa")]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string").withColumn("score", F.lit("x")).withColumn("row", F.lit(1))
    got = hyper.identify(df.repartition(4), F.coalesce(F.col("doc_id") % 3 != 0, F.lit(False)))
    assert got.columns == ["doc_id", "text", "lang", "row", "lang_pred", "score"]
    found = got.collect()
    assert len(found) == len(rows)
    held = [x for x in found if x.doc_id is not None and x.doc_id < 300 and x.doc_id % 3 == 0]
    assert len(held) == 100 and all(x.lang_pred == x.lang and 0.3 < x.score <= 1 for x in held)
    rest = {(x.doc_id, x.text): (x.lang_pred, x.score > 0) for x in found if x.doc_id is None or x.doc_id >= 300}
    assert rest == {(300, None): ("und", False), (301, ""): ("und", False), (302, "12 !"): ("und", False), (303, "ein die"): ("bb", True), (None, "losado"): ("cc", True), (300, "theron"): ("aa", True)}
    nothing = hyper.identify(df, F.lit(False), keep=["doc_id"]).collect()
    assert {(x.lang_pred, x.score) for x in nothing} == {("und", 0.0)}
    assert hyper.identify(df.limit(0), F.lit(True)).collect() == []


def test_query_knows_the_languages_of_held_out_documents(spark):
    given = spark.read.parquet(f"{SMALL}/documents.parquet").select("doc_id", "lang")
    found = queries.QUERIES["op12_hyperdimensional_language"](spark, SMALL).join(given, "doc_id").where("held_out").collect()
    assert len(found) > 20 and sum(x.lang_pred == x.lang for x in found) >= 0.95 * len(found)
    assert all(0 <= x.score <= 1 for x in found)


def test_too_many_languages_are_refused(spark, monkeypatch):
    monkeypatch.setattr(hyper, "LANGUAGES", 3)
    df = spark.range(8).select(F.lit("some text").alias("text"), F.col("id").cast("string").alias("lang"))
    with pytest.raises(ValueError, match="languages"):
        hyper.identify(df, F.lit(True))


def plain_audit(rows, least, top):
    groups, words, docs, whole = defaultdict(Counter), defaultdict(Counter), defaultdict(Counter), []
    for text, lang, source in rows:
        found = brute.letters(text)
        groups[lang or "", source or ""].update(found)
        words[lang or ""].update(found)
        docs[lang or ""].update(set(found))
    for (lang, source), own in groups.items():
        kept = [t for t in words[lang] if docs[lang][t] >= least]
        v = len(kept)
        rate = lambda c: lambda t, n=sum(c[t] for t in kept): 1 + 10**9 * (c[t] + 5) // (n + 5 * v)  # noqa: E731, B023
        p, q = rate(own), rate(words[lang])
        pairs = [(o, sum(abs(p(t) - rate(c)(t)) for t in kept)) for (x, o), c in groups.items() if x == lang and o != source]
        over = [(t, p(t) - q(t)) for t in kept if own[t] and p(t) > q(t)]
        for part, found, most in (("pair", pairs, None), ("term", over, top)):
            found = sorted(found, key=lambda x: (-x[1], x[0].encode()))[:most]
            whole += [(lang, source, part, item, value, n) for n, (item, value) in enumerate(found, 1)]
    return sorted(whole)


@pytest.mark.parametrize("sizes", [(4096, 64, 4096, 1024), (16, 2, 8, 4)])
def test_audit_matches_brute_force(spark, monkeypatch, sizes):
    for name, size in zip(("TERMS", "GROUPS", "PIECE", "COLUMNS"), sizes):
        monkeypatch.setattr(divergence, name, size)
    r = random.Random(2)
    vocabulary = [f"w{'abcdefghij'[i % 10]}{'klmnopq'[i // 10]}" for i in range(70)] + ["Über", "straße", "日本", "X"]
    text = lambda: " ".join(r.choices(vocabulary, weights=range(1, 75), k=r.randrange(0, 30)))
    rows = [(text(), r.choice(["en", "de", "en", None]), f"s{r.randrange(7)}") for _ in range(160)]
    rows += [rows[0], rows[0], (None, "en", "silent"), ("1 2 3", "en", None), ("rare words", "xx", "a"), ("rare", "xx", "b"), ("", None, None), ("wak9wbk_wak", "en", "s1")]
    df = spark.createDataFrame(rows, "text string, lang string, source string").withColumn("n", F.lit(1)).withColumn("term", F.lit("t")).repartition(3)
    got = divergence.audit(df, least=4, top=5)
    assert got.columns == ["lang", "source", "part", "item", "value", "rank"]
    assert sorted(map(tuple, got.collect())) == plain_audit(rows, 4, 5)


def test_audit_of_nothing(spark):
    df = spark.createDataFrame([("a", "en", "s")], "text string, lang string, source string")
    assert divergence.audit(df.limit(0)).collect() == []
    assert divergence.audit(df).collect() == []


def test_rates_do_not_overflow(spark):
    for n, total, kept in ((0, 0, 1), (10**12, 3 * 10**14, 10**8), (7, 9, 3)):
        want = 1 + 10**9 * (n + 5) // (total + 5 * kept)
        assert int(divergence._rates(np.array([n]), np.array([total]), kept)[0]) == want
        assert spark.range(1).select(divergence.rate(F.lit(n).cast("long"), F.lit(total).cast("long"), F.lit(kept).cast("long"))).first()[0] == want


def test_terms_end_with_their_text():
    distinct, document, term = divergence.terms(pa.array(["ab", "cd", None, "Ab9éx", ""]))
    assert [(int(d), distinct[int(t)].as_py()) for d, t in zip(document, term)] == [(0, "ab"), (1, "cd"), (3, "ab"), (3, "éx")]


def test_levels_before_the_first_proof_are_one_product():
    """Segments taken together, one by one and the plain scores agree; the many postings of a filled block are not taken segment by segment."""
    rng = np.random.default_rng(2)
    rows = rng.integers(-60, 60, (700, 24))
    ids, queries = np.arange(700), rows[:100]
    together, single = topk.Segments(ids, rows), topk.Segments(ids, rows)
    assert together.dense is not None and together.head > 16
    single.dense = None
    scores = queries @ rows.T
    for i, (found, alone) in enumerate(zip(together.best(queries, ids[:100], 9), single.best(queries, ids[:100], 9))):
        best = [j for j in np.lexsort((ids, -scores[i])) if j != i][:9]
        assert found[0].tolist() == alone[0].tolist() == best and found[1].tolist() == alone[1].tolist() == scores[i][best].tolist()
    sparse = topk.Segments(ids, rows * (rng.random(rows.shape) < 0.03))
    assert sparse.dense is None

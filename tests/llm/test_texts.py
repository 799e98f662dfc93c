import base64
import hashlib
import random
import sys
import time
from pathlib import Path

import numpy as np
import pyarrow as pa
import pytest
import tiktoken
from pyspark.sql import functions as F

sys.path.insert(0, str(Path(__file__).resolve().parent))
import brute  # noqa: E402

from ledgerloom.llm import bpe, decontaminate, html, licenses, secrets, topk  # noqa: E402
from ledgerloom.llm.queries import multi_vocabulary  # noqa: E402


def encoding():
    path, pattern = multi_vocabulary()
    with open(path, "rb") as lines:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
    return tiktoken.Encoding("plain", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})


@pytest.mark.parametrize("chunk,overlap", [(64, 20), (50, 17), (200, 30), (32_768, 1_024)])
def test_bpe_matches_the_library_and_decodes(spark, chunk, overlap):
    r = random.Random(chunk)
    odd = "".join(r.choice(["a", "b ", "  ", "\n", "1", "'re", "don't", "é", "漢", "!", "x" * 70]) for _ in range(300))
    texts = ["   " * 40 + "don't we're it's" * 30 + "x" * 300 + " a b  c\n\n d" * 20, "é'ré 'll" * 60, "a" * 500, None, "", odd, odd, "'r" * 100, " " * 700 + "x"]
    docs = spark.createDataFrame([(i, t, i) for i, t in enumerate(texts)] + [(None, "twice", 0)] * 2, "doc_id long, text string, key int").withColumn("ids", F.lit(0))
    encoded = bpe.encode(docs, *multi_vocabulary(), chunk=chunk, overlap=overlap)
    found = bpe.decode(encoded, *multi_vocabulary()).collect()
    assert len(found) == len(texts) + 2
    for x in found:
        text = "twice" if x.doc_id is None else texts[x.doc_id] or ""
        assert np.frombuffer(x.ids, "<u4").tolist() == encoding().encode_ordinary(text)
        assert bytes(x.decoded).decode() == text
    assert bpe.encode(docs.limit(0), *multi_vocabulary()).collect() == []


def test_secret_spans():
    novelty = secrets.Novelty()
    of = lambda t: secrets.all_spans(t, novelty)
    assert of('x PassWord: "abcdefgh1" y') == [("assign", 2, 22)]
    assert of("password: secret: abcdefgh12") == []  # the failing match has consumed the second word
    assert of("tokén KKey = x ſecret=abcdefgh") == []  # letters of ASCII only
    assert of("é AKIA1234567890AB AKIA123") == [("access", 2, 18)]
    h = "0123456789abcdef" * 2
    assert of(f"token={h} {h[:31]}") == [("assign", 0, 38), ("hex", 6, 38)]
    assert of('client_secret for the app: "Zk3v9Qp2LmX8tR7wYc1B"') == [("novel", 28, 48)]
    for plain in ("password reset RequestHandlerFactoryBean here", "authorization bearer abcdefghijklmnop1234567890", "the secret configuration_environment2", "", "no words of that kind Zk3v9Qp2LmX8tR7wYc1B"):
        assert of(plain) == []


def test_secrets_after_an_equals_sign_and_written_twice():
    novelty, s = secrets.Novelty(), "Zk3v9Qp2LmX8tR7wYc1B"
    found = lambda t: [(k, t[a:b]) for k, a, b in secrets.all_spans(t, novelty)]
    for name in ("AWS_SECRET_ACCESS_KEY", "export DB_PWD", "access_key", "passphrase", "https://x.org/?a=b&access_key"):
        for value in (s, s + "=", s + "=="):
            assert found(f"{name}={value}\nREGION=north") == [("novel", value)], (name, value)
    assert found("access_key=wJalrXUtnFEMI/K7MDENG/bPxRfiCYzQ8hT2kLpW") == [("novel", "wJalrXUtnFEMI/K7MDENG/bPxRfiCYzQ8hT2kLpW")]
    assert found(f"DB_PWD={s}\nDB_PWD={s}\n") == [("novel", s)] * 2
    assert found(f"pwd {s} {'word ' * 47}pwd {s} {'word ' * 47}pwd {s}") == [("novel", s)] * 3  # copies cut by the edge of the surroundings
    for plain in ("signing_key=request_handler_factory_bean", "if access_key==configuration_environment2:", "access_key=client_id=production", "pwd==============================Ab1"):
        assert found(plain) == [], plain


def test_novel_spans_match_brute_force():
    r, novelty = random.Random(8), secrets.Novelty()
    key = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_-"
    parts = ["token ", "secret", "api key ", "bearer: ", "pwd=", "access_key=", "=", "==", " ", " word ", '"', "password = ", "request_handler_factory", "é", "\n"]
    seen = 0
    for _ in range(400):
        made = ["".join(r.choice(key) for _ in range(r.randrange(9, 30))) for _ in range(3)] + [f"{r.randrange(16**32):032x}"]
        text = "".join(r.choice(parts + made * 2) for _ in range(r.randrange(3, 40)))
        base = secrets.base_spans(text)
        want = brute.novel_spans(text, base, novelty, secrets.SENSITIVE, secrets.REACH, secrets.NOVEL, secrets.LETTERS)
        assert secrets.novel_spans(text, base, novelty) == want, text
        seen += len(want)
    assert seen > 200


def test_secrets_of_texts_full_of_sensitive_words():
    novelty, s = secrets.Novelty(), "Zk3v9Qp2LmX8tR7wYc1B"
    begun = time.monotonic()
    assert secrets.all_spans("token " * 200_000, novelty) == []
    assert time.monotonic() - begun < 5  # 7,000 s when each word searches the rest of the text
    assert len(secrets.all_spans("token=abcdefgh12 " * 50_000 + f"pwd {s}", novelty)) == 50_001


def test_secret_scan_and_redaction(spark):
    rows = [(1, 'a token = "abcdefgh12345" z', 5), (1, 'a token = "abcdefgh12345" z', 5), (2, None, 6), (3, "", 7), (None, "word " * 60_000 + "AKIA1234567890AB", 8)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, secrets int")
    found = secrets.scan(docs).withColumn("spans", secrets.joined("secrets")).collect()
    assert sorted((x.doc_id or 0, x.spans) for x in found) == [(0, "access:300000:300016"), (1, "assign:2:24"), (1, "assign:2:24"), (2, ""), (3, "")]
    texts = [x.text for x in secrets.redact(docs).orderBy("secrets").collect()]
    assert texts[:4] == ['a [secret]" z', 'a [secret]" z', None, ""] and texts[4].endswith("word [secret]")
    assert secrets.scan(docs.limit(0)).collect() == []


def test_licences(spark):
    apache = licenses.TEMPLATES["Apache-2.0"]
    filler = " ".join(f"filler{i}" for i in range(300))
    rows = [
        (1, f"{filler}\n{apache[0].upper()} {filler}"), (2, f"{filler} {apache[1]}"), (3, "Licensed under\nCC BY-NC 4.0."), (4, "licensed by nobody " * 9), (5, ""), (6, None),
        (7, licenses.TEMPLATES["GPL-3.0"][0] + filler), (7, licenses.TEMPLATES["GPL-3.0"][0] + filler), (8, apache[1].replace("compliance", "accord")), (9, " ".join(apache[1].split()[:12])),
    ]
    found = licenses.scan(spark.createDataFrame(rows, "doc_id long, text string"))
    got = {(x.doc_id, x.license, x.template) for x in found.collect()}
    assert got == {(1, "Apache-2.0", 0), (2, "Apache-2.0", 0), (2, "Apache-2.0", 1), (3, "CC-BY-NC-4.0", 0), (7, "GPL-3.0", 0), (8, "Apache-2.0", 0)} | (got & {(8, "Apache-2.0", 1), (9, "Apache-2.0", 0)})
    assert found.where("license = 'GPL-3.0'").count() == 1
    assert not [n for n in str(found._jdf.queryExecution().executedPlan()).split() if "Python" in n or "Arrow" in n]
    assert licenses.scan(spark.createDataFrame(rows, "doc_id long, text string").limit(0)).collect() == []


def test_licence_windows_find_each_template_anywhere(spark):
    rows, n = [], 0
    for name, templates in licenses.TEMPLATES.items():
        for k, t in enumerate(templates):
            for before in (0, 3, 17, 40):
                rows.append((n, " ".join(["pad"] * before) + " " + t + " tail" * 30, name, k))
                n += 1
    found = {(x.doc_id, x.license, x.template) for x in licenses.scan(spark.createDataFrame(rows, "doc_id long, text string, name string, k int")).collect()}
    assert {(i, name, k) for i, _, name, k in rows} <= found


def test_both_notices_of_a_family_null_ids_and_clashing_names(spark):
    gpl3, gpl2 = licenses.TEMPLATES["GPL-3.0"][1], licenses.TEMPLATES["GPL-2.0"][1]
    worn = gpl2.replace("published", "issued", 1)  # misses five shingles, none of which tells of the version
    far = " ".join(f"filler{i}" for i in range(3_000))
    texts = {1: f"{gpl3} {far} {worn}", 2: f"{worn} {gpl3}", 3: f"{far} {gpl3}", 4: gpl2.replace("version 2", "version two") + far + gpl3, 5: worn}
    rows = [(i, t, "a", 1, 2.0, "x", 3, 4) for i, t in texts.items()] + [(None, gpl3, "b", 1, 2.0, "y", 3, 4), (None, gpl2, "c", 1, 2.0, "z", 3, 4), (None, None, None, 1, 2.0, "z", 3, 4)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, key string, `row` int, containment double, license string, words int, template int")
    found = licenses.scan(docs).where("license like 'GPL%' and template = 1").collect()
    got = sorted((x.doc_id or 0, x.license) for x in found)
    both = lambda i: [(i, "GPL-2.0"), (i, "GPL-3.0")]
    assert got == [(0, "GPL-2.0"), (0, "GPL-3.0"), *both(1), *both(2), (3, "GPL-3.0"), *both(4), (5, "GPL-2.0")]
    assert len(licenses.scan(docs.withColumnRenamed("doc_id", "row 1").drop("row"), key="row 1").columns) == 5


def test_notices_match_brute_force(spark):
    r = random.Random(6)
    every = [t for ts in licenses.TEMPLATES.values() for t in ts]
    texts = [""]
    for _ in range(120):
        w = []
        for _ in range(r.randrange(1, 4)):
            notice = r.choice(every).split()
            for _ in range(r.randrange(0, 3)):
                notice[r.randrange(len(notice))] = "other"
            w += [f"pad{r.randrange(50)}" for _ in range(r.randrange(60))] + notice
        texts.append(" ".join(w))
    found = {(x.doc_id, x.license, x.template): x.containment for x in licenses.scan(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")).collect()}
    full = {(i, *k): x for i, t in enumerate(texts) for k, x in brute.notices(t, licenses.TEMPLATES, licenses.CONTAINMENT).items()}
    assert found.keys() <= full.keys() and all(found[k] <= full[k] + 1e-9 for k in found)
    family = {r.number: r.family for r in licenses.template_table(spark, licenses.TEMPLATES).collect()}
    number = {k: i for i, k in enumerate((name, j) for name, ts in licenses.TEMPLATES.items() for j in range(len(ts)))}
    for i, name, k in full.keys() - found.keys():  # only for another of the family of a larger share in the same text
        kin = [x for (j, a, b), x in found.items() if j == i and family[number[a, b]] == family[number[name, k]]]
        assert max(kin) > full[i, name, k], (i, name, k)
    assert len(found) > 60


def test_leaks_match_brute_force(spark, monkeypatch):
    r = random.Random(2)
    items = [(k, " ".join(f"q{r.randrange(60)}" for _ in range(r.choice([2, 4, 6, 15, 30, 30, 45])))) for k in range(14)] + [(50, None), (51, ""), (3, "q1 q2 q3")]
    rows = []
    for i in range(60):
        w = [f"q{r.randrange(60)}" for _ in range(r.randrange(0, 80))]
        if i % 2 and items[i % 14][1]:
            leak = items[i % 14][1].upper().split()
            if i % 3 == 0:
                leak[r.randrange(len(leak))] = "other"
            at = r.randrange(len(w) + 1)
            w[at:at] = leak
        rows.append((i, " ".join(w)))
    rows += [(90, None), (91, ""), (92, items[4][1])]
    docs, bench = spark.createDataFrame(rows, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string")
    want = brute.leaks(rows, items[:14] + [(3000, items[16][1])])
    want = {(a, 3 if b == 3000 else b): x for (a, b), x in sorted(want.items(), key=lambda y: y[1])}
    found = decontaminate.contaminated(docs, bench).collect()
    got = {}
    for x in found:
        got[x.doc_id, x.item_id] = max(x.similarity, got.get((x.doc_id, x.item_id), 0))
    assert got.keys() == want.keys() and all(abs(got[k] - want[k]) < 1e-9 for k in got)
    clean = {x.doc_id for x in decontaminate.drop_contaminated(docs, bench).collect()}
    assert clean == {i for i, _ in rows} - {i for i, _ in got}
    assert decontaminate.contaminated(docs, bench.limit(0)).collect() == [] == decontaminate.contaminated(docs.limit(0), bench).collect()


def test_multi_index_misses_no_fingerprint_in_the_radius():
    rng = np.random.default_rng(1)
    items = decontaminate.Items(list(range(30)), [" ".join(f"w{x}" for x in rng.integers(0, 500, 12)) for _ in range(30)])
    prints = items.prints[rng.integers(0, 30, 300)].copy()
    for k in range(300):
        for b in rng.choice(64, rng.integers(0, decontaminate.RADIUS + 4), replace=False):
            prints[k] ^= np.uint64(1) << np.uint64(b)
    window, item = items.near(prints)
    near = {(a, b) for a in range(300) for b in range(30) if int(prints[a] ^ items.prints[b]).bit_count() <= decontaminate.RADIUS}
    assert set(zip(window.tolist(), item.tolist())) == near


def test_large_benchmarks_take_several_passes(spark):
    items = [(k, f"alpha{k} beta{k} gamma{k} delta{k} epsilon{k} zeta{k}") for k in range(20)]
    docs = spark.createDataFrame([(i, f"x {t} y") for i, t in items], "doc_id long, text string")
    found = decontaminate.contaminated(docs, spark.createDataFrame(items, "item_id long, text string"), most=200).collect()
    assert sorted((x.doc_id, x.item_id) for x in found) == [(i, i) for i, _ in items]


def test_passes_keep_the_weights_of_the_whole_benchmark(spark):
    r = random.Random(5)
    common = [[f"c{k}_{i}" for i in range(12)] for k in range(3)]  # passages that many items hold
    items = [(k, " ".join(common[k % 3] + [f"i{k}_{i}" for i in range(r.randrange(6, 20))])) for k in range(24)]
    rows = []
    for i in range(160):
        w = items[i % 24][1].split()
        a = r.randrange(len(w))
        w[a : a + r.randrange(1, 4)] = r.choice(common)[2:9] if i % 2 else ["other"]
        rows.append((i, " ".join(w)))
    want = brute.leaks(rows, items)
    docs, bench = spark.createDataFrame(rows, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string")
    got = {(x.doc_id, x.item_id): x.similarity for x in decontaminate.contaminated(docs, bench, most=1_500).collect()}
    assert got.keys() == want.keys() and all(abs(got[k] - want[k]) < 1e-9 for k in got) and len(got) > 10
    assert {x.doc_id for x in decontaminate.drop_contaminated(docs, bench, most=1_500).collect()} == set(range(160)) - {i for i, _ in want}
    parts = list(decontaminate._passes(bench, "item_id", "text", 10**6, items=5))
    assert sorted(len(p.ids) for p in parts) == [4, 5, 5, 5, 5] and all(p.unknown == parts[0].unknown for p in parts)


def test_recall_of_altered_passages(spark):
    r = random.Random(11)
    word = lambda: f"v{r.randrange(3000)}"
    items = [(k, [word() for _ in range(r.randrange(8, 160))]) for k in range(40)]
    rows = []
    for i in range(120):
        w = list(items[i % 40][1])
        for _ in range(r.randrange(0, 1 + len(w) // 40)):
            w[r.randrange(len(w))] = word()
        rows.append((i, " ".join([word() for _ in range(r.randrange(30))] + w + [word() for _ in range(r.randrange(30))])))
    items = [(k, " ".join(w)) for k, w in items]
    want = brute.leaks(rows, items)
    docs, bench = spark.createDataFrame(rows, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string")
    got = {(x.doc_id, x.item_id) for x in decontaminate.contaminated(docs, bench).collect()}
    assert got <= want.keys() and len(got) >= 0.99 * len(want) and any(x < 0.9 for x in want.values())


def test_topk_matches_brute_force(spark):
    rng = np.random.default_rng(3)
    v = rng.integers(-3, 4, (300, 6))
    v[50:90] = v[50]
    rows = [(int(i), [float(x) / 64 for x in y]) for i, y in enumerate(v)]
    odd = [(1000, None), (1020, [1.0, None]), (1040, [float("nan")]), (1060, [float("inf")]), (None, [1.0]), (0, rows[0][1]), (1080, [1.0])]
    vectors = spark.createDataFrame(rows + odd, "vec_id long, embedding array<float>").select("vec_id", topk.whole_numbers("embedding").alias("vector"))
    found = topk.search(vectors, F.col("vec_id") % 20 == 0, 20, block=64, chunk=4)
    got = {}
    for x in found.collect():
        got.setdefault(x.query_id, []).append((x["rank"], x.vec_id, x.score))
    full = [*((i, y) for i, y in enumerate(v)), (0, v[0]), (1080, np.array([64, 0, 0, 0, 0, 0]))]
    for q, y in {i: y for i, y in full if i % 20 == 0}.items():
        best = sorted((-int(y @ z), i) for i, z in full if i != q)[:20]
        assert sorted(got.pop(q)) == [(k + 1, i, -s) for k, (s, i) in enumerate(best)]
    assert got == {} and topk.search(vectors.limit(0), F.lit(True), 3).collect() == []


@pytest.mark.parametrize("n,dims,spread,most", [(3_000, 64, "normal", 0.85), (3_000, 64, "heavy", 0.5), (200, 5, "sparse", 1.0), (10, 3, "zero", 1.0)])
def test_segments_of_small_impact_are_skipped(n, dims, spread, most):
    rng = np.random.default_rng(n + dims)
    rows = np.floor(rng.normal(0, 50, (n, dims))) if spread == "normal" else np.floor(rng.standard_t(1.5, (n, dims)) * 9).clip(-9_000, 9_000) if spread == "heavy" else rng.integers(0, 2, (n, dims)) * 7
    rows = rows.astype(np.int64) * (spread != "zero")
    ids = rng.permutation(n) * 3
    index = topk.Segments(ids, rows)
    asked = rows[:40]
    for i, (found, scores) in enumerate(index.best(asked, ids[:40], 20)):
        best = sorted((-int(rows[j] @ asked[i]), int(ids[j])) for j in range(n) if j != i)[:20]
        assert list(zip((-scores).tolist(), found.tolist())) == best
    assert index.touched <= most * 40 * len(index.place)


def test_vectors_out_of_range_are_an_error(spark):
    assert topk._matrix(pa.array([[2**20 - 1, -(2**20) + 1], []], pa.list_(pa.int64()))).shape == (2, 2)
    for bad in ([2**20], [1, -(2**40)], [0] * 8_193):
        with pytest.raises(ValueError, match="components"):
            topk._matrix(pa.array([bad], pa.list_(pa.int64())))


PAGE = """<!DOCTYPE html><html><head><title>T</title><style>p{}</style></head><body class="nav-open"><nav><ul><li><a href=x>Home</a></li></ul></nav>
<div class="ad">Buy now</div><article><h1>Head&shy;line</h1><p><b>First  par&eacute; one<br>two</b><p>Short.<aside>Side note that is quite long</aside><p>Last <a href=y>link</a>
<script>if (a<b) { "</p>" }</script> words</p></article><section id="comments"><p>Nice post</p></section><footer>&copy; me</footer></body></html>"""


def test_main_text():
    assert html.main_text(PAGE) == "Head­line\nFirst paré one two\nShort.\nLast link words"
    plain = PAGE.replace("<article>", "<div>").replace("</article>", "</div>")
    assert html.main_text(plain) == html.main_text(PAGE)
    for page, text in (
        ("", ""), ("just  text", "just text"), ("<p>a<p>b", "a\nb"), ("<div class=ad>never closed <p>real", "never closed\nreal"), ("a < b and c", "a < b and c"),
        ("<nav><a>x</a></nav>", ""), ("<!-- <p>no</p> --><p>yes", "yes"), ("<script>never closed <p>no", ""), ("<p title='a>b'>c</p", "c"), ("<" * 5000, "<" * 5000),
    ):
        assert html.main_text(page) == text, page


@pytest.mark.parametrize("marked", [True, False])
def test_wrappers_are_no_boilerplate(marked):
    page = PAGE if marked else PAGE.replace("<article>", "<div>").replace("</article>", "</div>")
    body, want = page.index("<nav>"), html.main_text(PAGE)
    for wrapper in ("div class='content has-sidebar'", "div class=no-sidebar", "div id=with-comments", "div class=layout-widget", "form", 'div title="hidden things"', "div data-x=hidden", "div data-class=ad"):
        assert html.main_text(f"{page[:body]}<{wrapper}>{page[body:]}</{wrapper.split()[0]}>") == want, wrapper
    for gone in ("div class='x ad-slot'", "div class=site-footer", "div hidden", 'div title=a HIDDEN', "div aria-hidden=true", "div role=navigation"):
        assert html.main_text(page.replace("<p>Last", f"<{gone}>Advert of a few words</div><p>Last")) == want, gone


P1, P2 = "A first paragraph that is long enough to be the text of the page, with a comma and more words in it.", "A second one of the same kind, which goes on for a while so that its length alone tells what it is."


@pytest.mark.parametrize("page,text", [
    (f"<article><h1>T</h1><p>{P1}</p><section><article class=comment><p>{P2}</p></article></section></article>", f"T\n{P1}"),
    (f"<article><p>{P1}</p></article><section><article class='comment-body odd'><p>{P2}</p></article></section>", P1),
    (f"<article><p>{P1}</p></article><section id=comments><article><p>{P2}</p></article><article><p>{P2}</p></article></section>", P1),
    (f"<div><h1>T</h1><p>{P1}</p></div><section id=comments><article><p>{P2}</p></article><article><p>{P2}</p></article><article><p>{P2 * 9}</p></article></section>", f"T\n{P1}"),
    (f"<div class=comments><article><h1>T</h1><p>{P1}</p></article></div>", f"T\n{P1}"),
    (f"<article><p>{P1}</p><div class=social-history><p>{P2}</p></div></article>", f"{P1}\n{P2}"),
    (f"<article><div class=story-share-text><p>{P1}</p></div></article>", P1),
    (f"<article><div class=share><p>{P1}</p><p>{P2}</p></div></article>", f"{P1}\n{P2}"),
    (f"<article><p>{P1}</p><div class='share-buttons'>Tell all</div><div class=ad-300x250>Buy</div><p>{P2}</p></article>", f"{P1}\n{P2}"),
    ("<article><p>Let <math><mi>x</mi><annotation encoding=t>\\x</annotation></math> be one.</p></article>", "Let x be one."),
    (f"<article><header><nav><h2>Go</h2></nav><h1>T</h1><p>By one</p></header><p>{P1}</p></article>", f"T\n{P1}"),
    (f"<header><h1>Site</h1></header><article><p>{P1}</p></article>", P1),
    # surge and dive inside the article: a list of links without a hint goes, a few linked lines stay
    (f"<article><h1><a>T</a></h1><p>{P1}</p><ul><li><a>One</a><li><a>Two</a><li><a>Three</a></ul><p>Short</p></article>", f"T\n{P1}\nShort"),
    (f"<article><ul><li><a>One</a><li><a>Two</a><li><a>Three</a><li><a>Four</a></ul><p>{P1}</p><p><a>Source</a></p></article>", f"{P1}\nSource"),
    ("<article><p><a>All</a><p><a>is</a><p><a>linked</a></article>", "All\nis\nlinked"),
    # no marks at all
    (f"<div>Home</div><div>About us</div><div><h1>T</h1><p>{P1}</p><p>{P2}</p></div><div>Copyright 2024</div>", f"T\n{P1}\n{P2}"),
    (f"<p>{P1}</p><p>{P2}</p><p>© 2024 Someone.</p>", f"{P1}\n{P2}"),
    (f"<div><p>{P1}</p><div class=ad>a</div><div class=ad>b</div><div class=ad>c</div><p>Short end.</p></div>", f"{P1}\nShort end."),
])
def test_text_of_pages(page, text):
    assert html.main_text(page) == text


def test_extract(spark):
    rows = [(1, "u", PAGE, "old"), (1, "u", PAGE, "old"), (None, None, None, None), (2, "v", "<p>" + "word " * 50_000, "x")]
    found = html.extract(spark.createDataFrame(rows, "page_id long, url string, html string, text string"))
    assert found.columns == ["page_id", "url", "text"]
    got = sorted((x.page_id or 0, hashlib.md5(x.text.encode()).hexdigest(), len(x.text)) for x in found.collect())
    assert [g[2] for g in got] == [0, 51, 51, 249_999]

"""The queries of this subpackage and, where SQL can give the same rows, their SQL."""

from __future__ import annotations

import hashlib
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerloom.llm import bpe, codebooks, decontaminate, divergence, html, hyper, katz, licenses, partenum, quality, secrets, topk, toxicity
from ledgerloom.session import table
from ledgerloom.sinks import stage

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(function: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    QUERIES[function.__name__] = function
    return function


def remainder(value: str, by: int) -> Column:
    """The checksum of an id's text, to divide documents into folds."""
    return F.crc32(F.col(value).cast("string").cast("binary")) % by


@query
def op1_partenum_join(spark: SparkSession, folder: str) -> DataFrame:
    found = partenum.join(table(spark, folder, "documents").select("doc_id", "text"))
    return found.select("doc_id", "n_shingles", "set_id", "component_id")


@query
def op2_katz_backoff(spark: SparkSession, folder: str) -> DataFrame:
    documents = table(spark, folder, "documents").select("doc_id", "text")
    return katz.score(documents, remainder("doc_id", 7) == 2)


@query
def op3_toxicity_network(spark: SparkSession, folder: str) -> DataFrame:
    documents = table(spark, folder, "documents").select("doc_id", "text")
    found = toxicity.score(documents, table(spark, folder, "labels"), remainder("doc_id", 5) != 0)
    return found.select(
        "doc_id",
        (remainder("doc_id", 5) == 0).alias("held_out"),
        "score",
        F.when(F.col("score") >= 0.5, 1).otherwise(0).alias("predicted"),
    )


@query
def op4_secret_novelty(spark: SparkSession, folder: str) -> DataFrame:
    found = secrets.scan(table(spark, folder, "documents").select("doc_id", "text"))
    count = lambda kind: F.size(F.filter("secrets", lambda s: s.kind == kind)).cast("long")
    base = F.filter("secrets", lambda s: s.kind != "novel")
    return found.select(
        "doc_id",
        count("assign").alias("n_assign"),
        count("access").alias("n_access"),
        count("hex").alias("n_hex"),
        F.sha2(secrets.joined(base), 256).alias("base_sha256"),
        secrets.joined("secrets").alias("spans"),
    )


def multi_vocabulary() -> tuple[str, str]:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN


@query
def op9_byte_bpe(spark: SparkSession, folder: str) -> DataFrame:
    vocabulary = multi_vocabulary()
    encoded = bpe.encode(table(spark, folder, "documents").select("doc_id", "text"), *vocabulary)
    return bpe.decode(encoded, *vocabulary).select(
        "doc_id",
        (F.octet_length("ids") / 4).cast("long").alias("n_tokens"),
        F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


@query
def op10_line_blocks(spark: SparkSession, folder: str) -> DataFrame:
    found = html.extract(table(spark, folder, "pages").select("page_id", "url", "html"))
    return found.select("page_id", "url", "text", F.char_length("text").cast("long").alias("n_chars"))


@query
def op5_license_minhash(spark: SparkSession, folder: str) -> DataFrame:
    return licenses.scan(table(spark, folder, "documents").select("doc_id", "text"))


@query
def op7_site_quality(spark: SparkSession, folder: str) -> DataFrame:
    documents = table(spark, folder, "documents").select("doc_id", "text", "source", "lang")
    found = quality.score(documents, table(spark, folder, "labels"), keep=["doc_id"])
    return found.select("doc_id", "quality_score", (F.col("quality_score") >= 0.5).alias("keep"))


@query
def op8_simhash_windows(spark: SparkSession, folder: str) -> DataFrame:
    return decontaminate.contaminated(table(spark, folder, "documents"), table(spark, folder, "benchmark"))


@query
def op6_impact_topk(spark: SparkSession, folder: str) -> DataFrame:
    vectors = table(spark, folder, "embeddings").select("vec_id", topk.whole_numbers("embedding").alias("vector"))
    return topk.search(vectors, F.col("vec_id") % 20 == 0, 20)


@query
def op11_ball_codebooks(spark: SparkSession, folder: str) -> DataFrame:
    coded, books = codebooks.encode(table(spark, folder, "embeddings").select("vec_id", "embedding", "label"))
    coded = stage(coded, "codes")
    sums = stage(coded.groupBy("label").agg(F.sum("error").alias("label_error")), "label-errors")
    digest = hashlib.sha256(",".join(map(str, books.ravel().tolist())).encode()).hexdigest()
    found = coded.alias("c").join(sums.alias("s"), F.col("c.label").eqNullSafe(F.col("s.label")))
    return found.select("vec_id", F.lower(F.hex("code")).alias("code"), "error", "label_error", F.lit(digest).alias("codebooks_sha256"))


@query
def op12_hyperdimensional_language(spark: SparkSession, folder: str) -> DataFrame:
    documents = table(spark, folder, "documents").select("doc_id", "text", "lang")
    found = hyper.identify(documents, remainder("doc_id", 4) != 2, keep=["doc_id"])
    return found.select("doc_id", (remainder("doc_id", 4) == 2).alias("held_out"), "lang_pred", "score")


@query
def op13_level_products(spark: SparkSession, folder: str) -> DataFrame:
    return divergence.audit(table(spark, folder, "documents").select("text", "lang", "source"))


ORACLES["op6_impact_topk"] = """
WITH v AS (
    SELECT vec_id, list_transform(embedding, lambda x: floor(64 * CAST(x AS DOUBLE))) AS e FROM embeddings
    WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
      AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
)
SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score FROM (
    SELECT q.vec_id AS query_id, c.vec_id, CAST(list_dot_product(q.e, c.e) AS BIGINT) AS score,
           row_number() OVER (PARTITION BY q.vec_id ORDER BY list_dot_product(q.e, c.e) DESC, c.vec_id) AS rank
    FROM v q JOIN v c ON q.vec_id <> c.vec_id WHERE q.vec_id % 20 = 0
) WHERE rank <= 20
"""


def _codebook_sql(parts: int = 4, entries: int = 256, rounds: int = 4) -> str:
    """Full searches, round after round."""
    ctes = [
        f"""v AS MATERIALIZED (
    SELECT row_number() OVER (ORDER BY vec_id, x) AS row, vec_id, label, x FROM (
        SELECT vec_id, label, list_transform(embedding, lambda c: floor(1024 * CAST(c AS DOUBLE))) AS x FROM embeddings
        WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda c: c IS NULL OR NOT isfinite(c))) = 0)
), p AS MATERIALIZED (
    SELECT row, part, y, list_dot_product(y, y) AS yy FROM (
        SELECT row, part, x[1 + part * len(x) // {parts} : (part + 1) * len(x) // {parts}] AS y FROM v, range({parts}) t(part))
), b0 AS MATERIALIZED (SELECT part, row - 1 AS entry, y AS c FROM p WHERE row <= {entries})"""
    ]
    for n in range(rounds + 1):
        ctes.append(
            f"""a{n} AS MATERIALIZED (
    SELECT p.row, p.part, arg_min(b.entry, (p.yy - 2 * list_dot_product(p.y, b.c) + list_dot_product(b.c, b.c), b.entry)) AS entry,
           min(p.yy - 2 * list_dot_product(p.y, b.c) + list_dot_product(b.c, b.c)) AS far
    FROM p JOIN b{n} b ON p.part = b.part GROUP BY p.row, p.part)"""
        )
        if n < rounds:
            ctes.append(
                f"""m{n} AS (
    SELECT part, entry, list(mean ORDER BY place) AS c FROM (
        SELECT part, entry, place, floor(sum(value) / count(*)) AS mean FROM (
            SELECT a.part, a.entry, unnest(p.y) AS value, generate_subscripts(p.y, 1) AS place FROM a{n} a JOIN p ON p.row = a.row AND p.part = a.part)
        GROUP BY part, entry, place)
    GROUP BY part, entry
), b{n + 1} AS MATERIALIZED (SELECT b.part, b.entry, coalesce(m.c, b.c) AS c FROM b{n} b LEFT JOIN m{n} m ON m.part = b.part AND m.entry = b.entry)"""
            )
    return f"""WITH {", ".join(ctes)}, coded AS (
    SELECT row, string_agg(printf('%02x', entry), '' ORDER BY part) AS code, CAST(sum(far) AS BIGINT) AS error FROM a{rounds} GROUP BY row
), digest AS (
    SELECT sha256(string_agg(CAST(CAST(value AS BIGINT) AS VARCHAR), ',' ORDER BY part, entry, place)) AS books FROM (
        SELECT part, entry, unnest(c) AS value, generate_subscripts(c, 1) AS place FROM b{rounds})
)
SELECT v.vec_id, coded.code, coded.error, CAST(sum(coded.error) OVER (PARTITION BY v.label) AS BIGINT) AS label_error, digest.books AS codebooks_sha256
FROM v JOIN coded ON coded.row = v.row, digest"""


ORACLES["op11_ball_codebooks"] = _codebook_sql()

ORACLES["op13_level_products"] = r"""
WITH d AS (
    SELECT row_number() OVER () AS doc, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
           regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x40\x5B-\x60\x7B-\x7F]+') AS words
    FROM documents
), w AS (SELECT doc, lang, source, unnest(words) AS term FROM d
), k AS (SELECT lang, term, count(*) AS n FROM w GROUP BY lang, term HAVING count(DISTINCT doc) >= 30
), l AS (SELECT lang, count(*) AS v, sum(n) AS total FROM k GROUP BY lang
), c AS (SELECT w.lang, w.source, w.term, count(*) AS n FROM w JOIN k ON k.lang = w.lang AND k.term = w.term GROUP BY ALL
), t AS (SELECT lang, source, sum(n) AS total FROM c GROUP BY lang, source
), g AS (
    SELECT x.lang, x.source, coalesce(t.total, 0) AS total, coalesce(l.v, 0) AS v
    FROM (SELECT DISTINCT lang, source FROM d) x LEFT JOIN t ON t.lang = x.lang AND t.source = x.source LEFT JOIN l ON l.lang = x.lang
), p AS (
    SELECT g.lang, g.source, k.term, coalesce(c.n, 0) AS n,
           CAST(1 + (1000000000 * (coalesce(c.n, 0) + 5)::HUGEINT) // (g.total + 5 * g.v)::HUGEINT AS BIGINT) AS p,
           CAST(1 + (1000000000 * (k.n + 5)::HUGEINT) // (l.total + 5 * l.v)::HUGEINT AS BIGINT) AS q
    FROM g JOIN k ON k.lang = g.lang JOIN l ON l.lang = g.lang
    LEFT JOIN c ON c.lang = g.lang AND c.source = g.source AND c.term = k.term
), f AS (
    SELECT a.lang, a.source, 'pair' AS part, b.source AS item, sum(abs(a.p - b.p)) AS value
    FROM p a JOIN p b ON b.lang = a.lang AND b.term = a.term AND b.source <> a.source GROUP BY a.lang, a.source, b.source
    UNION ALL
    SELECT a.lang, a.source, 'pair', b.source, 0 FROM g a JOIN g b ON b.lang = a.lang AND b.source <> a.source WHERE a.v = 0
    UNION ALL
    SELECT lang, source, 'term', term, p - q FROM p WHERE n > 0 AND p > q
), r AS (
    SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS rank FROM f
)
SELECT lang, source, part, item, CAST(value AS BIGINT) AS value, CAST(rank AS INTEGER) AS rank FROM r WHERE part = 'pair' OR rank <= 50
"""

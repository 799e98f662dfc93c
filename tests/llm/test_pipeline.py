import sys
from pathlib import Path

import duckdb
import pytest
from pyspark.sql import functions as F

sys.path.insert(0, str(Path(__file__).resolve().parents[2]))
sys.path.insert(0, str(Path(__file__).resolve().parent))
import brute  # noqa: E402
import corpus_pipeline  # noqa: E402
import oracle  # noqa: E402

from ledgerloom.llm import decontaminate, queries  # noqa: E402

FOLDER = "/root/testdata/sf0.001"


def test_stages_keep_their_columns_and_take_effect(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    benchmark = [tuple(r) for r in spark.read.parquet(f"{FOLDER}/benchmark.parquet").collect()]
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{FOLDER}/labels.parquet").collect()}
    seen = {}
    for name, step in corpus_pipeline.STAGES[:-1]:
        docs = spark.createDataFrame(step(spark, docs, FOLDER).collect(), docs.schema)
        seen[name] = {r.doc_id: r for r in docs.collect()}
    good = seen["quality"]
    assert sum(good.keys() >= {i} for i, q in labels.items() if q == 1) > 0.98 * sum(q == 1 for q in labels.values())
    assert not [i for i, q in labels.items() if q == 0 and i in good][5:]
    near = brute.classes([(i, r.text) for i, r in good.items()])
    assert set(seen["near_duplicates"]) == set(near.values())
    leaks = {i for i, _ in brute.leaks([(i, r.text) for i, r in seen["near_duplicates"].items()], benchmark)}
    assert set(seen["decontamination"]) == set(seen["near_duplicates"]) - leaks
    assert set(seen["secrets"]) == set(seen["decontamination"]) and all(len(r.text) == r.n_chars for r in seen["secrets"].values())
    last = corpus_pipeline.STAGES[-1][1](spark, docs, FOLDER)
    assert last.where(F.col("text_sha256") == F.col("decoded_sha256")).count() == last.count() == len(seen["secrets"])


def test_stages_on_odd_rows(spark):
    rows = [(None, None, None, None, None), (1, "", "en", "s", 0), (2, "a b c d e f", None, "s", 11), (2, "a b c d e f", None, "s", 11), (3, "x" * 100_000, "en", None, 100_000)]
    docs = spark.createDataFrame([(*r, 0) for r in rows], "doc_id long, text string, lang string, source string, n_chars long, ids int")
    for name, step in corpus_pipeline.STAGES:
        found = step(spark, docs, FOLDER)
        if name != "tokens":
            assert found.columns == docs.columns
        if name in ("decontamination", "secrets", "tokens"):
            assert found.count() == len(rows)
        if name == "near_duplicates":
            assert sorted(r.doc_id or 0 for r in found.collect()) == [0, 1, 2, 3]
        assert step(spark, docs.limit(0), FOLDER).collect() == []


def test_topk_query_matches_sql(spark):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW embeddings AS SELECT * FROM read_parquet('{FOLDER}/embeddings.parquet')")
    assert oracle.difference(queries.QUERIES["op6_impact_topk"](spark, FOLDER), con, queries.ORACLES["op6_impact_topk"]) is None


@pytest.mark.parametrize("name", sorted(queries.QUERIES))
def test_queries_return_their_columns(spark, name):
    want = {
        "op1": "doc_id n_shingles component_id", "op2": "doc_id held_out n_tokens n_known train_tokens base_score score", "op3": "doc_id held_out score predicted",
        "op4": "doc_id n_assign n_access n_hex base_sha256 spans", "op5": "doc_id license", "op6": "query_id rank vec_id score", "op7": "doc_id quality_score keep",
        "op8": "doc_id item_id", "op9": "doc_id n_tokens ids_sha256 decoded_sha256", "op10": "page_id url text n_chars",
        "op11": "vec_id code error label_error codebooks_sha256", "op12": "doc_id held_out lang_pred score", "op13": "lang source part item value rank",
    }[name.split("_")[0]]
    assert set(want.split()) <= set(queries.QUERIES[name](spark, FOLDER).columns)


def test_query_of_leaks_matches_brute_force(spark):
    read = lambda t, *c: [tuple(r) for r in spark.read.parquet(f"{FOLDER}/{t}.parquet").select(*c).collect()]
    want = brute.leaks(read("documents", "doc_id", "text"), read("benchmark", "item_id", "text"), decontaminate.SIMILARITY)
    assert {(r.doc_id, r.item_id) for r in queries.QUERIES["op8_simhash_windows"](spark, FOLDER).collect()} == set(want)

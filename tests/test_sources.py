"""Readers and sinks on tiny files."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from ledgerloom import sinks
from ledgerloom.session import scratch_path
from ledgerloom.sources import readers


def test_delimited(spark, tmp_path):
    (tmp_path / "a.txt").write_text('1|x|2020-01-01\n2|"q|\\N\nbad||2020-13-40\n')
    rows = readers.read_delimited(spark, str(tmp_path / "a.txt"), "n INT, t STRING, d DATE", "|").collect()
    assert [tuple(r) for r in rows] == [
        (1, "x", dt.date(2020, 1, 1)), (2, '"q', None), (None, None, None),
    ]


def test_escaped_separators(spark, tmp_path):
    (tmp_path / "a.txt").write_text("1|x\\|y|z\n2|back\\\\|\\N\nbad||it\\'s\n4\n")
    rows = readers.read_escaped(spark, str(tmp_path / "a.txt"), "n INT, t STRING, u STRING", "|").collect()
    assert [tuple(r) for r in rows] == [
        (1, "x|y", "z"), (2, "back\\", None), (None, None, "it's"), (4, None, None),
    ]


def test_quotes_split_unless_honoured(spark, tmp_path):
    (tmp_path / "a.csv").write_text('1,"a,b"\n')
    path = str(tmp_path / "a.csv")
    plain = readers.read_delimited(spark, path, "n INT, t STRING", ",").first()
    quoted = readers.read_delimited(spark, path, "n INT, t STRING", ",", quote='"').first()
    assert (plain.t, quoted.t) == ('"a', "a,b")


def test_header_of_every_file_is_skipped(spark, tmp_path):
    for name in "ab":
        (tmp_path / f"{name}_audit.csv").write_text(f"K,V\n{name},1\n")
    (tmp_path / "c_other.csv").write_text("K,V\nc,1\n")
    rows = readers.read_delimited(spark, str(tmp_path / "*_audit.csv"), "k STRING, v INT", ",", header=True)
    assert sorted(r.k for r in rows.collect()) == ["a", "b"]


@pytest.mark.parametrize("ending", ["", "\n", " \n"])
def test_batch_date(spark, tmp_path, ending):
    (tmp_path / "BatchDate.txt").write_text("2017-07-07" + ending)
    rows = readers.read_batch_date(spark, str(tmp_path / "BatchDate.txt")).collect()
    assert [r.batch_date for r in rows] == [dt.date(2017, 7, 7)]


def test_fixed_width_is_routed_and_files_are_picked_by_name(spark, tmp_path):
    layouts = {"AAA": {"id": (3, 6), "rest": (6, None)}, "BBB": {"x": (4, 5)}}
    (tmp_path / "LINES1").write_bytes(b"AAA001hello  \nBBB-z\nCCC\nAAA\xff02w\xc3\xa9 it's\nAAA\n")
    (tmp_path / "LINES1_audit").write_text("AAA999no\n")
    (tmp_path / "OTHER").write_text("AAA998no\n")
    got = readers.read_fixed_width(
        spark, str(tmp_path / "*"), layouts, (0, 3), name_has="LINES", name_lacks="audit"
    )
    assert sorted((tuple(r) for r in got["AAA"].collect()), key=str) == [
        (False, "001", "hello"), (False, None, None), (True, "�02", "wé it's"),
    ]
    assert [r.x for r in got["BBB"].collect()] == ["z"]


def test_xml_absent_empty_and_repeated(spark, tmp_path):
    (tmp_path / "a.xml").write_text(
        '<?xml version="1.0"?><Rows><Row id="1"><N><A>x</A><B/></N><P id="7"/><P id="8"/></Row>'
        '<Row id="2"/></Rows>'.replace('<Row id="2"/>', '<Row id="2"></Row>')
    )
    schema = "_id INT, N STRUCT<A: STRING, B: STRING, C: STRING>, P ARRAY<STRUCT<_id: INT>>"
    for read in (readers.read_xml_rows, readers.read_xml_records):
        one, two = sorted(read(spark, str(tmp_path / "a.xml"), "Row", schema).collect(), key=lambda r: r._id)
        assert (one.N.A, one.N.B, one.N.C) == ("x", "", None)
        assert [p._id for p in one.P] == [7, 8]
        assert two.N is None and two.P is None


def test_split_and_join(spark):
    df = spark.createDataFrame([("a.b..c",), ("",)], "value string")
    fields = readers.split_line("value", ".")
    rows = df.select(fields.alias("f"), readers.join_fields(fields, ".").alias("back"), "value").collect()
    assert [r.f for r in rows] == [["a", "b", "", "c"], [""]]
    assert all(r.back == r.value for r in rows)


@pytest.mark.parametrize("split", ["134217728", "60"])
def test_sort_text_file_is_stable(spark, tmp_path, split):
    rnd = random.Random(4)
    lines = [f"{i}|{rnd.choice(['10', '9', '100', 'a', ''])}|x" for i in range(200)]
    (tmp_path / "in.txt").write_text("\n".join(lines) + "\n")
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    try:
        spark.conf.set("spark.sql.files.maxPartitionBytes", split)
        readers.sort_text_file(spark, str(tmp_path / "in.txt"), str(tmp_path / "out"), "|", 1)
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    got = [line for part in sorted((tmp_path / "out").glob("part-*")) for line in part.read_text().splitlines()]
    assert got == sorted(lines, key=lambda line: line.split("|")[1])


def test_sinks(spark, tmp_path):
    layout = sinks.layout("n INT, t STRING")
    df = spark.createDataFrame([("1", "a", True), ("x", "b", True)], "n string, t string, extra boolean")
    path = str(tmp_path / "t")
    sinks.create(df, path, layout)
    with pytest.raises(Exception, match="PATH_ALREADY_EXISTS"):
        sinks.create(df, path, layout)
    sinks.append(df, path, layout)
    assert sorted(((r.n, r.t) for r in spark.read.parquet(path).collect()), key=str) == [
        (1, "a"), (1, "a"), (None, "b"), (None, "b"),
    ]
    sinks.overwrite(df.limit(1), path, layout)
    assert spark.read.parquet(path).count() == 1


class _Session:
    """As much of a session as ``scratch_path`` looks at."""

    def __init__(self, master, **settings):
        self.conf, self.sparkContext, self.master = settings, self, master


def test_scratch_space_follows_the_session():
    shared = scratch_path(_Session("yarn", **{"spark.checkpoint.dir": "hdfs:///shared/"}), "x")
    assert shared.startswith("hdfs:///shared/x-")
    assert scratch_path(_Session("local[2]"), "x").endswith("/x")
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        scratch_path(_Session("spark://host:7077"), "x")


def test_stage_reads_back_what_it_wrote(spark):
    staged = sinks.stage(spark.range(3).withColumn("t", F.lit("a")), "numbers")
    assert sorted(tuple(r) for r in staged.collect()) == [(0, "a"), (1, "a"), (2, "a")]
    assert all("numbers" in f for f in staged.inputFiles())


def test_each_value_is_typed_once(spark, capsys):
    lines = spark.createDataFrame([(r"1\|2|1.50",), ("3|n/a",)], "line STRING")
    rows = readers.typed_rows(lines, "line", "name STRING, price DECIMAL(8, 2)", "|")
    rows.explain()
    assert capsys.readouterr().out.count("as decimal(8,2))") == 1
    assert [(r["name"], str(r["price"]), [tuple(x) for x in r["rejected"]]) for r in rows.collect()] == [
        ("1|2", "1.50", []), ("3", "None", [("price", "n/a")]),
    ]


def test_each_fixed_width_field_is_cut_once(spark, capsys):
    lines = spark.createDataFrame([("A 12",), ("B xy",), ("C 34",)], "line STRING")
    layouts = {"A": {"n": (2, None)}, "B": {"m": (2, None)}}
    casts = {"A": {"n": lambda c: c.try_cast("bigint")}, "B": {"m": lambda c: c.try_cast("decimal(9, 3)")}}
    rows = readers.routed_fixed_width(lines, "line", layouts, (0, 1), casts)
    rows.explain()
    assert capsys.readouterr().out.count("substring(") <= 6  # two for the type and for each field: one asks whether it is blank
    assert [(r["record_kind"], r["n"], r["m"], r["unknown_line"], [tuple(x) for x in r["rejected"]]) for r in rows.collect()] == [
        ("A", "12", None, None, []), ("B", None, "xy", None, [("m", "xy")]), ("unknown", None, None, "C 34", []),
    ]


def test_a_separator_is_plain_text(spark):
    for sep in ("|", ",", "^", "x", "||"):
        lines = spark.createDataFrame([(f"a{sep}b\\{sep}c{sep}d",), (f"a{sep}{sep}d",)], "line STRING")
        rows = readers.typed_rows(lines, "line", "p STRING, q STRING, r STRING", sep)
        assert [tuple(r)[:3] for r in rows.collect()] == [("a", f"b{sep}c", "d"), ("a", None, "d")]


def test_fixed_width_fields_are_sliced_once_and_by_characters(spark):
    """A slice is taken once, before its blanks are looked at: as bytes for lines of single bytes, as characters for others."""
    layouts = {"A": {"kind": (0, 1), "name": (1, 6), "rest": (6, None)}}
    texts = ["Aab   xyz", "Aä€b  xyz", "A", "A      ", "Aäöüßé", "B€", ""]
    rows = readers.routed_fixed_width(spark.createDataFrame([(t,) for t in texts], "line STRING"), "line", layouts, (0, 1))
    got = rows.select("kind", "name", "rest", "unknown_line").collect()
    assert [tuple(r) for r in got] == [
        ("A", "ab", "xyz", None), ("A", "ä€b", "xyz", None), ("A", None, None, None), ("A", None, None, None), ("A", "äöüßé", None, None),
        (None, None, None, "B€"), (None, None, None, ""),
    ]
    lines = spark.range(1).select(F.uuid().alias("line"))
    plan = readers.routed_fixed_width(lines, "line", layouts, (0, 1))._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("substring(") == 2 * len(layouts["A"]) + 1 and plan.count("rtrim(substring(") == 1  # the type of the line

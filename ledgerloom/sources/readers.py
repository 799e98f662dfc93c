"""Readers for the raw batch files, and the same decoding on a text column."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerloom.sinks import stage

# {field: (start, end)}; 0-based, end exclusive, None for the rest of the line.
Layout = Mapping[str, tuple[int, "int | None"]]

_DELIMITED = {"nullValue": "\\N", "mode": "PERMISSIVE"}


def batch_path(root: str, scale: int | str, batch: int, name: str = "") -> str:
    """``<root>/<scale>/Batch<n>/<name>``."""
    return f"{root.rstrip('/')}/{scale}/Batch{batch}/{name}"


def _options(sep: str, quote: str | None) -> dict[str, str]:
    return {**_DELIMITED, "sep": sep, "quote": quote or ""}


def read_delimited(
    spark: SparkSession,
    path: str | Sequence[str],
    schema: T.StructType | str,
    sep: str,
    *,
    header: bool = False,
    quote: str | None = None,
) -> DataFrame:
    """Delimited text with a declared schema; ``\\N`` and an empty field are null.

    Quotes mean nothing unless ``quote`` is given. With ``header`` the first line of every file is
    skipped. ``path`` may be a glob. A field that does not fit its type is null.
    """
    return (
        spark.read.schema(schema)
        .options(**_options(sep, quote))
        .option("header", header)
        .option("enforceSchema", True)
        .csv(path)
    )


def delimited(df: DataFrame, column: str, schema: str, sep: str, quote: str | None = None) -> DataFrame:
    """The fields of a delimited text column, next to the other columns."""
    parsed = df.withColumn("__row", F.from_csv(column, schema, _options(sep, quote)))
    return parsed.select(*[c for c in df.columns if c != column], "__row.*")


#: What follows a backslash in a field, and what it stands for; any other character stands for itself.
ESCAPES = {"n": "\n", "t": "\t", "r": "\r", "b": "\b", "0": "\0", "Z": "\x1a"}
REJECTED = "rejected"
REJECTS = "ARRAY<STRUCT<column_name: STRING, written: STRING>>"


def escaped_fields(line: Column | str, sep: str) -> Column:
    """The fields of a line in which a backslash takes the meaning from a separator; ``\\N`` is null.

    Lines without a backslash are only split. In others, escaped backslashes and separators are first put aside as two code
    points that no text may hold (noncharacters), so that any number of backslashes is read in pairs. A backslash does not
    join a line with the next: lines are what the reader splits files by.
    """
    line = F.col(line) if isinstance(line, str) else line
    backslash, separator, pattern = "\ufdd0", "\ufdd1", _plain(sep)
    aside = F.replace(F.replace(line, F.lit("\\\\"), F.lit(backslash)), F.lit("\\" + sep), F.lit(separator))

    def meant(written: Column) -> Column:
        out = written
        for letter, character in ESCAPES.items():
            out = F.replace(out, F.lit("\\" + letter), F.lit(character))
        out = F.regexp_replace(out, r"(?s)\\(.)", "$1")
        out = F.replace(F.replace(out, F.lit(separator), F.lit(sep)), F.lit(backslash), F.lit("\\"))
        escaped = F.contains(written, F.lit("\\")) | F.contains(written, F.lit(separator)) | F.contains(written, F.lit(backslash))
        return F.when(~escaped, written).when(written != "\\N", out)

    return F.when(F.contains(line, F.lit("\\")), F.transform(F.split(aside, pattern), meant)).otherwise(F.split(line, pattern))


def _plain(sep: str) -> str:
    """The pattern of a separator; one sign behind a backslash is split at without a regular expression."""
    return "\\" + sep if len(sep) == 1 and sep.isascii() and not sep.isalnum() else f"\\Q{sep}\\E"


def rejected(values: Mapping[str, tuple[Column, Column]], *more: Column) -> Column:
    """(column_name, written) of each value that is written but does not fit: {name: (as written, as typed)}."""
    wrong = {name: written.isNotNull() & (written != "") & typed.isNull() for name, (written, typed) in values.items()}
    misfits = [F.when(wrong[name], _reject(name, written)) for name, (written, _) in values.items()]
    any_wrong = reduce(lambda a, b: a | b, [*wrong.values(), *[m.isNotNull() for m in more]], F.lit(False))
    # Rows in which all fits, nearly all of them, build no array.
    return F.when(any_wrong, F.array_compact(F.array(*misfits, *more)).cast(REJECTS)).otherwise(F.array().cast(REJECTS))


def _reject(name: str, written: Column) -> Column:
    return F.struct(F.lit(name).alias("column_name"), written.alias("written"))


def typed_rows(
    df: DataFrame, column: str, schema: T.StructType | str, sep: str, casts: Mapping[str, Callable[[Column], Column]] | None = None
) -> DataFrame:
    """The fields of a delimited text column by type, next to the other columns, and in ``rejected`` what does not fit.

    An empty field is null. A value that does not fit its type is null, and kept as written in ``rejected``; so is the number of
    fields, as ``(fields)``, where it is not that of the schema. ``casts`` replaces the plain cast of a column. Rows and rejects come
    from one pass: write them together, and read the ``rejected`` column alone for the report.
    """
    layout = T.StructType.fromDDL(schema) if isinstance(schema, str) else schema
    others, count = [c for c in df.columns if c != column], "__count"
    written = {f.name: f"__written_{i}" for i, f in enumerate(layout)}
    checked = [f.name for f in layout if f.name in (casts or {}) or not isinstance(f.dataType, T.StringType)]
    # Each step is a projection of its own, so a field is taken from its line, and typed, once.
    split = df.select(*others, escaped_fields(column, sep).alias("__fields"))
    fields = [F.get("__fields", F.lit(i)).alias(w) for i, w in enumerate(written.values())]
    split = split.select(*others, F.size("__fields").alias(count), *fields)
    split = split.select(*others, count, *[F.nullif(F.col(w), F.lit("")).alias(w) for w in written.values()])
    typed = [(casts or {}).get(f.name, lambda x, f=f: x.try_cast(f.dataType))(F.col(written[f.name])).alias(f.name) for f in layout]
    rows = split.select(*others, count, *[written[n] for n in checked], *typed)
    wrong_count = F.when(F.col(count) != len(layout), _reject("(fields)", F.col(count).cast("string")))
    rejects = rejected({n: (F.col(written[n]), F.col(n)) for n in checked}, wrong_count)
    return rows.select(*others, *layout.names, rejects.alias(REJECTED))


def read_rows(
    spark: SparkSession, path: str | Sequence[str], schema: T.StructType | str, sep: str, casts: Mapping[str, Callable[[Column], Column]] | None = None
) -> DataFrame:
    """``typed_rows`` of text files, which Spark splits between tasks; empty lines are no rows."""
    return typed_rows(spark.read.text(path).where("value <> ''"), "value", schema, sep, casts)


def read_escaped(
    spark: SparkSession, path: str | Sequence[str], schema: str, sep: str
) -> DataFrame:
    """``read_delimited`` for files in which a backslash takes the meaning from a separator."""
    return read_rows(spark, path, schema, sep).drop(REJECTED)


def valid_text(value: Column) -> Column:
    """Text with each invalid byte sequence replaced by one character, so positions hold."""
    return F.make_valid_utf8(value)


def flag_invalid(df: DataFrame, column: str = "value", name: str = "invalid_text") -> DataFrame:
    """Mark rows that hold invalid bytes and make their text sliceable."""
    return df.withColumn(name, ~F.is_valid_utf8(F.col(column))).withColumn(
        column, valid_text(F.col(column))
    )


def field_at(text: Column, start: int, end: int | None) -> Column:
    """The slice of a fixed-width line, without trailing blanks; empty is null."""
    return _unpadded(_slice(text, start, end))


def _slice(text: Column, start: int, end: int | None) -> Column:
    length = F.length(text) if end is None else F.lit(end - start)
    return F.substring(text, F.lit(start + 1), length)


def _unpadded(field: Column) -> Column:
    return F.nullif(F.rtrim(field), F.lit(""))


def fixed_width(df: DataFrame, column: str, layout: Layout) -> DataFrame:
    """The fields of a fixed-width text column, next to the other columns."""
    text = F.col(column)
    return df.select(
        *[c for c in df.columns if c != column],
        *[field_at(text, start, end).alias(name) for name, (start, end) in layout.items()],
    )


KIND = "record_kind"
UNKNOWN_KIND = "unknown"


def routed_fixed_width(
    df: DataFrame,
    column: str,
    layouts: Mapping[str, Layout],
    type_slice: tuple[int, int],
    casts: Mapping[str, Mapping[str, Callable[[Column], Column]]] | None = None,
) -> DataFrame:
    """All record types in one frame: the type in ``record_kind``, each field of any type, the other columns.

    A field that a type does not have is null. A type in no layout is ``unknown`` and keeps its line in ``unknown_line``. ``casts``,
    by type and field, says what a field must fit; what does not is listed in ``rejected``, while fields stay text.
    Written apart by ``record_kind``, the lines are read once for all types.
    """
    others, text, code = [c for c in df.columns if c != column], F.col(column), F.col("__code")
    known = code.isin(*layouts)
    names = list(dict.fromkeys(name for layout in layouts.values() for name in layout))

    def fields(layout: Layout, line: Column) -> Column:
        """The slices of all fields of any type, in one order; null where the type has none."""
        return F.array(*[_slice(line, *layout[n]).cast("string") if n in layout else F.lit(None).cast("string") for n in names])

    def cut(line: Column) -> Column:
        return F.coalesce(*[F.when(code == kind, fields(layout, line)) for kind, layout in layouts.items()])

    # Each step is a projection of its own: the type is read once, a field is cut from its line once and typed once. Where each
    # character of a line is one byte, it is cut as bytes: in text every slice counts the characters before it.
    coded = df.select(*others, column, field_at(text, *type_slice).alias("__code"))
    slices = F.when(F.octet_length(text) == F.char_length(text), cut(text.cast("binary"))).otherwise(cut(text))
    unknown = F.when(~F.coalesce(known, F.lit(False)), text)
    rows = coded.select(*others, "__code", unknown.alias("unknown_line"), slices.alias("__fields"))
    rows = rows.select(*others, "__code", *[F.get("__fields", F.lit(i)).alias(name) for i, name in enumerate(names)], "unknown_line")
    rows = rows.select(*others, "__code", *[_unpadded(F.col(name)).alias(name) for name in names], "unknown_line")
    typed = {(kind, name): f"__typed_{kind}_{name}" for kind, mine in (casts or {}).items() for name in mine}
    rows = rows.select("*", *[F.when(code == kind, casts[kind][name](F.col(name))).alias(t) for (kind, name), t in typed.items()])
    misfits = [
        F.when(code == kind, rejected({name: (F.col(name), F.col(typed[kind, name])) for name in mine})) for kind, mine in (casts or {}).items()
    ]
    return rows.select(
        *others, F.when(known, code).otherwise(UNKNOWN_KIND).alias(KIND), *names, "unknown_line",
        F.coalesce(*misfits, F.array().cast(REJECTS)).alias(REJECTED),
    )


def of_kind(routed: DataFrame, kind: str, layout: Layout, *more: str) -> DataFrame:
    """The rows of one record type, with its own fields."""
    return routed.where(F.col(KIND) == kind).select(*more, *layout)


def route_fixed_width(
    df: DataFrame, column: str, layouts: Mapping[str, Layout], type_slice: tuple[int, int]
) -> dict[str, DataFrame]:
    """One frame per record type, by the code at ``type_slice``. Each reads ``df``: stage ``routed_fixed_width`` to read it once."""
    others = [c for c in df.columns if c != column]
    routed = routed_fixed_width(df, column, layouts, type_slice)
    return {kind: of_kind(routed, kind, layout, *others) for kind, layout in layouts.items()}


def read_fixed_width(
    spark: SparkSession,
    path: str,
    layouts: Mapping[str, Layout],
    type_slice: tuple[int, int],
    *,
    name_has: str | None = None,
    name_lacks: str | None = None,
) -> dict[str, DataFrame]:
    """Fixed-width lines routed by record type, from one read of the lines; files may be picked by their name. Lines of no
    known type are under ``unknown``, as text."""
    lines = flag_invalid(read_lines(spark, path, name_has=name_has, name_lacks=name_lacks))
    routed = stage(routed_fixed_width(lines, "value", layouts, type_slice), "routed", KIND)
    found = {kind: of_kind(routed, kind, layout, "invalid_text") for kind, layout in layouts.items()}
    return found | {UNKNOWN_KIND: of_kind(routed, UNKNOWN_KIND, {}, "invalid_text", "unknown_line")}


def read_lines(
    spark: SparkSession, path: str, *, name_has: str | None = None, name_lacks: str | None = None
) -> DataFrame:
    """Lines of text files whose name contains ``name_has`` and not ``name_lacks``.

    A file may also be a folder of part files, so the name is the last two steps of the path.
    Spark prunes files by the predicate on ``_metadata`` before it opens any.
    """
    lines = spark.read.text(path)
    name = F.substring_index(F.col("_metadata.file_path"), "/", -2)
    if name_has:
        lines = lines.where(name.contains(name_has))
    if name_lacks:
        lines = lines.where(~name.contains(name_lacks))
    return lines.select("value")


def _place() -> Column:
    """Where a line stands: its file, its part of the file, its turn in that part."""
    return F.struct(
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("line"),
    )


def sort_text_file(
    spark: SparkSession, source: str, target: str, delimiter: str, field: int
) -> None:
    """Write the lines of ``source`` to the new path ``target`` in the order of one field as text.

    Lines with equal fields keep their order. The sort is by range over all tasks, and as the place of
    a line is part of the order, also the lines of one value spread.
    """
    lines = spark.read.text(source).select(
        "value", F.get(split_line("value", delimiter), F.lit(field)).alias("__field"), _place().alias("__place")
    )
    lines.orderBy("__field", "__place").select("value").write.text(target)


def read_batch_date(spark: SparkSession, path: str) -> DataFrame:
    """The one-line date file as a one-row frame; any other number of lines with text is an error."""
    lines = spark.read.text(path).where(F.trim("value") != "").agg(F.count(F.lit(1)).alias("n"), F.min("value").alias("value"))
    wrong = F.raise_error(F.concat(F.lit("a date file has one line, this one has "), F.col("n").cast("string")))
    day = F.to_date(F.trim("value"), "yyyy-MM-dd")
    return lines.select(F.when(F.col("n") == 1, day).otherwise(wrong.cast("date")).alias("batch_date"))


def read_xml_rows(
    spark: SparkSession, path: str, row_tag: str, schema: T.StructType | str
) -> DataFrame:
    """One row per ``row_tag`` element. Absent reads as null, an empty element as blank text."""
    return spark.read.format("xml").option("rowTag", row_tag).schema(schema).load(path)


def read_xml_records(
    spark: SparkSession, path: str, row_tag: str, schema: str, *, order: str | None = None
) -> DataFrame:
    """``read_xml_rows`` for large files: the file is split between tasks at the closing tags.

    Spark's XML reader gives a whole file to one task. Here the closing tag ends a line of the
    text source, which does split. Each ``row_tag`` element must have a closing tag and hold no
    other of its kind. With ``order`` a column is added that follows the order in the file.
    """
    closing = f"</{row_tag}>"
    lines = spark.read.option("lineSep", closing).text(path)
    opening = F.greatest(*[F.locate(f"<{row_tag}{end}", F.col("value")) for end in (" ", ">")])
    columns = [F.concat(F.substring("value", opening, F.length("value")), F.lit(closing)).alias("__xml")]
    if order:
        columns.append(_place().alias(order))
    return xml_rows(lines.where(opening > 0).select(*columns), "__xml", schema, row_tag)


def xml_rows(df: DataFrame, column: str, schema: str, row_tag: str) -> DataFrame:
    """The elements of an XML text column, next to the other columns."""
    parsed = df.withColumn("__row", F.from_xml(column, schema, {"rowTag": row_tag}))
    return parsed.select(*[c for c in df.columns if c != column], "__row.*")


def split_line(value: Column | str, delimiter: str) -> Column:
    """The fields of a line; the delimiter is plain text, not a pattern."""
    return F.split(value, "\\Q" + delimiter + "\\E")


def join_fields(fields: Column, delimiter: str) -> Column:
    return F.array_join(fields, delimiter)

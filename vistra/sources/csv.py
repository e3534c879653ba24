"""CSV boundary: visit files (with or without header) and person files."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from vistra.operators.clean import normalize_na_tokens
from vistra.schema import PERSON_COLUMNS, REQUIRED_VISIT_COLUMNS, VISIT_COLUMNS
from vistra.sources.encoding import UTF8, list_files, read_groups, read_groups_many, reader_options
from vistra.sources.records import HEADER, Reading, broken_files, kept_states, read_records, utf8_lines, utf16_reading

MALFORMED = "_malformed"


@dataclass(frozen=True)
class VisitFile:
    """One visit input: a file, folder or glob, whether it has a header, and its
    encoding (None: found from each file's first bytes)."""

    path: str
    header: bool
    encoding: str | None = None


class MissingColumnsError(ValueError):
    pass


def _text_schema(names: Sequence[str]) -> T.StructType:
    return T.StructType([T.StructField(n, T.StringType(), True) for n in names])


def _column_names(spark: SparkSession, paths: Sequence[str], header: bool, options: dict[str, str]) -> list[str]:
    names = spark.read.options(**options).csv(list(paths)).columns if header else VISIT_COLUMNS
    absent = [c for c in REQUIRED_VISIT_COLUMNS if c not in names]
    if absent:
        raise MissingColumnsError(f"{list(paths)[0]}: no column {', '.join(absent)}")
    return names


def _visit_columns(df: DataFrame, names: Sequence[str]) -> DataFrame:
    return df.select(*[F.col(f"`{c}`") if c in names else F.lit(None).cast("string").alias(c) for c in VISIT_COLUMNS])


def _read_whole_records(
    lines: DataFrame | Reading, paths: Sequence[str], names: Sequence[str], header: bool, options: dict[str, str], states: DataFrame | None = None
) -> DataFrame:
    """Files in which records may go over line ends, or whose bytes only we can split."""
    kept = {k: v for k, v in options.items() if k not in ("encoding", "multiLine", "header", "enforceSchema")}
    row = F.from_csv("text", F.lit(_text_schema(names).toDDL()), kept).alias("row")
    rows = read_records(lines, header, states).select("kind", row)
    # every file's first record must name the same columns
    same = F.to_json(F.array(*[F.col("row")[c] for c in names])) == F.to_json(F.array(*[F.lit(c) for c in names]))
    data = F.when(F.col("kind") != HEADER, True).when(same, False)
    data = data.otherwise(F.raise_error(F.lit(f"CSV header of a file under {paths[0]} does not name {', '.join(names)}")).cast("boolean"))
    return _visit_columns((rows.filter(data) if header else rows).select("row.*"), names)


def _read_visit_group(spark: SparkSession, paths: Sequence[str], header: bool, encoding: str, spread: int | None, line_breaks: bool) -> DataFrame:
    """One reading of files in one encoding.

    A quote inside a quoted value is doubled and a backslash is text. The names
    of a headed file are those of its first line, and every file whose first
    line differs raises; the names of a headerless file are the 17 in order.
    """
    options = {"header": str(header).lower(), "escape": '"', "enforceSchema": "false", **reader_options(encoding)}
    names = _column_names(spark, paths, header, options)
    if encoding.upper() in ("UTF-16", "UTF-16LE", "UTF-16BE"):
        rows = _read_whole_records(utf16_reading(spark, paths), paths, names, header, options)
        return rows.repartition(spread) if spread else rows

    def plain(some: Sequence[str]) -> DataFrame:
        return _visit_columns(spark.read.schema(_text_schema(names)).options(**options).csv(list(some)), names)

    if not line_breaks or encoding.upper() != UTF8:
        return plain(paths)
    lines = utf8_lines(spark, paths)
    states = kept_states(spark, lines)
    broken = broken_files(spark, paths, states)
    if not broken:
        return plain(paths)
    others = sorted({r["path"] for r in list_files(spark, paths).filter("length > 0").collect()} - set(broken))
    if not others:  # the same lines in the same blocks
        return _read_whole_records(lines, paths, names, header, options, states)
    return _read_whole_records(utf8_lines(spark, broken), broken, names, header, options).unionByName(plain(others))


def _read_lines(spark: SparkSession, paths: Sequence[str], header: bool, encoding: str) -> DataFrame:
    """(malformed, whole) of each line."""
    options = {"header": str(header).lower(), "escape": '"', "enforceSchema": "false", **reader_options(encoding)}
    names = _column_names(spark, paths, header, options)
    schema = _text_schema(names).add(MALFORMED, T.StringType(), True)
    df = spark.read.schema(schema).options(columnNameOfCorruptRecord=MALFORMED, **options).csv(list(paths))
    # the reader looks at no more of a line than it is asked for, so all columns are asked for
    whole = F.length(F.concat_ws("", *[F.col(f"`{c}`") for c in names])) >= 0
    return df.select(F.col(MALFORMED).isNotNull().alias(MALFORMED), whole.alias("whole"))


def _stack(parts: Sequence[DataFrame]) -> DataFrame:
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def _read_parts(spark: SparkSession, files: Sequence[VisitFile], read) -> DataFrame:
    unknown = [f for f in files if f.encoding is None]
    found = dict(zip(unknown, read_groups_many(spark, [f.path for f in unknown]))) if unknown else {}
    parts = [read(paths, f.header, enc) for f in files for enc, paths in (found[f] if f.encoding is None else [(f.encoding, [f.path])])]
    if not parts:
        raise FileNotFoundError(f"no visit files under {[f.path for f in files]}")
    return _stack(parts)


def read_visits_csv(spark: SparkSession, files: Sequence[VisitFile], spread: int | None = None, line_breaks: bool = True) -> DataFrame:
    """Read visit CSVs as 17 text columns, by name, and stack them.

    All columns are text, so nothing is inferred; of a headed input one line is
    read ahead for its names. Columns may stand in any order and others may
    stand between them; one that the cleaning doesn't use may be absent (null).
    Files are split into blocks of 64 MB, UTF-16 files with a byte-order mark
    too (whose rows are dealt anew over ``spread`` partitions where that is given). Quoted values may hold line breaks: UTF-8 files are looked through
    for quotes that stay open at a line's end, and those that have any are read
    record by record (``vistra.sources.records``); with ``line_breaks=False``
    that pass is spared and every line is taken for a record. The reader's
    missing-value strings become NULL, as the reference's reader treats them.
    """
    parts = _read_parts(spark, files, lambda paths, header, enc: _read_visit_group(spark, paths, header, enc, spread, line_breaks))
    return normalize_na_tokens(parts, VISIT_COLUMNS)


def malformed_rows(spark: SparkSession, files: Sequence[VisitFile]) -> DataFrame:
    """One row (malformed_rows, rows): lines whose number of values isn't that of the columns.

    Lines, not records: a value with a line break counts as the lines it stands on.
    """
    rows = _read_parts(spark, files, lambda paths, header, enc: _read_lines(spark, paths, header, enc))
    return rows.agg(F.count_if(F.col(MALFORMED) & F.col("whole")).alias("malformed_rows"), F.count_if("whole").alias("rows"))


def _group_by_encoding(found: dict[str, str]) -> dict[str, list[str]]:
    groups: dict[str, list[str]] = {}
    for path, enc in found.items():
        groups.setdefault(enc, []).append(path)
    return groups


def read_person_csv(
    spark: SparkSession,
    path: str,
    encodings: dict[str, str] | None = None,
    groups: list[tuple[str, list[str]]] | None = None,
    encoding: str | None = None,
) -> DataFrame:
    """Read person CSV(s) with header as text, keep the three used columns.

    Names come from the header (the file may hold more columns); no type
    inference. Missing-value strings stay text and quoting is Spark's default,
    as the reference reads this file with Spark. ``encoding`` states the
    encoding of all files; without it their first bytes are looked at.
    """
    if groups is None:
        if encoding is not None:
            groups = [(encoding, [path])]
        elif encodings is not None:
            groups = sorted(_group_by_encoding(encodings).items())
        else:
            groups = read_groups(spark, [path])
    parts = []
    for enc, paths in groups:
        reader = spark.read.option("header", True)
        for key, value in reader_options(enc).items():
            reader = reader.option(key, value)
        parts.append(reader.csv(paths).select(*PERSON_COLUMNS))
    if not parts:
        raise FileNotFoundError(f"no person files under {path}")
    return _stack(parts)


def write_csv(
    df: DataFrame, path: str, header: bool = True, encoding: str = "UTF-8", doubled_quotes: bool = False
) -> None:
    """Write text rows as CSV (overwrite). Nulls are written as empty fields.

    ``doubled_quotes``: a quote inside a value is doubled and a backslash is
    text, as visit files have it; else Spark's default escaping.
    """
    writer = df.write.mode("overwrite").option("header", header).option("encoding", encoding)
    if doubled_quotes:
        writer = writer.option("escape", '"')
    writer.csv(path)

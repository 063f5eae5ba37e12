"""Readers: stored tables, text exports, manifests, lists, scans, specs, logs."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from vitrine.functions.text import scrub_newlines

# Columns of a media manifest.
MANIFEST_FIELDS = "name size objectnumber date creator contributor rightsholder imagenumber handling approvedforweb".split()

# Columns of a field specification.
SPEC_COLUMNS = (
    "marker number Name Label SolrField SearchTarget Suggestions Role Search Facet bMapper listDisplay fullDisplay gridDisplay mapDisplay inCSV x"
).split()


def scan_table(spark: SparkSession, table: str, format: str = "parquet", **options: str) -> DataFrame:
    """A stored table.

    For ``jdbc`` give ``url`` and, to read in parallel, ``partitionColumn`` with its
    bounds and ``numPartitions``; filters and column choice are pushed to the source.
    """
    if format == "table":
        return spark.table(table)
    reader = spark.read.format(format).options(**options)
    return reader.option("dbtable", table).load() if format == "jdbc" else reader.load(table)


def _pattern(sep: str) -> str:
    return "\\Q" + sep + "\\E"


def read_record_export(
    spark: SparkSession, path: str, field_sep: str = "\t", record_sep: str = "@@", columns: Sequence[str] | None = None
) -> tuple[DataFrame, DataFrame]:
    """Rows of a text export whose records end in ``record_sep`` and may hold line ends.

    Without ``columns`` the first record names them.  Returns the rows of the right
    width and the other records; the header and the ``(N rows)`` footer are neither.
    """
    records = spark.read.option("lineSep", record_sep).text(path)
    if columns is None:
        first = records.head()
        columns = [] if first is None else first["value"].strip("\r\n").split(field_sep)
    header = field_sep.join(columns)
    lines = records.select(scrub_newlines("value").alias("value")).filter(F.trim("value") != header)
    lines = lines.filter(~F.col("value").rlike(r"^\s*(\([0-9]+ rows?\))?\s*$"))
    cells = F.split("value", _pattern(field_sep), -1)
    good = lines.filter(F.size(cells) == len(columns)).select(*[cells[i].alias(n) for i, n in enumerate(columns)])
    return good, lines.filter(F.size(cells) != len(columns))


def read_manifest(spark: SparkSession, path: str, sep: str = "|") -> DataFrame:
    """Rows of a media manifest; expected fields that it lacks are blank."""
    rows = spark.read.csv(path, header=True, sep=sep)
    return clean_manifest(rows)


def clean_manifest(rows: DataFrame) -> DataFrame:
    """A manifest with every expected field, without line ends in its cells."""
    given = [F.coalesce(F.translate(F.col(n), "\r\n", ""), F.lit("")).alias(n) for n in rows.columns]
    missing = [F.lit("").alias(n) for n in MANIFEST_FIELDS if n not in rows.columns]
    return rows.select(*given, *missing)


def read_keyword_list(spark: SparkSession, path: str) -> DataFrame:
    """First column of a list file as ``value``."""
    return spark.read.text(path).select(F.split_part("value", F.lit("\t"), F.lit(1)).alias("value")).filter("value <> ''")


def parse_scanner_lines(lines: DataFrame, col: str = "value") -> DataFrame:
    """``(line, cells)`` of scanner lines; other lines drop, equal lines collapse (of one file, where lines carry their ``file``)."""
    of = [c for c in ("file",) if c in lines.columns]
    scans = lines.filter(F.col(col).startswith('"')).select(*of, F.rtrim(col).alias("line")).distinct()
    body = F.substring("line", F.lit(2), F.length("line") - 2)
    cells = F.transform(F.split(body, _pattern('","')), lambda cell: F.rtrim(cell))
    return scans.select(*of, "line", cells.alias("cells"))


def read_scanner_drop(spark: SparkSession, folder: str) -> DataFrame:
    """``(file, value)``: the lines of every file of a drop folder, with the file they came in."""
    return spark.read.text(folder).select(F.col("_metadata.file_path").alias("file"), "value")


def parse_field_spec(lines: DataFrame, col: str = "value") -> DataFrame:
    """The ``field`` rows of a field specification, one column per heading."""
    cells = F.split(F.col(col), "\t")
    named = [F.get(cells, F.lit(i)).alias(n) for i, n in enumerate(SPEC_COLUMNS)]
    return lines.filter(cells[0] == "field").select(*named)


def read_field_spec(spark: SparkSession, path: str) -> DataFrame:
    return parse_field_spec(spark.read.text(path))


def parse_audit_log(lines: DataFrame, col: str = "value", keep: Sequence[str] = ()) -> DataFrame:
    """Actions of an audit log: five fixed columns, then ``key=value`` cells as a map; of a repeated key the last counts.

    ``keep`` names further columns of ``lines`` to carry along.
    """
    cells = F.split(F.col(col), "\t")

    def entry(cell: Column) -> Column:
        at = F.instr(cell, "=")
        return F.struct(F.substring(cell, F.lit(1), at - 1).alias("key"), F.substring(cell, at + 1, F.length(cell)).alias("value"))

    tail = F.filter(F.slice(cells, F.lit(6), F.greatest(F.size(cells) - 5, F.lit(0))), lambda cell: cell.contains("="))
    entries = F.transform(tail, entry)
    from_last = F.reverse(F.transform(entries, lambda e: e["key"]))
    attrs = F.map_from_entries(F.filter(entries, lambda e, i: F.array_position(from_last, e["key"]) == F.size(entries) - i))
    fixed = [F.get(cells, F.lit(i)).alias(n) for i, n in enumerate(["action", "logged_at", "update_type", "uri", "username"])]
    return lines.filter(~F.col(col).startswith("#") & (F.col(col) != "")).select(*fixed, attrs.alias("attrs"), *keep)


def read_audit_log(spark: SparkSession, path: str) -> DataFrame:
    return parse_audit_log(spark.read.text(path))


def read_pairs(spark: SparkSession, path: str) -> list[tuple[str, str]]:
    """``table,field`` pairs of a template list; a list of settings, so it is read whole."""
    rows = spark.read.text(path).filter(F.col("value").contains(",")).collect()
    return [tuple(part.strip() for part in row["value"].split(",", 1)) for row in rows]

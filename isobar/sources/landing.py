"""Landed provider files.

The providers' records do not carry the station id.  Land them as
``<folder>/station=<id>/*.json``, or add a ``station`` field while landing; the folder counts first.

A folder may mix three formats, told apart by the file:

- JSON lines, one record a line: read in splits of any size;
- documents, one JSON value over many lines (an array, or provider B's answer): parsed whole, one
  task a file;
- large documents, above ``spark.sql.files.maxPartitionBytes``, that are plain lists of
  observations: cut at the ends of their records and read in splits like lines.

``*.jsonl`` and ``*.ndjson`` are lines by name.  Other files are looked at in one scan, cut at ``}``
and not parsed: a file that begins with ``[`` or ``{`` is a document, unless a ``{`` or ``[`` stands
where a document can have none: after an end, or on a new line without ``[``, ``,`` or ``:`` before
it.  A file with one record is read alike either way.  The driver learns the names of files of the rarer formats only
where formats are mixed, a part of the listing that it holds for any read.

The readers add ``station``, ``file`` and ``corrupt``: the text of a record that does not parse.
Such a record is one row with nothing else, for the normalising step to reject; a document that
does not parse as a whole is one such record.  Blank lines are no records.
"""

from __future__ import annotations

import re
from typing import NamedTuple
from urllib.parse import unquote

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..schemas import PROVIDER_A_SCHEMA, PROVIDER_B_SCHEMA, STATION_SCHEMA

LINES, DOCUMENT, LARGE = "lines", "document", "large document"
LINE_NAMES = r"\.(jsonl|ndjson)(\.[a-z0-9]+)?$"


class Format(NamedTuple):
    """How a provider writes: its record's schema, and what may stand before a document's first observation, as a pattern."""

    schema: T.StructType
    opening: str


PROVIDER_A = Format(PROVIDER_A_SCHEMA, r"\[")
PROVIDER_B = Format(PROVIDER_B_SCHEMA, r'\{\s*"data"\s*:\s*\[')


def with_station(schema: T.StructType) -> T.StructType:
    return T.StructType([*schema.fields, T.StructField("station", T.StringType()), T.StructField("corrupt", T.StringType())])


def _file() -> Column:
    return F.col("_metadata.file_path").alias("file")


def _paths(files: list[str]) -> list[str]:
    """File addresses as paths to read, without patterns."""
    return [re.sub(r"([\\{}\[\]*?])", r"\\\1", unquote(f)) for f in files]


def _between_ends(spark: SparkSession, paths: str | list[str]) -> DataFrame:
    """The text between the ends of objects, however long a line is."""
    return spark.read.option("recursiveFileLookup", True).option("lineSep", "}").text(paths)


def file_formats(spark: SparkSession, folder: str, form: Format, large: int | None = None) -> DataFrame:
    """(file, format) of every file in ``folder`` whose name does not say it; ``large`` in bytes."""
    if large is None:
        size = spark.conf.get("spark.sql.files.maxPartitionBytes")
        large = int(spark.sparkContext._jvm.org.apache.spark.network.util.JavaUtils.byteStringAsBytes(size))
    unnamed = _between_ends(spark, folder).filter(~F.col("_metadata.file_name").rlike(LINE_NAMES))
    piece = F.btrim("value", F.lit(" \t\r\n")).alias("piece")
    another = F.rlike("value", F.lit(r"(?:^|[^\[,:\s])\s*\n\s*\{|\]\s*\n\s*\[")).alias("another")
    block = F.col("_metadata.file_block_start").alias("block")
    seen = unnamed.select(
        _file(), block, F.col("_metadata.file_size").alias("size"), piece, another, F.monotonically_increasing_id().alias("place")
    )
    # per split first, where ids grow with the rows, then the splits by their position in the file; characters
    # are held as their codes, so that no piece is sorted
    splits = seen.groupBy("file", "block").agg(
        F.max("size").alias("size"),
        F.min_by(F.ascii(F.left("piece", F.lit(1))), F.when(F.col("piece") != "", F.col("place"))).alias("first"),
        # nothing (-1) behind the last end, or the last character behind it
        F.max_by(F.when(F.col("piece") == "", -1).otherwise(F.ascii(F.right("piece", F.lit(1)))), "place").alias("last"),
        F.bool_or("another").alias("several"),
    )
    looked = splits.groupBy("file").agg(
        F.max("size").alias("size"),
        F.min_by("first", F.when(F.col("first").isNotNull(), F.col("block"))).alias("first"),
        F.max_by("last", "block").alias("last"),
        F.bool_or("several").alias("several"),
    ).filter(F.col("first").isNotNull())
    one_value = F.col("first").isin(ord("["), ord("{")) & ~F.col("several")
    closed = F.col("last").isin(ord("]"), -1)
    kind = F.when(~one_value, LINES).when(closed & (F.col("size") > large), LARGE).otherwise(DOCUMENT)
    return looked.select("file", kind.alias("format"))


def _pieces(spark: SparkSession, files: list[str], form: Format) -> DataFrame:
    """file, what would be one observation, null behind the last, and whether the list is closed there."""
    pieces = _between_ends(spark, _paths(files)).select(_file(), "value")
    rest = F.regexp_replace("value", rf"^\s*(?:{form.opening}|,)?\s*", "")
    behind = F.regexp_replace("value", r"\s+", "")
    return pieces.select("file", F.when(~behind.isin("", "]"), rest).alias("piece"), (behind == "]").alias("closes"))


def _plain_lists(spark: SparkSession, files: list[str], form: Format) -> list[str]:
    """The files that are lists of objects without objects, or braces in texts, inside them."""
    piece = F.col("piece")
    quotes = F.length(F.regexp_replace(F.regexp_replace("piece", r"\\.", ""), r'[^"]', ""))
    plain = piece.isNull() | (piece.rlike(r"^\{[^{]*$") & (quotes % 2 == 0))
    whole = F.bool_and(plain) & (F.count_if("closes") == 1)
    judged = _pieces(spark, files, form).groupBy("file").agg(whole.alias("plain"))
    return [r.file for r in judged.filter("plain").select("file").collect()]


def _located(records: DataFrame) -> DataFrame:
    """``station`` from the folder, else the record's own; ids such as 08181 stay text."""
    from_folder = F.nullif(F.regexp_extract("file", r"/station=([^/]+)/", 1), F.lit(""))
    for _ in range(2):  # the folder's name is escaped, and so is the file's address
        from_folder = F.url_decode(F.replace(from_folder, F.lit("+"), F.lit("%2B")))
    return records.withColumn("station", F.coalesce(from_folder, "station"))


def _json(spark: SparkSession, form: Format, paths: str | list[str], multi_line: bool, but: list[str]) -> DataFrame:
    reader = spark.read.schema(with_station(form.schema)).option("multiLine", multi_line).option("recursiveFileLookup", True)
    landed = reader.option("columnNameOfCorruptRecord", "corrupt").json(paths)
    if but:
        # a filter on the file's name alone keeps the other files from being opened
        landed = landed.filter(~F.col("_metadata.file_path").isin(but))
    return landed.select("*", _file())


def _cut(spark: SparkSession, form: Format, files: list[str]) -> DataFrame:
    """Records of large documents, one row each: observations, as the provider's record holds them."""
    field = form.schema[0]
    listed = field.dataType.elementType if isinstance(field.dataType, T.ArrayType) else None
    flat = listed or form.schema
    pieces = _pieces(spark, files, form).filter("piece is not null")
    parsed = F.from_json(F.concat("piece", F.lit("}")), with_station(flat), {"columnNameOfCorruptRecord": "corrupt"})
    rows = pieces.select("file", parsed.alias("row"))
    if listed:
        record = F.when(F.col("row.corrupt").isNull(), F.array(F.struct(*[F.col(f"row.{f.name}").alias(f.name) for f in listed])))
        rows = rows.select(record.alias(field.name), "row.station", "row.corrupt", "file")
    else:
        rows = rows.select("row.*", "file")
    return rows


def read_records(spark: SparkSession, folder: str, form: Format, multi_line: bool | None = None, large: int | None = None) -> DataFrame:
    """Every record of the folder's files with station, file and corrupt; ``multi_line`` sets one format for all files."""
    if multi_line is not None:
        return _located(_json(spark, form, folder, multi_line, []))
    files: dict[str, list[str]] = {LINES: [], DOCUMENT: [], LARGE: []}
    formats = file_formats(spark, folder, form, large).cache()
    try:
        counts = {r["format"]: r["count"] for r in formats.groupBy("format").count().collect()}
        for kind in counts.keys() & {DOCUMENT, LARGE}:
            files[kind] = [r.file for r in formats.filter(F.col("format") == kind).select("file").collect()]
        lines = counts.get(LINES, 0) > 0
    finally:
        formats.unpersist()
    if files[LARGE]:
        plain = set(_plain_lists(spark, files[LARGE], form))
        files[DOCUMENT] += [f for f in files[LARGE] if f not in plain]
        files[LARGE] = sorted(plain)
    parts = []
    others = files[DOCUMENT] + files[LARGE]
    if lines or not others or _has_line_names(spark, folder):
        parts.append(_json(spark, form, folder, False, others))
    if files[DOCUMENT]:
        parts.append(_json(spark, form, _paths(files[DOCUMENT]) if parts or files[LARGE] else folder, True, []))
    if files[LARGE]:
        parts.append(_cut(spark, form, files[LARGE]))
    found = parts[0]
    for part in parts[1:]:
        found = found.unionByName(part)
    return _located(found)


def _has_line_names(spark: SparkSession, folder: str) -> bool:
    named = spark.read.option("recursiveFileLookup", True).format("binaryFile").load(folder).select("path")
    return not named.filter(F.col("path").rlike(LINE_NAMES)).isEmpty()


def read_provider_a(spark: SparkSession, folder: str, multi_line: bool | None = None, large: int | None = None) -> DataFrame:
    """One row per record of provider A."""
    return read_records(spark, folder, PROVIDER_A, multi_line, large)


def read_provider_b(spark: SparkSession, folder: str, multi_line: bool | None = None, large: int | None = None) -> DataFrame:
    """One row per observation of provider B (S3)."""
    return unnest_provider_b(read_records(spark, folder, PROVIDER_B, multi_line, large))


def unnest_provider_b(landed: DataFrame) -> DataFrame:
    """One row per observation; a record that does not parse, or has no data field, stays one row.

    An empty ``data`` list is a provider's answer of no observations and gives no row.
    """
    rest = [c for c in landed.columns if c != "data"]
    broken = F.when(F.col("data").isNull(), F.array(F.lit(None).cast(landed.schema["data"].dataType.elementType)))
    return landed.select(*rest, F.explode(F.coalesce("data", broken)).alias("row")).select("row.*", *rest)


def read_station_inventory(spark: SparkSession, path: str, multi_line: bool = True) -> DataFrame:
    """Stations with their position in the files by name, which decides ties.

    Row ids alone follow the order in which Spark reads the files, the largest first; inside a
    block of a file they grow with the rows.
    """
    stations = spark.read.schema(STATION_SCHEMA).option("multiLine", multi_line).json(path)
    block = [F.col(f"_metadata.{c}").alias(c) for c in ("file_path", "file_block_start")]
    return stations.withColumn("pos", F.struct(*block, F.monotonically_increasing_id().alias("row")))

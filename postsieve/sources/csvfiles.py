"""CSV landing files in and out."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from postsieve.operators.ingest import serialize_lists
from postsieve.operators.skew import ROWS_PER_TASK, skew_join
from postsieve.schemas import POSTS_CSV
from postsieve.session import cut_lineage
from postsieve.sources.order import PLACE, with_place

# Doubled quotes inside quoted fields, fields may span lines, blanks are kept.
OPTIONS = {
    "header": "true", "multiLine": "true", "quote": '"', "escape": '"',
    "ignoreLeadingWhiteSpace": "false", "ignoreTrailingWhiteSpace": "false",
}

# Rows per file of our own CSV output: texts hold line breaks, and such a file is read by one task, so files must stay small.
ROWS_PER_FILE = 250_000

# Structure of MS949 (CP949) text, seen byte by byte: ASCII, or a lead byte with its trail byte.
CP949_CHAR = r"[\x00-\x7f]+|[\x81-\xc6][\x41-\x5a\x61-\x7a\x81-\xfe]|[\xc7-\xfe][\xa1-\xfe]"

@contextmanager
def java_charsets(spark: SparkSession, *more: str) -> Iterator[None]:
    """Opens the session to Korean charsets, which it may refuse. Columns built inside keep the setting, a writer needs it while it runs."""
    names = ["spark.sql.legacy.javaCharsets", *more]
    before = {n: spark.conf.get(n) for n in names}
    try:
        for n in names:
            spark.conf.set(n, "true")
        yield
    finally:
        for n, value in before.items():
            spark.conf.set(n, value)


def lines_are_rows(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """Per file: can each of its lines be read by itself? A line break inside quotes leaves a line with an odd number of them.

    The lines are only counted, by tasks that split large files; encodings that hold ASCII as it is need not be known.
    """
    quotes = F.length("value") - F.length(F.replace("value", F.lit('"'), F.lit("")))
    raw = spark.read.text(path).select(F.col("_metadata.file_path").alias("file"), F.decode(F.col("value").cast("binary"), "ISO-8859-1").alias("value"))
    return raw.groupBy("file").agg(F.bool_and(quotes % 2 == 0).alias("plain"))


def scan_posts_csv(
    spark: SparkSession, path: str | list[str], schema: T.StructType = POSTS_CSV, encoding: str = "UTF-8", placed: bool = False
) -> DataFrame:
    """CSV of posts, all columns as text; columns are matched by header order of the schema.

    A byte order mark is dropped by the reader. Files without line breaks inside quotes are read by lines, so a large one is split over tasks;
    each of the others is one task. Only where a path holds both kinds are their names listed, as the driver's file index does anyway.
    ``placed`` adds the place of each row.
    """
    reader = spark.read.schema(schema).options(**OPTIONS).option("encoding", encoding)
    place = with_place if placed else lambda df: df
    kinds = {r["plain"]: r["n"] for r in lines_are_rows(spark, path).groupBy("plain").agg(F.count(F.lit(1)).alias("n")).collect()}
    if len(kinds) < 2:
        return place(reader.option("multiLine", str(True not in kinds)).csv(path))
    told = lines_are_rows(spark, path).collect()
    by_line, whole = ([r["file"] for r in told if r["plain"] == kind] for kind in (True, False))
    return place(reader.option("multiLine", "false").csv(by_line)).unionByName(place(reader.option("multiLine", "true").csv(whole)))


def file_encodings(rows: DataFrame, columns: list[str], file: str = "_file") -> DataFrame:
    """Encoding of each file from its rows, whose text has one character per byte: UTF-8 where all is valid, else MS949, else Latin-1."""
    as_bytes = F.concat_ws(",", *columns)  # no character of these encodings reaches over a comma
    tested = rows.groupBy(file).agg(
        F.bool_and(F.is_valid_utf8(F.encode(as_bytes, "ISO-8859-1").cast("string"))).alias("utf8"),
        F.bool_and(F.regexp_replace(as_bytes, CP949_CHAR, "") == "").alias("cp949"), F.count(F.lit(1)).alias("rows"),
    )
    choice = F.when(F.col("utf8"), "UTF-8").when(F.col("cp949"), "MS949").otherwise("ISO-8859-1")
    return tested.select(file, choice.alias("_encoding"), "rows")


def scan_csv_encodings(
    spark: SparkSession, path: str, schema: T.StructType = POSTS_CSV, first_choice: str | None = None, placed: bool = False
) -> DataFrame:
    """CSV files of mixed encodings; ``first_choice`` overrules the test for all of them.

    Quotes, commas and line ends are the same bytes in all of them. So files are read once, a character per byte, and stored; what
    their rows hold tells the encoding of a file, which joins its rows and decodes them. A file of very many rows is split over tasks.
    """
    names = [f.name for f in spark.createDataFrame([], schema).schema if isinstance(f.dataType, T.StringType)]
    if first_choice == "MS949":  # a reader would need the setting whenever its frame is run
        read = scan_posts_csv(spark, path, schema, "ISO-8859-1", placed)
        with java_charsets(spark, "spark.sql.legacy.codingErrorAction"):  # wrong bytes become U+FFFD, as a reader has it
            return read.withColumns({c: F.decode(F.encode(F.col(c), "ISO-8859-1"), "MS949") for c in names})
    if first_choice:
        return scan_posts_csv(spark, path, schema, first_choice, placed)
    read = scan_posts_csv(spark, path, schema, "ISO-8859-1", placed=True)
    rows = cut_lineage(read, "bytes")
    told = cut_lineage(file_encodings(rows, names), "encodings")
    hot = told.where(F.col("rows") > ROWS_PER_TASK).select(F.xxhash64("_file").alias("_key_hash"), F.ceil(F.col("rows") / ROWS_PER_TASK).cast("int").alias("_fan"))
    met = skew_join(rows, told.drop("rows"), ["_file"], "left", ["_block", "_row"], cut_lineage(hot, "hot"))

    def decoded(name: str) -> Column:
        data = F.encode(F.col(name), "ISO-8859-1")
        other = F.when(F.col("_encoding") == "MS949", F.decode(data, "MS949")).otherwise(F.col(name))
        return F.when(F.col("_encoding") == "UTF-8", F.decode(data, "UTF-8")).otherwise(other).alias(name)

    with java_charsets(spark):
        columns = [decoded(c) if c in names else F.col(c) for c in read.columns if placed or c not in PLACE]
        return met.select(*columns)


def scan_in_order(spark: SparkSession, path: str, schema: T.StructType = POSTS_CSV) -> DataFrame:
    """``scan_csv_encodings`` with the place of each row, for ``order.number_rows``."""
    return scan_csv_encodings(spark, path, schema, placed=True)


def sink_posts_csv(df: DataFrame, path: str, encoding: str = "UTF-8") -> None:
    """CSV with list columns as JSON text; maps and structs become JSON text, too. UTF-8 files start with a byte order mark."""
    lists = tuple(f.name for f in df.schema if isinstance(f.dataType, T.ArrayType))
    nested = {f.name: F.to_json(f.name) for f in df.schema if isinstance(f.dataType, T.MapType | T.StructType)}
    flat = serialize_lists(df, lists).withColumns(nested)
    if encoding == "UTF-8":  # the mark is the first character of the header, hence of each file
        flat = flat.withColumnRenamed(flat.columns[0], "\ufeff" + flat.columns[0])
    with java_charsets(df.sparkSession):
        flat.write.mode("overwrite").options(**OPTIONS).options(
            encoding=encoding, emptyValue="", maxRecordsPerFile=str(ROWS_PER_FILE)
        ).csv(path)

"""Scans: files, JSON lines, CSV, subtitles and release folders."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as t

from threshmill.functions import text as T
from threshmill.operators.clusters import number_by_range


def file_inventory(spark: SparkSession, folder: str, pattern: str = "*.md") -> DataFrame:
    """Files below a folder in path order: document_id, path, size, modification time, hashes, title and words."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", pattern).load(folder)
    text = F.decode("content", "utf-8")
    name = F.regexp_replace(F.element_at(F.split("path", "/"), -1), r"\.[^.]+$", "")
    rows = files.select("path", "length", "modificationTime", F.sha2("content", 256).alias("sha256"), F.md5("content").alias("md5"), T.extract_title(text, name).alias("title"), T.count_words(text).alias("word_count"))
    return number_by_range(rows, "path").withColumn("document_id", F.format_string("D%04d", "row_no")).drop("row_no")


def text_files(spark: SparkSession, folder: str, pattern: str = "*.md") -> DataFrame:
    """(path, text) of whole files."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", pattern).load(folder)
    return files.select("path", F.decode("content", "utf-8").alias("text"))


def json_lines(spark: SparkSession, path: str, schema: t.StructType | str, strict: bool = True) -> DataFrame:
    """Strict: a malformed line fails; tolerant: it is left out."""
    if strict:
        return spark.read.schema(schema).json(path, mode="FAILFAST")
    parsed = t._parse_datatype_string(schema) if isinstance(schema, str) else schema
    with_bad = t.StructType([*parsed.fields, t.StructField("_corrupt", t.StringType())])
    rows = spark.read.schema(with_bad).json(path, mode="PERMISSIVE", columnNameOfCorruptRecord="_corrupt")
    return rows.filter("_corrupt is null").drop("_corrupt")


def json_lines_numbered(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """JSON lines with their physical 1-based line, blank lines counted; unreadable lines are left out.

    Files are split as Spark splits text, so none has to fit in a row: lines are counted by split, and a split's lines
    are numbered from the count of those before it in its file.
    """
    rows = spark.read.option("recursiveFileLookup", True).text(path)
    at = rows.select(F.col("value").alias("line"), F.col("_metadata.file_path").alias("path"), F.col("_metadata.file_block_start").alias("block"), F.monotonically_increasing_id().alias("place"))
    sizes = at.groupBy("path", "block").agg(F.count("*").alias("n"))
    before = F.coalesce(F.sum("n").over(Window.partitionBy("path").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    first = at.groupBy("path", "block").agg(F.min("place").alias("first"))
    starts = sizes.select("path", "block", before.alias("before")).join(first, ["path", "block"])
    placed = at.join(starts, ["path", "block"])
    line = F.col("before") + F.col("place") - F.col("first") + 1  # a split is read by one task, so its places follow each other
    rows = placed.select("path", line.cast("int").alias("line_number"), F.from_json("line", schema).alias("r"))
    return rows.filter("r is not null").select("path", "line_number", "r.*")


def csv_table(spark: SparkSession, path: str) -> DataFrame:
    """CSV with a header; a byte order mark before the first name is dropped."""
    rows = spark.read.option("header", True).csv(path)
    return rows.toDF(*(c.lstrip("﻿") for c in rows.columns))


def json_document(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.option("multiLine", True).json(path)


def subtitles(files: DataFrame) -> DataFrame:
    """(path, index, start_seconds, end_seconds, text) of SRT files given as (path, text)."""
    block = F.explode(F.split(F.regexp_replace("text", "\r\n?", "\n"), r"\n[ \t]*\n+"))
    parsed = files.select("path", block.alias("block")).withColumn("block", F.trim("block"))
    clock = r"(\d+):(\d+):(\d+)[,.](\d+)"
    grammar = rf"(?s)^(\d+)\s*\n{clock}\s*-->\s*{clock}[^\n]*\n(.*)$"
    part = lambda i: F.regexp_extract("block", grammar, i)
    seconds = lambda i: part(i).cast("int") * 3600 + part(i + 1).cast("int") * 60 + part(i + 2).cast("int") + part(i + 3).cast("int") / 1000.0
    return parsed.filter(F.col("block").rlike(grammar)).select("path", part(1).cast("int").alias("index"), seconds(2).alias("start_seconds"), seconds(6).alias("end_seconds"), F.regexp_replace(F.trim(part(10)), r"\s*\n\s*", " ").alias("text"))


def tables(spark: SparkSession, folder: str, *names: str) -> dict[str, DataFrame]:
    """Tables of a folder that holds several, by name."""
    return {name: spark.read.parquet(f"{folder}/{name}") for name in names}


def optional(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """A Parquet table, or an empty one if it is not there."""
    from pyspark.errors import AnalysisException

    try:
        return spark.read.schema(schema).parquet(path)
    except AnalysisException as missing:
        if missing.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], schema)

"""Readers and writers of the pipeline's files."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lexiscope import schemas


def exists(spark: SparkSession, path: str) -> bool:
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return bool(p.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()).globStatus(p))


def read_jsonl(spark: SparkSession, path: str, schema: str = schemas.PAPER, strict: bool = False) -> DataFrame:
    """Blank and malformed lines go; strict: a malformed line fails, a missing file is an empty table."""
    if strict and not exists(spark, path):
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).option("mode", "FAILFAST" if strict else "DROPMALFORMED").json(path)


def read_or_default(spark: SparkSession, path: str, schema: str, lines: bool = True) -> DataFrame:
    """The file (JSON lines, or one JSON text over many lines), or an empty table where there is none."""
    return spark.read.schema(schema).option("multiLine", not lines).json(path) if exists(spark, path) else spark.createDataFrame([], schema)


def read_language_data(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(schemas.LANGUAGE_DATA).option("multiLine", True).json(path)


def read_class_files(spark: SparkSession, folder: str) -> DataFrame:
    """(language, class_id) of files 0.txt, 1.txt, … with a name on each line; no such file is an error."""
    if not exists(spark, f"{folder}/*.txt"):
        raise FileNotFoundError(f"no class files in {folder}")
    lines = spark.read.text(f"{folder}/*.txt").select(F.trim("value").alias("language"), F.regexp_extract(F.col("_metadata.file_name"), r"^(\d+)\.txt$", 1).alias("c"))
    return lines.where("c <> '' AND language <> ''").select("language", F.col("c").cast("int").alias("class_id")).distinct()


def latest_file(spark: SparkSession, pattern: str) -> str | None:
    """The newest file that fits a pattern."""
    if not exists(spark, pattern):
        return None
    files = spark.read.format("binaryFile").load(pattern).select("path", "modificationTime")
    return files.agg(F.max_by("path", F.struct("modificationTime", "path"))).first()[0]


def read_html_cache(spark: SparkSession, folder: str) -> DataFrame:
    """(safe_id, complete, sections array of title, text, cleaned_text, detected) of JSON files; unreadable ones go.

    Keys that begin with an underscore are no sections.
    """
    files = spark.read.text(f"{folder}/*.json", wholetext=True).select("value", F.regexp_extract("_metadata.file_name", r"^(.*)\.json$", 1).alias("safe_id"))
    raw = F.from_json("value", "map<string,string>")
    body = F.map_filter(raw, lambda k, v: ~k.startswith("_"))
    section = lambda e: F.struct(e["key"].alias("title"), F.from_json(e["value"], schemas.HTML_CACHE_SECTION).alias("s"))
    parsed = files.where(raw.isNotNull()).select(
        "safe_id", F.coalesce(raw["_complete"] == "true", F.lit(True)).alias("complete"), F.coalesce(raw["_unavailable"] == "true", F.lit(False)).alias("unavailable"),
        F.transform(F.map_entries(body), section).alias("x"),
    )
    return parsed.select("safe_id", "complete", "unavailable", F.transform("x", lambda e: F.struct(e["title"].alias("title"), e["s"]["text"].alias("text"), e["s"]["cleaned_text"].alias("cleaned_text"), e["s"]["detected"].alias("detected"))).alias("sections"))


def read_pdf_cache(spark: SparkSession, folder: str) -> DataFrame:
    files = spark.read.schema(schemas.PDF_CACHE).option("multiLine", True).json(f"{folder}/*.json")
    return files.withColumn("safe_id", F.regexp_extract("_metadata.file_name", r"^(.*)\.json$", 1))


def read_oai(spark: SparkSession, path: str) -> DataFrame:
    """Papers of OAI-PMH answers, an XML record each; records without metadata go."""
    raw = spark.read.format("xml").option("rowTag", "record").option("ignoreNamespace", True).schema(
        "header struct<identifier:string>, metadata struct<arXiv:struct<id:string,created:string,updated:string,title:string,abstract:string,"
        "categories:string,authors:struct<author:array<struct<keyname:string,forenames:string>>>>>"
    ).load(path)
    m = F.col("metadata.arXiv")
    squeeze = lambda c: F.trim(F.regexp_replace(c, r"\s+", " "))
    own = F.coalesce(m["id"], F.regexp_extract("header.identifier", r"([^:]+)$", 1))
    return raw.where(m.isNotNull()).select(
        F.concat(F.lit("https://arxiv.org/abs/"), own).alias("id"), squeeze(m["title"]).alias("title"), squeeze(m["abstract"]).alias("abstract"),
        F.transform(m["authors"]["author"], lambda a: F.trim(F.concat_ws(" ", a["forenames"], a["keyname"]))).alias("authors"),
        F.concat(m["created"], F.lit("T00:00:00")).alias("published"), F.concat(F.coalesce(m["updated"], m["created"]), F.lit("T00:00:00")).alias("updated"),
        F.split(m["categories"], " ").alias("categories"), F.concat(F.lit("https://arxiv.org/pdf/"), own).alias("pdf_url"),
        F.lit("oai_pmh").alias("_fetch_source"), m["created"].alias("created"),
    )


def resumption_token(xml: str) -> str | None:
    """The token for the next page, or none."""
    m = re.search(r"<(?:\w+:)?resumptionToken[^>]*>([^<]+)</", xml)
    return m[1].strip() or None if m else None


def write_week(df: DataFrame, folder: str, week: str) -> None:
    """Overwrites one week of a partitioned JSON table; other weeks stay."""
    df.withColumn("week", F.lit(week)).write.partitionBy("week").mode("overwrite").option("partitionOverwriteMode", "dynamic").json(folder)


def available_weeks(spark: SparkSession, folder: str) -> list[str]:
    """Weeks of a partitioned table, in order, from the names of its folders: no file is read."""
    p = spark._jvm.org.apache.hadoop.fs.Path(f"{folder}/week=*")
    found = p.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()).globStatus(p) or []
    return sorted(s.getPath().getName().removeprefix("week=") for s in found if s.isDirectory())


def facts_of_weeks(spark: SparkSession, folder: str, weeks: DataFrame) -> DataFrame:
    """Rows of a table partitioned by week whose week is among ``weeks`` (week): other weeks' files are pruned when the plan runs."""
    return spark.read.parquet(folder).withColumn("week", F.col("week").cast("string")).join(weeks.select("week").distinct(), "week", "left_semi")


def write_results(detected: DataFrame, none: DataFrame, warnings: DataFrame, folder: str, week: str) -> None:
    """Detected and undetected papers, and warnings if there are any."""
    write_week(detected, f"{folder}/detected", week)
    write_week(none, f"{folder}/no_detections", week)
    if not warnings.isEmpty():
        write_week(warnings, f"{folder}/warnings", week)

"""Writers: caches as keyed tables, the manifest's archive and latest copy, reference lists, markdown, publishing."""

from __future__ import annotations

import json
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lexiscope.functions.pdf_text import paper_markdown
from lexiscope.operators.gazetteer import to_language_data
from lexiscope.sources.files import exists, write_week

#: Parts of a cache; an upsert rewrites those that have a new row.
PARTS = 64
#: Folders of caches, which aren't published.
UNPUBLISHED = ("html_cache", "pdf_cache")


def _fs(spark: SparkSession, path: str):
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()), p


def write_text(spark: SparkSession, path: str, text: str) -> None:
    """One small file, through Spark's own file systems: written beside and renamed, so a reader never meets half of it."""
    files, p = _fs(spark, path)
    _, beside = _fs(spark, f"{path}.{uuid.uuid4().hex}")
    out = files.create(beside, True)
    out.write(bytearray(text.encode()))
    out.close()
    options = spark._jvm.org.apache.hadoop.fs.Options.Rename
    context = spark._jvm.org.apache.hadoop.fs.FileContext.getFileContext(files.getUri(), spark._jsparkSession.sessionState().newHadoopConf())
    swap = spark.sparkContext._gateway.new_array(options, 1)
    swap[0] = options.OVERWRITE
    context.rename(files.makeQualified(beside), files.makeQualified(p), swap)


def read_text(spark: SparkSession, path: str) -> str:
    return spark.read.text(path, wholetext=True).first()[0]


def upsert(rows: DataFrame, folder: str, key: str = "safe_id", parts: int = PARTS) -> None:
    """Writes rows into a Parquet table keyed by ``key``: new keys are added, present ones replaced, others stay.

    Of rows that repeat a key the greatest stays. The table is dealt into parts by the key's hash; parts
    without a new row aren't touched. New parts are written beside the table before any old one goes.
    """
    spark = rows.sparkSession
    columns = [c for c in rows.columns if c != key]
    new = rows.groupBy(key).agg(F.max(F.struct(*columns)).alias("r")).select(key, "r.*")
    new = new.withColumn("part", F.pmod(F.xxhash64(key), F.lit(parts)).cast("int"))
    if exists(spark, f"{folder}/part=*"):
        old = spark.read.schema(new.schema).parquet(folder)
        touched = old.join(new.select("part").distinct(), "part", "left_semi")
        new = touched.join(new.select(key), key, "left_anti").unionByName(new)
    beside = f"{folder.rstrip('/')}-{uuid.uuid4().hex}"
    new.write.parquet(beside)
    spark.read.schema(new.schema).parquet(beside).write.partitionBy("part").mode("overwrite").option("partitionOverwriteMode", "dynamic").parquet(folder)
    files, p = _fs(spark, beside)
    files.delete(p, True)


def write_html_cache(pages: DataFrame, folder: str) -> None:
    """pages: safe_id, html, complete, sections; a null html is kept as a row that says the page is unavailable."""
    upsert(pages.select("safe_id", "html", "complete", "sections", F.col("html").isNull().alias("unavailable")), folder)


def write_pdf_cache(texts: DataFrame, folder: str) -> None:
    """texts: safe_id and the columns of a PDF's text in its stages, with what was detected."""
    upsert(texts, folder)


def read_cache(spark: SparkSession, folder: str) -> DataFrame:
    return spark.read.parquet(folder).drop("part")


def cached_ids(spark: SparkSession, *folders: str) -> DataFrame:
    """Distinct safe_ids of caches; a folder that isn't there has none."""
    out = spark.createDataFrame([], "safe_id string")
    for f in folders:
        if exists(spark, f"{f}/part=*"):
            out = out.union(spark.read.parquet(f).select("safe_id"))
    return out.distinct()


def manifest_text(manifest: DataFrame) -> str:
    """The one row of a manifest as indented JSON."""
    return json.dumps(json.loads(manifest.toJSON().first()), indent=2, ensure_ascii=False)


def write_manifest(manifest: DataFrame, root: str, week: str, days: int = 7) -> None:
    """The same manifest twice: in the week's folder, and as the latest one of its window below the root."""
    spark, text = manifest.sparkSession, manifest_text(manifest)
    write_text(spark, f"{root}/weeks/{week}/manifest.json", text)
    write_text(spark, f"{root}/manifest_last_{days}_days.json", text)


def write_papers(papers: DataFrame, folder: str, week: str) -> None:
    """A week's papers as JSON lines; a week that is there is replaced."""
    write_week(papers, folder, week)


def write_language_data(gazetteer: DataFrame, ignore: DataFrame, review: DataFrame, path: str) -> None:
    """The reference lists (of some thousands of names) as one JSON file; names sorted."""
    names = to_language_data(gazetteer).first()[0] or {}
    data = {
        "lang_classes": {k: sorted(v) for k, v in sorted(names.items())},
        "languages_to_ignore": sorted(r[0] for r in ignore.select("language_lc").distinct().toLocalIterator()),
        "possible_false_positive_languages": {r[0]: r[1] for r in review.select("language", "flag_reason").orderBy("language").toLocalIterator()},
    }
    write_text(gazetteer.sparkSession, path, json.dumps(data, indent=2, ensure_ascii=False))


def write_markdown(pdfs: DataFrame, folder: str) -> None:
    """pdfs (filename, title, author, body, other metadata): a markdown file and a JSON line of metadata in a folder for each file name."""
    page = paper_markdown(F.col("title"), F.col("author"), F.col("body"))
    pdfs.select("filename", page.alias("value")).write.partitionBy("filename").mode("overwrite").option("lineSep", "\n").text(f"{folder}/markdown")
    pdfs.drop("body").withColumn("file", F.col("filename")).write.partitionBy("file").mode("overwrite").json(f"{folder}/metadata")


def publish(spark: SparkSession, source: str, target: str, files: tuple[str, ...], weeks: str = "weeks") -> list[str]:
    """Copies the named files and the weeks' folders, without caches; names of what was copied."""
    names = [f for f in files if exists(spark, f"{source}/{f}")]
    if exists(spark, f"{source}/{weeks}"):
        here, p = _fs(spark, f"{source}/{weeks}")
        for week in sorted(s.getPath().getName() for s in here.listStatus(p)):
            _, w = _fs(spark, f"{source}/{weeks}/{week}")
            names += [f"{weeks}/{week}/{s.getPath().getName()}" for s in here.listStatus(w) if s.getPath().getName() not in UNPUBLISHED]
    conf = spark._jsparkSession.sessionState().newHadoopConf()
    for name in names:
        a, src = _fs(spark, f"{source}/{name}")
        b, dst = _fs(spark, f"{target}/{name}")
        b.mkdirs(dst.getParent())
        spark._jvm.org.apache.hadoop.fs.FileUtil.copy(a, src, b, dst, False, True, conf)
    return names

"""A week's papers: request bounds, the search query, the fallback to the harvest, and the cap."""

from __future__ import annotations

import logging
from collections.abc import Callable

from pyspark.errors import PySparkException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lexiscope.functions.labels import in_window, month_guard, oai_date
from lexiscope.operators.assembly import first_by_id
from lexiscope.sources.papers_api import DAYS_AFTER, DAYS_BEFORE, HarvestedRecords

log = logging.getLogger(__name__)


def harvest_bounds(end: Column, days: int) -> tuple[Column, Column]:
    """(from, until) of a harvest's requests, as dates."""
    return F.date_sub(end, days + DAYS_BEFORE), F.date_add(end, DAYS_AFTER)


def search_query(categories: str, start: Column, end: Column) -> Column:
    """The search for papers submitted in a window; both ends count."""
    return F.format_string("%s AND submittedDate:[%s TO %s]", F.lit(categories), F.date_format(start, "yyyyMMddHHmm"), F.date_format(end, "yyyyMMddHHmm"))


def harvested(papers: DataFrame, end: str, days: int, arrival: Column | None = None) -> DataFrame:
    """Harvested records of a window, one for each id: created in the half-open window, with an id of one of its months.

    Of records that repeat an id the first one stays, by arrival (as it comes from the source: set, page and
    place), then by all its values. Records without a date in one of the two forms go.
    """
    stop = F.lit(end).cast("timestamp")
    created = oai_date(F.col("created"))
    start = F.date_sub(stop, days)
    own = papers.where(in_window(created, stop, days) & month_guard(F.col("id"), start, stop.cast("date")))
    columns = own.columns
    order = F.struct(*([arrival] if arrival is not None else []), *sorted(columns))
    return first_by_id(own.withColumn("_arrival", order), "_arrival").select(*columns)


def register(spark: SparkSession) -> None:
    """Makes the record source known to a session, with filters pushed to it."""
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    spark.dataSource.register(HarvestedRecords)


def harvest_records(spark: SparkSession, sets: str, client: str, end: str, days: int, **options: str) -> DataFrame:
    """Records of sets that were created in the half-open window, one for each id (see harvested); the window's dates reach the requests."""
    register(spark)
    records = spark.read.format("harvested_records").options(sets=sets, client=client, **options).load()
    stop = F.lit(end).cast("date")
    own = records.where((F.col("created") >= F.date_sub(stop, days)) & (F.col("created") < stop)).where(month_guard(F.col("id"), F.date_sub(stop, days), stop))
    return first_records(own)


def first_records(records: DataFrame) -> DataFrame:
    """Of records that repeat an id the first one by set, page and place; of a stream, the first one so far (output mode complete or update)."""
    rest = [c for c in records.columns if c not in ("id", "set", "page", "place")]
    first = F.min(F.struct("set", "page", "place", *rest)).alias("_first")
    return records.groupBy("id").agg(first).select("id", "_first.set", "_first.page", "_first.place", *(F.col(f"_first.{c}") for c in rest))


def as_papers(records: DataFrame) -> DataFrame:
    """Records in the form of papers."""
    day = F.col("created").cast("string")
    return records.select(
        "id", "title", "abstract", "authors", F.concat(day, F.lit("T00:00:00")).alias("published"), F.concat(day, F.lit("T00:00:00")).alias("updated"), "categories",
        F.replace("id", F.lit("/abs/"), F.lit("/pdf/")).alias("pdf_url"), F.lit("oai_pmh").alias("_fetch_source"), day.alias("created"),
    )


def stream_records(spark: SparkSession, sets: str, client: str, **options: str) -> DataFrame:
    """The sets' records as a stream, a page of each set a batch."""
    register(spark)
    return spark.readStream.format("harvested_records").options(sets=sets, client=client, **options).load()


def with_fallback(spark: SparkSession, search: Callable[[], DataFrame], harvest: Callable[[], DataFrame], path: str) -> DataFrame:
    """What the search gives, written to path; if it fails or gives nothing, the harvest. ``_fetch_source`` names which."""
    for name, source in (("search_api", search), ("oai_pmh", harvest)):
        try:
            source().withColumn("_fetch_source", F.lit(name)).write.mode("overwrite").parquet(path)
        except (PySparkException, OSError) as e:
            if name == "oai_pmh":
                raise
            log.warning("the search failed, harvesting instead: %s", e)
            continue
        found = spark.read.parquet(path)
        if name == "oai_pmh" or not found.isEmpty():
            return found
    raise AssertionError("unreachable")


def capped(papers: DataFrame, most: int) -> tuple[DataFrame, bool]:
    """(the newest ``most`` papers, whether that left any out), the search's own cap."""
    over = papers.limit(most + 1).count() > most
    if over:
        log.warning("more than %d papers in this window", most)
    return papers.orderBy(F.desc("published"), "id").limit(most), over


def read_search(spark: SparkSession, path: str) -> DataFrame:
    """Papers of the search's answers, an Atom entry each."""
    raw = spark.read.format("xml").option("rowTag", "entry").option("ignoreNamespace", True).schema(
        "id string, title string, summary string, published string, updated string, author array<struct<name:string>>, "
        "category array<struct<_term:string>>, link array<struct<_href:string,_title:string>>"
    ).load(path)
    squeeze = lambda c: F.trim(F.regexp_replace(c, r"\s+", " "))
    pdf = F.filter("link", lambda x: x["_title"] == "pdf")
    return raw.where("id IS NOT NULL").select(
        "id", squeeze(F.col("title")).alias("title"), squeeze(F.col("summary")).alias("abstract"), F.transform("author", lambda a: a["name"]).alias("authors"),
        "published", "updated", F.transform("category", lambda c: c["_term"]).alias("categories"), F.get(F.transform(pdf, lambda x: x["_href"]), F.lit(0)).alias("pdf_url"),
        F.lit("search_api").alias("_fetch_source"), F.substring("published", 1, 10).alias("created"),
    )

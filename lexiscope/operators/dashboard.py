"""What the dashboard reads: weeks, the site's tables, calendar bounds, orders and labels."""

from __future__ import annotations

from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from lexiscope import schemas
from lexiscope.functions.labels import name_order, normal_id
from lexiscope.operators import manifest as weekly
from lexiscope.sources.files import exists, read_or_default

LANGUAGES = "array<struct<language:string,count:long>>"
CLASSES = "array<struct<class:int,count:long>>"
DAYS = "array<struct<day:string,papers:long,flagged:long>>"
#: The columns of a manifest's file that are read back.
MANIFEST = (
    "generated_at string, window_days int, query string, week_start string, week_end string, "
    "counts struct<papers:long,flagged_papers:long,unique_languages:long,pdf_failed_no_detection:long>, "
    f"language_counts {LANGUAGES}, class_counts {CLASSES}, daily_series {DAYS}"
)
_SLUG = r"(\d{4})(\d{2})(\d{2})_to_\d{8}"


def empty_manifest(papers: DataFrame, flagged: DataFrame, days: int = 7, query: str = "cat:cs.CL") -> DataFrame:
    """The one row that stands in for a manifest that isn't there: counts of the two tables, and empty lists."""
    a, b = papers.agg(F.count("*").alias("papers")), flagged.agg(F.count("*").alias("flagged_papers"))
    counts = F.struct("papers", "flagged_papers", F.lit(0).cast("long").alias("unique_languages"), F.lit(0).cast("long").alias("pdf_failed_no_detection"))
    none = F.lit(None).cast("string")
    return a.crossJoin(b).select(  # one row each
        none.alias("generated_at"), F.lit(days).alias("window_days"), F.lit(query).alias("query"), none.alias("week_start"), none.alias("week_end"),
        counts.alias("counts"), F.array().cast(LANGUAGES).alias("language_counts"), F.array().cast(CLASSES).alias("class_counts"), F.array().cast(DAYS).alias("daily_series"),
    )


def read_manifest(spark: SparkSession, path: str) -> DataFrame | None:
    return spark.read.schema(MANIFEST).option("multiLine", True).json(path) if exists(spark, path) else None


def all_weeks(spark: SparkSession, root: str) -> DataFrame:
    """A row for each week that has a manifest, in order: counts and lists, 0 and empty where the file lacks them."""
    pattern = f"{root}/weeks/*_to_*/manifest.json"
    if not exists(spark, pattern):
        return spark.createDataFrame([], f"week_start string, week_end string, papers long, flagged_papers long, unique_languages long, language_counts {LANGUAGES}, class_counts {CLASSES}, daily_series {DAYS}")
    files = spark.read.schema(MANIFEST).option("multiLine", True).json(pattern).withColumn("_path", F.col("_metadata.file_path"))
    slug = lambda k: F.regexp_extract("_path", f"/{_SLUG}/manifest.json$", k)
    number = lambda c: F.coalesce(F.col(f"counts.{c}"), F.lit(0)).alias(c)
    filled = lambda c, kind: F.coalesce(c, F.array().cast(kind)).alias(c)
    return files.where(slug(1) != "").select(
        F.concat_ws("-", slug(1), slug(2), slug(3)).alias("week_start"), "week_end", number("papers"), number("flagged_papers"), number("unique_languages"),
        filled("language_counts", LANGUAGES), filled("class_counts", CLASSES), filled("daily_series", DAYS),
    ).orderBy("week_start")


def section_list(sections: Column) -> Column:
    """Sections by name as an array in order of name: source "" and no languages where they are missing."""
    one = lambda e: F.struct(
        e["key"].alias("name"), F.coalesce(e["value"]["source"], F.lit("")).alias("source"),
        F.coalesce(e["value"]["detected_languages"], F.array().cast(f"array<{schemas.DETECTION}>")).alias("detected_languages"),
    )
    entries = F.array_sort(F.map_keys(sections))
    listed = F.transform(entries, lambda k: one(F.struct(k.alias("key"), sections[k].alias("value"))))
    return F.coalesce(listed, F.array().cast(f"array<struct<name:string,source:string,detected_languages:array<{schemas.DETECTION}>>>"))


def with_sections(flagged: DataFrame, detected: DataFrame) -> DataFrame:
    """flagged (id, sections as an array, …) with sections of the detected records (paper_id, sections as a map) where its own are missing or empty.

    Ids meet in their normal form. Of records that repeat an id the least stays.
    """
    known = detected.select(normal_id(F.coalesce(F.col("paper.id"), F.col("paper_id"))).alias("_id"), section_list(F.col("sections")).alias("_s"))
    known = known.groupBy("_id").agg(F.min("_s").alias("_s"))
    j = flagged.withColumn("_id", normal_id(F.col("id"))).join(known, "_id", "left")
    own = F.coalesce(F.size("sections"), F.lit(0)) > 0
    empty = section_list(F.lit(None).cast(f"map<string,struct<source:string,detected_languages:array<{schemas.DETECTION}>>>"))
    return j.withColumn("sections", F.when(own, F.col("sections")).otherwise(F.coalesce("_s", empty))).drop("_id", "_s")


def site_data(spark: SparkSession, root: str, flagged: DataFrame, detected: DataFrame, papers: DataFrame, week: str | None = None, days: int = 7) -> dict[str, DataFrame]:
    """The tables of a page: manifest (an empty one if its file isn't there), reference lists, flagged papers with sections, coverage, counts, top languages."""
    path = f"{root}/weeks/{week}/manifest.json" if week else f"{root}/manifest_last_{days}_days.json"
    own = read_manifest(spark, path)
    shown = with_sections(flagged, detected)
    languages = shown.select("id", F.explode("languages").alias("x")).select("id", F.col("x.language").alias("language")).distinct()
    counts = weekly.language_counts(languages)
    return {
        "manifest": own if own is not None else empty_manifest(papers, flagged, days),
        "language_data": read_or_default(spark, f"{root}/language_data.json", schemas.LANGUAGE_DATA, lines=False),
        "flagged": shown, "coverage": weekly.coverage_stats(shown), "language_counts": counts, "top_languages": top_colours(counts),
    }


def week_available(day: Column, earliest: Column, latest: Column) -> Column:
    """Whether the week of a day lies between the first and the last one with data, compared as ISO dates."""
    return F.date_format(F.date_trunc("week", day), "yyyy-MM-dd").between(F.date_format(earliest, "yyyy-MM-dd"), F.date_format(latest, "yyyy-MM-dd"))


def week_neighbours(start: Column, earliest: Column, latest: Column) -> Column:
    """struct(previous, next): the weeks beside one, null where there is no data any more."""
    before, after = F.date_sub(start, 7), F.date_add(start, 7)
    return F.struct(F.when(before >= earliest, before).alias("previous"), F.when(after <= latest, after).alias("next"))


def last_monday(ts: Column, zone: str | None = None) -> Column:
    """The latest Monday, 0:00, of a moment in UTC, in a time zone or in UTC; a Monday is its own."""
    return F.date_trunc("week", F.from_utc_timestamp(ts, zone) if zone else ts)


def day_label(day: Column) -> Column:
    return F.date_format(day, "d MMM")


def weekday_label(day: Column) -> Column:
    return F.date_format(day, "EEE")


def long_date(day: Column) -> Column:
    """Empty for null."""
    return F.coalesce(F.date_format(day, "MMMM d, yyyy"), F.lit(""))


def range_label(first: Column, last: Column) -> Column:
    end = F.coalesce(last, first)
    return F.when(first.isNull() | end.isNull(), F.lit("the current window")).otherwise(F.concat(F.lit("The Week of "), day_label(first), F.lit("–"), day_label(end)))


def period_label(start: Column, granularity: str) -> Column:
    return {"week": day_label(start), "month": F.date_format(start, "MMM yyyy"), "year": F.date_format(start, "yyyy")}[granularity]


def top_colours(counts: DataFrame, n: int = 12) -> DataFrame:
    """The first n of (language, count), most frequent first, then by name, with the index of their colour."""
    top = counts.orderBy(F.desc("count"), name_order(F.col("language")), "language").limit(n)
    return top.withColumn("color_index", F.row_number().over(Window.orderBy(F.desc("count"), name_order(F.col("language")), "language")) - 1)  # n rows


def bump_order(ranked: DataFrame, totals: DataFrame) -> DataFrame:
    """(language, total) of the languages that any period ranks, by total, then name."""
    return ranked.select("language").distinct().join(totals, "language", "left").select("language", F.coalesce("total", F.lit(0)).cast("long").alias("total")).orderBy(F.desc("total"), "language")


def class_order(counts: DataFrame) -> DataFrame:
    """(class, count) above 0, most frequent first, then by class."""
    return counts.where("count > 0").orderBy(F.desc("count"), "class")


def active_chip(counts: DataFrame, query: str, active: str) -> DataFrame:
    """The names that a search leaves, and whether the active one is still among them; if not, "all" is active."""
    found = counts.where(F.contains(F.lower("language"), F.lit(query.strip().lower())))
    there = found.agg(F.coalesce(F.bool_or(F.col("language") == active), F.lit(False)).alias("_there"))
    return found.crossJoin(there).select("language", "count", F.when(F.col("_there"), F.lit(active)).otherwise(F.lit("all")).alias("active"))  # one row


# ---- counters of the notebooks

def section_counts(records: DataFrame, n: int | None = None) -> DataFrame:
    """(name, count) of sections with a detection over records (sections as an array); the n most frequent, if asked for."""
    out = records.select(F.explode("sections").alias("s")).where(F.size("s.detected_languages") > 0).groupBy(F.col("s.name").alias("name")).agg(F.count("*").alias("count"))
    return out.orderBy(F.desc("count"), "name").limit(n) if n else out


def mention_counts(records: DataFrame, n: int | None = None) -> DataFrame:
    """(language, count) of all detections, repeated ones too; a detection without a name counts as Unknown."""
    names = records.select(F.explode("sections").alias("s")).select(F.explode("s.detected_languages").alias("d"))
    out = names.groupBy(F.coalesce("d.language", F.lit("Unknown")).alias("language")).agg(F.count("*").alias("count"))
    return out.orderBy(F.desc("count"), name_order(F.col("language")), "language").limit(n) if n else out


def detection_totals(records: DataFrame) -> DataFrame:
    """One row: records with sections, detections in them, and kinds of sections with any."""
    sizes = F.transform("sections", lambda s: F.size(s["detected_languages"]))
    total = F.aggregate(sizes, F.lit(0).cast("long"), lambda a, x: a + x)
    a = records.agg(F.count_if(F.size("sections") > 0).alias("papers"), F.coalesce(F.sum(total), F.lit(0)).alias("detections"))
    return a.crossJoin(section_counts(records).agg(F.count("*").alias("section_kinds")))  # one row each


def unique_names(gazetteer: DataFrame) -> DataFrame:
    return gazetteer.agg(F.count_distinct("language").alias("unique_languages"))


def coded_names(texts: DataFrame, codes: DataFrame, key: str, columns: tuple[str, ...], not_names: tuple[str, ...] = (), least: int = 4) -> DataFrame:
    """(key, name, code): names (of at least so many characters, with a code) that stand as words in any of the columns, in any case.

    codes: name, code. Names of one word meet the texts' distinct words in an equi-join; of others, the first word
    does, and the whole name is looked for in the texts of that word alone.
    """
    names = codes.where((F.length("name") >= least) & (F.coalesce(F.col("code"), F.lit("")) != "") & ~F.col("name").isin(list(not_names))).distinct()
    words = lambda c: F.regexp_extract_all(F.lower(c), F.lit(r"([\p{L}\p{N}_]+)"), F.lit(1))
    own = F.array_distinct(F.concat(*(words(F.coalesce(F.col(c), F.lit(""))) for c in columns)))
    first = names.withColumn("word", F.get(words(F.col("name")), F.lit(0))).withColumn("one", F.lower("name") == F.col("word"))
    near = texts.select(key, F.explode(own).alias("word")).join(first, "word")
    whole = near.where("NOT one").join(texts.select(key, *columns), key)
    pattern = F.concat(F.lit(r"(?iu)(?<![\p{L}\p{N}_])\Q"), F.col("name"), F.lit(r"\E(?![\p{L}\p{N}_])"))
    there = reduce(or_, (F.coalesce(F.regexp_like(F.col(c), pattern), F.lit(False)) for c in columns))
    return near.where("one").select(key, "name", "code").union(whole.where(there).select(key, "name", "code")).distinct()

"""A week from start to end: papers, stored pages, screening, results, manifest; weeks in a row, and repeats on what is stored.

A week lies below one root:

    papers/week=S/                 papers as JSON lines
    html_cache/, pdf_cache/        keyed Parquet tables (see sources.sinks)
    processed/detected/week=S/     papers with languages; no_detections and warnings beside it
    screening_warnings/week=S/     places that the acronym veto took out
    weeks/S/manifest.json          the manifest, and its copy manifest_last_N_days.json at the root

S is the week's slug. A week that has a manifest is left as it is unless it is to be made again; papers
that were fetched before aren't fetched again.
"""

from __future__ import annotations

from collections.abc import Callable
from datetime import date, timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lexiscope import schemas
from lexiscope.functions.labels import safe_id
from lexiscope.operators import assembly, manifest
from lexiscope.operators.gazetteer import from_language_data
from lexiscope.operators.html import REMOVE_HEADINGS
from lexiscope.plans import weekly
from lexiscope.sources import files, harvest, sinks

#: The three reference lists: gazetteer, ignore list, review list.
Lists = tuple[DataFrame, DataFrame, DataFrame]


def slug(start: date, end: date) -> str:
    return f"{start:%Y%m%d}_to_{end:%Y%m%d}"


def read_lists(spark: SparkSession, path: str) -> Lists:
    return from_language_data(files.read_language_data(spark, path))


def week_papers(spark: SparkSession, root: str, week: str, fetch: Callable[[], DataFrame] | None) -> DataFrame:
    """The week's papers: stored ones, else what fetch gives, stored; an error if there is neither."""
    stored = f"{root}/papers/week={week}"
    if not files.exists(spark, f"{stored}/*"):
        if fetch is None:
            raise FileNotFoundError(f"no papers of {week} in {root}/papers")
        sinks.write_papers(fetch(), f"{root}/papers", week)
    return files.read_jsonl(spark, stored).where("id IS NOT NULL")


def candidates(spark: SparkSession, root: str, papers: DataFrame) -> DataFrame:
    """Papers with what the caches hold of them (see choose_sources); a cache that isn't there holds nothing."""
    own = papers.select(F.col("id").alias("paper_id"), safe_id(F.col("id")).alias("safe_id"), "abstract", F.to_date(F.substring("published", 1, 10)).alias("day"))
    html = spark.createDataFrame([], f"safe_id string, html_sections {weekly.SECTIONS}, html_complete boolean")
    pdf = spark.createDataFrame([], "safe_id string, pdf_text string")
    if files.exists(spark, f"{root}/html_cache/part=*"):
        there = sinks.read_cache(spark, f"{root}/html_cache").where("NOT unavailable")
        html = there.select("safe_id", F.transform("sections", lambda s: F.struct(s["title"].alias("title"), s["text"].alias("text"))).alias("html_sections"), F.col("complete").alias("html_complete"))
    if files.exists(spark, f"{root}/pdf_cache/part=*"):
        pdf = sinks.read_cache(spark, f"{root}/pdf_cache").select("safe_id", F.col("body_text").alias("pdf_text"))
    return own.join(html, "safe_id", "left").join(pdf, "safe_id", "left")


def run_week(
    spark: SparkSession, root: str, start: date, end: date, lists: Lists, fetch: Callable[[], DataFrame] | None = None, query: str = "",
    headings: tuple[str, ...] = REMOVE_HEADINGS, again: bool = False,
) -> dict[str, int] | None:
    """Screens a week and writes all of its outputs; the run's statistics, or None if the week is there already.

    ``again`` repeats a week on what is stored: sections without text don't count, and none is left out for its heading.
    """
    week, days = slug(start, end), (end - start).days
    if not again and files.exists(spark, f"{root}/weeks/{week}/manifest.json"):
        return None
    papers = week_papers(spark, root, week, fetch)
    found = candidates(spark, root, papers)
    if again:
        found, headings = weekly.stored_candidates(found), ()
    out = weekly.run_week(found, *lists, headings)
    languages = out.merged.groupBy("paper_id").agg(F.array_sort(F.collect_list(F.struct("language", "class", "needs_review", "flag_reason", "sources"))).alias("languages"))
    titled = out.checked.join(papers.select(F.col("id").alias("paper_id"), "title"), "paper_id", "left")
    detected, none = titled.join(languages, "paper_id"), titled.join(languages, "paper_id", "left_anti")
    files.write_results(detected, none, out.warnings, f"{root}/processed", week)
    if not out.vetoes.isEmpty():
        files.write_week(out.vetoes, f"{root}/screening_warnings", week)
    row = manifest.manifest(found.select("paper_id", "day"), out.merged, none, str(start), str(end), query, days)
    sinks.write_manifest(manifest.public_columns(row), root, week, days)
    return out.stats


def run_weeks(spark: SparkSession, root: str, first: date, last: date, lists: Lists, fetch: Callable[[date, date], DataFrame] | None = None, days: int = 7, **more) -> dict[str, dict[str, int] | None]:
    """run_week() of each window of ``days`` that begins from first on and ends by last; statistics by slug."""
    out = {}
    while first + timedelta(days) <= last:
        end = first + timedelta(days)
        one = (lambda a=first, b=end: fetch(a, b)) if fetch else None
        out[slug(first, end)] = run_week(spark, root, first, end, lists, one, **more)
        first = end
    return out


def retry_week(spark: SparkSession, root: str, start: date, end: date, lists: Lists) -> tuple[int, int]:
    """Screens a stored week's papers again that lack something (see needs_retry), and rewrites its results; (detected, undetected)."""
    week = slug(start, end)
    read = lambda name: spark.read.schema(RESULT).json(f"{root}/processed/{name}/week={week}") if files.exists(spark, f"{root}/processed/{name}/week={week}") else spark.createDataFrame([], RESULT)
    found = candidates(spark, root, week_papers(spark, root, week, None))
    html = found.where("html_sections IS NOT NULL").select("safe_id", F.coalesce("html_complete", F.lit(True)).alias("complete"))
    pdf = found.where("pdf_text IS NOT NULL").select("safe_id")
    old = read("detected")
    again = assembly.needs_retry(found.select("paper_id", "safe_id"), assembly.detected_by_id(old), html, pdf)
    out = weekly.run_week(found.join(again.select("paper_id"), "paper_id", "left_semi"), *lists)
    languages = out.merged.groupBy("paper_id").agg(F.array_sort(F.collect_list(F.struct("language", "class", "needs_review", "flag_reason", "sources"))).alias("languages"))
    new = out.checked.join(languages, "paper_id", "left").join(read("no_detections").unionByName(old).select("paper_id", "title").distinct(), "paper_id", "left")
    new = new.select("paper_id", "title", "sources_checked", "warnings", "n_detections", "languages")
    detected, none = weekly.retry_week(old, new.where("languages IS NOT NULL"), read("no_detections"), new.where("languages IS NULL"))
    files.write_results(weekly.written(detected, "retried"), weekly.written(none, "retried"), out.warnings, f"{root}/processed", week)
    return tuple(spark.read.schema(RESULT).json(f"{root}/processed/{n}/week={week}").count() if files.exists(spark, f"{root}/processed/{n}/week={week}") else 0 for n in ("detected", "no_detections"))


RESULT = "paper_id string, title string, sources_checked array<string>, warnings array<string>, n_detections long, languages array<struct<language:string,class:int,needs_review:boolean,flag_reason:string,sources:array<string>>>"


def stored_papers(spark: SparkSession, pattern: str) -> Callable[[], DataFrame]:
    """Papers of the newest file that fits a pattern, as a fetch for run_week()."""
    path = files.latest_file(spark, pattern)
    if path is None:
        raise FileNotFoundError(pattern)
    return lambda: files.read_jsonl(spark, path, schemas.PAPER)


def harvested_papers(spark: SparkSession, root: str, sets: str, client: str, search: Callable[[], DataFrame] | None = None, **options: str) -> Callable[[date, date], DataFrame]:
    """A fetch for run_weeks(): the search if there is one, else (or if it fails or is empty) the harvest of the window."""

    def fetch(start: date, end: date) -> DataFrame:
        records = lambda: harvest.as_papers(harvest.harvest_records(spark, sets, client, str(end), (end - start).days, **options))
        if search is None:
            return records()
        return harvest.with_fallback(spark, search, records, f"{root}/fetched/{slug(start, end)}")

    return fetch

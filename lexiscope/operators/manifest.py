"""Weekly counts: languages, classes, days, totals; the manifest as one row."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def language_counts(merged: DataFrame) -> DataFrame:
    """(language, count) of papers; merged has a row for each paper, language and class. Blank names go."""
    return merged.where("trim(language) <> ''").groupBy("language").agg(F.count("*").alias("count"))


def class_counts(merged: DataFrame) -> DataFrame:
    return merged.groupBy("class").agg(F.count("*").alias("count"))


def daily_series(papers: DataFrame, flagged: DataFrame, day: str = "day") -> DataFrame:
    """(day, papers, flagged) of the days of either table; null days go."""
    both = papers.select(day, F.lit(1).alias("p"), F.lit(0).alias("f")).union(flagged.select(day, F.lit(0), F.lit(1)))
    return both.where(F.col(day).isNotNull()).groupBy(day).agg(F.sum("p").alias("papers"), F.sum("f").alias("flagged"))


def counts_block(papers: DataFrame, merged: DataFrame, no_detections: DataFrame) -> DataFrame:
    """One row: papers, flagged_papers, unique_languages, pdf_failed_no_detection."""
    a = papers.agg(F.count("*").alias("papers"))
    b = merged.agg(F.count_distinct("paper_id").alias("flagged_papers"), F.count_distinct("language").alias("unique_languages"))
    c = no_detections.agg(F.count_if(F.array_contains("sources_checked", "pdf_unavailable")).alias("pdf_failed_no_detection"))
    return a.crossJoin(b).crossJoin(c)  # one row each


SOURCES = ("abstract", "html", "pdf", "pdf_unavailable")


def stat_columns(sources: tuple[str, ...] = SOURCES) -> list[Column]:
    """Aggregates over (sources_checked, n_detections, failed): totals, and papers for each known source."""
    return [
        F.count(F.lit(1)).alias("total"), F.count_if(F.col("n_detections") > 0).alias("with_detections"),
        F.coalesce(F.sum("n_detections"), F.lit(0)).alias("detections"), F.count_if("failed").alias("failed"),
        *(F.count_if(F.array_contains("sources_checked", s)).alias(s) for s in sources),
    ]


def run_stats(results: DataFrame, sources: tuple[str, ...] = SOURCES) -> DataFrame:
    """One row of stat_columns()."""
    return results.agg(*stat_columns(sources))


def coverage_stats(flagged: DataFrame, sources: str = "sources_checked") -> DataFrame:
    """(coverage, count): html before pdf before abstract only."""
    kind = F.when(F.array_contains(sources, "html"), "html").when(F.array_contains(sources, "pdf"), "pdf").otherwise("abstract_only")
    return flagged.select(kind.alias("coverage")).groupBy("coverage").agg(F.count("*").alias("count"))


def paper_facts(papers: DataFrame, merged: DataFrame, no_detections: DataFrame) -> DataFrame:
    """(paper_id, day, language, class, listed, failed, first): a row for each paper and detection, one with nulls for a paper without.

    papers: paper_id (a row for each paper), day; merged: paper_id, language, class; no_detections: paper_id, sources_checked.
    ``first`` marks one row of each paper, so that papers are counted by rows.
    """
    p = papers.select("paper_id", "day", F.lit(True).alias("listed"))
    failed = no_detections.where(F.array_contains("sources_checked", "pdf_unavailable")).select("paper_id", F.lit(True).alias("failed")).distinct()
    rows = p.join(merged.select("paper_id", "language", "class"), "paper_id", "full").join(failed, "paper_id", "full")
    place = Window.partitionBy("paper_id").orderBy("language", "class")
    return rows.withColumns({"first": F.row_number().over(place) == 1, "listed": F.coalesce("listed", F.lit(False)), "failed": F.coalesce("failed", F.lit(False))})


def summary(facts: DataFrame) -> DataFrame:
    """(kind, language, class, day, detections, papers, flagged, failed) by language, class and day and of all rows, in one pass over facts.

    kind is grouping_id: 3 a language's row, 5 a class's, 6 a day's, 7 the one of all.
    """
    flagged = F.col("first") & F.col("language").isNotNull()
    return facts.groupingSets([["language"], ["class"], ["day"], []], "language", "class", "day").agg(
        F.grouping_id().cast("int").alias("kind"), F.count("language").alias("detections"), F.count_if(F.col("first") & F.col("listed")).alias("papers"),
        F.count_if(flagged).alias("flagged"), F.count_if(F.col("first") & F.col("failed")).alias("failed"),
    ).where("kind <> 3 OR language IS NOT NULL").where("kind <> 5 OR class IS NOT NULL").where("kind <> 6 OR day IS NOT NULL")


def manifest(papers: DataFrame, merged: DataFrame, no_detections: DataFrame, week_start: str, week_end: str, query: str, days: int = 7) -> DataFrame:
    """The manifest's summary as one row (see paper_facts for the tables). Lists are of languages, classes and days alone."""
    s = summary(paper_facts(papers, merged, no_detections))
    named = (F.col("kind") == 3) & (F.trim("language") != "")
    total = lambda c: F.coalesce(F.max(F.when(F.col("kind") == 7, F.col(c))), F.lit(0))
    listed = lambda when, *fields: F.array_sort(F.collect_list(F.when(when, F.struct(*fields))))
    row = s.agg(  # of a row for each language, class and day
        F.struct(total("papers").alias("papers"), total("flagged").alias("flagged_papers"), F.count_if(F.col("kind") == 3).alias("unique_languages"), total("failed").alias("pdf_failed_no_detection")).alias("counts"),
        listed(named, (-F.col("detections")).alias("_o"), "language", F.col("detections").alias("count")).alias("language_counts"),
        listed(F.col("kind") == 5, "class", F.col("detections").alias("count")).alias("class_counts"),
        listed(F.col("kind") == 6, "day", "papers", "flagged").alias("daily_series"),
    )
    head = [F.current_timestamp().alias("generated_at"), F.lit(days).alias("window_days"), F.lit(week_start).alias("week_start"), F.lit(week_end).alias("week_end"), F.lit(query).alias("query")]
    return row.withColumn("language_counts", F.transform("language_counts", lambda x: x.dropFields("_o"))).select(*head, "*")


PRIVATE = ("text", "cleaned_text", "body_text", "screened_text", "html")


def public_columns(df: DataFrame) -> DataFrame:
    """df without any text of HTML or PDF."""
    return df.drop(*PRIVATE)

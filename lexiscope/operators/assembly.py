"""Evidence of several sources in one record for each paper, and incremental upserts."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lexiscope.functions.labels import safe_id


def merge_detections(detections: DataFrame, paper: str = "paper_id") -> DataFrame:
    """A row for each paper, language and class from (paper, source, language, class, needs_review, flag_reason, ord).

    Attributes are those of the first row; sources are distinct, in the order in which they first
    come up. Null languages go.
    """
    rows = detections.where("language IS NOT NULL")
    firsts = rows.groupBy(paper, "language", "class", "source").agg(F.min(F.struct("ord", "needs_review", "flag_reason")).alias("f"))
    return firsts.groupBy(paper, "language", "class").agg(
        F.min("f.ord").alias("ord"), F.min_by("f.needs_review", "f.ord").alias("needs_review"), F.min_by("f.flag_reason", "f.ord").alias("flag_reason"),
        F.transform(F.array_sort(F.collect_list(F.struct("f.ord", "source"))), lambda s: s["source"]).alias("sources"),
    )


def sources_checked(papers: DataFrame, html_ids: DataFrame, pdf_ids: DataFrame, complete_only: bool = False) -> DataFrame:
    """papers with sources_checked: abstract always, html and pdf where the caches have the paper.

    html_ids (safe_id, complete), pdf_ids (safe_id); complete_only leaves partial HTML out.
    """
    html = html_ids.where("complete") if complete_only else html_ids
    h = html.select("safe_id", F.lit("html").alias("_html")).distinct()
    p = pdf_ids.select("safe_id", F.lit("pdf").alias("_pdf")).distinct()
    out = papers.withColumn("safe_id", safe_id(F.col("id"))).join(h, "safe_id", "left").join(p, "safe_id", "left")
    return out.withColumn("sources_checked", F.array_compact(F.array(F.lit("abstract"), "_html", "_pdf"))).drop("_html", "_pdf")


def html_unavailable(present, complete, n_sections):
    """Null, incomplete, or without any section."""
    return ~F.coalesce(present, F.lit(False)) | ~F.coalesce(complete, F.lit(True)) | (F.coalesce(n_sections, F.lit(0)) == 0)


def choose_sources(candidates: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    """The fallback chain: (paper_id, source, text, warning) rows to screen, with the columns ``keep`` of the candidate.

    candidates: paper_id, abstract, html_sections (array of title and text), html_complete, pdf_text.
    The abstract always; complete HTML with sections; else the PDF; else what there is of the HTML.
    """
    n = F.size(F.coalesce("html_sections", F.array().cast("array<struct<title:string,text:string>>")))
    bad = html_unavailable(F.col("html_sections").isNotNull(), F.col("html_complete"), n)
    pdf = F.coalesce(F.col("pdf_text"), F.lit("")) != ""
    text = F.array_join(F.transform("html_sections", lambda s: s["text"]), "\n\n")
    picked = F.array_compact(
        F.array(
            F.struct(F.lit("abstract").alias("source"), F.coalesce("abstract", F.lit("")).alias("text"), F.lit(None).cast("string").alias("warning")),
            F.when(~bad, F.struct(F.lit("html").alias("source"), text.alias("text"), F.lit(None).cast("string").alias("warning")))
            .when(pdf, F.struct(F.lit("pdf").alias("source"), F.col("pdf_text").alias("text"), F.lit(None).cast("string").alias("warning")))
            .when(n > 0, F.struct(F.lit("html").alias("source"), text.alias("text"), F.lit("partial_html").alias("warning")))
            .otherwise(F.struct(F.lit("pdf_unavailable").alias("source"), F.lit("").alias("text"), F.lit("pdf_unavailable").alias("warning"))),
        )
    )
    return candidates.select("paper_id", *keep, F.inline(picked))


def needs_retry(papers: DataFrame, detected: DataFrame, html_cache: DataFrame, pdf_cache: DataFrame) -> DataFrame:
    """Papers (safe_id, …) that are to be screened again.

    detected (safe_id, sources_checked); html_cache (safe_id, complete); pdf_cache (safe_id). A paper
    is taken if it was never detected, if its PDF is there but neither pdf nor html is recorded, if
    nothing of it is cached, or if its HTML is there, not recorded and incomplete.
    """
    d = detected.groupBy("safe_id").agg(F.flatten(F.collect_list("sources_checked")).alias("_s"))
    h = html_cache.groupBy("safe_id").agg(F.bool_and("complete").alias("_complete"))
    p = pdf_cache.select("safe_id", F.lit(True).alias("_pdf")).distinct()
    j = papers.join(d, "safe_id", "left").join(h, "safe_id", "left").join(p, "safe_id", "left")
    has = lambda s: F.coalesce(F.array_contains("_s", s), F.lit(False))
    html, pdf = F.col("_complete").isNotNull(), F.coalesce("_pdf", F.lit(False))
    again = (
        F.col("_s").isNull() | (pdf & ~has("pdf") & ~has("html")) | (~html & ~pdf)
        | (html & ~has("html") & ~F.coalesce("_complete", F.lit(True)))
    )
    return j.where(again).drop("_s", "_complete", "_pdf")


def _hashable(records: DataFrame, column: str):
    """A column as xxhash64 takes it, which knows no maps."""
    kind = records.schema[column].dataType
    if isinstance(kind, T.MapType) and "map<" not in kind.valueType.simpleString():
        return F.map_entries(column)
    return F.to_json(F.struct(F.col(column))) if "map<" in kind.simpleString() else F.col(column)


def _one_of_each(records: DataFrame, key: str, best: tuple = ()) -> DataFrame:
    """A record for each key: of those that repeat it the first by ``best``, then by a hash of all its values. A null key is a key."""
    columns = records.columns
    order = F.struct(*best, F.xxhash64(*(_hashable(records, c) for c in columns)).alias("_hash"))
    return records.groupBy(key).agg(F.min_by(F.struct(*columns), order).alias("r")).select("r.*")


def _richer(sources):
    return F.coalesce(F.array_contains(sources, "html") | F.array_contains(sources, "pdf"), F.lit(False))


def upsert_detected(old: DataFrame, new: DataFrame, key: str = "paper_id") -> DataFrame:
    """old with new ids added; a record is replaced only if the new one read html or pdf and the old one neither.

    Of records that repeat an id on a side one counts: one that read html or pdf, if any did.
    """
    best = ((~_richer(F.col("sources_checked"))).alias("_poorer"),)
    o = _one_of_each(old, key, best).select(key, F.struct(*old.columns).alias("_old"))
    n = _one_of_each(new, key, best).select(key, F.struct(*old.columns).alias("_new"))
    take_new = F.col("_old").isNull() | (F.col("_new").isNotNull() & _richer(F.col("_new.sources_checked")) & ~_richer(F.col("_old.sources_checked")))
    return o.join(n, key, "full").select(F.when(take_new, F.col("_new")).otherwise(F.col("_old")).alias("r")).select("r.*")


def merge_no_detections(old: DataFrame, new: DataFrame, detected: DataFrame, key: str = "paper_id") -> DataFrame:
    """old without ids that are now detected, records replaced by new ones, and ids that weren't there; an id that repeats on a side counts once."""
    o = _one_of_each(old, key).select(key, F.struct(*old.columns).alias("_old"))
    n = _one_of_each(new, key).select(key, F.struct(*old.columns).alias("_new"))
    merged = o.join(n, key, "full").select(key, F.coalesce("_new", "_old").alias("r"))
    return merged.join(detected.select(key).distinct(), key, "left_anti").select("r.*")


def append_warnings(old: DataFrame, new: DataFrame) -> DataFrame:
    return old.unionByName(new, allowMissingColumns=True)


def first_by_id(records: DataFrame, arrival: str, key: str = "id") -> DataFrame:
    """The record that arrived first for each id."""
    return records.groupBy(key).agg(F.min_by(F.struct(*records.columns), arrival).alias("r")).select("r.*")


def detected_by_id(detected: DataFrame) -> DataFrame:
    return detected.select(safe_id(F.col("paper_id")).alias("safe_id"), "sources_checked")

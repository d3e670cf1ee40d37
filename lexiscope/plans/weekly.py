"""The weekly pipeline as one plan: choose sources, screen, merge, count; and its repeats on stored text."""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from lexiscope.functions.cleaning import clean_blocks, paper_acronyms
from lexiscope.operators import assembly, manifest, screening
from lexiscope.operators.gazetteer import build_detections, drop_ignored
from lexiscope.operators.html import REMOVE_HEADINGS, skip_sections
from lexiscope.staging import written

#: Order of evidence where it is merged.
ORDER = {"abstract": 0, "html": 1, "pdf": 2}
SECTIONS = "array<struct<title:string,text:string>>"


def source_texts(candidates: DataFrame, headings: tuple[str, ...] = REMOVE_HEADINGS) -> tuple[DataFrame, DataFrame]:
    """(texts to screen: paper_id, source, section, title, text, given acronyms; sources_checked and warnings of each paper).

    Abstracts and PDFs are screened without acronyms of other parts. HTML goes section by section, each with
    the acronyms that the whole paper defines; sections with one of the headings are left out (after the
    acronyms were looked for).
    """
    chosen = assembly.choose_sources(candidates, ("html_sections",))
    checked = chosen.groupBy("paper_id").agg(
        F.array_sort(F.collect_set("source")).alias("sources_checked"), F.array_sort(F.collect_set("warning")).alias("warnings")
    )
    none = F.array().cast("array<string>")
    whole = chosen.where("source IN ('abstract', 'pdf')").select("paper_id", "source", F.lit(0).alias("section"), F.lit(None).cast("string").alias("title"), "text", none.alias("given"))
    html = chosen.where("source = 'html'").withColumn("given", paper_acronyms(F.col("text")))
    parts = html.select("paper_id", "source", "given", F.posexplode("html_sections").alias("section", "s"))
    parts = parts.select("paper_id", "source", "section", F.coalesce("s.title", F.lit("")).alias("title"), F.coalesce("s.text", F.lit("")).alias("text"), "given")
    return whole.unionByName(skip_sections(parts, headings) if headings else parts), checked


def screen_papers(
    candidates: DataFrame, gazetteer: DataFrame, ignore: DataFrame, review: DataFrame, headings: tuple[str, ...] = REMOVE_HEADINGS
) -> tuple[DataFrame, DataFrame]:
    """(detections with paper_id, source, section, title, ord; sources_checked and warnings of each paper) of candidates (see choose_sources).

    A section's title is a block of its own before the others, as it stands.
    """
    rows, checked, _, _, _ = _screened(candidates, gazetteer, ignore, review, headings)
    return rows, checked


def _screened(candidates, gazetteer, ignore, review, headings):
    """Detections, sources_checked, stored blocks, the names found in them before the veto (stored too), and the stored texts with the acronyms that they were given."""
    texts, checked = source_texts(candidates, headings)
    texts = written(texts, "texts")  # blocks, titles and warnings read them, and a paper's acronyms are made once
    keys = ["paper_id", "source", "section"]
    blocks = clean_blocks(texts.select(*keys, "text", "given"), "text", "given").select(*keys, "block_idx", "block")
    titles = texts.where("title <> ''").select(*keys, F.lit(-1).alias("block_idx"), F.col("title").alias("block"))
    stored = written(blocks.union(titles), "blocks")
    own = [*keys, "block_idx"]
    found = written(screening.match_names(stored, drop_ignored(gazetteer, ignore), own), "found")
    kept = screening.without_acronyms(found, stored, own).select(*own, "language")
    rows = build_detections(kept, gazetteer, review, ignore)
    order = F.create_map(*(F.lit(x) for pair in ORDER.items() for x in pair))[F.col("source")]
    place = F.struct(order.alias("source"), "section", "block_idx", "language")
    return rows.withColumn("ord", place), checked, stored, found, texts


def weekly_manifest(papers: DataFrame, candidates: DataFrame, gazetteer: DataFrame, ignore: DataFrame, review: DataFrame, start: str, end: str, query: str) -> DataFrame:
    """The manifest of a week; papers have paper_id (a row for each) and day."""
    rows, checked = screen_papers(candidates, gazetteer, ignore, review)
    merged = written(assembly.merge_detections(rows), "merged")
    none = checked.join(merged.select("paper_id").distinct(), "paper_id", "left_anti")
    return manifest.manifest(papers, merged, none, start, end, query)


class Week(NamedTuple):
    """A run's outputs: detections merged by paper, what was checked, warnings, vetoed places, statistics."""

    merged: DataFrame
    checked: DataFrame
    warnings: DataFrame
    vetoes: DataFrame
    stats: dict[str, int]


def run_week(candidates: DataFrame, gazetteer: DataFrame, ignore: DataFrame, review: DataFrame, headings: tuple[str, ...] = REMOVE_HEADINGS) -> Week:
    """Screens a week's papers once and writes all that comes out of it.

    Blocks and the names in them are stored and feed detections and vetoes. Warnings are acronyms that a paper's HTML defines
    and that are names too. Statistics are observed while results are written, not counted afterwards.
    """
    rows, checked, blocks, named, texts = _screened(candidates, gazetteer, ignore, review, headings)
    keys = ["paper_id", "source", "section", "block_idx"]
    merged = written(assembly.merge_detections(rows), "week-merged")
    given = texts.where("source = 'html'").select("paper_id", F.explode("given").alias("acronym")).distinct()
    warnings = written(screening.conflicts_of(given, gazetteer, ignore).withColumn("step", F.lit("acronym_conflict")), "week-warnings")
    vetoes = written(screening.warnings_of(named, blocks, "paper_id", keys), "week-vetoes")
    found = merged.groupBy("paper_id").agg(F.sum(F.size("sources")).alias("n_detections"))
    results = checked.join(found, "paper_id", "left").withColumns({"n_detections": F.coalesce("n_detections", F.lit(0)), "failed": F.lit(False)})
    seen = Observation("stats")
    stored = written(results.observe(seen, *manifest.stat_columns()), "week-checked")
    return Week(merged, stored.drop("failed"), warnings, vetoes, seen.get)


def detected_records(rows: DataFrame, checked: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(papers with detections: paper_id, sources_checked, warnings, languages; those without)."""
    found = assembly.merge_detections(rows).groupBy("paper_id").agg(F.array_sort(F.collect_set("language")).alias("languages"))
    return checked.join(found, "paper_id"), checked.join(found, "paper_id", "left_anti")


def stored_candidates(candidates: DataFrame) -> DataFrame:
    """Candidates as a repeat on stored text takes them: sections without text don't count, and caches that don't say so are complete.

    So a paper's PDF is taken if no HTML is stored, if it isn't complete, or if none of its sections has text.
    """
    texts = F.filter("html_sections", lambda s: F.coalesce(s["text"], F.lit("")) != "")
    return candidates.withColumns({"html_complete": F.coalesce("html_complete", F.lit(True)), "html_sections": texts})


def reprocess(candidates: DataFrame, gazetteer: DataFrame, ignore: DataFrame, review: DataFrame) -> tuple[DataFrame, DataFrame]:
    """screen_papers on stored text alone: nothing is fetched, and no section is left out."""
    return screen_papers(stored_candidates(candidates), gazetteer, ignore, review, ())


def retry_week(old_detected: DataFrame, new_detected: DataFrame, old_none: DataFrame, new_none: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(detected, none) after papers were screened again."""
    detected = assembly.upsert_detected(old_detected, new_detected)
    return detected, assembly.merge_no_detections(old_none, new_none, detected)


def retry_missing(
    papers: DataFrame, candidates: DataFrame, old_detected: DataFrame, old_none: DataFrame, html_cache: DataFrame, pdf_cache: DataFrame,
    gazetteer: DataFrame, ignore: DataFrame, review: DataFrame,
) -> tuple[DataFrame, DataFrame]:
    """Screens the papers again that need it (see needs_retry; papers have paper_id and safe_id) and merges what comes out."""
    detected = old_detected.join(papers.select("paper_id", "safe_id"), "paper_id").select("safe_id", "sources_checked")
    again = assembly.needs_retry(papers, detected, html_cache, pdf_cache)
    rows, checked = screen_papers(candidates.join(again.select("paper_id"), "paper_id", "left_semi"), gazetteer, ignore, review)
    return retry_week(old_detected, *_in_turn(detected_records(rows, checked), old_none))


def _in_turn(new: tuple[DataFrame, DataFrame], old_none: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    return new[0], old_none, new[1].withColumn("languages", F.array().cast("array<string>")).select(*old_none.columns)

"""The paper table: search, filters, sorts, and what a row shows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lexiscope.operators.numbering import numbered

#: Order of sources in a row; others come last.
SOURCE_ORDER = ("abstract", "html", "pdf")
SORT_MODES = ("default", "languages_desc", "languages_asc", "class_asc", "class_desc", "title_asc", "title_desc")


def search_text(title: Column, authors: Column) -> Column:
    return F.lower(F.concat_ws(" ", title, F.array_join(authors, " ")))


def matches_text(text: Column, term: str) -> Column:
    """Substring, no wildcards; an empty term matches all."""
    return F.contains(text, F.lit(term.strip().lower()))


def matches_language(languages: Column, language: str) -> Column:
    return F.lit(True) if language == "all" else F.coalesce(F.array_contains(languages, language), F.lit(False))


def matches_class(chips: Column, class_: int | None) -> Column:
    return F.lit(True) if class_ is None else F.coalesce(F.exists(chips, lambda c: c["class"] == class_), F.lit(False))


def filter_papers(view: DataFrame, term: str = "", language: str = "all", class_: int | None = None) -> DataFrame:
    """view (search_text, languages, chips) where all three hold."""
    return view.where(matches_text(F.col("search_text"), term) & matches_language(F.col("languages"), language) & matches_class(F.col("chips"), class_))


def visible_count(view: DataFrame, condition: Column) -> DataFrame:
    return view.agg(F.count_if(condition).alias("visible"), F.count("*").alias("total"))


def search_languages(counts: DataFrame, query: str) -> DataFrame:
    return counts.where(F.contains(F.lower("language"), F.lit(query.strip().lower())))


def chips(detections: DataFrame, paper: str = "paper_id") -> DataFrame:
    """(paper, chips, languages, min_class): a paper's languages, class downward, then name; min_class is at most 5."""
    one = detections.groupBy(paper, "language").agg(F.min("class").alias("class"))
    g = one.groupBy(paper).agg(F.array_sort(F.collect_list(F.struct((-F.col("class")).alias("_o"), "language", "class"))).alias("c"))
    return g.select(
        paper, F.transform("c", lambda x: F.struct(x["language"].alias("language"), x["class"].alias("class"))).alias("chips"),
        F.transform("c", lambda x: x["language"]).alias("languages"),
        F.least(F.coalesce(F.array_min(F.transform("c", lambda x: x["class"])), F.lit(5)), F.lit(5)).alias("min_class"),
    )


def with_chips(papers: DataFrame, detections: DataFrame, paper: str = "paper_id") -> DataFrame:
    """papers with their chips; one without any has no languages and is of class 5."""
    out = papers.join(chips(detections, paper), paper, "left")
    return out.withColumn("n_languages", F.size(F.coalesce("languages", F.array().cast("array<string>")))).withColumn("min_class", F.coalesce("min_class", F.lit(5)))


def languages_by_source(detections: DataFrame, paper: str = "paper_id") -> DataFrame:
    """(paper, source, languages, source_order) from exploded sources."""
    order = F.coalesce(F.nullif(F.array_position(F.array(*map(F.lit, SOURCE_ORDER)), F.col("source")), F.lit(0)), F.lit(len(SOURCE_ORDER) + 1))
    return detections.groupBy(paper, "source").agg(F.array_sort(F.collect_set("language")).alias("languages")).withColumn("source_order", order)


def suppressed_languages(warnings: DataFrame, detected: DataFrame, paper: str = "paper_id") -> DataFrame:
    """(paper, language, acronyms) of acronym conflicts whose language wasn't detected anyway."""
    w = warnings.where("step = 'acronym_conflict'").join(detected.select(paper, "language").distinct(), [paper, "language"], "left_anti")
    return w.groupBy(paper, "language").agg(F.array_sort(F.collect_set("acronym")).alias("acronyms"))


def sort_columns(mode: str) -> list[Column]:
    """Columns of one of SORT_MODES (default is the index); ties keep the index, papers without languages are of class 5."""
    least = F.coalesce("min_class", F.lit(5))
    by = {
        "default": [], "languages_desc": [F.desc("n_languages")], "languages_asc": [F.asc("n_languages")], "class_asc": [least.asc()],
        "class_desc": [least.desc()], "title_asc": [F.asc(F.lower("title"))], "title_desc": [F.desc(F.lower("title"))],
    }
    return [*by[mode], F.asc("index")]


def sort_papers(view: DataFrame, mode: str = "default") -> DataFrame:
    return view.orderBy(*sort_columns(mode))


def numbered_papers(view: DataFrame) -> DataFrame:
    """Every row of view once for each of SORT_MODES, with mode and its row_number in it, from 1.

    All modes are numbered together: what a mode sorts by stands in one column for each kind of order.
    """
    least, none = F.coalesce("min_class", F.lit(5)), F.lit(None).cast("string")
    size, title = F.col("n_languages"), F.lower("title")
    by = {"languages_desc": (-size, none, none), "languages_asc": (size, none, none), "class_asc": (least, none, none), "class_desc": (-least, none, none)}
    by |= {"default": (F.lit(0), none, none), "title_asc": (F.lit(0), title, none), "title_desc": (F.lit(0), none, title)}
    keys = F.array(*(F.struct(F.lit(m).alias("mode"), *(c.cast(t).alias(n) for c, t, n in zip(by[m], ("long", "string", "string"), ("_number", "_up", "_down"), strict=True))) for m in SORT_MODES))
    rows = view.select("*", F.inline(keys))
    out = numbered(rows, F.asc("_number"), F.asc("_up"), F.desc("_down"), F.asc("index"), groups=("mode",), name="row_number")
    return out.drop("_number", "_up", "_down")


def class_table(gazetteer: DataFrame) -> DataFrame:
    """(class_id, count, examples): names for each class, and its first two."""
    return gazetteer.groupBy("class_id").agg(F.count("*").alias("count"), F.slice(F.array_sort(F.collect_list("language")), 1, 2).alias("examples"))


def low_class_languages(names: DataFrame, classes: DataFrame, below: int = 5) -> DataFrame:
    """Distinct names of a class below a bound, unknown names counting as 5; sorted by name."""
    return names.select("language").distinct().join(classes, "language", "left").where(F.coalesce("class", F.lit(5)) < below).orderBy("language")


def section_report(detections: DataFrame, paper: str = "paper_id") -> DataFrame:
    """(paper, sections): titles with their languages, in order of title."""
    s = detections.groupBy(paper, "title").agg(F.array_sort(F.collect_set("language")).alias("languages"))
    return s.groupBy(paper).agg(F.array_sort(F.collect_list(F.struct("title", "languages"))).alias("sections"))

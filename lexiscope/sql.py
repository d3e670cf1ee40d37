"""The library's functions in SQL text: table functions for lateral joins, and plain functions that stay in the JVM."""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lexiscope.functions.cleaning import APOSTROPHES, HYPHENS
from lexiscope.operators.gazetteer import TOKEN, drop_ignored, keyed
from lexiscope.operators.html import clean_tree, sections_of

#: Views that the functions read.
NAMES = "lexiscope_names"


@F.udtf(returnType="section_idx int, title string, text string", useArrow=True)
class HtmlSections:
    """html_sections(html[, headings]): a row for each section; headings (an array) are removed with what follows them."""

    def eval(self, html: str, headings: list | None = None) -> Iterator[tuple[int, str, str]]:
        if html is not None:
            for k, (title, text) in enumerate(sections_of(clean_tree(html, tuple(headings or ()))).items()):
                yield k, title, text


def _quoted(text: str) -> str:
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"


_KEY = f"translate(translate(lower(t), {_quoted(APOSTROPHES)}, {_quoted(chr(39) * len(APOSTROPHES))}), {_quoted(HYPHENS)}, {_quoted('-' * len(HYPHENS))})"
_WORDS = f"array_distinct(regexp_extract_all({_KEY}, {_quoted(TOKEN)}, 1))"
#: name(parameters) -> (type, body): functions of one value.
FUNCTIONS = {
    "match_key(t STRING)": ("STRING", _KEY), "words_of(t STRING)": ("ARRAY<STRING>", _WORDS),
    "safe_id(id STRING)": ("STRING", "element_at(split(id, '/'), -1)"), "week_of(day DATE)": ("DATE", "CAST(date_trunc('week', day) AS DATE)"),
    "week_slug(day DATE)": ("STRING", "concat(date_format(day, 'yyyyMMdd'), '_to_', date_format(date_add(day, 7), 'yyyyMMdd'))"),
}


def register(spark: SparkSession, gazetteer: DataFrame | None = None, ignore: DataFrame | None = None) -> None:
    """Makes ``html_sections`` and FUNCTIONS known to a session; with a gazetteer also the table function ``word_mentions(text)``.

    word_mentions gives (language, class_id) of the names of one word in a text, for a lateral join that
    Spark turns into an equi-join on words; ignored names are left out.
    """
    spark.udtf.register("html_sections", HtmlSections)
    for name, (kind, body) in FUNCTIONS.items():
        spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION {name} RETURNS {kind} RETURN {body}")
    if gazetteer is not None:
        names = gazetteer if ignore is None else drop_ignored(gazetteer, ignore)
        keyed(names).where("kind = 'word'").select("token", "language", "class_id").createOrReplaceTempView(NAMES)
        spark.sql(
            f"""CREATE OR REPLACE TEMPORARY FUNCTION word_mentions(t STRING) RETURNS TABLE (language STRING, class_id INT)
            RETURN SELECT n.language, n.class_id FROM explode({_WORDS}) AS w(token) JOIN {NAMES} n ON n.token = w.token"""
        )

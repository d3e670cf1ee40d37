"""Reference lists and literal rows that the registered queries use beside the tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

#: (name, class): single words, words of other scripts' letters, two words, hyphens; one name in two classes.
GAZETTEER = [
    ("Bo", 0), ("Hehe", 0), ("Cora", 0), ("Ha", 1), ("Dem", 1), ("Con", 2), ("Des", 3), ("Éré", 3), ("Für", 4), ("Para", 4),
    ("de la", 2), ("et des", 3), ("of the", 4), ("the and", 5), ("Und", 5), ("Ha", 4), ("heha-of", 5), ("Los", 5),
]
IGNORE = ["the", "en", "to", "as", "are"]
REVIEW = [("Bo", "short name"), ("Ha", "common word"), ("Con", "preposition")]


def lists(spark: SparkSession) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(gazetteer, ignore list, review list), as local rows of the plan."""
    return (
        spark.sql(_values(GAZETTEER, "language, class_id")), spark.sql(_values([(x,) for x in IGNORE], "language_lc")),
        spark.sql(_values(REVIEW, "language, flag_reason")),
    )


def _values(rows: list[tuple], names: str) -> str:
    quoted = ", ".join("(" + ", ".join("'" + v.replace("'", "''") + "'" if isinstance(v, str) else str(v) for v in r) + ")" for r in rows)
    return f"SELECT * FROM (VALUES {quoted}) AS v({names})"


LISTS_SQL = (
    f"gaz AS ({_values(GAZETTEER, 'language, class_id')}), ign AS ({_values([(x,) for x in IGNORE], 'language_lc')}), "
    f"rev AS ({_values(REVIEW, 'language, flag_reason')})"
)

CLEAN_CASES = [
    (1, "Costs are $x_i + 1$ here.\n\nMail a.b@c.org or email: d@e.org now"),
    (2, "Müller et al. (2022) and [Smith et al. 2021] found (see 2019a) 3B and GPT2 at 45 of 3.5"),
    (3, "Mean Absolute Percentage Error (MAPE) is low; MAPE rises.\n\nThe MAPE language is spoken; a far text goes on and on here"),
    (4, "Leave-One-Language-Out (LOLO) and leave-one-out (LOO); LOLO and LOO are used"),
    (5, "\\mathbf{x} and x_{i} and \\color[rgb]{1,0,0} deg ( M ) and rgb col@ = 5\nnext"),
    (6, ""),
    (7, "Ge'ez, Ge’ez and K’iche; N|uu! (Juǀʼhoan)\r\n\r\nno break"),
    (8, "def f(x): col = 3\nreturn col[2]\n\n\n\nend"),
]
ACRONYM_CASES = [
    (1, "We use a Generative Adversarial Network (GAN) for Swahili", "Gan"),
    (2, "we use the name (GAN) here", "Gan"),
    (3, "The Depression Anxiety and Stress Scale (DASS) is used", "Dass"),
    (4, "Point of Interest (POI) and Gan", "Poi"),
    (5, "Scale (DASS)", "Dass"),
    (6, "Feature-Based (FB)", "Fb"),
]
PDF_CASES = [
    (1, "Title\nAnn Author\nAbstract\nShort.\n1. Introduction\nWe study languages and more words here.\n2. Methods\nMany words.\nReferences\n[1] X"),
    (2, "Title\nINTRODUCTION\nBody text follows here and goes on for long enough.\nBibliography\n[1] X"),
    (3, "No marks at all"),
    (4, ""),
    (5, "Funding\nearly matter\nBody body body body body body body body body\nAppendix\nkept"),
]
MARKDOWN_CASES = [(1, "# Title\n\nBody of the text\n\n\n\n## Methods\nMore\n\n## References\n[1] X"), (2, "plain")]
HYPHEN_CASES = [(1, "dura-\ntion"), (2, "anecdo -\ntal"), (3, "anecdo -tal"), (4, "self-aware  and\n\n\n\nstate-of-the-art\x0c ")]
TITLE_CASES = [(1, "3.2Results  and more"), (2, "Appendix ADetails"), (3, "  "), (4, "Introduction"), (5, "2Methods")]
ENTRY_CASES = [(1, '"Gan"'), (2, '["Gan", 3]'), (3, '{"language": "Gan", "class": 2}'), (4, '{"name": "Gan"}'), (5, "Gan")]

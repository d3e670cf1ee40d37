"""The weekly run end to end: sources, skipped headings, acronyms as each source has them, records, repeats."""

import pytest

from lexiscope.plans import weekly

SECTIONS = "array<struct<title:string,text:string>>"
PAPERS = [
    # defines GAN in one section and names it in another; the skipped section names Swahili
    ("html", "Plain abstract.", [("1 Gan Method", "A Generative Adversarial Network (GAN) is used."), ("2 Results", "GAN works. Arabic too."), ("References", "Swahili here.")], True, None),
    # the abstract's GAN isn't known to it as an acronym of the sections
    ("both", "The Gan people speak.", [("Body", "Generative Adversarial Network (GAN); GAN is used")], True, None),
    ("pdf", "No names.", [("Body", "Swahili in a partial page")], False, "Body with Arabic names."),
    ("partial", "No names.", [("Body", "Swahili in a partial page")], False, ""),
    ("none", "Arabic in the abstract.", None, None, None),
    ("empty", None, [], True, None),
]


@pytest.fixture(scope="module")
def tables(spark):
    c = spark.createDataFrame(PAPERS, f"paper_id string, abstract string, html_sections {SECTIONS}, html_complete boolean, pdf_text string")
    names = spark.createDataFrame([("Gan", 0), ("Swahili", 0), ("Arabic", 1), ("The", 0)], "language string, class_id int")
    ignore = spark.createDataFrame([("the",)], "language_lc string")
    return c, names, ignore, spark.createDataFrame([("Gan", "short")], "language string, flag_reason string")


def test_papers_are_screened_source_by_source(tables):
    rows, checked = weekly.screen_papers(*tables)
    got = sorted({(r.paper_id, r.source, r.language) for r in rows.collect()})
    assert got == [("both", "abstract", "Gan"), ("html", "html", "Arabic"), ("html", "html", "Gan"), ("none", "abstract", "Arabic"), ("partial", "html", "Swahili"), ("pdf", "pdf", "Arabic")]
    # Gan comes from the section's title, which is a block as it stands
    assert {r.block_idx for r in rows.where("paper_id = 'html' AND language = 'Gan'").collect()} == {-1}
    said = {r.paper_id: (r.sources_checked, r.warnings) for r in checked.collect()}
    assert said["partial"] == (["abstract", "html"], ["partial_html"]) and said["empty"] == said["none"] == (["abstract", "pdf_unavailable"], ["pdf_unavailable"])
    assert said["pdf"] == (["abstract", "pdf"], []) and said["html"] == (["abstract", "html"], [])


def test_manifest_of_a_week(spark, tables):
    papers = tables[0].select("paper_id").withColumn("day", tables[0]["paper_id"])
    m = weekly.weekly_manifest(papers, *tables, "2024-01-01", "2024-01-08", "q").first()
    assert (m.counts.papers, m.counts.flagged_papers, m.counts.unique_languages, m.counts.pdf_failed_no_detection) == (6, 5, 3, 1)
    assert [(x.language, x["count"]) for x in m.language_counts] == [("Arabic", 3), ("Gan", 2), ("Swahili", 1)]


def test_repeat_on_stored_text_leaves_no_section_out(tables):
    rows, _ = weekly.reprocess(*tables)
    assert ("html", "Swahili") in {(r.paper_id, r.language) for r in rows.collect()}


def test_retry_takes_papers_that_lack_something_and_merges(spark, tables):
    c = tables[0]
    papers = c.selectExpr("paper_id", "paper_id AS safe_id")
    kinds = "paper_id string, sources_checked array<string>, warnings array<string>, languages array<string>"
    old = spark.createDataFrame([("pdf", ["abstract"], [], ["Old"]), ("html", ["abstract", "html"], [], ["Kept"])], kinds)
    none = spark.createDataFrame([("none", ["abstract"], [], []), ("empty", ["abstract"], [], [])], kinds)
    html = spark.createDataFrame([("html", True), ("both", True), ("partial", False)], "safe_id string, complete boolean")
    detected, rest = weekly.retry_missing(papers, c, old, none, html, spark.createDataFrame([("pdf",)], "safe_id string"), *tables[1:])
    got = {r.paper_id: (r.sources_checked, r.languages) for r in detected.collect()}
    assert got["html"] == (["abstract", "html"], ["Kept"]) and got["pdf"] == (["abstract", "pdf"], ["Arabic"])
    assert set(got) == {"html", "pdf", "both", "partial", "none"} and [r.paper_id for r in rest.collect()] == ["empty"]


def test_repeated_records_count_once(spark):
    from lexiscope.operators import assembly

    kinds = "paper_id string, sources_checked array<string>, n int"
    old = spark.createDataFrame([("a", ["abstract"], 1), ("a", ["abstract", "html"], 2), ("b", ["abstract"], 3)], kinds)
    new = spark.createDataFrame([("a", ["abstract", "pdf"], 4), ("b", ["abstract", "pdf"], 5), ("b", ["abstract"], 6), ("c", ["abstract"], 7)], kinds)
    assert sorted((r.paper_id, r.n) for r in assembly.upsert_detected(old, new).collect()) == [("a", 2), ("b", 5), ("c", 7)]
    gone = spark.createDataFrame([("c",)], "paper_id string")
    assert sorted(r.paper_id for r in assembly.merge_no_detections(old, new, gone).collect()) == ["a", "b"]

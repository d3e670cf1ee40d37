"""Weeks from start to end: outputs below one root, skipped and repeated weeks, retries, the command line."""

import json
from datetime import date

import pytest

from lexiscope import __main__ as command
from lexiscope.operators import dashboard
from lexiscope.plans import job, weekly
from lexiscope.sources import files, sinks

START, END = date(2024, 1, 1), date(2024, 1, 8)
PAPERS = [{"id": f"http://x.org/abs/{k}", "title": f"T{k}", "abstract": t, "published": f"2024-01-0{1 + i % 3}T00:00:00Z"} for i, (k, t) in enumerate([("1", "Gan people"), ("2", "none"), ("3", "none"), ("4", None), ("5", "none")])]
DATA = {"lang_classes": {"0": ["Gan", "Swahili"], "1": ["Arabic"]}, "languages_to_ignore": ["the"], "possible_false_positive_languages": {"Gan": "short"}}


@pytest.fixture
def root(spark, tmp_path):
    (tmp_path / "in").mkdir()
    (tmp_path / "in/papers_1.jsonl").write_text("\n".join(map(json.dumps, PAPERS)) + "\nbroken\n")
    (tmp_path / "lists.json").write_text(json.dumps(DATA))
    kinds = "safe_id string, html string, complete boolean, sections array<struct<title:string,text:string,cleaned_text:string,detected:array<string>>>"
    s = lambda *rows: [(t, x, None, None) for t, x in rows]
    pages = [("2", "<p>", True, s(("Body", "A Generative Adversarial Network (GAN) and Swahili."), ("References", "Arabic"))), ("3", "<p>", False, s(("Body", ""))), ("5", None, False, None)]
    sinks.write_html_cache(spark.createDataFrame(pages, kinds), str(tmp_path / "html_cache"))
    sinks.write_pdf_cache(spark.createDataFrame([("3", "Arabic in the body.")], "safe_id string, body_text string"), str(tmp_path / "pdf_cache"))
    return tmp_path


def languages(spark, root, name="detected"):
    week = f"{root}/processed/{name}/week={job.slug(START, END)}"
    return {r.paper_id[-1]: (r.sources_checked, [x.language for x in r.languages or []]) for r in spark.read.schema(job.RESULT).json(week).collect()}


def test_a_week_and_its_repeats(spark, root, capsys):
    command.main([str(root), "2024-01-01", "2024-01-10", "--lists", str(root / "lists.json"), "--papers", f"{root}/in/*.jsonl", "--query", "cat:x"])
    stats = json.loads(capsys.readouterr().out.strip().split("\n")[-1])["20240101_to_20240108"]
    assert stats == {"total": 5, "with_detections": 3, "detections": 3, "failed": 0, "abstract": 5, "html": 1, "pdf": 1, "pdf_unavailable": 3}
    assert languages(spark, root) == {"1": (["abstract", "pdf_unavailable"], ["Gan"]), "2": (["abstract", "html"], ["Swahili"]), "3": (["abstract", "pdf"], ["Arabic"])}
    assert set(languages(spark, root, "no_detections")) == {"4", "5"}
    warning = spark.read.json(f"{root}/processed/warnings").first()
    assert (warning.paper_id[-1], warning.acronym, warning.language) == ("2", "GAN", "Gan")
    m = dashboard.read_manifest(spark, f"{root}/weeks/20240101_to_20240108/manifest.json").first()
    assert m.counts.asDict() == {"papers": 5, "flagged_papers": 3, "unique_languages": 3, "pdf_failed_no_detection": 2} and m.query == "cat:x"
    assert [x.asDict() for x in dashboard.read_manifest(spark, f"{root}/manifest_last_7_days.json").first().class_counts] == [{"class": 0, "count": 2}, {"class": 1, "count": 1}]
    lists = job.read_lists(spark, str(root / "lists.json"))
    assert job.run_week(spark, str(root), START, END, lists) is None  # it is there
    assert files.available_weeks(spark, f"{root}/processed/detected") == ["20240101_to_20240108"]
    # a repeat on stored text leaves no section out
    assert job.run_week(spark, str(root), START, END, lists, again=True)["detections"] == 4
    assert languages(spark, root)["2"] == (["abstract", "html"], ["Arabic", "Swahili"])
    # what came into the caches meanwhile is found by a retry
    sinks.write_pdf_cache(spark.createDataFrame([("5", "Swahili")], "safe_id string, body_text string"), f"{root}/pdf_cache")
    assert job.retry_week(spark, str(root), START, END, lists) == (4, 1)
    assert languages(spark, root)["5"] == (["abstract", "pdf"], ["Swahili"]) and languages(spark, root)["2"][1] == ["Arabic", "Swahili"]


def test_a_week_without_papers_is_an_error(spark, tmp_path):
    with pytest.raises(FileNotFoundError):
        job.week_papers(spark, str(tmp_path), "20240101_to_20240108", None)
    with pytest.raises(FileNotFoundError):
        job.stored_papers(spark, f"{tmp_path}/*.jsonl")


def test_sections_without_text_leave_the_pdf(spark):
    rows = [(1, [("a", "")], None, "pdf"), (2, [("a", "x")], None, "pdf"), (3, [("a", "x")], False, "pdf"), (4, None, None, "pdf")]
    c = spark.createDataFrame(rows, f"paper_id int, html_sections {weekly.SECTIONS}, html_complete boolean, pdf_text string").selectExpr("*", "'' AS abstract")
    _, checked = weekly.source_texts(weekly.stored_candidates(c), ())
    assert {r.paper_id: r.sources_checked[-1] for r in checked.collect()} == {1: "pdf", 2: "html", 3: "pdf", 4: "pdf"}

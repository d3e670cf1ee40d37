import datetime
import re

from pyspark.sql import functions as F

from lexiscope.operators import assembly, gazetteer, html, papers, screening, trends
from lexiscope.plans import fixtures as fx


def test_names_match_a_nested_loop(spark):
    names = [("Ge'ez", 0), ("de la", 1), ("Éré", 2), ("N|uu!", 3), ("Ha", 4), ("Ha", 1), ("!!", 5)]
    texts = [(1, "Geʼez de  la éré"), (2, "ha Haha HA de la."), (3, "N|uu! and !!"), (4, "ge-ez Ge'ez"), (5, "")]
    got = screening.match_names(spark.createDataFrame(texts, "id int, block string"), spark.createDataFrame(names, "language string, class_id int"), ["id"])

    def pattern(n):
        return "".join("['ʼʻʹʽ`]" if c in "'ʼʻʹʽ`" else re.escape(c) for c in n)

    want = {(i, n, c) for i, t in texts for n, c in names if re.search(rf"(?<!\w){pattern(n)}(?!\w)", t, re.I)}
    assert {tuple(r) for r in got.collect()} == want


def test_veto_keeps_plain_use(spark):
    b = spark.createDataFrame([(1, "a Generative Adversarial Network (GAN) for Swahili"), (2, "Gan language data")], "id int, block string")
    names = spark.createDataFrame([("Gan", 0), ("Swahili", 0)], "language string, class_id int")
    ignore = spark.createDataFrame([("the",)], "language_lc string")
    assert {(r.id, r.language) for r in screening.detect(b, names, ignore, ["id"]).collect()} == {(1, "Swahili"), (2, "Gan")}


def test_html():
    s = html.sections_of(html.clean_tree("<section id=a><h2>1 Intro</h2><p>x<span>Mo</span>tion<p>y</section><section><h2>6. Related Work</h2><p>z</section>", html.REMOVE_HEADINGS))
    # the second section loses its heading and all that follows it, so an empty one without a title is left
    assert s == {"1 Intro": "xMotion\n\ny", "section": ""}
    assert html.sections_of(html.clean_tree("<math><msub><mi>i</mi><mi>k</mi></msub></math><p>a</p>")) == {"body": "a"}
    assert html.sections_of(html.clean_tree("<nav>n</nav>just text")) == {"body": "just text"}
    assert html.sections_of(html.clean_tree("<h1>T</h1><p>a<h2>T</h2><p>b")) == {"T": "b"}


def test_merge_and_upsert(spark):
    d = spark.createDataFrame([("p", "html", "Gan", 1, False, None, 2), ("p", "abstract", "Gan", 1, True, "r", 1), ("p", "html", None, 1, False, None, 0)],
                              "paper_id string, source string, language string, class int, needs_review boolean, flag_reason string, ord int")
    r = assembly.merge_detections(d).collect()
    assert len(r) == 1 and r[0].sources == ["abstract", "html"] and r[0].needs_review and r[0].flag_reason == "r"
    old = spark.createDataFrame([("a", ["abstract"], 0), ("b", ["abstract", "pdf"], 0)], "paper_id string, sources_checked array<string>, v int")
    new = spark.createDataFrame([("a", ["abstract", "html"], 1), ("b", ["abstract", "html"], 1), ("c", ["abstract"], 1)], old.schema)
    assert {r.paper_id: r.v for r in assembly.upsert_detected(old, new).collect()} == {"a": 1, "b": 0, "c": 1}


def test_fill_week_moves_a_sunday_forward(spark):
    daily = spark.createDataFrame([(datetime.date(2024, 1, 8), 3, 1)], "day date, papers int, flagged int")
    weeks = spark.createDataFrame([(datetime.date(2024, 1, 7),)], "week_start date")
    days = [r.day for r in trends.fill_week(daily, weeks).orderBy("day").collect()]
    assert days[0] == datetime.date(2024, 1, 8) and len(days) == 7


def test_classes(spark):
    names, ignore, review = fx.lists(spark)
    assert {r.language: r["class"] for r in gazetteer.name_classes(names).collect()}["Ha"] == 1
    d = gazetteer.build_detections(spark.createDataFrame([("Ha",), ("Nope",), ("The",)], "language string"), names, review, ignore)
    assert [(r.language, r["class"], r.needs_review) for r in d.collect()] == [("Ha", 1, True)]
    assert not names.filter(F.col("language").isNull()).count()


def test_papers_are_numbered_whole_in_every_mode(spark):
    rows = [(0, "b", 2, 3), (1, "A", 0, None), (2, "c", 2, 4), (3, "B", 1, 5)]
    view = spark.createDataFrame(rows, "index int, title string, n_languages int, min_class int")
    got: dict[str, list[int]] = {}
    for r in papers.numbered_papers(view).orderBy("mode", "row_number").collect():
        got.setdefault(r.mode, []).append(r["index"])
        assert r.row_number == len(got[r.mode])
    assert got == {
        "default": [0, 1, 2, 3], "languages_desc": [0, 2, 3, 1], "languages_asc": [1, 3, 0, 2], "class_asc": [0, 2, 1, 3],
        "class_desc": [1, 3, 2, 0], "title_asc": [1, 0, 3, 2], "title_desc": [2, 0, 3, 1],
    }
    assert [r["index"] for r in papers.sort_papers(view, "class_asc").collect()] == got["class_asc"]


def test_queries_read_whole_tables(spark):
    from lexiscope.plans import queries as q

    sf = "/root/testdata/sf0.001"
    n_docs, n_papers = (spark.read.parquet(f"{sf}/{t}.parquet").count() for t in ("documents", "customer"))
    assert q.paper_sort(spark, sf).count() == n_papers
    for name, cases in (("acronyms", fx.CLEAN_CASES), ("pdf_trim", fx.PDF_CASES), ("md_trim", fx.MARKDOWN_CASES)):
        ids = [r.id for r in q.QUERIES[name](spark, sf).select("id").collect()]
        assert len(ids) == n_docs + len(cases) and sum(i < 0 for i in ids) == len(cases)
    texts = {r.id: r.text for r in q.md_trim(spark, sf).where("id < 0").collect()}
    assert texts == {-1: "Title\n\nBody of the text\n\nMethods\nMore", -2: "plain"}

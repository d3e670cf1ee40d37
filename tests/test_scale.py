"""Row numbers, manifests in one pass, names of several words by pairs, the weekly run's side outputs."""

import random
import re

from pyspark.sql import functions as F

from lexiscope.operators import manifest, papers, screening
from lexiscope.operators.numbering import numbered


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_numbers_of_all_rows_with_ties_and_nulls(spark):
    r = random.Random(2)
    rows = [(i, r.choice([None, 1, 1, 2, 7, r.randrange(1000)])) for i in range(3000)]
    df = spark.createDataFrame(rows, "id long, v long").repartition(7)
    out = numbered(df, F.desc("v"), F.asc("id"))
    want = sorted(rows, key=lambda x: (x[1] is None, -(x[1] or 0), x[0]))
    assert [(x.id, x.v) for x in out.orderBy("number").collect()] == want
    assert sorted(x.number for x in out.collect()) == list(range(1, 3001))
    assert "SinglePartition" not in plan(out)
    same = numbered(spark.range(500).select(F.lit(1).alias("v")), F.asc("v"))
    assert sorted(x.number for x in same.collect()) == list(range(1, 501))
    assert numbered(df.limit(0), F.asc("v")).count() == 0


def test_numbers_within_groups_with_a_null_group(spark):
    r = random.Random(3)
    rows = [(i, r.choice([None, "", "a", "a", "a", "b"]), r.randrange(50)) for i in range(2000)]
    out = numbered(spark.createDataFrame(rows, "id long, g string, v long").repartition(5), F.asc("v"), F.asc("id"), groups=("g",), name="place")
    got = {x.id: x.place for x in out.collect()}
    want = {}
    for g in {x[1] for x in rows}:
        for k, x in enumerate(sorted((x for x in rows if x[1] == g), key=lambda x: (x[2], x[0])), 1):
            want[x[0]] = k
    assert got == want


def test_papers_in_all_modes_without_a_single_task(spark):
    view = spark.createDataFrame([(i, f"T{i % 7}", i % 3, None if i % 5 == 0 else i % 4) for i in range(200)], "index long, title string, n_languages int, min_class int")
    out = papers.numbered_papers(view)
    assert "SinglePartition" not in plan(out) and out.count() == 7 * 200
    for mode in papers.SORT_MODES:
        want = [r["index"] for r in papers.sort_papers(view, mode).collect()]
        assert [r["index"] for r in out.where(F.col("mode") == mode).orderBy("row_number").collect()] == want, mode


def test_a_paper_without_chips_is_of_class_5(spark):
    out = papers.with_chips(spark.createDataFrame([(1,), (2,)], "paper_id long"), spark.createDataFrame([(1, "Bo", 2)], "paper_id long, language string, class int"))
    assert {r.paper_id: (r.n_languages, r.min_class) for r in out.collect()} == {1: (1, 2), 2: (0, 5)}


def test_manifest_counts_in_one_pass(spark):
    p = spark.createDataFrame([(1, "2024-01-01"), (2, "2024-01-01"), (3, None), (4, "2024-01-02")], "paper_id long, day string")
    m = spark.createDataFrame([(1, "Bo", 0), (1, "Ha", 1), (1, "Ha", 4), (3, "Bo", 0), (4, " ", 2)], "paper_id long, language string, class int")
    n = spark.createDataFrame([(2, ["abstract", "pdf_unavailable"])], "paper_id long, sources_checked array<string>")
    r = manifest.manifest(p, m, n, "a", "b", "q").first()
    assert r.counts.asDict() == {"papers": 4, "flagged_papers": 3, "unique_languages": 3, "pdf_failed_no_detection": 1}
    assert [tuple(x) for x in r.language_counts] == [("Bo", 2), ("Ha", 2)]
    assert [tuple(x) for x in r.class_counts] == [(0, 2), (1, 1), (2, 1), (4, 1)]
    assert [tuple(x) for x in r.daily_series] == [("2024-01-01", 2, 1), ("2024-01-02", 1, 1)]
    empty = manifest.manifest(p.limit(0), m.limit(0), n.limit(0), "a", "b", "q").first()
    assert empty.counts.papers == 0 and empty.language_counts == [] and empty.daily_series == []


def test_names_of_several_words_equal_a_guarded_search(spark):
    names = [("de la", 1), ("of the", 2), ("heha-of", 3), ("a b a b", 4), ("a b", 5), ("k'iche", 6), ("!Xóõ", 7), ("N|uu", 8), ("Old-Tu pi", 9), ("a", 0)]
    r = random.Random(5)
    words = ["de", "la", "of", "the", "heha", "a", "b", "A", "k", "iche", "!Xóõ", "N|uu", "old", "tu", "pi", "x_a", "É"]
    texts = ["".join(r.choice(words) + r.choice([" ", " ", " ", "-", "–", "’", "'", "  ", "\n", ". ", "|"]) for _ in range(r.randrange(0, 30))) for _ in range(400)]
    texts += [None, "", "a", "a b a b a b", "de la", "xde la", "de lax", "an Old–tu pi!"]
    df = spark.createDataFrame(list(enumerate(texts)), "id long, block string")
    got = {(x.id, x.language) for x in screening.match_names(df, spark.createDataFrame(names, "language string, class_id int"), ["id"]).collect()}

    def pattern(name):
        body = "".join(f"[{'-‐‑‒–—−'}]" if c in "-‐‑‒–—−" else "['ʼʻʹʽ`]" if c in "'ʼʻʹʽ`" else re.escape(c) for c in name)
        return re.compile(rf"(?<!\w){body}(?!\w)", re.I)

    want = {(i, n) for n, _ in names for i, t in enumerate(texts) if t and pattern(n).search(t)}
    assert got == want and {n for _, n in want} == {n for n, _ in names}
    assert "block" not in plan(screening.pair_matches(df, screening.keyed(spark.createDataFrame(names, "language string, class_id int")).where("kind = 'pairs'"), ["id"], "block")).split("BroadcastHashJoin")[0]


def test_functions_in_sql_text_equal_the_dataframe_forms(spark):
    from lexiscope import sql
    from lexiscope.operators import html

    page = "<html><body><section id='a'><h2>1 Intro</h2><p>Some <b>text</b>.</p><section><h3>Sub</h3><p>More</p></section></section><section><p>None</p></section></body></html>"
    flat = "<body><p>before</p><h1>One</h1><p>a</p><p> b </p><h2>Empty</h2><h2>Two</h2><div>c</div></body>"
    pages = spark.createDataFrame([(1, page), (2, flat), (3, None), (4, "only text"), (5, "")], "id long, html string")
    sql.register(spark, spark.createDataFrame([("Bo", 1), ("de la", 2), ("The", 3)], "language string, class_id int"), spark.createDataFrame([("the",)], "language_lc string"))
    pages.createOrReplaceTempView("test_pages")
    got = spark.sql("SELECT p.id, s.* FROM test_pages p, LATERAL html_sections(p.html) s").collect()
    want = html.html_sections(pages, ["id"]).collect()
    assert sorted(map(tuple, got)) == sorted(map(tuple, want))
    assert [(r.title, r.text) for r in want if r.id == 2] == [("body", "before"), ("One", "a\n\nb"), ("Two", "c")]
    assert [(r.title, r.text) for r in want if r.id == 1] == [("1Intro", "Some text.\n\nMore"), ("Sub", "More"), ("section", "None")] or [r.title for r in want if r.id == 1][1:] == ["Sub", "section"]
    cut = spark.sql("SELECT s.title FROM test_pages p, LATERAL html_sections(p.html, array('One')) s WHERE p.id = 2").collect()
    assert [r.title for r in cut] == ["body", "Two"]
    texts = spark.createDataFrame([(1, "bo, BO and the bob"), (2, None), (3, "Bo-Bo")], "id long, t string")
    texts.createOrReplaceTempView("test_texts")
    out = spark.sql("SELECT d.id, m.* FROM test_texts d, LATERAL word_mentions(d.t) m")
    assert sorted(map(tuple, out.collect())) == [(1, "Bo", 1), (3, "Bo", 1)]
    assert spark.sql("SELECT safe_id('http://x/abs/1'), week_slug(DATE '2024-01-01'), match_key('A–b’cʼd')").first()[:] == ("1", "20240101_to_20240108", "a-b’c'd")


def test_names_are_in_a_readers_order(spark):
    from lexiscope.functions.labels import name_order
    from lexiscope.operators import trends

    names = ["Fa", "Éré", "Ea", "ere", "Ez", "Zu", "Ära", "ab"]
    df = spark.createDataFrame([(n, 1) for n in names], "language string, count long")
    assert [r.language for r in df.orderBy(name_order(F.col("language"))).collect()] == ["ab", "Ära", "Ea", "ere", "Éré", "Ez", "Fa", "Zu"]
    ranked = trends.ranks(df.withColumn("period", F.lit(1)), None)
    assert [r.language for r in ranked.orderBy("rank").collect()] == ["ab", "Ära", "Ea", "ere", "Éré", "Ez", "Fa", "Zu"]


def test_entries_in_three_forms_with_sources(spark):
    from lexiscope.functions import labels

    rows = ['"Gan"', '["Gan", 3]', '{"language": "Gan", "class": 2, "sources": ["html", "pdf"]}', '{"name": "Gan", "class": "x"}', "Gan", '["Gan"]', "{}", None, "[broken", "12"]
    df = spark.createDataFrame([(i, r) for i, r in enumerate(rows)], "i int, e string")
    e = F.col("e")
    got = [(r[0], r[1], r[2]) for r in df.orderBy("i").select(labels.entry_language(e), labels.entry_class(e), labels.entry_sources(e)).collect()]
    none: list = []
    assert got == [("Gan", None, none), ("Gan", 3, none), ("Gan", 2, ["html", "pdf"]), ("Gan", None, none), ("Gan", None, none), ("Gan", None, none), (None, None, none), (None, None, none), ("[broken", None, none), ("12", None, none)]


def test_weeks_come_from_a_listing_and_prune_files(spark, tmp_path):
    from lexiscope.sources import files

    root = str(tmp_path / "t")
    rows = spark.range(700).withColumn("week", F.concat(F.lit("2024010"), (F.col("id") % 7 + 1).cast("string"), F.lit("_to_x")))
    rows.write.partitionBy("week").parquet(root)
    (tmp_path / "t" / "week=20240109_to_x").mkdir()
    (tmp_path / "t" / "week=20240109_to_x" / "bad.parquet").write_text("no Parquet at all")
    assert len(files.available_weeks(spark, root)) == 8 and files.available_weeks(spark, str(tmp_path / "none")) == []
    wanted = rows.where("id = 3").select("week")
    out = files.facts_of_weeks(spark, root, wanted)
    assert "dynamicpruning" in plan(out).lower() and out.count() == 100


def test_settled_labels(spark):
    r = random.Random(1)
    rows = [(k % 3, i, r.uniform(0, 300)) for i, k in enumerate(range(90))]
    from lexiscope.operators import trends

    got = {x.i: x.label_y for x in trends.settled(spark.createDataFrame(rows, "side int, i int, y double")).collect()}
    for side in range(3):
        last = float("-inf")
        for _, i, y in sorted((x for x in rows if x[0] == side), key=lambda x: x[2]):
            last = max(y, last + 16)
            assert abs(got[i] - last) < 1e-6


def test_a_manifest_is_swapped_whole(spark, tmp_path):
    from lexiscope.sources import sinks

    target = str(tmp_path / "m" / "x.json")
    for text in ("one", "two"):
        sinks.write_text(spark, target, text)
        assert sinks.read_text(spark, target) == text
    assert sorted(p.name for p in (tmp_path / "m").iterdir() if not p.name.startswith(".")) == ["x.json"]

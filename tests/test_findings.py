"""Faults that reviews found, each with the case that showed it."""

import datetime
import random
import re
import unicodedata

import duckdb
import pyarrow as pa
from pyspark.sql import functions as F

from lexiscope.functions import acronyms, cleaning
from lexiscope.llm import pieces
from lexiscope.operators import gazetteer, html, screening
from lexiscope.plans import more_queries  # noqa: F401  registers its queries beside the others
from lexiscope.plans import queries, weekly


def against_sql(spark, folder, name, **tables):
    """(rows of a query over small tables, rows of its SQL), both sorted."""
    db = duckdb.connect()
    for table, df in tables.items():
        df.coalesce(1).write.mode("overwrite").parquet(f"{folder}/{table}.parquet")
        db.execute(f"CREATE VIEW {table} AS SELECT * FROM '{folder}/{table}.parquet/*.parquet'")
    got = queries.QUERIES[name](spark, str(folder))
    want = db.execute(f"SELECT {', '.join(got.columns)} FROM ({queries.ORACLE_SQL[name]})").fetchall()
    return sorted(tuple(r) for r in got.collect()), sorted(want)


def orders(spark, rows):
    at = datetime.datetime(1996, 3, 5)
    return spark.createDataFrame([(k, c, "F", at, p) for k, c, p in rows], "o_orderkey long, o_custkey long, o_orderstatus string, o_orderdate timestamp, o_orderpriority string")


def test_harvest_window_with_the_month_in_a_number(spark, tmp_path):
    got, want = against_sql(spark, tmp_path, "harvest_window", orders=orders(spark, [(1, 9601, "x"), (2, 86013, "x"), (3, 5, "x"), (4, 6, "x")]))
    assert got == want == [("http://x/abs/1603.10006", 4, "F")]


def test_paper_filter_takes_every_paper(spark, tmp_path):
    customers = spark.createDataFrame([(k, f"Customer {k}", "BUILDING") for k in (10, 11, 12)], "c_custkey long, c_name string, c_mktsegment string")
    rows = [(k, c, p) for k, c in enumerate((10, 11)) for p in ("1-URGENT", "2-HIGH")]
    got, want = against_sql(spark, tmp_path, "paper_filter", customer=customers, orders=orders(spark, rows))
    assert got == want == [(10,), (11,)]


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_stable_characters_need_no_normalisation(spark):
    stable = [chr(c) for c in range(0x10000) if re.match(f"[{cleaning.STABLE}]", chr(c))]
    some = random.Random(3).choices(stable, k=20_000)
    assert all(unicodedata.normalize("NFKC", c) == c and not unicodedata.combining(c) for c in stable)
    assert unicodedata.normalize("NFKC", "".join(some)) == "".join(some)
    texts = ["ﬁne", "é", "a\xa0b", "½", "naïve", "", None, "한ᆨ", "et al ."]
    df = spark.createDataFrame([(t,) for t in texts], "t string").select("t", cleaning.nfkc(F.col("t")).alias("n"))
    assert all(r.n == (r.t if r.t is None else unicodedata.normalize("NFKC", r.t)) for r in df.collect())


def test_what_needs_normalisation_is_told_apart_cheaply(spark):
    odd = [chr(c) for c in (*range(0xD800), *range(0xE000, 0x10000), 0x1D400, 0x20000)]
    t = F.col("t")
    df = spark.createDataFrame([(f"aé{c}ñ z",) for c in odd] + [("",), ("plain é",)], "t string")
    assert df.where(F.regexp_like(t, F.lit(cleaning.UNSTABLE)) != F.regexp_like(t, F.lit(f"[^{cleaning.STABLE}]"))).count() == 0
    # the whole class is tried at characters alone that the two ranges leave over
    assert cleaning.UNSTABLE.startswith(r"(?=[^\x00-\x7f\xbf-\u0131])") and plan(df.select(cleaning.nfkc(t))).count(cleaning.UNSTABLE) >= 1
    # no single space is replaced by itself
    pieces = F.regexp_extract_all("t", F.lit(f"({cleaning.BETWEEN})"), F.lit(1))
    words = spark.createDataFrame([("one two  three, four - é 5 ",)], "t string").select(pieces).first()[0]
    assert words == ["  ", ", ", " 5 "]


def test_python_gets_some_rows_at_a_time(spark):
    df = spark.createDataFrame([(1, "<p>é</p>")], "id long, html string")
    for one in (df.select(cleaning.nfkc(F.col("html"))), html.html_sections(df, ["id"])):
        assert "BatchEvalPython" in plan(one) and "ArrowEvalPython" not in plan(one)


def test_acronyms_equal_a_search_of_the_whole_text(spark):
    r = random.Random(4)
    words = ["Mean", "of", "the", "a", "la", "xY", "Big-Net", "low-net", "(MN)", "(GAN)", "(A", "ABC)", "(toolongname)", "Error", "é", "9", ",", ".", "Net"]
    texts = ["".join(r.choice(words) + r.choice([" ", " ", " ", "", "\n", "\xa0", ". "]) for _ in range(r.randrange(25))) for _ in range(3000)]
    slow = cleaning.DEFINITION.replace("*+", "*").replace("++", "+")
    both = lambda t: F.array_sort(F.array_distinct(F.concat(*(F.regexp_extract_all(t, F.lit(p), F.lit(2)) for p in (slow, cleaning.HYPHENATED)))))
    plain = F.regexp_replace(F.regexp_replace("t", slow, "$1 "), cleaning.HYPHENATED, "$1 ")
    t = F.col("t")
    rows = spark.createDataFrame([(x,) for x in texts], "t string").select(cleaning.defined_acronyms(t), both(t), cleaning.strip_definitions(t), plain).collect()
    assert all(a == b and c == d for a, b, c, d in rows) and sum(bool(x[0]) for x in rows) > 100


def test_a_report_makes_each_step_once(spark):
    df = spark.createDataFrame([("x",)], "t string").select(cleaning.step_matches(F.col("t")))
    assert plan(df).count("pgfstrokecolor") <= 4


def test_cleaned_blocks_keep_letters_and_marks_alone(spark):
    odd = [chr(c) for c in (*range(1, 0x250), *range(0x1680, 0x1690), *range(0x2000, 0x2070), 0x3000, 0x4E00, 0xFEFF)]
    df = spark.createDataFrame([("".join(random.Random(k).sample(odd, 60)),) for k in range(200)], "t string")
    one = F.trim(F.regexp_replace("t", cleaning.BETWEEN, " "))
    assert df.where(one != cleaning.squeeze_space(cleaning.replace_non_letters(F.col("t")))).count() == 0
    assert df.where(cleaning.trim_space(F.col("t")) != F.regexp_replace("t", rf"^{cleaning.S}+|{cleaning.S}+\z", "")).count() == 0


def test_texts_are_cut_into_words_once(spark):
    texts = spark.createDataFrame([(1, "de la Bo")], "id long, block string")
    names = spark.createDataFrame([("de la", 1), ("Bo", 2)], "language string, class_id int")
    assert plan(screening.match_names(texts, names, ["id"])).count("posexplode") == 1


def test_keys_are_made_without_patterns(spark):
    r = random.Random(5)
    texts = ["".join(r.choices("aÉß '-`ʼʻʹʽ‐‑‒–—−.\n", k=r.randrange(9))) for _ in range(2000)]
    t = F.col("t")
    plain = F.translate(F.translate(F.lower(t), cleaning.APOSTROPHES, "'" * 6), cleaning.HYPHENS, "-" * 7)
    df = spark.createDataFrame([(x,) for x in texts], "t string")
    assert df.where(gazetteer.match_key(t) != plain).count() == 0 and "rlike" not in plan(df.select(gazetteer.match_key(t))).lower()


def test_clauses_are_cut_at_their_last_mark(spark):
    r = random.Random(6)
    texts = ["".join(r.choices(["Big ", "net", "of ", "É", "\xa0", "\t", "\n", " ", ".", ";", ":", "!", "?", "x-Y "], k=r.randrange(9))) for _ in range(3000)]
    t = F.col("t")
    ends = F.translate(F.rtrim(t, F.lit(acronyms._SPACE)), acronyms._ENDS, "......")
    plain = F.regexp_extract_all(F.substring_index(ends, ".", -1), F.lit(acronyms._WORD), F.lit(1))
    df = spark.createDataFrame([(x,) for x in texts], "t string")
    assert df.where(acronyms.clause_words(t) != plain).count() == 0 and "translate" not in plan(df.select(acronyms.clause_words(t))).lower()


def test_places_of_acronyms_are_counted_once(spark):
    df = spark.createDataFrame([(1, "A Generative Adversarial Network (GAN), ( GAN ) and (XY)")], "id long, block string")
    places = screening.acronym_places(df, ["id"])
    assert [tuple(x) for x in places.collect()] == [(1, "GAN", 1)] and plan(places).count(r"\(\s*\Q") == 1


def test_a_week_looks_for_names_once(spark, monkeypatch):
    calls, own = [], screening.match_names
    monkeypatch.setattr(screening, "match_names", lambda *a, **k: calls.append(1) or own(*a, **k))
    papers = spark.createDataFrame([(1, "We use a Generative Adversarial Network (GAN) in Bo.", None, None, None)], "paper_id long, abstract string, html_sections array<struct<title:string,text:string>>, html_complete boolean, pdf_text string")
    names = spark.createDataFrame([("Gan", 1), ("Bo", 2)], "language string, class_id int")
    out = weekly.run_week(papers, names, spark.createDataFrame([], "language_lc string"), spark.createDataFrame([], "language string, flag_reason string"))
    assert [r.language for r in out.merged.collect()] == ["Bo"] and len(calls) == 1


def test_a_week_normalises_papers_once(spark):
    papers = spark.createDataFrame([(1, "Bo.", [("A", "A Generative Adversarial Network (GAN) é"), ("B", "GAN and Bo")], True, None)], "paper_id long, abstract string, html_sections array<struct<title:string,text:string>>, html_complete boolean, pdf_text string")
    names = spark.createDataFrame([("Gan", 1), ("Bo", 2)], "language string, class_id int")
    texts = weekly._screened(papers, names, spark.createDataFrame([], "language_lc string"), spark.createDataFrame([], "language string, flag_reason string"), ())[4]
    assert "BatchEvalPython" not in plan(texts) and sorted(r.given for r in texts.collect()) == [[], ["GAN"], ["GAN"]]


def test_the_backward_search_runs_whatever_the_columns(monkeypatch):
    searches, own = [], pieces.Pieces.cuts
    monkeypatch.setattr(pieces.Pieces, "cuts", lambda self, link, n: searches.append(link) or own(self, link, n))
    schema = pa.schema({"text": pa.string(), "ids": pa.list_(pa.int32()), "second_gap": pa.float64()})
    monkeypatch.setattr(pieces, "shared_pieces", pieces.Pieces)
    batch = pa.record_batch({"text": ["some words of unfathomable length", "", None]})
    out = pa.Table.from_batches(pieces._encode(pieces.model_path(), schema, ("ids", "second_gap"), 1)(iter([batch]))).to_pylist()
    (best, _), (second, _) = pieces.Pieces(pieces.model_path()).nbest(out[0]["text"], 2)
    assert searches and abs(out[0]["second_gap"] - (best - second)) < 1e-9 and [r["ids"] for r in out[1:]] == [[], []] and out[1]["second_gap"] is None

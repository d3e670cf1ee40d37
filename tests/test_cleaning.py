import random
import re

from pyspark.sql import functions as F

from lexiscope.functions import cleaning, pdf_text
from lexiscope.functions.acronyms import clause_words, count_acronym_places, spelled_out, spells
from lexiscope.functions.cleaning import strip_acronyms
from lexiscope.plans import fixtures as fx


def blocks(spark, text, acronyms=None):
    df = spark.createDataFrame([(1, text, acronyms)], "id int, text string, given array<string>")
    return [r.block for r in cleaning.clean_blocks(df, acronyms="given").orderBy("block_idx").collect()]


def test_blocks(spark):
    assert blocks(spark, "One.\n\nTwo.") == ["One", "Two"]
    assert blocks(spark, "a\r\n\r\nb") == ["a b"]
    assert blocks(spark, "") == [] and blocks(spark, None) == []


def test_steps(spark):
    assert blocks(spark, "Cost $x+1$ here, mail a@b.org") == ["Cost here mail"]
    assert blocks(spark, "as Müller et al. (2022) say") == ["as say"]
    assert blocks(spark, "see [Smith et al. 2021] and (in 2019)") == ["see and"]
    assert blocks(spark, "3B and GPT2 of 45") == ["and of"]
    assert blocks(spark, "Ge’ez N|uu! x́") == ["Ge ez N|uu! x"]


def test_acronyms(spark):
    text = "Mean Absolute Percentage Error (MAPE) is low; MAPE rises"
    assert blocks(spark, text) == ["Mean Absolute Percentage Error is low rises"]
    assert blocks(spark, "MAPE rises", ["MAPE"]) == ["rises"]
    long = "term " * 3000 + "Foo Bar (FB) and FB"
    assert "FB" not in blocks(spark, long)[0]


def test_context_and_initials(spark):
    cases = [
        ("Mean Absolute Percentage Error", "MAPE", True, True), ("Depression Anxiety and Stress Scale", "DASS", True, True),
        ("a lower case sentence", "MAPE", False, False), ("Scale", "DASS", False, False), ("Feature-Based", "FB", True, False),
        ("Point of Interest", "POI", True, True), ("Mean Absolute Error", "GAN", True, False), ("First Part. Mean Absolute Percentage Error", "MAPE", True, True),
        ("One Two Three; x", "OTT", False, False), ("", "AB", False, False), ("SOME CAPITALS here", "SC", True, True), ("don't Do's Go", "DG", True, True),
    ]
    d = spark.createDataFrame([(i, *c) for i, c in enumerate(cases)], "id int, head string, acronym string, context boolean, initials boolean")
    words = clause_words(F.col("head"))
    got = d.select("id", spelled_out(words).alias("c"), spells(words, F.col("acronym")).alias("i")).orderBy("id").collect()
    assert [(r.c, r.i) for r in got] == [(c, i) for _, _, c, i in cases]


def test_acronym_places(spark):
    two = "A Generative Adversarial Network ( GAN ) and Generative Adversarial Network (GAN)."
    cases = [("Generative Adversarial Network (GAN)", "Gan", 1), ("plain (GAN)", "Gan", 0), (None, "Gan", 0), ("x", None, 0), (two, "gan", 2), ("Any Body (A)", "A", 0), ("", "Gan", 0)]
    d = spark.createDataFrame([(i, *c) for i, c in enumerate(cases)], "id int, text string, name string, n int")
    assert d.where(count_acronym_places("text", "name") != F.col("n")).collect() == []


def test_code_blocks_end_what_stands_in_them(spark):
    cases = [
        ("def f(x): return col = 1 def g(y): return Swahili words", "def f(x): return  def g(y): return Swahili words"),
        ("def f(x): return col = 1 def g(y): return col[2] Swahili", "def f(x): return  def g(y): return  Swahili"),
        ("no code but col = 1 and more", "no code but col = 1 and more"), ("def f(x): col = 1", "def f(x): col = 1"),
    ]
    d = spark.createDataFrame([(i, t) for i, (t, _) in enumerate(cases)], "id int, t string")
    got = [" ".join(r[0].split()) for r in d.orderBy("id").select(cleaning.strip_code_blocks(F.col("t"))).collect()]
    assert got == [" ".join(w.split()) for _, w in cases]
    assert "Swahili words" in blocks(spark, cases[0][0])[0]


def test_step_report_names_acronyms_and_characters(spark):
    text = "def f(x): return 1. Mean Absolute Error (MAE) at 5% of " + " ".join(str(k) for k in range(30))
    r = spark.createDataFrame([(text,)], "t string").select(cleaning.step_matches(F.col("t")).alias("m")).first().m
    assert r["acronym_catch"] == ["MAE"] and "%" in r["replaced_chars"] and len(r["standalone_numbers"]) == 20 and len(r["def_return_funcs"]) == 1


def test_pdf(spark):
    df = spark.createDataFrame(fx.PDF_CASES, "id int, text string").select("id", pdf_text.trim_to_body(F.col("text")).alias("b"))
    got = {r.id: r.b for r in df.collect()}
    assert got[1].startswith("1. Introduction") and got[1].endswith("Many words.")
    assert got[2].startswith("INTRODUCTION") and "Bibliography" not in got[2]
    assert got[3] == "No marks at all" and got[4] == "" and got[5].endswith("kept") and got[5].startswith("Funding")


def test_acronyms_go_unless_a_language_is_meant_near(spark):
    context = re.compile(rf"(?i)(?<![{cleaning.HYPHENS}])\b(?:language|speakers?|dialect|corpus|script|words?|text|spoken|fluent|native)\b")

    def plain(block, acronyms):
        for a in sorted(acronyms):
            near = lambda m, b=block: (b[max(0, m.start() - 60) : m.start()], b[m.end() : m.end() + 60])
            block = re.sub(rf"(?<!\w){a}(?!\w)", lambda m: m[0] if any(map(context.search, near(m))) else " ", block)
        return block

    r = random.Random(3)
    words = ["GAN", "FB", "GAN", "xGAN", "GANs", "the", "Language", "a-language", "corpus.", "é", "(FB)", "GAN-FB", "long" * 8, "text", "\n"]
    rows = [(i, " ".join(r.choice(words[: r.choice([6, 15])]) for _ in range(r.randrange(60))), r.sample(["GAN", "FB", "ZZ"], r.randrange(4))) for i in range(400)]
    rows += [(1000, "FB " * 500 + "text", ["FB"]), (1001, "FB", ["FB"]), (1002, "", ["FB"]), (1003, "the GAN language", ["GAN"]), (1004, "the GAN is", ["GAN"])]
    df = spark.createDataFrame([*rows, (2000, None, ["FB"]), (2001, "FB", None)], "id int, b string, a array<string>")
    got = {x.id: x.out for x in df.select("id", strip_acronyms("b", "a").alias("out")).collect()}
    assert got == {i: plain(b, a) for i, b, a in rows} | {2000: None, 2001: "FB"}
    assert "ArrowEval" not in df.select(strip_acronyms("b", "a"))._jdf.queryExecution().executedPlan().toString()

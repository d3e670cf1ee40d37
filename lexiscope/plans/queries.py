"""One query for each operator over the tables, and its SQL where SQL can express it.

The tables hold no papers, so they stand in: documents for texts, pages for HTML, events and orders
for weekly facts, customers for cached and detected papers.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lexiscope.functions import cleaning, labels, pdf_text
from lexiscope.functions.acronyms import clause_words, count_acronym_places, spelled_out, spells
from lexiscope.operators import assembly, gazetteer, html, manifest, papers, screening, trends
from lexiscope.plans import fixtures as fx
from lexiscope.staging import written

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE_SQL: dict[str, str] = {}


def query(sql: str | None = None):
    def add(f):
        QUERIES[f.__name__] = f
        if sql:
            ORACLE_SQL[f.__name__] = sql
        return f

    return add


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read(spark, sf_dir, "documents").select("doc_id", "text", "source", F.date_add(F.lit("2024-01-01").cast("date"), (F.col("doc_id") % 28).cast("int")).alias("day"))


# ---- names in texts

_TOKENS = r"""
tok AS (
  SELECT DISTINCT doc_id, unnest(regexp_extract_all(translate(lower(text), '‐‑‒–—−ʼʻʹʽ`', '------'''''''''''), '[\p{L}\p{N}_]+')) AS token
  FROM documents
)"""
_MENTIONS = rf"""
WITH {fx.LISTS_SQL}, {_TOKENS},
single AS (
  SELECT doc_id, g.language, g.class_id FROM tok JOIN gaz g ON token = lower(g.language)
  WHERE regexp_full_match(g.language, '[\p{{L}}\p{{N}}_]+')
),
many AS (
  SELECT d.doc_id, g.language, g.class_id FROM documents d JOIN gaz g ON NOT regexp_full_match(g.language, '[\p{{L}}\p{{N}}_]+')
    AND regexp_matches(d.text, '(?i)(^|[^\p{{L}}\p{{N}}_])' || g.language || '([^\p{{L}}\p{{N}}_]|$)')
),
hits AS (SELECT * FROM single UNION ALL SELECT * FROM many),
found AS (SELECT h.* FROM hits h WHERE lower(h.language) NOT IN (SELECT language_lc FROM ign)),
classed AS (SELECT language, min(class_id) AS class FROM gaz GROUP BY 1),
merged AS (SELECT DISTINCT f.doc_id, f.language, c.class FROM found f JOIN classed c USING (language))"""


def mentions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(doc_id, language, class_id): names in raw texts."""
    names, ignore, _ = fx.lists(spark)
    return screening.match_names(documents(spark, sf_dir).select("doc_id", "text"), gazetteer.drop_ignored(names, ignore), ["doc_id"], "text")


def merged(spark: SparkSession, sf_dir: str) -> DataFrame:
    names, _, _ = fx.lists(spark)
    return gazetteer.attach_class(mentions(spark, sf_dir).select("doc_id", "language").distinct(), names)


@query(_MENTIONS + " SELECT doc_id, language, class_id FROM found")
def lang_mentions(spark, sf_dir):
    return mentions(spark, sf_dir)


@query(_MENTIONS + " SELECT doc_id, language, class_id FROM many WHERE lower(language) NOT IN (SELECT language_lc FROM ign)")
def lang_mentions_multi(spark, sf_dir):
    return mentions(spark, sf_dir).where(~F.regexp_like("language", F.lit(r"^[\p{L}\p{N}_]+\z")))


@query(_MENTIONS + " SELECT language, count(*) AS count FROM merged GROUP BY 1")
def language_counts(spark, sf_dir):
    return manifest.language_counts(merged(spark, sf_dir))


@query(_MENTIONS + " SELECT class, count(*) AS count FROM merged GROUP BY 1")
def class_counts(spark, sf_dir):
    return manifest.class_counts(merged(spark, sf_dir))


@query(_MENTIONS + " SELECT m.doc_id, m.language, m.class, r.language IS NOT NULL AS needs_review, r.flag_reason FROM merged m LEFT JOIN rev r USING (language)")
def review_flags(spark, sf_dir):
    return gazetteer.attach_review(merged(spark, sf_dir), fx.lists(spark)[2]).select("doc_id", "language", "class", "needs_review", "flag_reason")


@query(
    _MENTIONS + """ SELECT (SELECT count(*) FROM documents) AS papers, count(DISTINCT doc_id) AS flagged_papers, count(DISTINCT language) AS unique_languages,
    (SELECT count(*) FROM documents WHERE source = 'src3') AS pdf_failed_no_detection FROM merged"""
)
def counts_block(spark, sf_dir):
    d = documents(spark, sf_dir)
    failed = d.select(F.array(F.when(F.col("source") == "src3", "pdf_unavailable").otherwise("html")).alias("sources_checked"))
    return manifest.counts_block(d, merged(spark, sf_dir).withColumnRenamed("doc_id", "paper_id"), failed)


@query(
    _MENTIONS + """, days AS (SELECT doc_id, DATE '2024-01-01' + CAST(doc_id % 28 AS INT) AS day FROM documents)
    SELECT CAST(day AS DATE) AS day, count(*) AS papers, CAST(sum(CASE WHEN doc_id IN (SELECT doc_id FROM merged) THEN 1 ELSE 0 END) AS BIGINT) AS flagged
    FROM days GROUP BY 1"""
)
def daily_series(spark, sf_dir):
    d = documents(spark, sf_dir)
    flagged = d.join(merged(spark, sf_dir).select("doc_id").distinct(), "doc_id", "left_semi")
    return manifest.daily_series(d, flagged)


@query(_MENTIONS + " SELECT language, count(*) AS count FROM merged WHERE class < 3 GROUP BY 1 ORDER BY count DESC, language LIMIT 3")
def top_low_class(spark, sf_dir):
    return manifest.language_counts(merged(spark, sf_dir).where("class < 3")).orderBy(F.desc("count"), "language").limit(3)


#: What a manifest's summary looks like in SQL, from p (paper_id, day), m (paper_id, language, class) and f (paper_id).
MANIFEST_SQL = """SELECT 7 AS window_days, '2024-01-01' AS week_start, '2024-01-08' AS week_end, 'cat:x' AS query,
    (SELECT count(*) FROM p) AS papers, (SELECT count(DISTINCT paper_id) FROM m) AS flagged_papers, (SELECT count(DISTINCT language) FROM m) AS unique_languages,
    (SELECT count(*) FROM f) AS pdf_failed_no_detection,
    (SELECT string_agg(language || ':' || n, ',' ORDER BY n DESC, language) FROM (SELECT language, count(*) AS n FROM m GROUP BY 1)) AS languages,
    (SELECT string_agg(class || ':' || n, ',' ORDER BY class) FROM (SELECT class, count(*) AS n FROM m GROUP BY 1)) AS classes,
    (SELECT string_agg(strftime(day, '%Y-%m-%d') || ':' || n || ':' || k, ',' ORDER BY day) FROM
      (SELECT day, count(*) AS n, count(*) FILTER (WHERE paper_id IN (SELECT paper_id FROM m)) AS k FROM p GROUP BY 1)) AS days"""


def flat_manifest(row: DataFrame) -> DataFrame:
    """A manifest's row with its lists as text."""
    joined = lambda c, *names: F.array_join(F.transform(c, lambda x: F.concat_ws(":", *(x[n].cast("string") for n in names))), ",")
    return row.select(
        "window_days", "week_start", "week_end", "query", "counts.*", joined("language_counts", "language", "count").alias("languages"),
        joined("class_counts", "class", "count").alias("classes"), joined("daily_series", "day", "papers", "flagged").alias("days"),
    )


@query(
    _MENTIONS + """, p AS (SELECT doc_id AS paper_id, CAST(DATE '2024-01-01' + CAST(doc_id % 28 AS INT) AS DATE) AS day FROM documents),
    m AS (SELECT doc_id AS paper_id, language, class FROM merged), f AS (SELECT paper_id FROM p WHERE paper_id % 2 = 0 AND paper_id NOT IN (SELECT paper_id FROM m)) """ + MANIFEST_SQL
)
def manifest_row(spark, sf_dir):
    d = documents(spark, sf_dir).withColumnRenamed("doc_id", "paper_id")
    m = written(merged(spark, sf_dir).withColumnRenamed("doc_id", "paper_id"), "merged")
    none = d.join(m.select("paper_id").distinct(), "paper_id", "left_anti")
    failed = none.select("paper_id", F.array(F.lit("abstract"), F.when(F.col("paper_id") % 2 == 0, "pdf_unavailable")).alias("sources_checked"))
    return flat_manifest(manifest.manifest(d, m, failed, "2024-01-01", "2024-01-08", "cat:x"))


@query()
def screen_documents(spark, sf_dir):
    names, ignore, review = fx.lists(spark)
    return screening.screen(documents(spark, sf_dir), names, ignore, review, ["doc_id"])


# ---- cleaning

def _docs(spark, sf_dir):
    return read(spark, sf_dir, "documents").select("doc_id", "text")


def _with_cases(spark, sf_dir, cases, key: str = "id"):
    """(key, text): all documents, and before them literal rows for what documents don't hold, by negative ids."""
    own = spark.createDataFrame([(-row[0], row[1]) for row in cases], f"{key} long, text string")
    return own.unionByName(_docs(spark, sf_dir).select(F.col("doc_id").cast("long").alias(key), "text"))


@query(r"SELECT doc_id, md5(regexp_replace(text, '[^\s]+@[^\s]+\.[^\s]+', ' ', 'g')) AS cleaned FROM documents")
def clean_email(spark, sf_dir):
    return _docs(spark, sf_dir).select("doc_id", F.md5(cleaning.strip_emails(F.col("text"))).alias("cleaned"))


@query(r"SELECT doc_id, md5(regexp_replace(text, '\$[^$]+\$|\\\([^)]*\\\)|\\\[[^\]]*\\\]', ' ', 'g')) AS cleaned FROM documents")
def clean_math(spark, sf_dir):
    return _docs(spark, sf_dir).select("doc_id", F.md5(cleaning.strip_inline_math(F.col("text"))).alias("cleaned"))


@query(r"""SELECT doc_id, md5(regexp_replace(text, '[^\s\x1c-\x1f\x{85}\p{Z}\p{L}''ʼʻʹʽ`\-‐‑‒–—−()|!‡]', ' ', 'g')) AS cleaned FROM documents""")
def clean_whitelist(spark, sf_dir):
    return _docs(spark, sf_dir).select("doc_id", F.md5(cleaning.replace_non_letters(F.col("text"))).alias("cleaned"))


#: Words between two private marks, as the SQL dialect has no look-around.
_MARKED = r"""regexp_replace(text, '([\p{L}\p{N}_]+)', chr(57344) || '\1' || chr(57345), 'g')"""


@query(rf"""SELECT doc_id, md5(translate(regexp_replace(regexp_replace({_MARKED}, chr(57344) || '(\d+[a-zA-Z]+|[a-zA-Z]+\d+[a-zA-Z]*)' || chr(57345), ' ', 'g'),
    chr(57344) || '\d+' || chr(57345) || '(\.' || chr(57344) || '\d+' || chr(57345) || ')?', ' ', 'g'), chr(57344) || chr(57345), '')) AS cleaned FROM documents""")
def clean_numbers(spark, sf_dir):
    return _docs(spark, sf_dir).select("doc_id", F.md5(cleaning.strip_numbers(cleaning.strip_alnum_tokens(F.col("text")))).alias("cleaned"))


@query()
def clean_citations(spark, sf_dir):
    c = F.col("text")
    for f in (cleaning.strip_author_year, cleaning.strip_citation_parens, cleaning.strip_citation_brackets):
        c = f(c)
    return _docs(spark, sf_dir).select("doc_id", F.md5(c).alias("cleaned"))


@query()
def clean_full(spark, sf_dir):
    return cleaning.clean_blocks(_docs(spark, sf_dir)).select("doc_id", "block_idx", F.md5("block").alias("cleaned"))


@query()
def clean_cases(spark, sf_dir):
    return cleaning.clean_blocks(_with_cases(spark, sf_dir, fx.CLEAN_CASES))


@query()
def step_report(spark, sf_dir):
    d = _with_cases(spark, sf_dir, fx.CLEAN_CASES)
    return d.select("id", F.explode(cleaning.step_matches(cleaning.normalise(F.col("text")))).alias("step", "matches"))


@query(
    r"""WITH c AS (SELECT unnest(string_split(regexp_replace(text, '[\s\x1c-\x1f\x{85}\p{Z}\p{L}''ʼʻʹʽ`\-‐‑‒–—−()|!‡]', '', 'g'), '')) AS character FROM documents)
    SELECT character, count(*) AS count FROM c WHERE character <> '' GROUP BY 1"""
)
def char_histogram(spark, sf_dir):
    return cleaning.replaced_characters(_docs(spark, sf_dir), "text")


@query("""SELECT conv_id, count(*) AS n_blocks, md5(string_agg(b, chr(10) ORDER BY turn)) AS blocks FROM
    (SELECT conv_id, turn, trim(text, chr(32) || chr(10) || chr(13) || chr(9)) AS b FROM conversations) WHERE b <> '' GROUP BY 1""")
def block_split(spark, sf_dir):
    c = read(spark, sf_dir, "conversations")
    whole = c.groupBy("conv_id").agg(F.array_sort(F.collect_list(F.struct("turn", "text"))).alias("t"))
    b = whole.select("conv_id", cleaning.split_blocks(F.array_join(F.transform("t", lambda x: x["text"]), "\n\n")).alias("b"))
    return b.select("conv_id", F.size("b").cast("long").alias("n_blocks"), F.md5(F.array_join("b", "\n")).alias("blocks")).where("n_blocks > 0")


@query(r"SELECT doc_id, md5(regexp_replace(text, '[^A-Za-zÀ-ÿ]', ' ', 'g')) AS cleaned FROM documents")
def clean_latin(spark, sf_dir):
    return _docs(spark, sf_dir).select("doc_id", F.md5(cleaning.latin_letters(F.col("text"))).alias("cleaned"))


# ---- acronyms

def _acronym_texts(spark, sf_dir, rows=fx.ACRONYM_CASES):
    """(id, text, language): the literal cases by negative ids, and all documents with a definition behind their text."""
    cases = spark.createDataFrame([(-r[0], r[1], r[2] if len(r) > 2 else None) for r in rows], "id long, text string, language string")
    bare = F.replace(F.replace(F.coalesce("text", F.lit("")), F.lit("("), F.lit(" ")), F.lit(")"), F.lit(" "))
    text = F.concat(bare, F.lit(" \n. A Generative Adversarial Network (GAN)"))
    return cases.unionByName(_docs(spark, sf_dir).select(F.col("doc_id").cast("long").alias("id"), text.alias("text"), F.lit("Gan").alias("language")))


@query("""SELECT CAST(id AS BIGINT) AS id, acronyms FROM (VALUES (-1, ''), (-2, ''), (-3, 'MAPE'), (-4, 'LOLO,LOO'), (-5, ''), (-6, ''), (-7, ''), (-8, '')) AS v(id, acronyms)
    UNION ALL SELECT doc_id, 'GAN' FROM documents""")
def acronyms(spark, sf_dir):
    d = _acronym_texts(spark, sf_dir, fx.CLEAN_CASES)
    return d.select("id", F.array_join(cleaning.paper_acronyms(F.col("text")), ",").alias("acronyms"))


@query("SELECT CAST(id AS BIGINT) AS id, places FROM (VALUES (-1, 1), (-2, 0), (-3, 1), (-4, 1), (-5, 0), (-6, 0)) AS v(id, places) UNION ALL SELECT doc_id, 1 FROM documents")
def acronym_veto(spark, sf_dir):
    d = _acronym_texts(spark, sf_dir)
    return d.select("id", count_acronym_places("text", "language").alias("places"))


@query("""SELECT CAST(paper_id AS BIGINT) AS paper_id, acronym, language, language_class, 'Acronym ' || acronym || ' is also the language name ' || language || '; mentions may have been removed' AS message
    FROM (SELECT * FROM (VALUES (-3, 'MAPE', 'Mape', 0), (-4, 'LOLO', 'Lolo', 3)) AS v(paper_id, acronym, language, language_class) UNION ALL SELECT doc_id, 'GAN', 'Gan', 0 FROM documents)""")
def acronym_conflicts(spark, sf_dir):
    d = _acronym_texts(spark, sf_dir, fx.CLEAN_CASES).withColumnRenamed("id", "paper_id")
    names = spark.createDataFrame([("Mape", 0), ("Lolo", 3), ("Gan", 0)], "language string, class_id int")
    return screening.acronym_conflicts(d, names, fx.lists(spark)[1])


@query("""SELECT 'parenthetical_acronym_context' AS rule, language, upper(language) AS acronym, paper_id
    FROM (SELECT * FROM (VALUES ('Gan', '-1'), ('Dass', '-3')) AS v(language, paper_id) UNION ALL SELECT 'Gan', CAST(doc_id AS VARCHAR) FROM documents)""")
def screening_warnings(spark, sf_dir):
    d = _acronym_texts(spark, sf_dir).select(F.col("id").alias("paper_id"), F.col("text").alias("block"))
    names = spark.createDataFrame([("Gan", 0), ("Dass", 0), ("Swahili", 0)], "language string, class_id int")
    return screening.screening_warnings(d, names, fx.lists(spark)[1], "paper_id", ["paper_id"])


# ---- PDF text and HTML

@query()
def pdf_trim(spark, sf_dir):
    return _with_cases(spark, sf_dir, fx.PDF_CASES).select("id", pdf_text.trim_to_body(F.col("text")).alias("body"))


@query(r"""SELECT CAST(id AS BIGINT) AS id, text FROM (VALUES (-1, 'duration'), (-2, 'anecdotal'), (-3, 'anecdotal'), (-4, 'self-aware and' || chr(10) || chr(10) || 'state-of-the-art')) AS v(id, text)
    UNION ALL SELECT doc_id, md5(trim(regexp_replace(regexp_replace(regexp_replace(text, '([a-z])-\n([a-z])', '\1\2', 'g'), '\n{3,}', chr(10) || chr(10), 'g'), ' {2,}', ' ', 'g'), chr(32) || chr(10) || chr(13) || chr(9)))
      FROM (SELECT doc_id, regexp_replace(regexp_replace(coalesce(text, ''), ' -', ' ', 'g'), '([a-z]) ([a-z])', '\1-' || chr(10) || '\2') AS text FROM documents)""")
def pdf_dehyphenate(spark, sf_dir):
    """Cases, and all documents with a word cut at a line end."""
    cut = F.regexp_replace(F.regexp_replace(F.coalesce("text", F.lit("")), " -", " "), "^((?s).*?[a-z]) ([a-z])", "$1-\n$2")
    d = _docs(spark, sf_dir).select(F.col("doc_id").cast("long").alias("id"), F.md5(pdf_text.join_hyphens(cut)).alias("text"))
    return spark.createDataFrame([(-i, t) for i, t in fx.HYPHEN_CASES], "id long, text string").select("id", pdf_text.join_hyphens(F.col("text")).alias("text")).unionByName(d)


@query(r"""SELECT doc_id, md5(trim(regexp_replace(regexp_replace(regexp_replace(regexp_replace(text, '([a-z])-\n([a-z])', '\1\2', 'g'),
    '([a-z]) -\n?([a-z])', '\1\2', 'g'), '\n{3,}', chr(10) || chr(10), 'g'), ' {2,}', ' ', 'g'), chr(32) || chr(10) || chr(13) || chr(9))) AS cleaned FROM documents""")
def pdf_clean_documents(spark, sf_dir):
    return _docs(spark, sf_dir).select("doc_id", F.md5(pdf_text.join_hyphens(F.col("text"))).alias("cleaned"))


@query()
def md_trim(spark, sf_dir):
    d = _with_cases(spark, sf_dir, fx.MARKDOWN_CASES)
    return d.select("id", pdf_text.trim_markdown(F.col("text")).alias("text"))


@query()
def html_sections(spark, sf_dir):
    return html.html_sections(read(spark, sf_dir, "pages"), ["page_id"])


@query()
def html_clean(spark, sf_dir):
    s = html.html_sections(read(spark, sf_dir, "pages"), ["page_id"], remove_headings=html.REMOVE_HEADINGS)
    return html.skip_sections(s).select("page_id", "section_idx", "title", F.md5("text").alias("text"))


@query(r"SELECT page_id, regexp_extract(html, '<title>([^<]*)</title>', 1) AS title FROM pages")
def html_title(spark, sf_dir):
    return read(spark, sf_dir, "pages").select("page_id", F.regexp_extract("html", "<title>([^<]*)</title>", 1).alias("title"))


@query()
def html_languages(spark, sf_dir):
    names, ignore, review = fx.lists(spark)
    s = html.skip_sections(html.html_sections(read(spark, sf_dir, "pages"), ["page_id"], remove_headings=html.REMOVE_HEADINGS))
    return screening.screen(s, names, ignore, review, ["page_id", "section_idx"])


# ---- assembly

def _event_detections(spark, sf_dir):
    e = read(spark, sf_dir, "events")
    return e.select(
        F.col("user_id").alias("paper_id"), F.col("event_type").alias("language"), (F.length("event_type") % 6).cast("int").alias("class"),
        F.when(F.hour("ts") % 2 == 0, "html").otherwise("pdf").alias("source"), (F.col("value") > 50).alias("needs_review"),
        F.lit(None).cast("string").alias("flag_reason"), F.col("event_id").alias("ord"),
    )


@query("""WITH d AS (SELECT user_id AS paper_id, event_type AS language, CAST(length(event_type) % 6 AS INT) AS class,
      CASE WHEN hour(ts) % 2 = 0 THEN 'html' ELSE 'pdf' END AS source, value > 50 AS needs_review, event_id AS ord FROM events),
    f AS (SELECT paper_id, language, class, source, min(ord) AS ord FROM d GROUP BY ALL)
    SELECT d.paper_id, d.language, d.class, d.needs_review, s.sources FROM d JOIN
      (SELECT paper_id, language, class, min(ord) AS ord, string_agg(source, ',' ORDER BY ord) AS sources FROM f GROUP BY ALL) s
      ON d.paper_id = s.paper_id AND d.language = s.language AND d.ord = s.ord""")
def merge_detections(spark, sf_dir):
    m = assembly.merge_detections(_event_detections(spark, sf_dir))
    return m.select("paper_id", "language", "class", "needs_review", F.array_join("sources", ",").alias("sources"))


@query("""SELECT coverage, count(*) AS count FROM (SELECT CASE WHEN o_orderpriority = '1-URGENT' THEN 'html' WHEN o_orderpriority = '2-HIGH' THEN 'pdf'
    ELSE 'abstract_only' END AS coverage FROM orders) GROUP BY 1""")
def coverage_stats(spark, sf_dir):
    p = F.col("o_orderpriority")
    s = F.array_compact(F.array(F.lit("abstract"), F.when(p == "1-URGENT", "html"), F.when(p == "2-HIGH", "pdf")))
    return manifest.coverage_stats(read(spark, sf_dir, "orders").select(s.alias("sources_checked")))


@query("""SELECT count(*) AS total, count(*) FILTER (WHERE o_orderkey % 4 > 0) AS with_detections, CAST(sum(o_orderkey % 4) AS BIGINT) AS detections,
    count(*) FILTER (WHERE o_orderstatus = 'P') AS failed, count(*) AS abstract, count(*) FILTER (WHERE o_orderkey % 3 = 0) AS html,
    count(*) FILTER (WHERE o_orderkey % 5 = 0) AS pdf, 0 AS pdf_unavailable FROM orders""")
def run_stats(spark, sf_dir):
    k = F.col("o_orderkey")
    r = read(spark, sf_dir, "orders").select(
        F.array_compact(F.array(F.lit("abstract"), F.when(k % 3 == 0, "html"), F.when(k % 5 == 0, "pdf"))).alias("sources_checked"),
        (k % 4).alias("n_detections"), (F.col("o_orderstatus") == "P").alias("failed"),
    )
    return manifest.run_stats(r)


_SOURCES = "CASE WHEN c_custkey % 5 = 0 THEN ['abstract','html'] WHEN c_custkey % 5 = 1 THEN ['abstract','pdf'] ELSE ['abstract'] END"


def _records(spark, sf_dir, shift: int):
    k = F.col("c_custkey") + shift
    s = F.when(k % 5 == 0, F.array(F.lit("abstract"), F.lit("html"))).when(k % 5 == 1, F.array(F.lit("abstract"), F.lit("pdf"))).otherwise(F.array(F.lit("abstract")))
    return read(spark, sf_dir, "customer").select(F.col("c_custkey").alias("paper_id"), s.alias("sources_checked"), F.lit(f"v{shift}").alias("version"))


_RECORDS = f"""old AS (SELECT c_custkey AS paper_id, {_SOURCES} AS s, 'v0' AS version FROM customer WHERE c_custkey % 3 <> 0),
    new AS (SELECT c_custkey AS paper_id, {_SOURCES.replace('c_custkey', '(c_custkey + 1)')} AS s, 'v1' AS version FROM customer WHERE c_custkey % 2 = 0)"""


@query(f"""WITH {_RECORDS} SELECT paper_id, CASE WHEN pick THEN nv ELSE ov END AS version FROM (
      SELECT coalesce(o.paper_id, n.paper_id) AS paper_id, o.version AS ov, n.version AS nv,
        o.paper_id IS NULL OR (n.paper_id IS NOT NULL AND len(n.s) = 2 AND len(o.s) = 1) AS pick
      FROM old o FULL JOIN new n ON o.paper_id = n.paper_id)""")
def retry_upsert(spark, sf_dir):
    old = _records(spark, sf_dir, 0).where("paper_id % 3 <> 0")
    new = _records(spark, sf_dir, 1).where("paper_id % 2 = 0")
    return assembly.upsert_detected(old, new).select("paper_id", "version")


@query(f"""WITH {_RECORDS} SELECT coalesce(n.paper_id, o.paper_id) AS paper_id, coalesce(n.version, o.version) AS version
    FROM old o FULL JOIN new n ON o.paper_id = n.paper_id WHERE coalesce(n.paper_id, o.paper_id) % 7 <> 0""")
def no_detection_merge(spark, sf_dir):
    old = _records(spark, sf_dir, 0).where("paper_id % 3 <> 0")
    new = _records(spark, sf_dir, 1).where("paper_id % 2 = 0")
    return assembly.merge_no_detections(old, new, _records(spark, sf_dir, 0).where("paper_id % 7 = 0")).select("paper_id", "version")


@query(f"""SELECT c_custkey AS safe_id FROM customer WHERE c_custkey % 3 = 0
      OR (c_custkey % 4 = 0 AND len({_SOURCES}) = 1) OR (c_custkey % 2 <> 0 AND c_custkey % 4 <> 0)
      OR (c_custkey % 2 = 0 AND c_custkey % 5 <> 0 AND c_custkey % 6 <> 0)""")
def retry_needed(spark, sf_dir):
    p = _records(spark, sf_dir, 0).withColumnRenamed("paper_id", "safe_id")
    detected = p.where("safe_id % 3 <> 0").select("safe_id", "sources_checked")
    h = p.where("safe_id % 2 = 0").select("safe_id", (F.col("safe_id") % 6 == 0).alias("complete"))
    return assembly.needs_retry(p.select("safe_id"), detected, h, p.where("safe_id % 4 = 0").select("safe_id"))


@query("""SELECT 'http://x/' || c_custkey AS id, array_to_string(list_filter(['abstract', CASE WHEN c_custkey % 2 = 0 THEN 'html' END,
      CASE WHEN c_custkey % 3 = 0 THEN 'pdf' END], lambda x: x IS NOT NULL), ',') AS sources_checked FROM customer""")
def source_join(spark, sf_dir):
    c = read(spark, sf_dir, "customer").select(F.concat(F.lit("http://x/"), "c_custkey").alias("id"), "c_custkey")
    h = c.where("c_custkey % 2 = 0").select(F.col("c_custkey").cast("string").alias("safe_id"), F.lit(True).alias("complete"))
    p = c.where("c_custkey % 3 = 0").select(F.col("c_custkey").cast("string").alias("safe_id"))
    return assembly.sources_checked(c, h, p).select("id", F.array_join("sources_checked", ",").alias("sources_checked"))


@query("""SELECT c_custkey AS paper_id, 'abstract' AS source FROM customer UNION ALL SELECT c_custkey, CASE WHEN c_custkey % 2 = 0 AND c_custkey % 10 <> 0 THEN 'html'
    WHEN c_custkey % 3 = 0 THEN 'pdf' WHEN c_custkey % 2 = 0 THEN 'html' ELSE 'pdf_unavailable' END FROM customer""")
def fallback_chain(spark, sf_dir):
    k = F.col("c_custkey")
    c = read(spark, sf_dir, "customer").select(
        k.alias("paper_id"), F.col("c_name").alias("abstract"),
        F.when(k % 2 == 0, F.array(F.struct(F.lit("t").alias("title"), F.col("c_name").alias("text")))).alias("html_sections"),
        (k % 10 != 0).alias("html_complete"), F.when(k % 3 == 0, F.col("c_name")).alias("pdf_text"),
    )
    return assembly.choose_sources(c).select("paper_id", "source")


@query("SELECT o_custkey AS id, min(o_orderkey) AS arrival FROM orders GROUP BY 1")
def dedupe_first(spark, sf_dir):
    o = read(spark, sf_dir, "orders").select(F.col("o_custkey").alias("id"), F.col("o_orderkey").alias("arrival"))
    return assembly.first_by_id(o, "arrival").select("id", "arrival")


# ---- trends over orders by nation

_STAR = """star AS (
  SELECT CAST(date_trunc('week', o_orderdate) AS DATE) AS week_start, n_name AS language, n_regionkey AS class, count(*) AS count
  FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey GROUP BY ALL
),
tot AS (SELECT week_start, CAST(sum(count) AS BIGINT) AS papers, CAST(sum(count) FILTER (WHERE class < 3) AS BIGINT) AS flagged FROM star GROUP BY 1)"""


def star(spark, sf_dir):
    """(week_start, language, class, count)."""
    o = read(spark, sf_dir, "orders").select("o_custkey", labels.week_start(F.col("o_orderdate")).alias("week_start"))
    c = read(spark, sf_dir, "customer").select("c_custkey", "c_nationkey")
    n = read(spark, sf_dir, "nation").select("n_nationkey", F.col("n_name").alias("language"), F.col("n_regionkey").alias("class"))
    per = o.join(c, o.o_custkey == c.c_custkey).groupBy("week_start", "c_nationkey").agg(F.count("*").alias("count"))
    return per.join(n, per.c_nationkey == n.n_nationkey).select("week_start", "language", "class", "count")


def star_totals(spark, sf_dir):
    return star(spark, sf_dir).groupBy("week_start").agg(F.sum("count").alias("papers"), F.sum(F.when(F.col("class") < 3, F.col("count"))).alias("flagged"))


def _trend(granularity: str, form: str):
    sql = f"""WITH {_STAR}, u AS (SELECT strftime(week_start, '{form}') AS period, count(DISTINCT language) AS unique_languages FROM star GROUP BY 1)
      SELECT t.*, u.unique_languages FROM (SELECT strftime(week_start, '{form}') AS period, min(week_start) AS sort_key,
        CAST(sum(papers) AS BIGINT) AS papers, CAST(sum(flagged) AS BIGINT) AS flagged FROM tot GROUP BY 1) t JOIN u USING (period)"""

    def trend(spark, sf_dir):
        s = star(spark, sf_dir)
        return trends.trend_periods(s, star_totals(spark, sf_dir), granularity)

    trend.__name__ = f"trend_{granularity}"
    query(sql)(trend)


for _g, _f in (("week", "%Y-%m-%d"), ("month", "%Y-%m"), ("year", "%Y")):
    _trend(_g, _f)

_YEARS = _STAR + """,
yr AS (SELECT strftime(week_start, '%Y') AS period, language, class, CAST(sum(count) AS BIGINT) AS count FROM star GROUP BY ALL),
rk AS (SELECT *, row_number() OVER (PARTITION BY period ORDER BY count DESC, language) AS rank FROM yr)"""


def _years(spark, sf_dir):
    return trends.period_counts(star(spark, sf_dir), "year")


@query(f"WITH {_YEARS} SELECT language, CAST(sum(count) AS BIGINT) AS count FROM yr GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 10")
def top10_languages(spark, sf_dir):
    return trends.top_languages(star(spark, sf_dir))


@query(f"WITH {_YEARS} SELECT language, CAST(sum(count) AS BIGINT) AS count FROM yr GROUP BY 1")
def language_totals(spark, sf_dir):
    return trends.language_totals(star(spark, sf_dir))


@query(f"WITH {_STAR} SELECT CAST(sum(papers) AS BIGINT) AS papers, CAST(sum(flagged) AS BIGINT) AS flagged, (SELECT count(DISTINCT language) FROM star) AS unique_languages FROM tot")
def overall_totals(spark, sf_dir):
    return trends.overall_totals(star_totals(spark, sf_dir), star(spark, sf_dir))


_WEEKS = _STAR + """, wk AS (SELECT strftime(week_start, '%Y-%m-%d') AS period, language, CAST(sum(count) AS BIGINT) AS count FROM star GROUP BY ALL),
top AS (SELECT language FROM wk GROUP BY 1 ORDER BY sum(count) DESC, language LIMIT 10)"""


@query(f"WITH {_WEEKS} SELECT p.period, t.language, coalesce(wk.count, 0) AS count FROM (SELECT DISTINCT period FROM wk) p CROSS JOIN top t LEFT JOIN wk ON wk.period = p.period AND wk.language = t.language")
def dense_grid(spark, sf_dir):
    s = star(spark, sf_dir)
    return trends.dense_grid(trends.period_counts(s, "week"), trends.top_languages(s))


_SHARES = _STAR + """, yc AS (SELECT strftime(week_start, '%Y') AS period, class, CAST(sum(count) AS BIGINT) AS count FROM star GROUP BY ALL),
grid AS (SELECT p.period, c.class, coalesce(yc.count, 0) AS count FROM (SELECT DISTINCT period FROM yc) p CROSS JOIN (SELECT unnest(range(0, 6))::INT AS class) c LEFT JOIN yc ON yc.period = p.period AND yc.class = c.class),
sh AS (SELECT *, count / greatest(sum(count) OVER (PARTITION BY period), 1) AS share FROM grid)"""


@query(f"WITH {_SHARES} SELECT period, class, count, round(share, 6) AS share, round(coalesce(sum(share) OVER (PARTITION BY period ORDER BY class ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0), 6) AS \"offset\" FROM sh")
def class_share(spark, sf_dir):
    c = trends.period_counts(star(spark, sf_dir), "year", "class")
    grid = trends.dense_grid(c, spark.range(6).select(F.col("id").cast("int").alias("class")), "class")
    return trends.class_shares(grid).withColumns({"share": F.round("share", 6), "offset": F.round("offset", 6)})


@query(f"WITH {_YEARS} SELECT period, language, count, rank FROM rk WHERE rank <= 10")
def bump_ranks(spark, sf_dir):
    return trends.ranks(_years(spark, sf_dir))


_SEGMENTS = _YEARS + ", ix AS (SELECT period, row_number() OVER (ORDER BY period) AS idx FROM (SELECT DISTINCT period FROM yr)), r AS (SELECT rk.*, idx FROM rk JOIN ix USING (period) WHERE rank <= 10)"


@query(f"WITH {_SEGMENTS} SELECT a.language, a.period AS period_from, b.period AS period_to, a.rank AS rank_from, b.rank AS rank_to FROM r a JOIN r b ON a.language = b.language AND b.idx = a.idx + 1")
def bump_segments(spark, sf_dir):
    y = _years(spark, sf_dir)
    return trends.segments(trends.ranks(y), y)


@query(f"WITH {_SEGMENTS} SELECT language, min(period) AS first_period, arg_min(rank, period) AS first_rank, max(period) AS last_period, arg_max(rank, period) AS last_rank FROM r GROUP BY 1")
def first_last(spark, sf_dir):
    return trends.first_last(trends.ranks(_years(spark, sf_dir)))


_MOVES = _YEARS + """, ps AS (SELECT period, row_number() OVER (ORDER BY period DESC) AS k FROM (SELECT DISTINCT period FROM yr)),
a AS (SELECT language, rank FROM rk WHERE period = (SELECT period FROM ps WHERE k = 2)), b AS (SELECT language, rank FROM rk WHERE period = (SELECT period FROM ps WHERE k = 1)),
mv AS (SELECT coalesce(a.language, b.language) AS language, CASE WHEN a.rank <= 10 AND b.rank <= 10 THEN 'matched' WHEN a.rank <= 10 THEN 'dropped' WHEN b.rank <= 10 THEN 'new' END AS status,
  a.rank AS rank_before, b.rank AS rank_now FROM a FULL JOIN b ON a.language = b.language)"""


def _moves(spark, sf_dir):
    return trends.latest_movements(_years(spark, sf_dir))


@query(f"WITH {_MOVES} SELECT * FROM mv WHERE status = 'matched'")
def mirror_matched(spark, sf_dir):
    return _moves(spark, sf_dir).where("status = 'matched'")


@query(f"WITH {_MOVES} SELECT * FROM mv WHERE status = 'new'")
def mirror_new(spark, sf_dir):
    return _moves(spark, sf_dir).where("status = 'new'")


@query(f"WITH {_MOVES} SELECT * FROM mv WHERE status = 'dropped'")
def mirror_dropped(spark, sf_dir):
    return _moves(spark, sf_dir).where("status = 'dropped'")


_BY_LANGUAGE = _STAR + ", lt AS (SELECT language, class, CAST(sum(count) AS BIGINT) AS count FROM star GROUP BY ALL)"


def _by_language(spark, sf_dir):
    return star(spark, sf_dir).groupBy("language", "class").agg(F.sum("count").alias("count"))


@query(f"""WITH {_BY_LANGUAGE}, r AS (SELECT *, row_number() OVER (PARTITION BY class ORDER BY count DESC, language) AS rn FROM lt)
    SELECT class, language AS label, count, 1 AS n_languages FROM r WHERE rn <= 3
    UNION ALL SELECT class, count(*) || ' more languages not shown', CAST(sum(count) AS BIGINT), count(*) FROM r WHERE rn > 3 GROUP BY class""")
def top_n_other(spark, sf_dir):
    return trends.top_and_other(_by_language(spark, sf_dir), 3)


@query(f"WITH {_BY_LANGUAGE}, c AS (SELECT class, CAST(sum(count) AS BIGINT) AS count FROM lt GROUP BY 1) SELECT class, count, CAST(sum(count) OVER () AS BIGINT) AS grand_total FROM c")
def class_flow(spark, sf_dir):
    return trends.class_flow(_by_language(spark, sf_dir))


@query(f"""WITH {_BY_LANGUAGE}, c AS (SELECT class, CAST(sum(count) AS BIGINT) AS count FROM lt GROUP BY 1), s AS (SELECT *, 360.0 * count / sum(count) OVER () AS sweep FROM c)
    SELECT class, round(sweep, 6) AS sweep, round(coalesce(sum(sweep) OVER (ORDER BY count DESC, class ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0), 6) AS start_angle FROM s""")
def pie_slices(spark, sf_dir):
    c = _by_language(spark, sf_dir).groupBy("class").agg(F.sum("count").alias("count"))
    return trends.pie_slices(c).select("class", F.round("sweep", 6).alias("sweep"), F.round("start_angle", 6).alias("start_angle"))


@query("""WITH ev AS (SELECT CAST(ts AS DATE) AS day, count(*) AS papers, count(*) FILTER (WHERE event_type = 'click') AS flagged FROM events GROUP BY 1),
    wk AS (SELECT DISTINCT CAST(date_trunc('week', ts) AS DATE) AS week_start FROM events), ds AS (SELECT week_start, CAST(week_start + i AS DATE) AS day FROM wk, (SELECT unnest(range(0, 7))::INT AS i))
    SELECT week_start, ds.day, coalesce(papers, 0) AS papers, coalesce(flagged, 0) AS flagged FROM ds LEFT JOIN ev USING (day)""")
def calendar_fill(spark, sf_dir):
    e = read(spark, sf_dir, "events").select(F.to_date("ts").alias("day"), F.when(F.col("event_type") == "click", 1).alias("c"), labels.week_start(F.col("ts")).alias("week_start"))
    daily = e.groupBy("day").agg(F.count("*").alias("papers"), F.count("c").alias("flagged"))
    return trends.fill_week(daily, e.select("week_start").distinct())


# ---- ids, labels, weeks

@query("""SELECT n_nationkey, list_reduce(list_prepend(CAST(0 AS BIGINT), list_transform(string_split(n_name, ''), lambda c: CAST(ascii(c) AS BIGINT))), lambda h, c: (h * 31 + c) % 4294967296) AS hash,
    CAST(list_reduce(list_prepend(CAST(0 AS BIGINT), list_transform(string_split(n_name, ''), lambda c: CAST(ascii(c) AS BIGINT))), lambda h, c: (h * 31 + c) % 4294967296) % 6 AS INT) AS class FROM nation""")
def hash_class(spark, sf_dir):
    return read(spark, sf_dir, "nation").select("n_nationkey", labels.hash31(F.col("n_name")).alias("hash"), labels.hash_class(F.col("n_name")).alias("class"))


@query(f"""WITH {fx.LISTS_SQL} SELECT n_name AS language, coalesce(g.class, CAST(list_reduce(list_prepend(CAST(0 AS BIGINT), list_transform(string_split(n_name, ''), lambda c: CAST(ascii(c) AS BIGINT))), lambda h, c: (h * 31 + c) % 4294967296) % 6 AS INT)) AS class
    FROM (SELECT n_name FROM nation UNION ALL SELECT 'Ha') LEFT JOIN (SELECT language, max(class_id) AS class FROM gaz GROUP BY 1) g ON g.language = n_name""")
def class_or_hash(spark, sf_dir):
    n = read(spark, sf_dir, "nation").select(F.col("n_name").alias("language")).union(spark.createDataFrame([("Ha",)], "language string"))
    return gazetteer.attach_class_or_hash(n, fx.lists(spark)[0])


@query("""SELECT DISTINCT CAST(date_trunc('week', o_orderdate) AS DATE) AS week_start, strftime(date_trunc('week', o_orderdate), '%Y%m%d') || '_to_' || strftime(date_trunc('week', o_orderdate) + INTERVAL 7 DAY, '%Y%m%d') AS slug,
    CAST(date_trunc('week', o_orderdate) + INTERVAL 7 DAY AS DATE) AS week_end, CAST(weekofyear(o_orderdate) AS INT) AS iso_week FROM orders""")
def week_slug(spark, sf_dir):
    w = read(spark, sf_dir, "orders").select(labels.week_start(F.col("o_orderdate")).alias("week_start")).distinct()
    w = w.withColumn("slug", labels.week_slug(F.col("week_start")))
    return w.select(labels.slug_start(F.col("slug")).alias("week_start"), "slug", labels.slug_end(F.col("slug")).alias("week_end"), F.weekofyear("week_start").alias("iso_week"))


@query("SELECT event_id FROM events WHERE ts >= TIMESTAMP '2024-01-08' AND ts < TIMESTAMP '2024-01-15'")
def oai_window(spark, sf_dir):
    end = F.lit("2024-01-15").cast("timestamp_ntz")
    return read(spark, sf_dir, "events").where(labels.in_window(F.col("ts"), end, 7)).select("event_id")


@query("SELECT o_orderkey FROM orders WHERE o_orderdate IS NULL OR strftime(o_orderdate, '%y%m') BETWEEN '9601' AND '9602' OR o_orderkey % 7 = 0")
def month_guard(spark, sf_dir):
    o = read(spark, sf_dir, "orders")  # ids say 20YY, so dates move on by 20 years; ids of each seventh row hold no month
    paper = F.when(F.col("o_orderkey") % 7 == 0, F.lit("cs/0601001")).otherwise(F.concat(F.lit("http://x/abs/"), F.date_format(F.add_months("o_orderdate", 240), "yyMM"), F.lit(".01234")))
    return o.where(labels.month_guard(paper, F.lit("2016-01-31").cast("date"), F.lit("2016-02-10").cast("date"))).select("o_orderkey")


@query("""SELECT c_custkey, CASE WHEN length(a) <= 72 THEN a ELSE n1 || ', ' || n2 || ', ' || n3 || ' et al.' END AS authors FROM (
    SELECT c_custkey, c_name AS n1, c_mktsegment AS n2, c_name AS n3, c_name || ', ' || c_mktsegment || ', ' || c_name || CASE WHEN c_custkey % 2 = 0 THEN ', ' || c_name ELSE '' END AS a FROM customer)""")
def authors_short(spark, sf_dir):
    a = F.array_compact(F.array("c_name", "c_mktsegment", "c_name", F.when(F.col("c_custkey") % 2 == 0, F.col("c_name"))))
    return read(spark, sf_dir, "customer").select("c_custkey", labels.short_authors(a).alias("authors"))


@query("""SELECT p_partkey AS id, CASE p_partkey % 5 WHEN 0 THEN p_size || '.2. ' || p_brand || ' ' || p_name WHEN 1 THEN 'Appendix A. ' || p_brand WHEN 2 THEN 'Untitled section'
    WHEN 3 THEN p_brand ELSE p_size || '. ' || p_brand END AS title FROM part
    UNION ALL SELECT * FROM (VALUES (-1, '3.2. Results and more'), (-2, 'Appendix A. Details'), (-3, 'Untitled section'), (-4, 'Introduction'), (-5, '2. Methods')) AS v(id, title)""")
def section_title(spark, sf_dir):
    kind = F.col("p_partkey") % 5
    raw = (
        F.when(kind == 0, F.concat("p_size", F.lit(".2"), "p_brand", F.lit("  "), "p_name")).when(kind == 1, F.concat(F.lit("Appendix A"), "p_brand"))
        .when(kind == 2, F.lit("  ")).when(kind == 3, F.concat(F.lit(" "), "p_brand")).otherwise(F.concat("p_size", "p_brand"))
    )
    cases = spark.createDataFrame([(-i, t) for i, t in fx.TITLE_CASES], "id long, t string")
    d = read(spark, sf_dir, "part").select(F.col("p_partkey").alias("id"), raw.alias("t")).unionByName(cases)
    return d.select("id", labels.section_title(F.col("t")).alias("title"))


@query("""SELECT p_partkey AS id, p_name AS language, CASE WHEN p_partkey % 5 IN (1, 2) THEN p_size END AS class, CASE WHEN p_partkey % 5 = 2 THEN 'html,' || p_brand ELSE '' END AS sources FROM part
    UNION ALL SELECT * FROM (VALUES (-1, 'Gan', NULL, ''), (-2, 'Gan', 3, ''), (-3, 'Gan', 2, ''), (-4, 'Gan', NULL, ''), (-5, 'Gan', NULL, '')) AS v(id, language, class, sources)""")
def entry_forms(spark, sf_dir):
    kind, quoted = F.col("p_partkey") % 5, F.concat(F.lit('"'), "p_name", F.lit('"'))
    raw = (
        F.when(kind == 0, quoted).when(kind == 1, F.concat(F.lit("["), quoted, F.lit(", "), "p_size", F.lit("]")))
        .when(kind == 2, F.concat(F.lit('{"language": '), quoted, F.lit(', "class": '), "p_size", F.lit(', "sources": ["html", "'), "p_brand", F.lit('"]}')))
        .when(kind == 3, F.concat(F.lit('{"name": '), quoted, F.lit("}"))).otherwise(F.col("p_name"))
    )
    cases = spark.createDataFrame([(-i, e) for i, e in fx.ENTRY_CASES], "id long, e string")
    d = read(spark, sf_dir, "part").select(F.col("p_partkey").alias("id"), raw.alias("e")).unionByName(cases)
    return d.select("id", labels.entry_language(F.col("e")).alias("language"), labels.entry_class(F.col("e")).alias("class"), F.array_join(labels.entry_sources(F.col("e")), ",").alias("sources"))


@query("SELECT c_custkey, CAST(c_custkey AS VARCHAR) AS safe_id, 'http://x.org/abs/' || c_custkey AS normal_id FROM customer")
def paper_ids(spark, sf_dir):
    i = F.concat(F.lit("https://x.org/abs/"), "c_custkey")
    return read(spark, sf_dir, "customer").select("c_custkey", labels.safe_id(i).alias("safe_id"), labels.normal_id(i).alias("normal_id"))


@query("""SELECT p_partkey AS id, p_type || '.' || p_size AS category, p_type || ':' || p_type || ':' || p_size AS spec FROM part
    UNION ALL SELECT p_partkey, 'math', 'math:math' FROM part""")
def category_specs(spark, sf_dir):
    own = F.concat(F.lit("cat:"), "p_type", F.lit("."), "p_size")
    q = read(spark, sf_dir, "part").select(F.col("p_partkey").alias("id"), F.concat(own, F.lit(" OR cat:math OR "), own).alias("q"))
    return q.select("id", F.explode(labels.category_tokens(F.col("q"))).alias("category")).withColumn("spec", labels.set_spec(F.col("category")))


@query(f"WITH {_STAR} SELECT week_start, printf('%.1f%%', round(100.0 * flagged / papers, 1)) AS share, printf('%d (%d%%)', flagged, CAST(round(100.0 * flagged / papers) AS INT)) AS label FROM tot WHERE flagged IS NOT NULL")
def share_labels(spark, sf_dir):
    t = star_totals(spark, sf_dir).where("flagged IS NOT NULL")
    return t.select("week_start", labels.percent(F.col("flagged"), F.col("papers")).alias("share"), labels.count_with_share(F.col("flagged"), F.col("papers")).alias("label"))


@query("SELECT event_id, CAST(json_extract(props, '$.k') AS BIGINT) AS k FROM events")
def json_props(spark, sf_dir):
    return read(spark, sf_dir, "events").select("event_id", F.from_json("props", "k long")["k"].alias("k"))


# ---- paper table

_VIEW = """vw AS (SELECT c_custkey AS paper_id, lower(c_name || ' ' || c_mktsegment) AS s, c_name AS title FROM customer),
det AS (SELECT DISTINCT o_custkey AS paper_id, o_orderpriority AS language, CAST(substr(o_orderpriority, 1, 1) AS INT) AS class FROM orders WHERE o_custkey % 11 <> 0)"""


#: The same with the detections of every paper.
_WHOLE_VIEW = _VIEW.replace(" WHERE o_custkey % 11 <> 0", "")


def paper_view(spark, sf_dir, detections=None):
    c = read(spark, sf_dir, "customer")
    det = _order_detections(spark, sf_dir).where("paper_id % 11 <> 0") if detections is None else detections  # some papers have no chips
    v = c.select(F.col("c_custkey").alias("paper_id"), F.col("c_name").alias("title"), papers.search_text(F.col("c_name"), F.array("c_mktsegment")).alias("search_text"), F.col("c_custkey").alias("index"))
    return papers.with_chips(v, det)


def _order_detections(spark, sf_dir):
    o = read(spark, sf_dir, "orders")
    return o.select(F.col("o_custkey").alias("paper_id"), F.col("o_orderpriority").alias("language"), F.substring("o_orderpriority", 1, 1).cast("int").alias("class")).distinct()


@query(f"WITH {_VIEW} SELECT paper_id FROM vw WHERE contains(s, '1 buil') OR contains(s, '9 auto')")
def paper_search(spark, sf_dir):
    v = paper_view(spark, sf_dir)
    return v.where(papers.matches_text(F.col("search_text"), "1 BUIL ") | papers.matches_text(F.col("search_text"), "9 auto")).select("paper_id")


@query(f"WITH {_WHOLE_VIEW} SELECT paper_id FROM vw WHERE contains(s, 'building') AND paper_id IN (SELECT paper_id FROM det WHERE language = '1-URGENT') AND paper_id IN (SELECT paper_id FROM det WHERE class = 2)")
def paper_filter(spark, sf_dir):
    return papers.filter_papers(paper_view(spark, sf_dir, _order_detections(spark, sf_dir)), "building", "1-URGENT", 2).select("paper_id")


@query(f"WITH {_VIEW} SELECT count(*) FILTER (WHERE contains(s, 'machinery')) AS visible, count(*) AS total FROM vw")
def visible_count(spark, sf_dir):
    return papers.visible_count(paper_view(spark, sf_dir), papers.matches_text(F.col("search_text"), "machinery"))


@query(f"""WITH {_VIEW}, g AS (SELECT paper_id, count(*) AS n, least(min(class), 5) AS m, string_agg(language, ',' ORDER BY class DESC, language) AS chips FROM det GROUP BY 1)
    SELECT vw.paper_id, chips, coalesce(n, 0) AS n_languages, coalesce(m, 5) AS min_class FROM vw LEFT JOIN g USING (paper_id)""")
def paper_chips(spark, sf_dir):
    return paper_view(spark, sf_dir).select("paper_id", F.array_join("languages", ",").alias("chips"), "n_languages", "min_class")


@query(f"""WITH {_VIEW}, g AS (SELECT vw.paper_id, count(det.language) AS n FROM vw LEFT JOIN det USING (paper_id) GROUP BY 1)
    SELECT paper_id, n AS n_languages FROM g ORDER BY n DESC, paper_id""")
def paper_sort(spark, sf_dir):
    return papers.sort_papers(paper_view(spark, sf_dir), "languages_desc").select("paper_id", "n_languages")


_SORTS = {
    "default": "paper_id", "languages_desc": "n DESC, paper_id", "languages_asc": "n, paper_id", "class_asc": "m, paper_id",
    "class_desc": "m DESC, paper_id", "title_asc": "lower(title), paper_id", "title_desc": "lower(title) DESC, paper_id",
}


@query(f"""WITH {_VIEW}, g AS (SELECT vw.paper_id, title, count(det.language) AS n, coalesce(least(min(class), 5), 5) AS m FROM vw LEFT JOIN det USING (paper_id) GROUP BY 1, 2)
    """ + " UNION ALL ".join(f"SELECT '{mode}' AS mode, row_number() OVER (ORDER BY {by}) AS row_number, paper_id, n AS n_languages FROM g" for mode, by in _SORTS.items()))
def paper_sort_modes(spark, sf_dir):
    return papers.numbered_papers(paper_view(spark, sf_dir)).select("mode", "row_number", "paper_id", "n_languages")


@query("""SELECT o_custkey AS paper_id, s AS source, string_agg(DISTINCT o_orderpriority, ',' ORDER BY o_orderpriority) AS languages, CASE s WHEN 'abstract' THEN 1 WHEN 'html' THEN 2 ELSE 4 END AS source_order
    FROM (SELECT *, CASE o_orderstatus WHEN 'O' THEN 'abstract' WHEN 'F' THEN 'html' ELSE 'other' END AS s FROM orders) GROUP BY 1, 2""")
def source_groups(spark, sf_dir):
    s = F.when(F.col("o_orderstatus") == "O", "abstract").when(F.col("o_orderstatus") == "F", "html").otherwise("other")
    d = read(spark, sf_dir, "orders").select(F.col("o_custkey").alias("paper_id"), s.alias("source"), F.col("o_orderpriority").alias("language"))
    return papers.languages_by_source(d).withColumn("languages", F.array_join("languages", ","))


@query("""SELECT o_custkey AS paper_id, o_orderpriority AS language, string_agg(DISTINCT o_orderstatus, ',' ORDER BY o_orderstatus) AS acronyms FROM orders o
    WHERE NOT EXISTS (SELECT 1 FROM orders d WHERE d.o_orderkey % 3 = 0 AND d.o_custkey = o.o_custkey AND d.o_orderpriority = o.o_orderpriority) GROUP BY 1, 2""")
def suppressed_languages(spark, sf_dir):
    o = read(spark, sf_dir, "orders").select(F.col("o_custkey").alias("paper_id"), F.col("o_orderpriority").alias("language"), F.col("o_orderstatus").alias("acronym"), F.lit("acronym_conflict").alias("step"), "o_orderkey")
    return papers.suppressed_languages(o, o.where("o_orderkey % 3 = 0")).withColumn("acronyms", F.array_join("acronyms", ","))


@query("SELECT class_id, count(*) AS count, array_to_string(list_sort(list(language))[1:2], ',') AS examples FROM (SELECT DISTINCT p_type AS language, p_size % 6 AS class_id FROM part) GROUP BY 1")
def class_table(spark, sf_dir):
    g = read(spark, sf_dir, "part").select(F.col("p_type").alias("language"), (F.col("p_size") % 6).alias("class_id")).distinct()
    return papers.class_table(g).withColumn("examples", F.array_join("examples", ","))


@query("SELECT p_brand AS language, count(*) AS count FROM part WHERE contains(lower(p_brand), '#1') GROUP BY 1")
def language_search(spark, sf_dir):
    c = read(spark, sf_dir, "part").groupBy(F.col("p_brand").alias("language")).agg(F.count("*").alias("count"))
    return papers.search_languages(c, "#1")


@query(_MENTIONS + " SELECT DISTINCT language FROM merged WHERE class < 5")
def low_class_languages(spark, sf_dir):
    return papers.low_class_languages(merged(spark, sf_dir), gazetteer.name_classes(fx.lists(spark)[0])).select("language")


@query("""SELECT CAST(id AS BIGINT) AS id, context_initials FROM (VALUES (-1, 'True True'), (-2, 'False False'), (-3, 'True True'), (-4, 'True True'), (-5, 'False False'), (-6, 'True False')) AS v(id, context_initials)
    UNION ALL SELECT doc_id, 'True True' FROM documents""")
def acronym_context(spark, sf_dir):
    d = _acronym_texts(spark, sf_dir)
    words, acronym = clause_words(F.regexp_extract("text", r"^([^(]*)", 1)), F.regexp_extract("text", r"\(([^)]*)\)", 1)
    said = lambda c: F.initcap(c.cast("string"))
    return d.select("id", F.concat_ws(" ", said(spelled_out(words)), said(spells(words, acronym))).alias("context_initials"))

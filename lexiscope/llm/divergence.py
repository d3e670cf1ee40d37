"""Source divergence audit: how far sources of a language lie apart in their terms.

Sort-based streaming. Tasks read documents and sum up what a block of them holds by language, source
and term (documents with the term, occurrences) before anything is shuffled, so a frequent term or a
source with a third of all rows comes down to a row a block. These rows are repartitioned by language
and term and sorted by (lang, term, source, block, named by its smallest document); a scan of run lengths adds
up a source's run and ends a term's run with its document frequency. Terms in enough documents stay,
and a second scan, with each source's shares at hand, emits the partial sums of each pair of sources
that a run has. What a scan holds is the open run: a row a source of the language.

A pair's sum runs over all kept terms, also those that a source lacks. All of a source's missing terms
have one share, so with f(p, q) the term's value, p0 and q0 the shares of a missing term,

    sum f(p, q) = V f(p0, q0) + sum over a's terms of f(p, q0) - f(p0, q0) + the same for b's terms
                  + sum over terms of both of f(p, q) - f(p, q0) - f(p0, q) + f(p0, q0):

only the last part looks at two sources at once; the middle ones sum a source's histogram of counts.
All numbers are whole; products stay in 64 bits up to 9e15 occurrences in a language.

Defined cases: null text, lang and source are empty strings; a row is a document, also where rows
repeat a doc_id or are equal; a group without terms has pairs like any other; a language without
kept terms has pairs of value 0 and no terms; an empty table gives no rows. Values that tie are
ranked by item. Other columns are not read.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lexiscope.llm.common import LOWER_BYTES, staged

#: Letters of ASCII and every code point above it.
TERM = re.compile(rb"[A-Za-z\x80-\xff]+")
#: Entries of a block's tables, after which its sums are emitted.
ENTRIES = 400_000
SCALE = 1_000_000_000
BLOCK = "lang string, term string, source string, block long, n_docs long, n long"


def _blocks(entries: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[tuple, tuple[dict, dict]] = {}
        size, first = 0, None

        def emit() -> Iterator[pa.RecordBatch]:
            for (lang, source), (docs, counts) in held.items():
                k = len(counts)
                terms = pa.array(list(counts), pa.binary()).cast(pa.string())
                n_docs = pa.array(map(docs.__getitem__, counts), pa.int64(), size=k)
                n = pa.array(counts.values(), pa.int64(), size=k)
                yield pa.record_batch([pa.repeat(lang, k), terms, pa.repeat(source, k), pa.repeat(pa.scalar(first, pa.int64()), k), n_docs, n], names=["lang", "term", "source", "block", "n_docs", "n"])

        for batch in batches:
            for lang, source, doc_id, text in zip(*(batch[c].to_pylist() for c in ("lang", "source", "doc_id", "text")), strict=True):
                words = TERM.findall(text.translate(LOWER_BYTES))
                if not words:
                    continue
                docs, counts = held.setdefault((lang, source), ({}, {}))
                size -= len(counts)
                for w in words:
                    counts[w] = counts.get(w, 0) + 1
                for w in set(words):
                    docs[w] = docs.get(w, 0) + 1
                size += len(counts)
                first = doc_id if first is None or (doc_id is not None and doc_id < first) else first
                if size > entries:
                    yield from emit()
                    held.clear()
                    size, first = 0, None
        yield from emit()

    return run


def term_blocks(docs: DataFrame, entries: int = ENTRIES) -> DataFrame:
    """(lang, term, source, block, n_docs, n): sums of a block of documents."""
    text = F.coalesce("text", F.lit("")).cast("binary").alias("text")
    named = [F.coalesce(c, F.lit("")).alias(c) for c in ("lang", "source")]
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), *named, text).mapInArrow(_blocks(entries), BLOCK)


def _breaks(table: pa.Table, *columns: str) -> np.ndarray:
    """The first row of each run of equal values."""
    new = np.zeros(table.num_rows, bool)
    new[:1] = True
    for c in columns:
        x = table[c].combine_chunks()
        new[1:] |= pc.not_equal(x[1:], x[:-1]).to_numpy(zero_copy_only=False)
    return np.flatnonzero(new)


def _numbers(table: pa.Table, column: str) -> np.ndarray:
    return table[column].to_numpy().astype(np.int64)


def _runs(batches: Iterator[pa.RecordBatch], merge) -> Iterator[tuple[pa.Table, np.ndarray]]:
    """Whole runs of (lang, term), some at a time, with the first row of each; ``merge`` shortens what is held of rows read so far."""
    held = None
    for batch in batches:
        if not batch.num_rows:
            continue
        t = pa.Table.from_batches([batch])
        t = merge(t if held is None else pa.concat_tables([held, t]))
        starts = _breaks(t, "lang", "term")
        if last := int(starts[-1]):
            yield t.slice(0, last), starts[:-1]
        held = t.slice(last)
    if held is not None:
        yield held, np.zeros(1, np.int64)


def _by_source(t: pa.Table) -> pa.Table:
    starts = _breaks(t, "lang", "term", "source")
    own = t.take(pa.array(starts))
    for c in ("n_docs", "n"):
        own = own.set_column(own.column_names.index(c), c, pa.array(np.add.reduceat(_numbers(t, c), starts)))
    return own


KEPT = "lang string, term string, source string, n long, n_lang long, first boolean"


def _keep(min_docs: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for t, starts in _runs(batches, _by_source):
            sizes = np.diff(np.append(starts, t.num_rows))
            enough = np.repeat(np.add.reduceat(_numbers(t, "n_docs"), starts) >= min_docs, sizes)
            total = np.repeat(np.add.reduceat(_numbers(t, "n"), starts), sizes)
            first = np.zeros(t.num_rows, bool)
            first[starts] = True
            out = t.select(["lang", "term", "source", "n"]).append_column("n_lang", pa.array(total)).append_column("first", pa.array(first))
            yield from out.filter(pa.array(enough)).combine_chunks().to_batches()

    return run


def kept_terms(docs: DataFrame, min_docs: int = 10, entries: int = ENTRIES) -> DataFrame:
    """(lang, term, source, n, n_lang, first) of terms in at least ``min_docs`` documents of a language; ``first`` marks a row for each term."""
    order = [F.xxhash64("lang", "term"), "lang", "term", "source", "block"]  # most comparisons are of one number
    ranged = term_blocks(docs, entries).repartition("lang", "term").sortWithinPartitions(*order)
    return ranged.mapInArrow(_keep(min_docs), KEPT)


def share(n: Column, d: Column) -> Column:
    """1 + floor(SCALE * (n + 2) / d), by long division with three digits at a time."""
    out, rest = F.lit(0).cast("long"), n + 2
    for _ in range(3):
        out = out * 1000 + F.call_function("div", rest * 1000, d)
        rest = (rest * 1000) % d
    return out + 1


def value(p: Column, q: Column) -> Column:
    return F.call_function("div", (p - q) * (p - q), p + q)


PARTIAL = "lang string, source string, item string, value long"
#: Sums of pairs that a task holds before it emits them.
PAIRS = 500_000


def _pairs(limit: int):
    f = lambda p, q: (p - q) * (p - q) // (p + q)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[tuple, int] = {}

        def emit() -> pa.RecordBatch:
            cols = [pa.array([k[i] for k in sums], pa.string()) for i in range(3)]
            return pa.record_batch([*cols, pa.array(sums.values(), pa.int64(), size=len(sums))], names=["lang", "source", "item", "value"])

        for t, starts in _runs(batches, lambda t: t):
            run_of = np.repeat(np.arange(len(starts)), np.diff(np.append(starts, t.num_rows)))
            p, p0 = _numbers(t, "p"), _numbers(t, "p0")
            named = [t[c].combine_chunks().dictionary_encode() for c in ("lang", "source")]
            lang, source = (x.indices.to_numpy().astype(np.int64) for x in named)
            langs, names = (x.dictionary.to_pylist() for x in named)
            for far in range(1, int(np.diff(np.append(starts, t.num_rows)).max())):
                a = np.flatnonzero(run_of[far:] == run_of[:-far])
                b = a + far
                both = f(p[a], p[b]) - f(p[a], p0[b]) - f(p0[a], p[b]) + f(p0[a], p0[b])
                pair, at = np.unique((lang[a] * len(names) + source[a]) * len(names) + source[b], return_inverse=True)
                total = np.zeros(len(pair), np.int64)
                np.add.at(total, at, both)
                for k, v in zip(pair.tolist(), total.tolist(), strict=True):
                    rest, y = divmod(k, len(names))
                    z, x = divmod(rest, len(names))
                    key = (langs[z], names[x], names[y])
                    sums[key] = sums.get(key, 0) + v
                if len(sums) > limit:
                    yield emit()
                    sums.clear()
        if sums:
            yield emit()

    return run


def audit(docs: DataFrame, min_docs: int = 10, top: int = 10, entries: int = ENTRIES) -> DataFrame:
    """(lang, source, part, item, value, rank): for each source, all others of its language by divergence, and its ``top`` terms above the language's share."""
    kept = staged(kept_terms(docs, min_docs, entries), "kept-terms")
    named = [F.coalesce(c, F.lit("")).alias(c) for c in ("lang", "source")]
    langs = kept.groupBy("lang").agg(F.count_if("first").alias("v"), F.sum("n").alias("n_all"))
    groups = docs.select(*named).distinct().join(kept.groupBy("lang", "source").agg(F.sum("n").alias("n_own")), ["lang", "source"], "left")
    groups = groups.join(langs, "lang", "left").na.fill(0, ["v", "n_own", "n_all"])
    d = F.when(F.col("v") > 0, F.col("n_own") + 2 * F.col("v"))  # null without kept terms
    groups = staged(groups.select("lang", "source", "v", d.alias("d"), (F.col("n_all") + 2 * F.col("v")).alias("d_lang"), share(F.lit(0).cast("long"), d).alias("p0")), "groups")
    shares = kept.join(groups, ["lang", "source"]).withColumn("p", share(F.col("n"), F.col("d")))

    others = groups.select("lang", F.col("source").alias("item"), F.col("p0").alias("q0"))
    base = groups.join(others, "lang").where("source <> item").select(
        "lang", "source", "item", F.when(F.col("v") > 0, F.col("v") * value(F.col("p0"), F.col("q0"))).otherwise(0).alias("value")
    )
    counts = shares.groupBy("lang", "source", "p", "p0").agg(F.count("*").alias("terms"))
    one = counts.join(others, "lang").where("source <> item").select(
        "lang", "source", "item", (F.col("terms") * (value(F.col("p"), F.col("q0")) - value(F.col("p0"), F.col("q0")))).alias("value")
    )
    one = one.groupBy("lang", "source", "item").agg(F.sum("value").alias("value"))
    runs = shares.select("lang", "term", "source", "p", "p0").repartition("lang", "term").sortWithinPartitions("lang", "term", "source")
    both = runs.mapInArrow(_pairs(PAIRS), PARTIAL)
    either = one.union(both)
    mirrored = either.union(either.select("lang", F.col("item").alias("source"), F.col("source").alias("item"), "value"))
    pairs = base.union(mirrored).groupBy("lang", "source", "item").agg(F.sum("value").alias("value"))

    above = shares.withColumn("q", share(F.col("n_lang"), F.col("d_lang"))).where("p > q")
    terms = above.select("lang", "source", F.col("term").alias("item"), value(F.col("p"), F.col("q")).alias("value"))
    order = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    ranked = lambda rows, part: rows.select("lang", "source", F.lit(part).alias("part"), "item", "value", F.row_number().over(order).alias("rank"))
    return ranked(pairs, "pair").union(ranked(terms, "term").where(F.col("rank") <= top))


def digest(docs: DataFrame) -> DataFrame:
    """The columns of op11."""
    return audit(docs)


SQL = """
WITH d AS (SELECT doc_id, coalesce(text, '') AS text, coalesce(lang, '') AS lang, coalesce(source, '') AS source FROM documents),
w AS (
  SELECT doc_id, lang, source, unnest(regexp_extract_all(
    translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x00-\\x40\\x5B-\\x60\\x7B-\\x7F]+')) AS term FROM d
),
k AS (SELECT lang, term, count(*) AS n_lang FROM w GROUP BY lang, term HAVING count(DISTINCT doc_id) >= 10),
v AS (SELECT lang, count(*) AS v, sum(n_lang) AS n_all FROM k GROUP BY lang),
c AS (SELECT w.lang, w.source, term, count(*) AS n FROM w JOIN k USING (lang, term) GROUP BY ALL),
o AS (SELECT lang, source, sum(n) AS n_own FROM c GROUP BY ALL),
g AS (
  SELECT lang, source, coalesce(v, 0) AS v, CAST(coalesce(n_own, 0) + 2 * coalesce(v, 0) AS HUGEINT) AS dd,
    CAST(coalesce(n_all, 0) + 2 * coalesce(v, 0) AS HUGEINT) AS dl
  FROM (SELECT DISTINCT lang, source FROM d) LEFT JOIN v USING (lang) LEFT JOIN o USING (lang, source)
),
s AS (
  SELECT g.lang, g.source, k.term, coalesce(c.n, 0) AS n, 1 + (CAST(1000000000 AS HUGEINT) * (coalesce(c.n, 0) + 2)) // dd AS p,
    1 + (CAST(1000000000 AS HUGEINT) * (n_lang + 2)) // dl AS q
  FROM g JOIN k USING (lang) LEFT JOIN c ON c.lang = g.lang AND c.source = g.source AND c.term = k.term
),
f AS (SELECT a.lang, a.source, b.source AS item, sum((a.p - b.p) * (a.p - b.p) // (a.p + b.p)) AS x
  FROM s a JOIN s b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY ALL),
r AS (
  SELECT a.lang, a.source, 'pair' AS part, b.source AS item, CAST(coalesce(x, 0) AS BIGINT) AS value
  FROM g a JOIN g b ON a.lang = b.lang AND a.source <> b.source LEFT JOIN f ON f.lang = a.lang AND f.source = a.source AND f.item = b.source
  UNION ALL
  SELECT lang, source, 'term', term, CAST((p - q) * (p - q) // (p + q) AS BIGINT) FROM s WHERE n > 0 AND p > q
),
z AS (SELECT *, CAST(row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS INT) AS rank FROM r)
SELECT * FROM z WHERE part = 'pair' OR rank <= 10
"""

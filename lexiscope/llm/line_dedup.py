"""Line dedup across documents, with DataFrame functions alone.

Every line gets a 128-bit key hash, and hashes are written to the shared folder once, so that ranges
can be drawn from a sample of them and not of texts. They are range-partitioned together with a salt of
the document, sorted by document (largest first) and position within, and a window streams over each
run to mark first occurrences; the window needs no other exchange than the ranges. A key that a third
of all documents hold takes up a third of the sample too, so ranges part it between its salts (one a
shuffle partition) and it never meets in one task. A key's runs in all salts are then summed (map-side
combined), and the sums go back to each share of the key. What travels between stages is a hash, a
document id and a position; the result is a sparse bitmap of 64-line words per document.

Defined cases: a null text is one empty line; a null doc_id is one document, ordered below all
others, so it is never the one that keeps a repeated line; rows that repeat a doc_id are one
document as far as counting goes, and all of them keep the line if that doc_id is the largest
holder. Keys that are shorter than ``min_chars`` never count. Extra columns are carried along.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lexiscope.llm.common import ASCII_SPACE, ascii_lower, salts, staged, with_totals

NO_ID = -(2**63)


def split_lines(text: Column) -> Column:
    return F.split(F.coalesce(text, F.lit("")), "\n")


def line_key(line: Column) -> Column:
    return ascii_lower(F.trim(line, F.lit(ASCII_SPACE)))


def _rows(docs: DataFrame) -> DataFrame:
    """The identity of a row: its id (null: the smallest number) and its text's hash, for rows that repeat an id."""
    return docs.select(F.coalesce("doc_id", F.lit(NO_ID)).alias("rid"), F.xxhash64("text").alias("rhash"), "text")


def repeated_lines(docs: DataFrame, min_chars: int = 20, min_docs: int = 3) -> DataFrame:
    """(rid, rhash, pos) of each line to drop."""
    lines = _rows(docs).select("rid", "rhash", F.posexplode(split_lines(F.col("text"))).alias("pos", "line"))
    keyed = lines.select("rid", "rhash", "pos", line_key(F.col("line")).alias("key")).where(F.length("key") >= min_chars)
    ranges = salts(docs.sparkSession)
    salt = F.pmod(F.xxhash64("rid"), F.lit(ranges)).cast("int")
    hashed = keyed.select("rid", "rhash", "pos", F.xxhash64("key").alias("h1"), F.xxhash64(F.lit(7), "key").alias("h2"), salt.alias("salt"))
    run_key = ["h1", "h2", "salt"]
    ranged = staged(hashed, "line-hashes").repartitionByRange(ranges, *run_key).sortWithinPartitions(*run_key, F.desc("rid"), "pos")
    run = Window.partitionBy(*run_key).orderBy(F.desc("rid"), "pos")
    first = (F.row_number().over(run) == 1) | (F.lag("rid").over(run) != F.col("rid"))
    seen = staged(ranged.withColumn("first", first).drop("salt"), "lines")  # read twice below
    counted = with_totals(
        seen, ["h1", "h2"], "rid", F.count_if("first").alias("n_docs"), F.max("rid").alias("keeper"), having=f"n_docs >= {min_docs}"
    )
    return counted.where(F.col("rid") < F.col("keeper")).select("rid", "rhash", "pos")


def keep_bitmaps(docs: DataFrame, min_chars: int = 20, min_docs: int = 3) -> DataFrame:
    """(rid, rhash, words, n_dropped): per document that loses lines, its keep bitmap.

    words is an array of struct(word long, keep long); bit i of keep is line 64 * word + i. Words
    that are not listed keep all their lines.
    """
    drops = repeated_lines(docs, min_chars, min_docs)
    bits = drops.groupBy("rid", "rhash", F.shiftright("pos", 6).alias("word")).agg(
        F.expr("bit_or(shiftleft(1L, pos & 63))").alias("drop")
    )
    return bits.groupBy("rid", "rhash").agg(
        F.sort_array(F.collect_list(F.struct("word", F.expr("~drop").alias("keep")))).alias("words"),
        F.sum(F.expr("bit_count(drop)")).cast("long").alias("n_dropped"),
    )


def dedup_lines(docs: DataFrame, min_chars: int = 20, min_docs: int = 3) -> DataFrame:
    """docs with ``text`` replaced by what is kept, and the columns ``n_lines`` and ``n_dropped`` (which replace any of these names)."""
    maps = keep_bitmaps(docs, min_chars, min_docs).withColumnsRenamed(
        {"rid": "_rid", "rhash": "_rhash", "n_dropped": "_dropped", "words": "_words"}
    )
    lines = split_lines(F.col("text"))
    #: The bitmap as an array indexed by word, so that a line's bit is found at once: listed words, each after as many full ones as it takes.
    dense = F.expr(
        "flatten(transform(_words, (w, k) -> concat(array_repeat(-1L, CAST(w.word - IF(k = 0, -1, get(_words, k - 1).word) - 1 AS INT)), array(w.keep))))"
    )
    kept = F.expr(
        "array_join(filter(_lines, (l, i) -> coalesce((shiftright(get(_dense, shiftright(i, 6)), i & 63) & 1L) = 1L, true)), '\n')"
    )
    joined = docs.drop("n_lines", "n_dropped").withColumns(
        {"_id": F.coalesce("doc_id", F.lit(NO_ID)), "_hash": F.xxhash64("text")}
    ).join(maps, (F.col("_id") == F.col("_rid")) & (F.col("_hash") == F.col("_rhash")), "left")
    return (
        joined.withColumn("_lines", lines)
        .withColumn("_dense", dense)
        .withColumn("text", F.when(F.col("_words").isNull(), F.col("text")).otherwise(kept))
        .withColumn("n_lines", F.size("_lines").cast("long"))
        .withColumn("n_dropped", F.coalesce("_dropped", F.lit(0)).cast("long"))
        .drop("_id", "_hash", "_rid", "_rhash", "_dropped", "_words", "_lines", "_dense")
    )


def digest(docs: DataFrame) -> DataFrame:
    """The columns of op4."""
    d = dedup_lines(docs.select("doc_id", "text"))
    return d.select("doc_id", "n_lines", "n_dropped", F.sha2(F.coalesce("text", F.lit("")), 256).alias("kept_sha256"))


SQL = """
WITH d AS (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS ls FROM documents),
l AS (SELECT doc_id, unnest(ls) AS line, unnest(range(1, len(ls) + 1)) AS pos FROM d),
k AS (
  SELECT *, translate(trim(line, chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key FROM l
),
f AS (
  SELECT key, max(doc_id) AS keeper FROM k WHERE length(key) >= 20
  GROUP BY key HAVING count(DISTINCT doc_id) >= 3
),
r AS (SELECT k.doc_id, pos, line, coalesce(k.doc_id < f.keeper, false) AS dropped FROM k LEFT JOIN f USING (key))
SELECT doc_id, count(*) AS n_lines, CAST(sum(CAST(dropped AS INT)) AS BIGINT) AS n_dropped,
  sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (WHERE NOT dropped), '')) AS kept_sha256
FROM r GROUP BY doc_id
"""

"""Quality classifier from weak labels.

Overlapping heuristic labellers vote good, bad or abstain on each text from simple measures that one
scan takes on the executors. The votes of all documents are counted by pattern (at most 3 to the
number of labellers, whatever the corpus), expectation-maximisation estimates each labeller's
accuracy from these counts, and the posterior labels of a bounded sample train a linear scorer over
hashed token shapes. Human labels are not used at all; they are for evaluation.

Defined cases: a null or empty text gets the measures of an empty text and the vote ``bad`` of
two labellers, so it is scored like any other; rows that repeat are scored one by one. Extra
columns are carried along; the new columns replace their namesakes.
"""

from __future__ import annotations

import functools
import re
import zlib
from collections import Counter
from collections.abc import Iterator
from operator import eq

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lexiscope.llm import label_model

#: Texts that the scorer is fitted on, by hash, and their characters.
SAMPLE_ROWS, SAMPLE_CHARS = 6_000, 24_000_000
BUCKETS = 1 << 12
THRESHOLD = 0.5
#: Share of good texts before any vote is counted.
START_BALANCE = 0.85

MEASURES = ("symbols", "capitals", "repeats", "top_word", "odd_tokens", "bars", "mean_word", "n_words", "runs")


def counted(text: str | None) -> tuple[list[str], Counter]:
    words = (text or "").split()
    return words, Counter(words)


def measures(text: str | None, words: list[str], counts: Counter) -> tuple[float, ...]:
    """Shares of symbols, of capitals among other characters, of words seen before, of the commonest word, of
    tokens with symbols on them, of tokens that are bars; the mean length of words; their number; the share of
    words that repeat the word before."""
    data, n = (text or "").encode("utf-8", "surrogatepass"), len(words) or 1
    symbols = len(data) - len(data.translate(None, _SYMBOLS))
    capitals = len(data) - len(data.translate(None, _CAPITALS))
    letters = len(data) - symbols - data.count(b" ") - data.count(b"\n")
    odd = sum(c for w, c in counts.items() if w[-1] in _SYMBOL_SET or w[0] in _SYMBOL_SET)
    return (
        symbols / (len(data) or 1), capitals / (letters or 1), 1 - len(counts) / n,
        max(counts.values(), default=0) / n, odd / n, counts.get("|", 0) / n,
        sum(map(len, words)) / n, float(len(words)), sum(map(eq, words, words[1:])) / n,
    )


_SYMBOLS = b"#$%&*@^_~<>{}[]\\|=+!"
_SYMBOL_SET = frozenset(_SYMBOLS.decode())
_CAPITALS = b"ABCDEFGHIJKLMNOPQRSTUVWXYZ"

_PLAIN = "symbols < 0.01 AND (capitals < 0.3 OR n_words < 5) AND bars < 0.01"
_VARIED = "(n_words < 30 OR (repeats <= 0.85 AND top_word <= 0.2)) AND (n_words < 10 OR runs <= 0.2)"
#: name -> SQL for a vote. Most labellers know one kind of poor text and abstain on the rest.
LABELLERS = {
    "symbols": "CASE WHEN symbols > 0.04 THEN -1 ELSE 0 END",
    "odd_tokens": "CASE WHEN odd_tokens > 0.2 THEN -1 ELSE 0 END",
    "shouting": "CASE WHEN capitals > 0.3 AND n_words >= 5 THEN -1 ELSE 0 END",
    "repetition": "CASE WHEN n_words >= 30 AND repeats > 0.85 THEN -1 ELSE 0 END",
    "top_word": "CASE WHEN n_words >= 30 AND top_word > 0.2 THEN -1 ELSE 0 END",
    "runs": "CASE WHEN n_words >= 10 AND runs > 0.2 THEN -1 ELSE 0 END",
    "bars": "CASE WHEN bars > 0.05 THEN -1 ELSE 0 END",
    "word_length": "CASE WHEN mean_word > 15 OR mean_word < 2 THEN -1 ELSE 0 END",
    "plain": f"CASE WHEN {_PLAIN} THEN 1 ELSE 0 END",
    "varied": f"CASE WHEN {_VARIED} THEN 1 ELSE 0 END",
    "prose": f"CASE WHEN {_PLAIN} AND {_VARIED} AND n_words >= 20 THEN 1 WHEN n_words < 1 THEN -1 ELSE 0 END",
}
#: Letters as x or X, digits as 9.
_CLASSES = bytes(
    120 if 97 <= c <= 122 or c >= 128 else 88 if 65 <= c <= 90 else 57 if 48 <= c <= 57 else c for c in range(256)
)
_RUN = re.compile(rb"(.)\1+")


def shape(word: str) -> bytes:
    """A token's kinds of characters in order, each run once, at most 12."""
    return _RUN.sub(rb"\1", word.encode("utf-8", "surrogatepass").translate(_CLASSES))[:12]


class Shapes(dict):
    """Hashed shapes by word; bounded."""

    def __missing__(self, word: str) -> int:
        if len(self) >= 600_000:
            self.clear()
        self[word] = k = zlib.crc32(shape(word)) % BUCKETS
        return k


@functools.cache
def shared_shapes() -> Shapes:
    """One for each Python worker."""
    return Shapes()


def hashed_features(counts: Counter, shapes: Shapes, m: tuple[float, ...]) -> dict[int, float]:
    """Shares of token shapes, and what repeats, by bucket."""
    n = int(m[7]) or 1
    out: dict[int, float] = {}
    for w, c in counts.items():
        k = shapes[w]
        out[k] = out.get(k, 0.0) + c / n
    for name, v in (("top", m[3]), ("runs", m[8]), ("capitals", m[1]), ("symbols", m[0]), ("repeats", max(0.0, m[2] - 0.75) if n >= 30 else 0.0), ("none", float(not counts))):
        k = zlib.crc32(b"=" + name.encode()) % BUCKETS
        out[k] = out.get(k, 0.0) + v
    return out


def _measure(schema: pa.Schema):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [measures(t, *counted(t)) for t in batch["text"].to_pylist()]
            columns = {n: batch[n] for n in batch.schema.names}
            columns |= dict(zip(MEASURES, (pa.array([r[k] for r in rows], pa.float64()) for k in range(len(MEASURES))), strict=True))
            yield from pa.table({n: columns[n] for n in schema.names}).cast(schema).to_batches()

    return run


def measured(docs: DataFrame) -> DataFrame:
    from pyspark.sql.pandas.types import to_arrow_schema

    rest = docs.drop(*MEASURES)
    out = rest.withColumns({m: F.lit(0.0) for m in MEASURES}).schema
    return rest.mapInArrow(_measure(to_arrow_schema(out)), out)


def votes(measured_docs: DataFrame) -> DataFrame:
    return measured_docs.withColumn("votes", F.array(*(F.expr(x) for x in LABELLERS.values())))


def fit_labels(docs: DataFrame) -> label_model.LabelModel:
    """The label model from the votes on all documents."""
    counts = votes(measured(docs.select("text"))).groupBy("votes").count().collect()  # at most 3 ** labellers patterns
    counts = sorted((tuple(r[0]), r[1]) for r in counts) or [((1,) * len(LABELLERS), 1)]  # in an order of their own, so sums don't vary
    return label_model.fit(np.array([p for p, _ in counts]), np.array([n for _, n in counts], float), START_BALANCE, share_of_good(np.array([p for p, _ in counts])))


def share_of_good(patterns: np.ndarray) -> np.ndarray:
    """Where estimation starts: the plain share of good votes among those cast (with one of each before any vote), whatever the labeller."""
    return ((patterns > 0).sum(axis=1) + 1) / ((patterns != 0).sum(axis=1) + 2)


def sample_texts(docs: DataFrame) -> DataFrame:
    """SAMPLE_ROWS distinct texts in order of their hash, those over a 20th of SAMPLE_CHARS last; only hashes are shuffled to find them."""
    key = F.struct((F.length("text") > SAMPLE_CHARS // 20).alias("long"), F.xxhash64("text").alias("h"))
    keyed = docs.select("text").where("text IS NOT NULL").withColumn("key", key)
    last = keyed.select("key").distinct().orderBy("key").limit(SAMPLE_ROWS).agg(F.max("key")).first()[0]
    if last is None:
        return keyed.select("text").limit(0)
    within = F.col("key") <= F.struct(F.lit(last.long).alias("long"), F.lit(last.h).cast("long").alias("h"))
    return keyed.where(within).distinct().orderBy("key", "text").limit(SAMPLE_ROWS).select("text")


def fit(docs: DataFrame) -> tuple[np.ndarray, float, label_model.LabelModel]:
    labels = fit_labels(docs)
    sample = votes(measured(sample_texts(docs)))
    shapes, r, c, v, p, size = Shapes(), [], [], [], [], 0
    for row in sample.toLocalIterator():
        if size + len(row.text) > SAMPLE_CHARS:
            continue
        size += len(row.text)
        f = hashed_features(counted(row.text)[1], shapes, tuple(row[m] for m in MEASURES))
        r += [len(p)] * len(f)
        c += f.keys()
        v += f.values()
        p.append(row.votes)
    if not p:
        return np.zeros(BUCKETS), 0.0, labels
    target = labels.posterior(np.array(p))
    w, b = label_model.train_linear(np.array(r), np.array(c), np.array(v), len(p), BUCKETS, target, np.ones(len(p)), l2=1e-5, steps=400)
    return w, b, labels


def _score(model, schema: pa.Schema):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        (w, b), shapes = model.value, shared_shapes()
        w = w.tolist()
        for batch in batches:
            z = []
            for t in batch["text"].to_pylist():
                words, counts = counted(t)
                features = hashed_features(counts, shapes, measures(t, words, counts))
                z.append(b + sum(w[k] * v for k, v in sorted(features.items())))
            scores = 1 / (1 + np.exp(-np.clip(np.array(z), -500, 500)))
            columns = {n: batch[n] for n in batch.schema.names}
            columns["score"] = pa.array(scores, pa.float64())
            yield from pa.table({n: columns[n] for n in schema.names}).cast(schema).to_batches()

    return run


def score_documents(docs: DataFrame) -> DataFrame:
    """docs with score, from 0 (poor) to 1."""
    from pyspark.sql.pandas.types import to_arrow_schema

    w, b, _ = fit(docs)
    model = docs.sparkSession.sparkContext.broadcast((w, b))  # BUCKETS weights
    rest = docs.drop("score")
    out = rest.withColumn("score", F.lit(0.0)).schema
    return rest.mapInArrow(_score(model, to_arrow_schema(out)), out)


def digest(docs: DataFrame) -> DataFrame:
    d = score_documents(docs.select("doc_id", "text"))
    return d.select("doc_id", "score", (F.col("score") >= THRESHOLD).alias("kept"))

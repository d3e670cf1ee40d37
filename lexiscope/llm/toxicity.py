"""Toxicity by weak supervision.

From a bounded sample of labelled texts, words and word beginnings that come up in toxic texts far
more often than chance allows become lexicons; an occurrence counts once for its neighbourhood
(the word before, the word, the word after), so that copies of a text don't add up. Lexicons of each
kind, dealt into several voters, a general list of insults, and pattern voters vote on each text.
The annotator is one more voter. A generative label model estimates the voters' accuracies and
correlations, and a linear classifier over hashed lexicon and pattern features is trained on its
posterior labels. Labels outside the training rows are never read; lang, source and doc_id are
never inputs.

Whole texts are scored on the executors with the (small) model.

Defined cases: a null or empty text has the score of a text without any feature; rows that repeat a
doc_id are scored one by one; a null doc_id is not held out; labels of null doc_ids or with null
toxic are not used; with any labels or none the classifier also learns from the general list's insults, as
texts of one word, and from empty texts as clean ones. Extra columns are carried along; the new columns replace their namesakes.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lexiscope.llm import label_model

#: Rows of labelled text that the lexicons, the label model and the classifier are fitted on, and their characters.
SAMPLE_ROWS, SAMPLE_CHARS = 8_000, 20_000_000
#: A general list of insults, fixed.
INSULTS = frozenset(
    "idiot idiots stupid moron morons dumb loser losers trash scum garbage pathetic worthless disgusting clown clowns "
    "imbecile fool filthy vermin creep jerk bastard degenerate retard ugly hate kill".split()
)
#: Empty texts, labelled clean, for each insult, labelled toxic, that are added to a sample.
CLEAN = 9
PREFIXES = (3, 4, 5, 6, 7, 8)
VOTERS_OF_A_KIND = 3
BUCKETS = 1 << 14
THRESHOLD = 0.7
_WORD = re.compile(r"\w+")
_SHOUT, _BANG, _MASKED, _YOU = (
    re.compile(x) for x in (r"\b[A-Z]{3,}\b(?:\W+[A-Z]{2,}\b){4}", r"[!?]{3}", r"\b\w[*#@$]{2,}\w?\b", r"(?i)\byou(?:'re| are) (?:an? )?\w+")
)
PATTERNS = (_SHOUT, _BANG, _MASKED, _YOU)


def held_out(doc_id: Column) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string")) % 3 == 1, F.lit(False))


def features_of(word: str) -> list[str]:
    return ["w:" + word] + [f"{n}:{word[:n]}" for n in PREFIXES if len(word) > n]


def mine_lexicon(texts: list[str], labels: np.ndarray) -> dict[str, float]:
    """Features that toxic texts have more often than chance allows, with their log-odds."""
    ids: dict[str, int] = {}
    keys = [np.zeros((0, 3), np.int32)]
    marks = [np.zeros(0, np.int8)]
    for text, y in zip(texts, labels, strict=True):
        w = np.fromiter((ids.setdefault(x, len(ids)) for x in _WORD.findall(text.lower())), np.int32)
        if len(w):
            around = np.concatenate([[-1], w, [-1]]).astype(np.int32)
            keys.append(np.stack([w, around[:-2], around[2:]], axis=1))
            marks.append(np.full(len(w), y, np.int8))
    at, y = np.concatenate(keys), np.concatenate(marks)
    del keys, marks
    code = (at[:, 0].astype(np.int64) * (len(ids) + 2) + at[:, 1] + 1) * np.int64(0x9E3779B1) + at[:, 2]
    _, first = np.unique(code * 2 + y, return_index=True)
    word, y = at[first, 0], y[first]
    del at, code, first
    pos, neg = (np.bincount(word[y == c], minlength=len(ids)) for c in (1, 0))
    rate = pos.sum() / max(1, pos.sum() + neg.sum())
    if not 0 < rate < 1:
        return {}
    some: dict[str, int] = {}
    for w, p in zip(ids, pos.tolist(), strict=True):
        if p:
            for f in features_of(w):
                some[f] = some.get(f, 0) + p
    tried = len(some)
    against = {f: 0 for f, p in some.items() if p >= 3}
    for w, q in zip(ids, neg.tolist(), strict=True):
        if q:
            for f in features_of(w):
                if f in against:
                    against[f] += q
    names = [f for f, q in against.items() if some[f] / (some[f] + q) > max(0.5, 2 * rate)]
    p, q = np.array([some[f] for f in names], float), np.array([against[f] for f in names], float)
    share = p / (p + q)
    g2 = 2 * (p * np.log(share / rate) + q * np.log(np.maximum(1 - share, 1e-300) / (1 - rate)) * (q > 0))
    enough = 2 * np.log(tried)
    odds = np.log((p + 0.5) / (q + 0.5) * (1 - rate) / rate)
    return {f: float(o) for f, o, g, s in zip(names, odds, g2, share, strict=True) if g > enough and s > 0.8}


class Model:
    """A lexicon with buckets and weights; picklable."""

    def __init__(self, lexicon: dict[str, float], weights: dict[int, float], bias: float, cache: int = 100_000):
        self.lexicon, self.weights, self.bias, self.cache = lexicon, weights, bias, cache
        self.known: dict[str, tuple[str, ...]] = {}

    def found(self, text: str) -> set[str]:
        """Lexicon and pattern features of a text."""
        out: set[str] = set()
        known, lexicon = self.known, self.lexicon
        for w in set(_WORD.findall(text.lower())):
            f = known.get(w)
            if f is None:
                if len(known) > self.cache:
                    known.clear()
                f = known[w] = tuple(x for x in features_of(w) if x in lexicon) + (("i:" + w,) if w in INSULTS else ())
            out.update(f)
        out.update(f"p:{k}" for k, p in enumerate(PATTERNS) if p.search(text))
        return out

    def score(self, text: str | None) -> float:
        z = self.bias + sum(self.weights.get(bucket(f), 0.0) for f in sorted(self.found(text or "")))
        return float(1 / (1 + np.exp(-np.clip(z, -500, 500))))


def bucket(feature: str) -> int:
    return zlib.crc32(feature.encode("utf-8", "surrogatepass")) % BUCKETS


def votes_of(found: set[str]) -> list[int]:
    """A row of votes: lexicon voters by kind and share, the list of insults, patterns (never negative alone)."""
    kinds = ["w:", *(f"{n}:" for n in PREFIXES)]
    out = [0] * (len(kinds) * VOTERS_OF_A_KIND)
    for f in found:
        kind = f[:2]
        if kind in kinds:
            out[kinds.index(kind) * VOTERS_OF_A_KIND + bucket(f) % VOTERS_OF_A_KIND] = 1
    insult = any(f.startswith("i:") for f in found)
    out.append(1 if insult else 0)
    out.append(1 if any(out) else -1)  # no lexicon at all speaks for a clean text
    out.extend(1 if f"p:{k}" in found else 0 for k in range(len(PATTERNS)))
    return out


def fit(rows: list[tuple[str, int]]) -> Model:
    """From labelled texts, each distinct text once. The label model sees these alone; the classifier also gets texts of one insult
    each and CLEAN empty ones for each of them, with any labels or none, so insults of the list that the sample lacks have a weight."""
    known = sorted(dict(rows).items())
    texts, y = [t for t, _ in known], np.array([v for _, v in known], np.int64)
    model = Model(mine_lexicon(texts, y) if known else {}, {}, 0.0)
    found = [model.found(t) for t in texts]
    votes = np.array([[*votes_of(f), 2 * v - 1] for f, v in zip(found, y.tolist(), strict=True)], np.int64).reshape(len(known), len(votes_of(set())) + 1)
    patterns, which, counts = np.unique(votes, axis=0, return_inverse=True, return_counts=True)
    rate = float(np.clip(y.mean() if known else 0.5, 0.01, 0.99))
    labels = label_model.fit(patterns, counts.astype(float), rate, np.where(patterns[:, -1] > 0, 0.9, 0.1))
    insults = sorted(INSULTS)
    found += [model.found(w) for w in insults] + [set()] * (CLEAN * len(insults))
    target = np.concatenate([labels.posterior(patterns)[which.ravel()], np.full(len(insults), 0.99), np.full(CLEAN * len(insults), 0.01)])
    pairs = [(i, bucket(f)) for i, own in enumerate(found) for f in own]
    r, c = np.array(pairs, np.int64).reshape(-1, 2).T
    w, b = label_model.train_linear(r, c, np.ones(len(r)), len(found), BUCKETS, target, np.ones(len(found)))
    weights = {int(k): float(w[k]) for k in np.unique(c)}
    return Model(model.lexicon, weights, b)


def training_rows(docs: DataFrame, labels: DataFrame, n: int = SAMPLE_ROWS, chars: int = SAMPLE_CHARS) -> list[tuple[str, int]]:
    """A sample by hash of the labelled rows that aren't held out, within both bounds: texts over a 20th of chars last, those that don't fit skipped."""
    own = labels.where(F.col("toxic").isin(0, 1) & F.col("doc_id").isNotNull() & ~held_out(F.col("doc_id")))
    picked = own.select("doc_id", F.col("toxic").cast("int").alias("toxic")).distinct().orderBy(F.xxhash64("doc_id"), "toxic").limit(n)
    joined = docs.select("doc_id", "text").join(F.broadcast(picked), "doc_id").where("text IS NOT NULL")
    running = 0
    out = []
    for r in joined.select("text", "toxic").orderBy(F.length("text") > chars // 20, F.xxhash64("text"), "toxic").limit(n).toLocalIterator():
        if running + len(r.text) > chars:
            continue
        running += len(r.text)
        out.append((r.text, r.toxic))
    return out


def _score(model, schema: pa.Schema, threshold: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = model.value
        for batch in batches:
            scores = [m.score(t.as_py()) for t in batch["text"]]
            columns = {n: batch[n] for n in batch.schema.names}
            columns |= {"score": pa.array(scores, pa.float64()), "predicted": pa.array([int(s >= threshold) for s in scores], pa.int32())}
            yield from pa.table({n: columns[n] for n in schema.names}).cast(schema).to_batches()

    return run


def score_documents(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """docs with score and predicted."""
    from pyspark.sql.pandas.types import to_arrow_schema

    model = fit(training_rows(docs, labels))
    model.known = {}
    shared = docs.sparkSession.sparkContext.broadcast(model)  # at most BUCKETS weights and a lexicon from the sample
    rest = docs.drop("score", "predicted")
    out = rest.withColumns({"score": F.lit(0.0), "predicted": F.lit(0)}).schema
    return rest.mapInArrow(_score(shared, to_arrow_schema(out), threshold), out)


def digest(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The columns of op6."""
    d = score_documents(docs.select("doc_id", "text"), labels)
    return d.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", "predicted")

"""Benchmark decontamination by an FM-index per training shard.

A shard is a stretch of documents of one partition. Its words become symbols of the benchmark's
vocabulary; a word that no item holds is symbol 0, which no phrase contains, and stretches of
benchmark words that are shorter than the shortest phrase are left out of the index, as no phrase
fits in them. Over the rest a suffix array, the Burrows-Wheeler transform, its wavelet matrix and
sampled suffix positions are built. All phrases (windows of ``width`` words) are searched backward
at once, step by step, by ranks in the wavelet matrix; occurrences are located by walking to the
next sampled position, and the spans of a document are merged.

The benchmark goes to the executors in blocks of about ``block_bytes`` of text, so that what a task holds
of it has a bound and any benchmark is searched whole. One block is broadcast; several are files in the
shared folder, and a task reads them one after the other for each shard: once for the words that the
shard shares with any of them, which are its alphabet, and once for the search, all in the one index.

Defined cases: null and empty texts have no words; an item without words has no phrase; items that
repeat an id count once; a null item_id is left out. Rows that repeat a doc_id are each judged on
their own text. Extra columns are carried along; ``n_words``, ``spans`` and ``items`` are replaced.
"""

from __future__ import annotations

import pickle
from collections.abc import Iterator
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lexiscope.llm.common import fresh_dir
from lexiscope.llm.files import new_file, open_folder

WIDTH = 10
BLOCK_BYTES = 2_000_000
#: Text bytes of a shard; bounds what a task holds.
SHARD_BYTES = 4_000_000
SAMPLE = 8

#: A-Z lower-cased, other ASCII but digits and a-z to spaces; every byte of 128 and over belongs to a word.
_WORD_BYTES = bytes(
    c + 32 if 65 <= c <= 90 else c if 48 <= c <= 57 or 97 <= c <= 122 or c >= 128 else 32 for c in range(256)
)
SPANS = T.ArrayType(T.StructType([T.StructField("start", T.LongType()), T.StructField("stop", T.LongType())]))
ITEMS = T.ArrayType(T.StringType())


def words_of(text: str | None) -> list[bytes]:
    return (text or "").encode("utf-8", "surrogatepass").translate(_WORD_BYTES).split()


def phrases_of(words: list[bytes], width: int = WIDTH) -> list[tuple[bytes, ...]]:
    """The windows of an item: width words in a row, or all of them if there are fewer."""
    if not words:
        return []
    return list(dict.fromkeys(tuple(words[i : i + width]) for i in range(max(1, len(words) - width + 1))))


def suffix_array(s: np.ndarray) -> np.ndarray:
    """Prefix doubling; each round sorts only suffixes that still tie."""
    n = len(s)
    sa = np.argsort(s, kind="stable")
    at = np.arange(n)
    new = np.ones(n, bool)
    new[1:] = s[sa][1:] != s[sa][:-1]
    rank = np.empty(n, np.int64)
    rank[sa] = np.maximum.accumulate(np.where(new, at, 0))
    k = 1
    while True:
        single = new.copy()
        single[:-1] &= new[1:]
        tied = np.flatnonzero(~single)
        if not len(tied):
            return sa
        p = sa[tied]
        nxt = np.where(p + k < n, rank[np.minimum(p + k, n - 1)] + 1, 0)
        key = rank[p] * (n + 1) + nxt
        order = np.argsort(key, kind="stable")
        p, key = p[order], key[order]
        sa[tied] = p
        new[tied[1:]] = key[1:] != key[:-1]
        new[tied[0]] = True
        rank[p] = np.maximum.accumulate(np.where(new[tied], tied, 0))
        k *= 2


class Bits:
    """A bit vector with rank: 64-bit words and the ones before each."""

    def __init__(self, bits: np.ndarray):
        n = len(bits)
        padded = np.zeros((n // 64 + 1) * 64, np.uint8)
        padded[:n] = bits
        self.words = np.packbits(padded.reshape(-1, 64), axis=1, bitorder="little").view(np.uint64).ravel()
        self.before = np.zeros(len(self.words) + 1, np.int64)
        np.cumsum(np.bitwise_count(self.words), out=self.before[1:])
        self.n = n

    def rank(self, i: np.ndarray) -> np.ndarray:
        """Ones among the first i bits."""
        w = i >> 6
        low = (np.uint64(1) << (i & 63).astype(np.uint64)) - np.uint64(1)
        return self.before[w] + np.bitwise_count(self.words[w] & low)

    def get(self, i: np.ndarray) -> np.ndarray:
        return (self.words[i >> 6] >> (i & 63).astype(np.uint64)) & np.uint64(1) != 0


class FMIndex:
    """Of a sequence of symbols from 0 to sigma - 1."""

    def __init__(self, s: np.ndarray, sigma: int, sample: int = SAMPLE):
        s = np.append(s + 1, 0)  # an end that is smaller than all
        self.n, self.sample = len(s), sample
        sa = suffix_array(s)
        bwt = s[sa - 1]
        self.first = np.zeros(sigma + 2, np.int64)
        np.cumsum(np.bincount(s, minlength=sigma + 1), out=self.first[1:])
        marked = sa % sample == 0
        self.marked, self.samples = Bits(marked), sa[marked]
        self.levels: list[tuple[int, Bits, int]] = []
        cur, base = bwt, np.arange(sigma + 1)
        origin = np.zeros(sigma + 1, np.int64)  # where position 0 of the sequence arrives, for each symbol
        for shift in range(int(sigma).bit_length() - 1, -1, -1):
            bit = (cur >> shift) & 1
            bits, zeros = Bits(bit), int(len(bit) - bit.sum())
            self.levels.append((shift, bits, zeros))
            ones = bits.rank(origin)
            origin = np.where((base >> shift) & 1, zeros + ones, origin - ones)
            cur = np.concatenate([cur[bit == 0], cur[bit == 1]])
        self.origin = origin

    def lf(self, c: np.ndarray, i: np.ndarray) -> np.ndarray:
        """Rows that start with c before those that continue with the first i rows."""
        pos = i
        for shift, bits, zeros in self.levels:
            ones = bits.rank(pos)
            pos = np.where((c >> shift) & 1, zeros + ones, pos - ones)
        return self.first[c] + pos - self.origin[c]

    def symbol(self, i: np.ndarray) -> np.ndarray:
        pos, c = i, np.zeros(len(i), np.int64)
        for shift, bits, zeros in self.levels:
            bit, ones = bits.get(pos), bits.rank(pos)
            c |= bit.astype(np.int64) << shift
            pos = np.where(bit, zeros + ones, pos - ones)
        return c

    def search(self, phrases: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Rows of a matrix of symbols, backward: (phrase, low, high) of those that occur."""
        alive = np.arange(len(phrases))
        lo, hi = np.zeros(len(phrases), np.int64), np.full(len(phrases), self.n, np.int64)
        for column in range(phrases.shape[1] - 1, -1, -1):
            c = phrases[alive, column] + 1
            lo, hi = self.lf(c, lo), self.lf(c, hi)
            there = lo < hi
            alive, lo, hi = alive[there], lo[there], hi[there]
        return alive, lo, hi

    def locate(self, rows: np.ndarray) -> np.ndarray:
        """The positions of suffix rows."""
        out, steps = np.empty(len(rows), np.int64), np.zeros(len(rows), np.int64)
        todo, at = np.arange(len(rows)), rows
        while len(todo):
            done = self.marked.get(at)
            out[todo[done]] = self.samples[self.marked.rank(at[done])] + steps[todo[done]]
            todo, at = todo[~done], at[~done]
            steps[todo] += 1
            at = self.lf(self.symbol(at), at)
        return out


class Phrases:
    """What a block of the benchmark looks for; picklable, within block_bytes."""

    def __init__(self, items: list[tuple[str, str]], width: int):
        found: dict[tuple[bytes, ...], set[str]] = {}
        for item, text in items:
            for p in phrases_of(words_of(text), width):
                found.setdefault(p, set()).add(item)
        self.ids: dict[bytes, int] = {}
        for p in found:
            for w in p:
                self.ids.setdefault(w, len(self.ids) + 1)
        self.by_length: dict[int, tuple[np.ndarray, list[set[str]]]] = {}
        for n in sorted({len(p) for p in found}):
            own = [p for p in found if len(p) == n]
            self.by_length[n] = np.array([[self.ids[w] for w in p] for p in own], np.int64), [found[p] for p in own]
        self.shortest = min(self.by_length, default=0)


def _long_runs(symbols: np.ndarray, shortest: int) -> np.ndarray:
    """Positions of stretches of at least so many symbols other than 0, each followed by the 0 after it."""
    edge = np.flatnonzero(np.diff(np.concatenate([[False], symbols != 0, [False]]).astype(np.int8)))
    start, stop = edge[::2], edge[1::2]
    long = stop - start >= shortest
    start, size = start[long], (stop - start)[long] + 1
    return np.repeat(start - np.concatenate([[0], np.cumsum(size)[:-1]]), size) + np.arange(size.sum())


class Blocks:
    """Phrases of several blocks, each one read from its file when its turn comes."""

    def __init__(self, folder: str, paths: list[str]):
        self.folder, self.paths = folder, paths

    def __len__(self) -> int:
        return len(self.paths)

    def __iter__(self) -> Iterator[Phrases]:
        files, _ = open_folder(self.folder)
        for path in self.paths:
            with files.open_input_stream(path) as f:
                yield pickle.loads(f.read())


def _alphabet(texts: list[str | None], blocks: Blocks | list[Phrases]) -> tuple[dict[bytes, int], int]:
    """Symbols of the shard's words that any block has, and the length of the shortest phrase."""
    own = set().union(*map(words_of, texts))
    ids: dict[bytes, int] = {}
    shortest = 0
    for phrases in blocks:
        for w in own.intersection(phrases.ids):
            ids.setdefault(w, len(ids) + 1)
        shortest = min(filter(None, (shortest, phrases.shortest)), default=0)
    return ids, shortest


def scan_shard(texts: list[str | None], blocks: Blocks | list[Phrases]) -> list[tuple[int, list[tuple[int, int]], set[str]]]:
    """Per document: its words, merged spans [start, stop) of words, items that occur."""
    ids, shortest = (blocks[0].ids, blocks[0].shortest) if isinstance(blocks, list) and len(blocks) == 1 else _alphabet(texts, blocks)
    get, counts, parts = ids.get, np.zeros(len(texts), np.int64), []
    for k, text in enumerate(texts):
        words = words_of(text)
        counts[k] = len(words)
        parts.append(np.fromiter(map(get, words, repeat(0)), np.int64, len(words)))
        parts.append(np.zeros(1, np.int64))
    out: list[tuple[int, list[tuple[int, int]], set[str]]] = [(int(n), [], set()) for n in counts]
    symbols = np.concatenate(parts) if parts else np.zeros(0, np.int64)
    if not shortest or not len(kept := _long_runs(symbols, shortest)):
        return out
    index = FMIndex(symbols[kept], len(ids) + 1)
    begins = np.concatenate([[0], np.cumsum(counts + 1)])
    marks = np.zeros(len(symbols) + 1, np.int32)
    for phrases in blocks:
        symbol = np.fromiter(map(get, phrases.ids, repeat(0)), np.int64, len(phrases.ids))  # by the block's own number of a word, from 1
        for n, (matrix, items) in phrases.by_length.items():
            shared = symbol[matrix - 1]
            here = np.flatnonzero((shared > 0).all(axis=1))
            which, lo, hi = index.search(shared[here])
            if not len(which):
                continue
            size = hi - lo
            rows = np.repeat(lo - np.concatenate([[0], np.cumsum(size)[:-1]]), size) + np.arange(size.sum())
            at = kept[index.locate(rows)]
            np.add.at(marks, at, 1)
            np.add.at(marks, at + n, -1)
            doc = np.searchsorted(begins, at, side="right") - 1
            pairs = np.unique(doc * len(matrix) + np.repeat(here[which], size))
            for d, p in zip((pairs // len(matrix)).tolist(), (pairs % len(matrix)).tolist(), strict=True):
                out[d][2].update(items[p])
    edge = np.flatnonzero(np.diff(np.concatenate([[0], np.cumsum(marks[:-1]) > 0, [0]]).astype(np.int8)))
    start, stop = edge[::2], edge[1::2]
    owner = np.searchsorted(begins, start, side="right") - 1
    for d, a, b in zip(owner.tolist(), (start - begins[owner]).tolist(), (stop - begins[owner]).tolist(), strict=True):
        out[d][1].append((a, b))
    return out


def _scanner(blocks, schema: pa.Schema):
    """blocks: Blocks, or the broadcast of the only one's phrases."""

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = blocks if isinstance(blocks, Blocks) else [blocks.value]

        def flush(held: pa.Table) -> Iterator[pa.RecordBatch]:
            found = scan_shard(held["text"].to_pylist(), own)
            columns = {c: held[c] for c in held.column_names}
            columns["n_words"] = pa.array([n for n, _, _ in found], pa.int64())
            columns["spans"] = pa.array([[{"start": a, "stop": b} for a, b in s] for _, s, _ in found], schema.field("spans").type)
            columns["items"] = pa.array([sorted(i) for _, _, i in found], schema.field("items").type)
            yield from pa.table({c: columns[c] for c in schema.names}).cast(schema).to_batches(max_chunksize=2000)

        held, size = [], 0
        for batch in batches:
            held.append(batch)
            size += batch.nbytes
            if size >= SHARD_BYTES:
                yield from flush(pa.Table.from_batches(held))
                held, size = [], 0
        if held:
            yield from flush(pa.Table.from_batches(held))

    return scan


def find_spans(docs: DataFrame, benchmark: DataFrame, width: int = WIDTH, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """docs with n_words, spans (array of start and stop, in words, merged) and items (sorted strings)."""
    from pyspark.sql.pandas.types import to_arrow_schema

    spark = docs.sparkSession
    items = benchmark.where("item_id IS NOT NULL AND text IS NOT NULL").select(F.col("item_id").cast("string").alias("item"), "text")
    total = items.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    n = -(-total // block_bytes) or 1
    rest = docs.drop("n_words", "spans", "items")
    out = rest.withColumns({"n_words": F.lit(0).cast("long"), "spans": F.array().cast(SPANS), "items": F.array().cast(ITEMS)}).schema
    if n == 1:
        blocks = spark.sparkContext.broadcast(Phrases([(r.item, r.text) for r in items.toLocalIterator()], width))  # of block_bytes at most
    else:
        folder, paths = fresh_dir(spark, "benchmark"), []
        for b in range(n):  # of about block_bytes each
            own = items.where(F.pmod(F.xxhash64("item", "text"), F.lit(n)) == b)
            files, path = new_file(folder, ".phrases")
            with files.open_output_stream(path) as f:
                f.write(pickle.dumps(Phrases([(r.item, r.text) for r in own.toLocalIterator()], width)))
            paths.append(path)
        blocks = Blocks(folder, paths)
    return rest.mapInArrow(_scanner(blocks, to_arrow_schema(out)), out)


def digest(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The columns of op7."""
    d = find_spans(docs.select("doc_id", "text"), benchmark)
    hits = F.aggregate("spans", F.lit(0).cast("long"), lambda acc, s: acc + s["stop"] - s["start"])
    return d.select(
        "doc_id", "n_words", hits.alias("n_hit"), F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"), (hits > 0).alias("contaminated"),
    )


#: Words carry their position, so that a window is ten rows in a row; an item of fewer words is one window.
SQL = r"""
WITH dw AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS ws FROM documents
),
bw AS (
  SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS ws FROM benchmark
),
win AS (
  SELECT DISTINCT item_id, least(len(ws), 10) AS n, hash(array_to_string(ws[i : i + least(len(ws), 10) - 1], ' ')) AS h
  FROM (SELECT item_id, ws, unnest(range(1, greatest(len(ws) - 9, 1) + 1)) AS i FROM bw WHERE len(ws) > 0)
),
sizes AS (SELECT DISTINCT n FROM win),
dwin AS (
  SELECT doc_id, i, n, hash(array_to_string(ws[i : i + n - 1], ' ')) AS h
  FROM (SELECT doc_id, ws, n, unnest(range(1, len(ws) - n + 2)) AS i FROM dw, sizes WHERE len(ws) >= n)
),
hit AS (SELECT doc_id, i, n, item_id FROM dwin JOIN win USING (n, h)),
spots AS (SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + n)) AS p FROM hit) GROUP BY doc_id),
its AS (
  SELECT doc_id, count(*) AS n_items, string_agg(s, ',' ORDER BY s) AS items
  FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS s FROM hit) GROUP BY doc_id
)
SELECT doc_id, CAST(len(ws) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
  sha256(coalesce(items, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM dw LEFT JOIN spots USING (doc_id) LEFT JOIN its USING (doc_id)
"""

"""MinHash near-dedup by a chosen-path set similarity join.

1. One scan turns each document into its set of word shingles (64-bit hashes), and the set into a
   128-bit identity, K minwise tokens of 16 bits and ``trees`` root tokens of 64 bits. Equal sets
   become one class, whose vertex is half of its identity; rows that repeat a doc_id with unlike texts
   are so in classes of their own. The smallest doc_id of a class lends its text.
2. Every class enters the node of its root token in each tree. Nodes of at most ``node_limit``
   members are compared exhaustively by their K tokens; larger nodes branch: the node's own hash
   selects ``branches`` of the minwise tokens, and a member goes to the child of each. Members of a
   node that stays large after ``depth`` levels share that many tokens; they are taken together.
   A tree misses a pair of similarity s with probability 1 - s at its root and (1 - s) ** branches
   at each level below, so independent trees leave at most 0.15 ** 6, about 1e-5, at 0.85. What
   comes out are loose links (estimate of at least ``loose``), one per member and node at most.
3. Components of loose links get their full sets, each once, and similarity is decided on these by
   a search that leaves a component as soon as all its members are reached. Components with more
   than ``group_shingles`` shingles are never brought to one task: their members are first held
   against one pivot, and only those it doesn't cover meet the others, in blocks.

Defined cases: a document without words (or with null text) has an empty set and is linked with
nothing; fewer than k words are one shingle; rows that repeat a doc_id are judged on their own text
(and are kept if their component's smallest doc_id is their own); rows with a null doc_id are returned, linked with nothing (component_id null, kept). Extra columns
are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lexiscope.llm.common import LOWER_BYTES, staged
from lexiscope.llm.components import star_components

U = np.uint64
TOKENS = 48
_RNG = np.random.default_rng(20240607)
_XOR = _RNG.integers(0, 2**63, TOKENS, dtype=np.uint64)
_MUL = _RNG.integers(0, 2**63, TOKENS, dtype=np.uint64) * U(2) + U(1)


class _WordHashes(dict):
    """64-bit hashes by word; emptied when full."""

    def __missing__(self, word: bytes) -> int:
        if len(self) >= 250_000:
            self.clear()
        self[word] = h = xxhash.xxh3_64_intdigest(word)
        return h


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> U(30))) * U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> U(27))) * U(0x94D049BB133111EB)
    return x ^ (x >> U(31))


def shingles(text: str | None, hashes: dict, k: int = 3) -> np.ndarray:
    """The sorted distinct hashes of k words in a row; of all words if there are fewer."""
    words = (text or "").encode("utf-8", "surrogatepass").translate(LOWER_BYTES).split()
    if not words:
        return np.zeros(0, np.uint64)
    h = np.fromiter(map(hashes.__getitem__, words), np.uint64, len(words))
    m = min(k, len(h))
    s = np.full(len(h) - m + 1, m, np.uint64)
    for i in range(m):
        s = _mix(s * U(0x9E3779B97F4A7C15) + h[i : len(h) - m + 1 + i])
    return np.unique(s)


def sketch(s: np.ndarray, trees: int) -> tuple[np.ndarray, np.ndarray]:
    """K tokens of 16 bits and the root tokens (whole hashes of the minwise shingles) of a set."""
    low = np.full(TOKENS, 2**32 - 1, np.uint32)
    roots = np.zeros(trees, np.uint64)
    for at in range(0, len(s), 4096):
        part = s[at : at + 4096]
        v = (((part[None, :] ^ _XOR[:, None]) * _MUL[:, None]) >> U(32)).astype(np.uint32)
        who = v[:trees].argmin(axis=1)
        m = v.min(axis=1)
        better = m[:trees] < low[:trees] if at else np.ones(trees, bool)
        roots[better] = part[who][better]
        np.minimum(low, m, out=low)
    return (low * np.uint32(0x9E3779B1) >> np.uint32(16)).astype(np.uint16), _mix(roots + np.arange(trees, dtype=np.uint64))


def identity(s: np.ndarray) -> tuple[int, int]:
    d = xxhash.xxh3_128_digest(s.tobytes())
    return int.from_bytes(d[:8], "little", signed=True), int.from_bytes(d[8:], "little", signed=True)


SCANNED = "doc_id long, row_hash long, n_shingles long, h1 long, h2 long, tokens binary, roots array<long>"


def _scan(k: int, trees: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = _WordHashes()
        for batch in batches:
            sets = (shingles(t.as_py(), hashes, k) for t in batch["text"])
            rows = [(len(s), *identity(s), *((t.tobytes(), r.view(np.int64)) if len(s) else (None, [])) ) for s in sets for t, r in [sketch(s, trees)]]
            n, h1, h2, tokens, roots = zip(*rows, strict=True) if rows else ([],) * 5
            yield pa.record_batch(
                [batch["doc_id"], batch["row_hash"], pa.array(n, pa.int64()), pa.array(h1, pa.int64()), pa.array(h2, pa.int64()), pa.array(tokens, pa.binary()), pa.array(roots, pa.list_(pa.int64()))],
                names=["doc_id", "row_hash", "n_shingles", "h1", "h2", "tokens", "roots"],
            )

    return run


def _groups(batches: Iterator[pa.RecordBatch], key: str) -> Iterator[pa.Table]:
    """Rows sorted by key, a table for each value."""
    held: list[pa.RecordBatch] = []
    for batch in batches:
        if not batch.num_rows:
            continue
        k = batch[key].to_numpy(zero_copy_only=False)
        edges = np.flatnonzero(k[1:] != k[:-1]) + 1
        if held and held[-1][key][held[-1].num_rows - 1].as_py() != k[0]:
            yield pa.Table.from_batches(held)
            held = []
        for a, b in zip([0, *edges], [*edges, len(k)], strict=True):
            held.append(batch.slice(a, b - a))
            if b < len(k):
                yield pa.Table.from_batches(held)
                held = []
    if held:
        yield pa.Table.from_batches(held)


def _edges(u: list[int], v: list[int]) -> pa.RecordBatch:
    return pa.record_batch([pa.array(u, pa.int64()), pa.array(v, pa.int64())], names=["u", "v"])


def _compare_nodes(loose: float, threshold: int):
    """Loose links in small nodes: a spanning forest of those that sizes and tokens allow."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        u: list[int] = []
        v: list[int] = []
        for g in _groups(batches, "node"):
            ids, n = g["id"].to_numpy(), g["n"].to_numpy()
            t = np.frombuffer(b"".join(g["tokens"].to_pylist()), np.uint16).reshape(-1, TOKENS)
            left = np.arange(len(ids))
            while len(left) > 1:
                root, queue, left = left[0], [left[0]], left[1:]
                while queue and len(left):
                    p = queue.pop()
                    same = (t[left] == t[p]).sum(axis=1) >= loose * TOKENS
                    near = same & (100 * np.minimum(n[left], n[p]) >= threshold * np.maximum(n[left], n[p]))
                    queue.extend(left[near])
                    u.extend(ids[left[near]].tolist())
                    v.extend([int(ids[root])] * int(near.sum()))
                    left = left[~near]
            if len(u) > 50_000:
                yield _edges(u, v)
                u, v = [], []
        yield _edges(u, v)

    return run


def loose_links(reps: DataFrame, trees: int, node_limit: int, branches: int, depth: int, loose: float, threshold: int) -> DataFrame:
    """(u, v) from reps (id, n, tokens, roots)."""
    frontier = reps.select(F.explode("roots").alias("node"), "id", "n", "tokens")
    out = None
    for level in range(depth):
        if level:
            frontier = staged(frontier, "nodes")
            if frontier.isEmpty():
                break
        sizes = frontier.groupBy("node").agg(F.count("*").alias("size"), F.min("id").alias("least")).where("size > 1")
        # nodes to compare are small, so each may go to one task; the join before may split its partitions, and so
        # isn't relied on: dealt by node itself, rows would be taken as dealt already
        few = frontier.join(sizes.where(F.col("size") <= node_limit), "node").select("node", "id", "n", "tokens")
        found = few.repartition(F.xxhash64("node")).sortWithinPartitions("node", "id").mapInArrow(_compare_nodes(loose, threshold), "u long, v long")
        large = frontier.join(sizes.where(F.col("size") > node_limit), "node")
        if level == depth - 1:
            found = found.union(large.select(F.col("id").alias("u"), F.col("least").alias("v")))
        else:
            picks = [F.pmod(F.xxhash64("node", F.lit(b)), F.lit(TOKENS)) for b in range(branches)]
            child = F.array(*(F.xxhash64("node", F.lit(b), p, F.substring("tokens", 2 * p.cast("int") + 1, F.lit(2))) for b, p in enumerate(picks)))
            frontier = large.select(F.explode(F.array_distinct(child)).alias("node"), "id", "n", "tokens")
        found = staged(found.distinct(), "loose")
        out = found if out is None else out.union(found)
    return out


def exact_components(sets: list[np.ndarray], threshold: int) -> np.ndarray:
    """For each set, the index of the first set of its component of links 100 * intersection >= threshold * union."""
    g, n = len(sets), np.array([len(s) for s in sets])
    if g == 2:
        both = len(np.intersect1d(sets[0], sets[1], assume_unique=True))
        return np.array([0, 0 if 100 * both >= threshold * (n.sum() - both) else 1])
    _, element = np.unique(np.concatenate(sets), return_inverse=True)
    owner = np.repeat(np.arange(g), n)[np.argsort(element, kind="stable")]
    begin = np.concatenate([[0], np.cumsum(np.bincount(element))])
    at = np.concatenate([[0], np.cumsum(n)])
    label, left = np.full(g, -1), g
    for root in range(g):
        if label[root] >= 0:
            continue
        label[root], queue = root, [root]
        left -= 1
        while queue and left:
            p = queue.pop()
            e = element[at[p] : at[p + 1]]
            size = begin[e + 1] - begin[e]
            posts = np.repeat(begin[e] - np.concatenate([[0], np.cumsum(size)[:-1]]), size) + np.arange(size.sum())
            both = np.bincount(owner[posts], minlength=g)
            near = np.flatnonzero((label < 0) & (100 * both >= threshold * (n + n[p] - both)))
            label[near] = root
            left -= len(near)
            queue.extend(near.tolist())
    return label


def _full_sets(k: int):
    """(comp, id, n, words) of the rows whose set is the one that the class stands for."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = _WordHashes()
        for batch in batches:
            keep, data, n = [], [], []
            for i, (text, h1, h2) in enumerate(zip(batch["text"], batch["id"].to_pylist(), batch["h2"].to_pylist(), strict=True)):
                s = shingles(text.as_py(), hashes, k)
                if identity(s) == (h1, h2):
                    keep.append(i)
                    data.append(s.tobytes())
                    n.append(len(s))
            own = batch.take(pa.array(keep, pa.int64()))
            yield pa.record_batch([own["comp"], own["id"], own["total"], pa.array(n, pa.int64()), pa.array(data, pa.binary())], names=["comp", "id", "total", "n", "words"])

    return run


def _sets_of(g: pa.Table) -> list[np.ndarray]:
    return [np.frombuffer(b.as_py(), np.uint64) for b in g["words"]]


def _verify(threshold: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        u: list[int] = []
        v: list[int] = []
        for g in _groups(batches, "comp"):
            if g.num_rows > 1:
                ids = g["id"].to_numpy()
                label = exact_components(_sets_of(g), threshold)
                u.extend(ids.tolist())
                v.extend(ids[label].tolist())
            if len(u) > 50_000:
                yield _edges(u, v)
                u, v = [], []
        yield _edges(u, v)

    return run


def _against_pivot(threshold: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            linked = []
            for a, b in zip(batch["words"], batch["pivot_words"], strict=True):
                x, y = np.frombuffer(a.as_py(), np.uint64), np.frombuffer(b.as_py(), np.uint64)
                both = len(np.intersect1d(x, y, assume_unique=True))
                linked.append(100 * both >= threshold * (len(x) + len(y) - both))
            yield pa.record_batch([batch["comp"], batch["id"], batch["pivot"], pa.array(linked, pa.bool_())], names=["comp", "id", "pivot", "linked"])

    return run


def _large_links(sets: DataFrame, group_shingles: int, threshold: int) -> DataFrame:
    """Links in components that are too large for a task: against a pivot, then the uncovered against all, in blocks."""
    pivots = sets.groupBy("comp").agg(F.min("id").alias("pivot"))
    pivot_sets = sets.join(pivots, ["comp"]).where("id = pivot").select("comp", "pivot", F.col("words").alias("pivot_words"))
    held = staged(
        sets.join(pivot_sets, "comp").mapInArrow(_against_pivot(threshold), "comp long, id long, pivot long, linked boolean"), "pivot"
    )
    links = held.where("linked").select(F.col("id").alias("u"), F.col("pivot").alias("v"))
    apart = sets.join(held.where("NOT linked").select("comp", "id"), ["comp", "id"])
    counts = apart.groupBy("comp").agg(F.sum("n").alias("apart_n"))
    half = group_shingles // 2
    blocks = lambda c: F.ceil(F.col(c) / half).cast("long")
    sized = counts.select("comp", blocks("apart_n").alias("rows"))
    all_rows = sets.join(sized, "comp").withColumn("columns", blocks("total"))
    block = F.pmod(F.xxhash64("id"), F.col("columns"))
    right = all_rows.select(F.explode(F.expr("sequence(0L, rows - 1)")).alias("r"), block.alias("c"), "comp", "id", "words")
    wide = apart.join(sized, "comp").withColumn("columns", blocks("total"))
    left = wide.select(F.pmod(F.xxhash64("id"), F.col("rows")).alias("r"), F.explode(F.expr("sequence(0L, columns - 1)")).alias("c"), "comp", "id", "words")
    tasks = right.union(left).dropDuplicates(["r", "c", "comp", "id"]).withColumn("comp", F.xxhash64("comp", "r", "c"))
    return links.union(tasks.repartition("comp").sortWithinPartitions("comp", "id").select("comp", "id", "words").mapInArrow(_verify(threshold), "u long, v long"))


def near_duplicates(docs: DataFrame, k: int = 3, threshold: int = 85, **limits: float) -> DataFrame:
    """(doc_id, n_shingles, component_id, kept) of each row of docs (doc_id, text)."""
    return judged_rows(docs, k, threshold, **limits).drop("row_hash")


def judged_rows(
    docs: DataFrame,
    k: int,
    threshold: int,
    trees: int = 6,
    node_limit: int = 2000,
    branches: int = 3,
    depth: int = 4,
    loose: float = 0.6,
    group_shingles: int = 4_000_000,
) -> DataFrame:
    """near_duplicates() with ``row_hash``, the hash of the row's text: with doc_id it names a row among those that repeat a doc_id."""
    ids = F.col("doc_id").cast("long")
    own = docs.select(ids.alias("doc_id"), "text", F.xxhash64("text").alias("row_hash"))
    scanned = staged(own.mapInArrow(_scan(k, trees), SCANNED), "sketches")
    usable = scanned.where("doc_id IS NOT NULL AND n_shingles > 0")
    classes = staged(
        usable.groupBy("h1", "h2").agg(F.min(F.struct("doc_id", "n_shingles", "tokens", "roots")).alias("r"))
        .select(F.col("h1").alias("id"), "h2", "r.doc_id", F.col("r.n_shingles").alias("n"), "r.tokens", "r.roots"), "classes"
    )
    loosely = star_components(loose_links(classes, trees, node_limit, branches, depth, loose, threshold))
    members = loosely.join(classes.select("id", "h2", "n", "doc_id"), "id")
    totals = members.groupBy("comp").agg(F.sum("n").alias("total"))
    members = staged(members.join(totals, "comp").select("doc_id", "comp", "id", "h2", "total"), "members")
    # the members are the hashed side at every size: texts aren't sorted, nor the members broadcast
    text = docs.select(ids.alias("doc_id"), "text").join(members.hint("shuffle_hash"), "doc_id")
    sets = text.mapInArrow(_full_sets(k), "comp long, id long, total long, n long, words binary")
    if members.where(F.col("total") > group_shingles).isEmpty():
        small, links = sets, None
    else:
        sets = staged(sets.dropDuplicates(["comp", "id"]), "sets")
        small = sets.where(F.col("total") <= group_shingles)
        links = _large_links(sets.where(F.col("total") > group_shingles), group_shingles, threshold)
    exact = small.select("comp", "id", "words").repartition("comp").sortWithinPartitions("comp", "id").mapInArrow(_verify(threshold), "u long, v long")
    found = star_components(exact if links is None else exact.union(links))
    linked = staged(classes.select("id", "h2", "doc_id").join(found, "id"), "linked")
    least = linked.groupBy("comp").agg(F.min("doc_id").alias("reached"))
    reach = linked.join(least, "comp").select(F.col("id").alias("h1"), "h2", "reached")
    alone = classes.join(linked.select("id"), "id", "left_anti").select(F.col("id").alias("h1"), "h2", F.col("doc_id").alias("reached"))
    rows = scanned.select("doc_id", "row_hash", "n_shingles", "h1", "h2").join(reach.union(alone), ["h1", "h2"], "left")
    own_id = F.col("doc_id").isNull() | (F.col("n_shingles") == 0)
    return rows.select(
        "doc_id", "row_hash", "n_shingles", F.when(own_id, F.col("doc_id")).otherwise(F.col("reached")).alias("component_id")
    ).withColumn("kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True)))

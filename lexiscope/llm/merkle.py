"""A Merkle manifest of documents: a tree of digests for each source, a tree of the sources, proofs for each row.

Supersteps on RDDs, in the manner of Pregel. A vertex holds ``3 ** LEVELS`` consecutive nodes of a
tree and what lies above them, up to the one node that it has in the tree's next part: children send
their digests to their vertex, which hashes when it has them all (a group of known size), and sends
its node on, until one node is left. Then the steps run backwards: a vertex that knows the siblings on
the way from its top to the root sends each child that way and the siblings within the vertex itself.
With ``levels=1`` a superstep is a level of the tree; with six, a table of a hundred million rows takes
three steps up and three down, and what is sent down for a leaf never crosses the network. Vertices of
a step are written to the shared folder, so a lost executor costs the running step alone.

A vertex's key has the source's number and its place, so a source with a third of all rows is dealt
over as many vertices as it needs. Leaves are digests by the time that anything is shuffled: 80 bytes
a row, not texts. Places come from ``numbered``, which counts rows by task.

Defined cases: nulls are ``-`` in a leaf, and a null doc_id or source is ordered first; a null source
is a source of its own, apart from an empty one; rows that repeat a doc_id are ordered by their leaf;
equal rows are leaves of their own. A row whose doc_id is null is never tampered with. A single leaf is
its source's subroot, a single subroot the root, and the digest of no siblings is that of an empty
text. An empty table gives no rows. Other columns are not read.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

from pyspark import RDD
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lexiscope.llm.common import staged
from lexiscope.operators.numbering import numbered

#: Children of a node.
WIDTH = 3
#: Levels of a tree that a vertex holds.
LEVELS = 6
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")


def field(value: Column) -> Column:
    """A field of a leaf: ``-`` for null, else its length in bytes, a colon, the value."""
    text = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def leaf_digest(text: Column | None = None) -> Column:
    """32 bytes over the fields of a row; ``text`` stands in for the text."""
    values = [F.col(x) for x in FIELDS[:-1]] + [F.col("text") if text is None else text]
    return F.unhex(F.sha2(F.concat(*[field(v) for v in values]), 256))


def digest_of(parts: list[bytes]) -> bytes:
    """Digest of digests, which enter as lowercase hex."""
    return hashlib.sha256("".join(p.hex() for p in parts).encode()).digest()


def levels_above(nodes: list[bytes], n: int, levels: int) -> list[list[bytes]]:
    """nodes, consecutive ones of a level of n, and the levels above them: ``levels`` ones, or up to the tree's root."""
    out = [nodes]
    while n > 1 and len(out) <= levels:
        out.append([digest_of(out[-1][k : k + WIDTH]) for k in range(0, len(out[-1]), WIDTH)])
        n = -(-n // WIDTH)
    return out


def way_up(above: list[list[bytes]], place: int) -> bytes:
    """The steps from a node to the top of its vertex, each as place in the run, number of siblings, siblings."""
    out = []
    for nodes in above[:-1]:
        first = place - place % WIDTH
        siblings = [x for k, x in enumerate(nodes[first : first + WIDTH], first) if k != place]
        out.append(bytes([place % WIDTH, len(siblings)]) + b"".join(siblings))
        place //= WIDTH
    return b"".join(out)


def steps_of(way: bytes) -> Iterator[tuple[int, list[bytes]]]:
    at = 0
    while at < len(way):
        place, n = way[at], way[at + 1]
        yield place, [way[k : k + 32] for k in range(at + 2, at + 2 + 32 * n, 32)]
        at += 2 + 32 * n


def fold(leaf: bytes, way: bytes) -> bytes:
    """The root that a leaf and its siblings give."""
    for place, siblings in steps_of(way):
        leaf = digest_of([*siblings[:place], leaf, *siblings[place:]])
    return leaf


def proof_digest(way: bytes) -> bytes:
    return digest_of([x for _, siblings in steps_of(way) for x in siblings])


VERTEX = "tree long, vertex long, n long, nodes array<struct<digest:binary,id:long,other:binary>>, top binary, done boolean"


def _vertex(levels: int):
    def run(item: tuple) -> tuple:
        (tree, vertex), got = item
        own = sorted(got, key=lambda x: x[0])
        n = own[0][2]
        above = levels_above([x[1] for x in own], n, levels)
        return tree, vertex, n, [(x[1], x[3], x[4]) for x in own], above[-1][0], n <= WIDTH**levels

    return run


def climb(spark: SparkSession, nodes: RDD, trees: int, total: int, most: int, levels: int, name: str) -> list[DataFrame]:
    """The vertices of each superstep. nodes: (tree, place, nodes in the tree's level, digest, id, other); total and most: of all trees, of the largest."""
    size, out = WIDTH**levels, []
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    while True:
        sent = nodes.map(lambda x: ((x[0], x[1] // size), (x[1] % size, x[3], x[2], x[4], x[5])))
        total = math.ceil(total / size) + trees  # vertices at most
        hashed = sent.groupByKey(max(1, min(parts, total))).map(_vertex(levels))
        out.append(staged(spark.createDataFrame(hashed, VERTEX, verifySchema=False), name))
        if most <= size:
            return out
        most = math.ceil(most / size)
        up = out[-1].where("NOT done").select("tree", "vertex", "n", "top")
        nodes = up.rdd.map(lambda r: (r[0], r[1], -(-r[2] // size), r[3], None, None))


def descend(steps: list[DataFrame], roots: RDD, levels: int) -> RDD:
    """((tree, place), (digest, id, other, way, what)) of the nodes that climb() began with.

    roots: (tree, step in which it was done, way from its root on, what) with anything that is to reach its nodes.
    """
    size, sent = WIDTH**levels, None

    def down(item: tuple) -> Iterator[tuple]:
        (tree, vertex), ((n, nodes), (way, what)) = item
        above = levels_above([bytes(x[0]) for x in nodes], n, levels)
        for k, (digest, own, other) in enumerate(nodes):
            yield (tree, vertex * size + k), (bytes(digest), own, other, way_up(above, k) + way, what)

    for k in reversed(range(len(steps))):
        vertices = steps[k].select("tree", "vertex", "n", "nodes").rdd.map(lambda r: ((r[0], r[1]), (r[2], r[3])))
        tops = roots.filter(lambda x, k=k: x[1] == k).map(lambda x: ((x[0], 0), (x[2], x[3])))
        known = tops if sent is None else tops.union(sent)
        reached = vertices.join(known, vertices.getNumPartitions()).flatMap(down)
        sent = reached.mapValues(lambda x: (x[3], x[4]))
    return reached


PROOF = "doc_id long, leaf binary, subroot binary, root binary, way binary, other binary"


def proofs(docs: DataFrame, other: Column, levels: int = LEVELS) -> DataFrame:
    """A row for each of docs: doc_id, leaf, subroot, root, way (siblings on the way to the root, see ``steps_of``), other.

    other: a digest of the row's own, carried along (as the leaf that somebody claims it to have).
    """
    spark = docs.sparkSession
    leaves = staged(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "source", leaf_digest().alias("leaf"), other.alias("other")), "leaves")
    sources = numbered(leaves.groupBy("source").agg(F.count("*").alias("n")), F.asc_nulls_first("source"), name="tree")
    sources = sources.withColumnRenamed("source", "of")
    placed = numbered(leaves, F.asc_nulls_first("doc_id"), F.col("leaf").asc(), groups=("source",), name="place")
    rows = placed.join(sources, F.col("source").eqNullSafe(F.col("of"))).selectExpr("tree - 1", "place - 1", "n", "leaf", "doc_id", "other")
    count, total, most = sources.agg(F.count("*"), F.sum("n"), F.max("n")).first()
    if not count:
        return spark.createDataFrame([], PROOF)
    plain = lambda r: (r[0], r[1], r[2], bytes(r[3]), r[4], None if r[5] is None else bytes(r[5]))
    low = climb(spark, rows.rdd.map(plain), count, total, most, levels, "merkle")
    tops = None
    for k, step in enumerate(low):
        done = step.where("done").select("tree", "top", F.lit(k).cast("long").alias("step"))
        tops = done if tops is None else tops.union(done)
    # the tree of the sources: its nodes are subroots, their place is the source's number
    subroots = tops.rdd.map(lambda r: (0, r[0], count, bytes(r[1]), r[2], None))
    high = climb(spark, subroots, 1, count, count, levels, "merkle-sources")
    root = bytes(high[-1].where("done").first()["top"])
    ways = descend(high, spark.sparkContext.parallelize([(0, len(high) - 1, b"", root)], 1), levels)
    roots = ways.map(lambda x: (x[0][1], x[1][1], x[1][3], (x[1][0], x[1][4])))
    found = descend(low, roots, levels).map(lambda x: (x[1][1], x[1][0], x[1][4][0], x[1][4][1], x[1][3], x[1][2]))
    return spark.createDataFrame(found, PROOF, verifySchema=False)


VERIFIED = "doc_id long, leaf string, subroot string, root string, proof_sha256 string, folded_root string, verified boolean"


def verify(proved: DataFrame) -> DataFrame:
    """What the claimed leaves (``other``) come to: proofs() with the root that each one folds to."""

    def check(r: tuple) -> tuple:
        doc_id, leaf, subroot, root, way, other = (bytes(x) if isinstance(x, bytearray) else x for x in r)
        folded = fold(other, way)
        return doc_id, leaf.hex(), subroot.hex(), root.hex(), proof_digest(way).hex(), folded.hex(), folded == root

    return proved.sparkSession.createDataFrame(proved.rdd.map(check), VERIFIED, verifySchema=False)


def digest(docs: DataFrame) -> DataFrame:
    """The columns of op13: half of the rows are held against a text without its line ends."""
    tampered = F.crc32(F.col("doc_id").cast("long").cast("string").cast("binary")) % 2 == 0
    claimed = F.when(tampered, leaf_digest(F.replace(F.col("text"), F.lit("\n"), F.lit("")))).otherwise(leaf_digest())
    return verify(proofs(docs, claimed))

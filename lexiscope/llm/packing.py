"""Packing of documents into sequences of equal size: shortest pack first over the histogram of lengths.

Tasks encode documents and write their ids to shards in the shared folder, with a histogram of what
each shard has to place: pieces of the full width, and a remainder a document. The summed histogram, a
number for each length at most, is packed on the driver in time that doesn't depend on the corpus:
lengths are placed longest first, each into the pack with the most room, and what is counted are
patterns of packs, not packs. Packs that still have room are then topped up with cut pieces of the
emptiest packs, which go (in a bounded number of steps, the most room first). Patterns are joined back to documents by rank: the n-th piece of a length in
all shards (a prefix sum over shards, a count within) stands where the patterns have that length's n-th
place. Only numbers are shuffled, a row a shard and length; texts and ids never are.

Which documents share a sequence follows from the order of the input's rows and splits; a table read
in other splits is packed otherwise, but as tightly. Sequences are numbered from 0. A hundredth of a
sequence may stay empty, or a few sequences' worth of a small table.

Defined cases: null and empty texts have the end id alone; rows that repeat a doc_id, or have none,
are documents of their own; doc_ids are cast to long; an empty table gives no rows. Other columns are
not read.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from heapq import heappop, heappush
from itertools import count

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lexiscope.llm.common import fresh_dir, staged
from lexiscope.llm.files import new_file, open_folder
from lexiscope.llm.token_ids import tokenizer_path
from lexiscope.llm.word_ids import shared_encoder
from lexiscope.llm.word_table import slices

WIDTH = 2048
#: Ids after which a task begins another shard.
SHARD_IDS = 32_000_000

# --- patterns -------------------------------------------------------------------------------------


def shortest_pack_first(histogram: dict[int, int], width: int) -> list[tuple[int, list[int]]]:
    """(number of packs, their lengths) that place ``histogram[length]`` pieces of each length, longest first."""
    rooms: list[list[tuple[int, list[int]]]] = [[] for _ in range(width + 1)]
    roomiest = 0
    for length in sorted(histogram, reverse=True):
        left = histogram[length]
        while left:
            while roomiest and not rooms[roomiest]:
                roomiest -= 1
            if roomiest >= length:
                packs, lengths = rooms[roomiest].pop()
                if packs > left:
                    rooms[roomiest].append((packs - left, lengths))
                room, new = roomiest - length, [(min(packs, left), [*lengths, length])]
                left -= new[0][0]
                rooms[room] += new
            else:  # new packs, which further pieces of this length then fill
                fit = width // length
                for packs, n in ((left // fit, fit), (int(left % fit > 0), left % fit)):
                    if packs:
                        rooms[width - n * length].append((packs, [length] * n))
                        roomiest = max(roomiest, width - n * length)
                left = 0
    return [x for packs in rooms for x in packs]


#: A place in a pattern: pieces of ``length`` with ranks from ``rank`` on, of which ``size`` ids from ``start`` on lie there.
Slot = tuple[int, int, int, int]


def ranked(patterns: list[tuple[int, list[int]]]) -> list[tuple[int, list[Slot]]]:
    """Patterns with the ranks of the pieces that they take."""
    taken: dict[int, int] = {}
    out = []
    for packs, lengths in patterns:
        slots = []
        for length in lengths:
            slots.append((length, taken.get(length, 0), 0, length))
            taken[length] = taken.get(length, 0) + packs
        out.append((packs, slots))
    return out


def _cut(slots: list[Slot], k: int) -> tuple[list[Slot], list[Slot]]:
    """The slots of the first k packs, and of the others."""
    return slots, [(length, rank + k, start, size) for length, rank, start, size in slots]


#: Rooms below this part of the width are left.
LEAST = 128
#: Steps of topping up, which take the packs with the most room in all first.
STEPS = 20_000


def top_up(patterns: list[tuple[int, list[Slot]]], width: int, steps: int = STEPS) -> list[tuple[int, list[Slot]]]:
    """The same pieces in fewer packs: pieces of emptier packs are cut to fill fuller ones.

    Each step takes the pattern whose packs have the most room together, and the emptiest packs that
    there are; a pattern of very many packs is filled from packs of its own.
    """
    out: list[tuple[int, list[Slot]]] = []
    alive: dict[int, tuple[int, int, list[Slot]]] = {}
    by_room, by_fill, names = [], [], count()

    def put(packs: int, fill: int, slots: list[Slot]) -> None:
        if not packs or not slots:
            return
        if (width - fill) * LEAST < width:
            out.append((packs, slots))
            return
        name = next(names)
        alive[name] = packs, fill, slots
        heappush(by_room, (-packs * (width - fill), name))
        heappush(by_fill, (fill, name))

    def first(heap: list[tuple[int, int]]) -> int | None:
        while heap and heap[0][1] not in alive:
            heappop(heap)
        return heap[0][1] if heap else None

    for packs, slots in patterns:
        put(packs, sum(s[3] for s in slots), slots)
    for _ in range(steps):
        if (own := first(by_room)) is None:
            break
        packs, fill, slots = alive.pop(own)
        gone, other = packs * (width - fill) // width, first(by_fill)
        if other is not None and (not gone or 8 * alive[other][0] * alive[other][1] >= packs * (width - fill)):
            giver, taker = sorted([(fill, packs, slots), (lambda x: (x[1], x[0], x[2]))(alive.pop(other))], key=lambda x: x[0])
        elif gone:
            mine, rest = _cut(slots, gone)
            giver, taker = (fill, gone, mine), (fill, packs - gone, rest)
        else:
            out.append((packs, slots))
            continue
        (fill, packs, slots), (to_fill, to_packs, to_slots) = giver, taker
        k = min(packs, to_packs)
        to_slots, rest = _cut(to_slots, k)
        put(to_packs - k, to_fill, rest)
        slots, rest = _cut(slots, k)
        put(packs - k, fill, rest)
        length, rank, start, size = slots[-1]
        moved = min(size, width - to_fill)
        put(k, fill - moved, slots[:-1] + ([(length, rank, start, size - moved)] if size > moved else []))
        put(k, to_fill + moved, [*to_slots, (length, rank, start + size - moved, moved)])
    return out + [(packs, slots) for packs, _, slots in alive.values()]


PLACES = ("length", "rank", "packs", "start", "size", "sequence", "offset")


def places(histogram: dict[int, int], width: int) -> np.ndarray:
    """Rows (see PLACES): of the pieces of a length with ranks in [rank, rank + packs), ``size`` ids from ``start`` on
    stand at ``offset`` of the sequences from ``sequence`` on."""
    rows, sequence = [], 0
    for packs, slots in top_up(ranked(shortest_pack_first(histogram, width)), width):
        offset = 0
        for length, rank, start, size in slots:
            rows.append((length, rank, packs, start, size, sequence, offset))
            offset += size
        sequence += packs
    return np.array(sorted(rows), np.int64).reshape(-1, len(PLACES))


class Places:
    """Finds the places of pieces by length and rank."""

    def __init__(self, rows: np.ndarray):
        # rank ranges of a length may be cut at different ranks by different parts of a piece: cut all at all edges
        edges: dict[int, set[int]] = {}
        for length, rank, packs, *_ in rows.tolist():
            edges.setdefault(length, set()).update((rank, rank + packs))
        at = {n: np.array(sorted(x), np.int64) for n, x in edges.items()}
        parts: dict[tuple[int, int], list[tuple]] = {}
        for length, rank, packs, start, size, sequence, offset in rows.tolist():
            own = at[length]
            for lo in own[np.searchsorted(own, rank) : np.searchsorted(own, rank + packs)].tolist():
                parts.setdefault((length, lo), []).append((start, size, sequence + lo - rank, offset))
        keys = sorted(parts)
        self.first_of, before = {}, 0
        for n in sorted(at):
            self.first_of[n] = before  # ranks of all lengths in a row
            before += int(at[n][-1])
        self.starts = np.array([self.first_of[n] + lo for n, lo in keys], np.int64)
        self.low = np.array([lo for _, lo in keys], np.int64)
        self.n = np.array([len(parts[k]) for k in keys], np.int64)
        self.at = np.cumsum(self.n) - self.n
        self.parts = np.array([x for k in keys for x in sorted(parts[k])], np.int64).reshape(-1, 4)

    def find(self, lengths: np.ndarray, ranks: np.ndarray) -> tuple[np.ndarray, ...]:
        """(which piece, start, size, sequence, offset) of all parts of pieces."""
        kinds, back = np.unique(lengths, return_inverse=True)
        firsts = np.array([self.first_of[n] for n in kinds.tolist()], np.int64)
        k = np.searchsorted(self.starts, firsts[back] + ranks, side="right") - 1
        piece = np.repeat(np.arange(len(k)), self.n[k])
        within = np.arange(len(piece)) - np.repeat(np.cumsum(self.n[k]) - self.n[k], self.n[k])
        start, size, sequence, offset = self.parts[np.repeat(self.at[k], self.n[k]) + within].T
        return piece, start, size, sequence + (ranks - self.low[k])[piece], offset


# --- shards ---------------------------------------------------------------------------------------

SHARD = "path string, n_docs long, counts array<struct<length:int,n:long>>"
_SHARD_ROWS = pa.schema([("doc_id", pa.int64()), ("ids", pa.binary())])


def piece_lengths(sizes: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """(document, length) of the pieces of documents of so many ids, in order."""
    n = -(-sizes // width)
    doc = np.repeat(np.arange(len(sizes)), n)
    last = np.arange(len(doc)) == (np.cumsum(n) - 1)[doc]
    return doc, np.where(last, sizes[doc] - (n[doc] - 1) * width, width)


def _write(path: str, folder: str, end_id: int, width: int, shard_ids: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc, out = shared_encoder(path), None
        end = np.array([end_id], enc.type)
        kinds = pa.list_(pa.struct([("length", pa.int32()), ("n", pa.int64())]))

        def close() -> pa.RecordBatch:
            out.close()
            counts = [{"length": n, "n": c} for n, c in enumerate(histogram.tolist()) if c]
            return pa.record_batch([pa.array([name]), pa.array([docs], pa.int64()), pa.array([counts], kinds)], names=["path", "n_docs", "counts"])

        for batch in batches:
            for some in slices(batch, size=1_000_000):  # what is looked up at once stays in the caches
                ids = [np.concatenate([x, end]) for x in enc.encode(some["text"].to_pylist())]
                if out is None:
                    files, name = new_file(folder, ".ids")
                    out = pa.ipc.new_stream(files.open_output_stream(name), _SHARD_ROWS, options=pa.ipc.IpcWriteOptions(compression="zstd"))
                    histogram, docs, total = np.zeros(width + 1, np.int64), 0, 0
                sizes = np.fromiter(map(len, ids), np.int64, len(ids))
                histogram += np.bincount(piece_lengths(sizes, width)[1], minlength=width + 1)
                docs, total = docs + len(ids), total + int(sizes.sum())
                out.write_batch(pa.record_batch([some["doc_id"], pa.array([x.tobytes() for x in ids], pa.binary())], schema=_SHARD_ROWS))
                if total >= shard_ids:
                    yield close()
                    out = None
        if out is not None:
            yield close()

    return run


PIECE = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long"


def _place(folder: str, found: Places, kind: str, width: int, with_ids: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        files, _ = open_folder(folder)
        for shards in batches:
            for path, ranks in zip(shards["path"].to_pylist(), shards["ranks"].to_pylist(), strict=True):
                next_rank = np.zeros(width + 1, np.int64)
                for r in ranks:
                    next_rank[r["length"]] = r["before"]
                with files.open_input_stream(path) as f:
                    for batch in pa.ipc.open_stream(f):
                        yield place(batch, next_rank)

    def place(batch: pa.RecordBatch, next_rank: np.ndarray) -> pa.RecordBatch:
        ids = [np.frombuffer(x, kind) for x in batch["ids"].to_pylist()]
        sizes = np.fromiter(map(len, ids), np.int64, len(ids))
        doc, length = piece_lengths(sizes, width)
        order = np.argsort(length, kind="stable")
        n = np.bincount(length, minlength=width + 1)
        rank = np.empty(len(length), np.int64)
        rank[order] = np.arange(len(length)) - np.repeat(np.cumsum(n) - n, n) + next_rank[length[order]]
        next_rank += n
        piece, start, size, sequence, offset = found.find(length, rank)
        first = np.arange(len(doc)) - (np.cumsum(np.bincount(doc, minlength=len(ids))) - np.bincount(doc, minlength=len(ids)))[doc]
        own, start = doc[piece], first[piece] * width + start
        parts = [ids[d][a : a + k].astype("<u4") for d, a, k in zip(own.tolist(), start.tolist(), size.tolist(), strict=True)]
        columns = [
            batch["doc_id"].take(pa.array(own)), pa.array(start), pa.array(size), pa.array([zlib.crc32(x.tobytes()) for x in parts], pa.int64()),
            pa.array(sizes[own]), pa.array(sequence), pa.array(offset),
        ]
        names = [x.split()[0] for x in PIECE.split(", ")]
        if with_ids:
            columns.append(pa.array([x.astype(np.int32) for x in parts], pa.list_(pa.int32())))
            names.append("ids")
        return pa.record_batch(columns, names=names)

    return run


def pack_documents(docs: DataFrame, path: str | None = None, end_id: int = 1, width: int = WIDTH, with_ids: bool = False, shard_ids: int = SHARD_IDS) -> DataFrame:
    """The pieces of all documents with their place in a sequence (PIECE), and their ids if asked for; see ``sequences``."""
    spark = docs.sparkSession
    path, folder = path or tokenizer_path("word_bpe_49k.json"), fresh_dir(spark, "packing")
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    shards = staged(rows.mapInArrow(_write(path, folder, end_id, width, shard_ids), SHARD), "packing-shards")
    counts = shards.select("path", F.inline("counts"))
    total = {r["length"]: r["n"] for r in counts.groupBy("length").agg(F.sum("n").alias("n")).collect()}  # a row a length
    earlier = Window.partitionBy("length").orderBy("path").rowsBetween(Window.unboundedPreceding, -1)
    before = counts.withColumn("before", F.coalesce(F.sum("n").over(earlier), F.lit(0)))
    ranks = before.groupBy("path").agg(F.collect_list(F.struct("length", "before")).alias("ranks"))  # a row a length at most
    tasks = max(1, min(10_000, shards.count()))
    place = _place(folder, Places(places(total, width)), shared_encoder(path).type.str, width, with_ids)
    return ranks.repartition(tasks).mapInArrow(place, PIECE + (", ids array<int>" if with_ids else ""))


def sequences(pieces: DataFrame) -> DataFrame:
    """(sequence_id, ids, starts) from pieces with ids: a sequence's ids in a row, and where each piece begins in them."""
    own = F.sort_array(F.collect_list(F.struct("offset", "ids")))  # not more than the sequence's width
    return pieces.groupBy("sequence_id").agg(own.alias("own")).select("sequence_id", F.flatten("own.ids").alias("ids"), F.col("own.offset").alias("starts"))


def digest(docs: DataFrame) -> DataFrame:
    """The columns of op12."""
    return pack_documents(docs)

"""Token ids in binary shards, with a minimal perfect hash index from document key to offset.

Documents are range-partitioned by doc_id, so that shards follow each other in ascending order, and
encoded. A shard is three files: ``.bin`` holds raw ids (16 bits where the vocabulary allows it) after
a short head; ``.idx`` holds a minimal perfect hash over the shard's document keys (levels of bit
arrays; a key sits at the first level where it is alone), by hash value a slot of 32-bit fingerprint,
first document and number of documents, and the documents' ends; ``.key`` lists the documents' keys
in file order for readers that want all of them. The index holds no keys, and a lookup reads a 64-byte
block for each level that it tries, one slot, and two ends, wherever the key lies.

Words are encoded by the tokenizer once and kept in a table of bounded size: the pre-tokenizer always
cuts before a space that a non-space follows and around a single line end, so the ids of a text are
those of its words in a row. A word of letters (and a tail of marks) is a piece already, so only its
merges are asked for. Texts with other runs of white space, or with the string of an added token, are
encoded whole.

Defined cases: a null or empty text has the end id alone; rows that tie in doc_id are in the order
of their text's hash, then text, and share one key; a null doc_id comes first and has no key; doc_ids
are cast to long (one that can't be stops the run under ANSI mode). Extra columns are not read.
"""

from __future__ import annotations

import functools
import os
import re
import zlib
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lexiscope.llm.common import fresh_dir, staged
from lexiscope.llm.files import new_file, open_folder
from lexiscope.llm.word_table import WordTable, slices, spread

U = np.uint64
HEAD, INDEX_HEAD = b"LEXIDS02", b"LEXIDX02"
SHARD_IDS = 32_000_000
#: Words of a generation of the table.
WORDS = 450_000
#: Two line ends before more white space or the end of a text.
_LINE_ENDS = re.compile(r"\n\n(?=[\n ]|\Z)")


def tokenizer_path(name: str = "byte_bpe_50k.json") -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


#: Characters that end a word and are a piece of their own after a letter.
TAIL = ".,;:!?#$%&*)]}"


def byte_letters() -> dict[int, str]:
    """How byte-level vocabularies write a byte: printable ones as themselves, the others from U+0100 on."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    return {b: chr(b) for b in shown} | {b: chr(256 + k) for k, b in enumerate(sorted(set(range(256)).difference(shown)))}


class Encoder:
    """Whole texts to ids as little-endian unsigned 16-bit (or 32-bit) bytes."""

    def __init__(self, path: str, words: int = WORDS):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tok = Tokenizer.from_file(path)
        self.added = [t.content for t in self.tok.get_added_tokens_decoder().values()]  # their strings in a text are tokens
        self.type = np.dtype("<u2" if self.tok.get_vocab_size() <= 2**16 else "<u4")
        self.line_end = self.ids("\n")
        self.letters = byte_letters()
        self.tails: dict[str, list[int]] = {}
        self.ends = {c: self.ids(c) for c in TAIL}
        self.table = WordTable(self._learn_all, "H" if self.type.itemsize == 2 else "I", words)
        if len(self.line_end) != 1:
            raise ValueError("the vocabulary has no single id for a line end")

    def ids(self, text: str) -> list[int]:
        return self.tok.encode(text, add_special_tokens=False).ids

    def raw(self, text: str) -> bytes:
        return np.array(self.ids(text), self.type).tobytes()

    def _learn(self, word: str) -> list[int] | None:
        """The ids of a word after a space, or after the line end that it begins with."""
        line, body = word[:1] == "\n", word.removeprefix("\n")
        if not body:
            return self.line_end if line else None
        if body[0].isspace() or body[-1].isspace():
            return None
        core = body.rstrip(TAIL)
        if core.isalpha() and (core.isascii() or max(core) < "\u0250"):
            # letters alone are one piece, so only its merges are needed
            spelt = core if core.isascii() else core.encode().decode("latin-1").translate(self.letters)
            ids = [t.id for t in self.tok.model.tokenize(spelt if line else "\u0120" + spelt)]
            if tail := body[len(core) :]:
                if tail not in self.tails:
                    if len(self.tails) > 10_000:
                        self.tails.clear()
                    self.tails[tail] = self.ids(tail)
                ids = ids + self.tails[tail]
        else:
            ids = self.ids(body if line else " " + body)
        return self.line_end + ids if line else ids

    def _learn_all(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        tokenize, ends, found = self.tok.model.tokenize, self.ends, []
        for w in words:
            if w.isascii():  # nearly all are letters, or letters and one mark: the same as _learn has, with less around it
                if w.isalpha():
                    found.append([t.id for t in tokenize("\u0120" + w)])
                    continue
                if w[-1:] in ends and w[:-1].isalpha():
                    found.append([t.id for t in tokenize("\u0120" + w[:-1])] + ends[w[-1]])
                    continue
            found.append(self._learn(w))
        sizes = np.array([-1 if x is None else len(x) for x in found], np.int64)
        return np.fromiter(chain.from_iterable(x or () for x in found), self.type), sizes

    def _odd(self, text: str) -> bool:
        """Runs of white space that the pre-tokenizer doesn't cut at the space, or an added token."""
        if "  " in text or " \n" in text or text[-1:] == " " or ("\n\n" in text and _LINE_ENDS.search(text)):
            return True
        return any(a in text for a in self.added)

    def encode(self, texts: list[str]) -> list[bytes]:
        # a line end in front makes the first word one without a space
        split = [[] if self._odd("\n" + t) else ("\n" + t).replace("\n", " \n").split(" ")[1:] for t in texts]
        starts, sizes = self.table.look_up([w for s in split for w in s])
        ends = np.cumsum([len(s) for s in split])
        lost = np.unique(np.searchsorted(ends, np.flatnonzero(sizes < 0), side="right")).tolist()
        sizes = np.maximum(sizes, 0)
        ids = self.table.pool()[spread(starts, sizes)]
        at = np.concatenate([[0], np.cumsum(sizes)])[np.concatenate([[0], ends]).astype(np.int64)].tolist()
        whole = {k for k, s in enumerate(split) if not s}.union(lost)
        return [self.raw(t) if k in whole else ids[at[k] + 1 : at[k + 1]].tobytes() for k, t in enumerate(texts)]


@functools.cache
def shared_encoder(path: str) -> Encoder:
    """One for each Python worker, so that its tables serve all tasks of the worker."""
    return Encoder(path)


def mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> U(30))) * U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> U(27))) * U(0x94D049BB133111EB)
    return x ^ (x >> U(31))


#: Words of a block of the bit arrays, after the ones before it.
BLOCK = 7
SLOT = np.dtype([("fingerprint", "<u4"), ("n", "<u4"), ("first", "<i8")])


def _place(h: np.ndarray, level: int, size: int) -> np.ndarray:
    return (mix(h + U(level * 0x9E3779B97F4A7C15 % 2**64)) % U(size)).astype(np.int64)


class PerfectHash:
    """A minimal perfect hash of distinct 64-bit keys: 0 to n - 1, without the keys.

    blocks: rows of the number of ones before, then BLOCK words; spill: sorted hashes of the few keys that no level has alone.
    """

    GAMMA, LEVELS = 1.7, 48

    def __init__(self, sizes: np.ndarray, blocks: np.ndarray, spill: np.ndarray):
        self.sizes, self.blocks, self.spill = sizes, blocks, spill
        self.at = np.concatenate([[0], np.cumsum(sizes)])
        self.words = blocks[:, 1:].ravel()
        self.before = np.concatenate([[0], np.cumsum(np.bitwise_count(self.words))]).astype(np.int64)

    @classmethod
    def build(cls, keys: np.ndarray) -> PerfectHash:
        left, sizes, levels, unit = mix(keys.astype(np.uint64)), [], [np.zeros(0, np.uint64)], 64 * BLOCK
        while len(left) and len(sizes) < cls.LEVELS:
            size = int(len(left) * cls.GAMMA) // unit * unit + unit
            p = _place(left, len(sizes), size)
            alone = np.bincount(p, minlength=size) == 1
            levels.append(np.packbits(alone, bitorder="little").view(np.uint64))
            sizes.append(size)
            left = left[~alone[p]]
        words = np.concatenate(levels).reshape(-1, BLOCK)
        ones = np.bitwise_count(words).sum(axis=1).astype(np.uint64)
        return cls(np.array(sizes, np.int64), np.column_stack([np.cumsum(ones) - ones, words]), np.sort(left))

    def __call__(self, keys: np.ndarray) -> np.ndarray:
        """The values of keys; of keys that weren't there, any value or -1."""
        h = mix(keys.astype(np.uint64))
        out, todo = np.full(len(h), -1, np.int64), np.arange(len(h))
        for level, size in enumerate(self.sizes.tolist()):
            p = self.at[level] + _place(h[todo], level, size)
            word, low = self.words[p >> 6], (p & 63).astype(np.uint64)
            there = (word >> low) & U(1) != 0
            rank = self.before[p >> 6] + np.bitwise_count(word & ((U(1) << low) - U(1)))
            out[todo[there]] = rank[there]
            todo = todo[~there]
        if len(todo) and len(self.spill):
            k = np.minimum(np.searchsorted(self.spill, h[todo]), len(self.spill) - 1)
            found = self.spill[k] == h[todo]
            out[todo[found]] = self.before[-1] + k[found]
        return out


def fingerprints(keys: np.ndarray) -> np.ndarray:
    return (mix(keys.astype(np.uint64) ^ U(0xA0761D6478BD642F)) >> U(32)).astype(np.uint32)


def build_index(keys: np.ndarray, ends: np.ndarray) -> bytes:
    """Of a shard: its documents' keys in ascending order (those without one come first), and all documents' ends."""
    own, first, n = np.unique(keys, return_index=True, return_counts=True)
    h = PerfectHash.build(own)
    slots = np.zeros(len(own), SLOT)
    at = h(own)
    slots["fingerprint"][at], slots["n"][at], slots["first"][at] = fingerprints(own), n, len(ends) - len(keys) + first
    head = np.array([len(own), len(ends), len(h.sizes), len(h.blocks), len(h.spill)], "<i8")
    parts = (head, h.sizes.astype("<i8"), h.blocks.astype("<u8"), h.spill.astype("<u8"), slots, ends.astype("<i8"))
    return INDEX_HEAD + b"".join(x.tobytes() for x in parts)


class Shard:
    """Keyed access to the ids of a shard."""

    def __init__(self, path: str, uri: str):
        files, _ = open_folder(uri)
        self.index, self.file, self.key_file = (files.open_input_file(path + x) for x in (".idx", ".bin", ".key"))
        head = self.file.read_at(16, 0)
        if head[:8] != HEAD or self.index.read_at(8, 0) != INDEX_HEAD:
            raise ValueError(f"{path} is no shard of ids")
        self.type = np.dtype(f"<u{int.from_bytes(head[8:16], 'little')}")
        self.n_keys, self.n_docs, levels, self.n_blocks, self.n_spill = self._read(8, 5, "<i8").tolist()
        self.sizes = self._read(48, levels, "<i8")
        self.level_at = np.concatenate([[0], np.cumsum(self.sizes)]).tolist()
        self.blocks_at = 48 + 8 * levels
        self.spill_at = self.blocks_at + 8 * (BLOCK + 1) * self.n_blocks
        self.slots_at = self.spill_at + 8 * self.n_spill
        self.ends_at = self.slots_at + SLOT.itemsize * self.n_keys

    def _read(self, at: int, n: int, kind) -> np.ndarray:
        kind = np.dtype(kind)
        return np.frombuffer(self.index.read_at(n * kind.itemsize, at), kind)

    def find(self, key: int) -> tuple[int, int]:
        """(first document, number of documents) of a key, from a few ranges of the index; 0 documents if it isn't there."""
        one = np.array([key], np.int64)
        h, slot = mix(one.astype(np.uint64)), -1
        for level, size in enumerate(self.sizes.tolist()):
            block, bit = divmod(self.level_at[level] + int(_place(h, level, size)[0]), 64 * BLOCK)
            x = self._read(self.blocks_at + block * 8 * (BLOCK + 1), BLOCK + 1, "<u8").tolist()
            word, low = x[1 + bit // 64], bit % 64
            if word >> low & 1:
                slot = x[0] + sum(w.bit_count() for w in x[1 : 1 + bit // 64]) + (word & ((1 << low) - 1)).bit_count()
                break
        else:
            spill = self._read(self.spill_at, self.n_spill, "<u8")
            if len(k := np.flatnonzero(spill == h[0])):
                slot = self.n_keys - self.n_spill + int(k[0])
        if slot < 0:
            return 0, 0
        s = self._read(self.slots_at + slot * SLOT.itemsize, 1, SLOT)[0]
        return (int(s["first"]), int(s["n"])) if s["fingerprint"] == fingerprints(one)[0] else (0, 0)

    def get(self, key: int) -> list[np.ndarray]:
        """The ids of each document of a key."""
        first, n = self.find(key)
        if not n:
            return []
        edges = self._read(self.ends_at + 8 * max(0, first - 1), n + (first > 0), "<i8")
        edges = edges if first else np.concatenate([[0], edges])
        return [self.ids(int(a), int(b)) for a, b in zip(edges, edges[1:], strict=False)]

    def ids(self, start: int, stop: int) -> np.ndarray:
        w = self.type.itemsize
        return np.frombuffer(self.file.read_at((stop - start) * w, 16 + start * w), self.type)

    def keys(self) -> np.ndarray:
        """The documents' keys in file order, without the first n_docs - len that have none."""
        return np.frombuffer(self.key_file.read_at(self.key_file.size(), 0), "<i8")

    def documents(self, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """find() of many keys at once, with the whole index in memory."""
        if not self.n_keys:
            return np.zeros(len(keys), np.int64), np.zeros(len(keys), np.int64)
        blocks = self._read(self.blocks_at, self.n_blocks * (BLOCK + 1), "<u8").reshape(-1, BLOCK + 1)
        slot = PerfectHash(self.sizes, blocks, self._read(self.spill_at, self.n_spill, "<u8"))(keys)
        s = self._read(self.slots_at, self.n_keys, SLOT)[slot]
        fits = (slot >= 0) & (s["fingerprint"] == fingerprints(keys))
        return np.where(fits, s["first"], 0), np.where(fits, s["n"], 0).astype(np.int64)

    def ends(self) -> np.ndarray:
        return self._read(self.ends_at, self.n_docs, "<i8")


MANIFEST = "part long, shard long, path string, n_docs long, n_ids long, least long, most long"


def _write(path: str, folder: str, end_id: int, shard_ids: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc, part, shard = shared_encoder(path), TaskContext.get().partitionId(), 0
        end = np.array([end_id], enc.type).tobytes()
        out = None

        def close() -> pa.RecordBatch:
            out.close()
            own = np.array(keys, np.int64)
            for suffix, data in ((".idx", build_index(own, np.array(ends, np.int64))), (".key", own.astype("<i8").tobytes())):
                with files.open_output_stream(name + suffix) as f:
                    f.write(data)
            row = (part, shard, name, len(ends), ends[-1], int(own[0]) if len(own) else None, int(own[-1]) if len(own) else None)
            kinds = (pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.int64(), pa.int64())
            return pa.record_batch([pa.array([v], t) for v, t in zip(row, kinds, strict=True)], names=[x.split()[0] for x in MANIFEST.split(", ")])

        for batch in batches:
            for some in slices(batch):
                ids = enc.encode(some["text"].to_pylist())
                for doc, raw in zip(some["doc_id"].to_pylist(), ids, strict=True):
                    if out is None:
                        files, name = new_file(folder, "")
                        out = files.open_output_stream(name + ".bin")
                        out.write(HEAD + enc.type.itemsize.to_bytes(8, "little"))
                        keys, ends = [], []
                    out.write(raw + end)
                    if doc is not None:
                        keys.append(doc)
                    ends.append((ends[-1] if ends else 0) + len(raw) // enc.type.itemsize + 1)
                    if ends[-1] >= shard_ids:
                        yield close()
                        out, shard = None, shard + 1
        if out is not None:
            yield close()

    return run


def write_shards(docs: DataFrame, path: str | None = None, end_id: int = 0, shard_ids: int = SHARD_IDS, folder: str | None = None) -> tuple[DataFrame, str]:
    """Writes the shards; (manifest with each shard's first id ``base``, folder)."""
    folder = folder or fresh_dir(docs.sparkSession, "ids")
    text = F.coalesce("text", F.lit(""))
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text.alias("text"))
    order = [F.asc_nulls_first("doc_id"), F.xxhash64("text")]
    ranged = rows.repartitionByRange(*order).sortWithinPartitions(*order, "text")
    manifest = staged(ranged.mapInArrow(_write(path or tokenizer_path(), folder, end_id, shard_ids), MANIFEST), "manifest")
    before = Window.orderBy("part", "shard").rowsBetween(Window.unboundedPreceding, -1)  # a row for each shard
    return manifest.withColumn("base", F.coalesce(F.sum("n_ids").over(before), F.lit(0))), folder


READ = "doc_id long, start long, n_tokens long, ids_crc32 long"


def _read(folder: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path, base in zip(batch["path"].to_pylist(), batch["base"].to_pylist(), strict=True):
                s = Shard(path, folder)
                keys, ends = s.keys(), s.ends()
                begins = np.concatenate([[0], ends[:-1]])
                own = np.unique(keys)
                first, n = s.documents(own)
                lost = s.n_docs - len(keys)
                which = np.concatenate([np.arange(lost), spread(first, n)]).astype(np.int64)
                ids = [None] * lost + np.repeat(own, n).tolist()
                crc = [zlib.crc32(s.ids(a, b).astype("<u4").tobytes()) for a, b in zip(begins[which].tolist(), ends[which].tolist(), strict=True)]
                yield pa.record_batch(
                    [pa.array(ids, pa.int64()), pa.array(base + begins[which]), pa.array((ends - begins)[which]), pa.array(crc, pa.int64())],
                    names=["doc_id", "start", "n_tokens", "ids_crc32"],
                )

    return run


def digest(docs: DataFrame) -> DataFrame:
    """The columns of op8, by lookups of every key in the files; shards are dealt one by one to as many tasks (10,000 at most)."""
    manifest, folder = write_shards(docs)
    tasks = max(1, min(10_000, manifest.count()))
    return manifest.select("path", "base").repartition(tasks).mapInArrow(_read(folder), READ)

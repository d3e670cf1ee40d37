"""SentencePiece encoding and decoding: N-best segmentation over the piece lattice.

The lattice of a text has an edge for every piece of the vocabulary that matches somewhere. A
forward Viterbi pass gives each position the best score of any segmentation that ends there. These
scores are exact heuristics for a backward A-star search from the end, which pops complete
segmentations in order of score. The vocabulary's scores are read as a unigram model's; a character
without a piece costs ``min score - 10`` and becomes its UTF-8 byte pieces.

Keys of the search are what a partial segmentation costs against the best one. With exact heuristics
these costs are exact and don't fall, so ties go to the position nearest to the text's beginning, the
search runs straight to its next result, and no more partial segmentations need be kept than results
are still wanted. Partial segmentations are linked, not copied, and edges are found again from
the text, so memory grows with a text's length and not faster, whatever the text.

Where two neighbouring characters stand side by side in no piece at all, no edge crosses, so the
lattice of a text is a chain of small lattices (links). What the Viterbi pass makes of words is kept in
tables of bounded size: ids, score, and what the search's second result would cost. A text's best
segmentation is the chain of best ones; its n best differ from it in the n - 1 words whose second best
costs least at most, so the search opens these alone, and their results are combined in order of cost.

Decoding is exact for every text: a literal U+2581, the mark for a space, is encoded by its bytes.

Defined cases: a null text is empty; an empty text has no pieces. Of segmentations that cost the
same, those that differ in an earlier word come first. Rows that repeat are each encoded. Extra
columns are carried along; the new columns replace their namesakes.
"""

from __future__ import annotations

import functools
import hashlib
import heapq
import re
from array import array
from collections import Counter
from collections.abc import Iterator
from operator import itemgetter
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lexiscope.llm.word_table import WordTable, slices, spread

MARK = "▁"
#: Words of a generation of the table, and words whose n best are kept; both live as long as a Python worker.
WORDS, OPENED = 200_000, 20_000
#: Kinds of characters that the pass over many words tells apart, and the longest word that it takes.
CLASSES, SHORT = 256, 40
#: Segmentations that op5 returns of each text.
N_BEST = 4
#: Stands for a literal U+2581 in a lattice.
LITERAL = "\ud800"


def model_path(name: str = "piece_bpe_32k.model") -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


class Pieces:
    """A vocabulary with scores, and segmentations by it."""

    def __init__(self, path: str):
        import sentencepiece

        sp = sentencepiece.SentencePieceProcessor(model_file=path)
        self.ids: dict[str, int] = {}
        self.score: dict[str, float] = {}
        self.bytes_of: list[bytes] = []
        self.byte_id = [0] * 256
        for i in range(sp.get_piece_size()):
            piece = sp.id_to_piece(i)
            if sp.is_byte(i):
                b = int(piece[3:-1], 16)
                self.byte_id[b] = i
                self.bytes_of.append(bytes([b]))
            elif sp.is_control(i) or sp.is_unknown(i) or sp.is_unused(i):
                self.bytes_of.append(b"")
            else:
                self.ids[piece], self.score[piece] = i, sp.get_score(i)
                self.bytes_of.append(piece.replace(MARK, " ").encode())
        self.unknown = min(self.score.values()) - 10
        #: Scores of pieces, None for what only begins one. A score of 0 would end a search, so it is as near to 0 as can be.
        self.prefixes: dict[str, float | None] = {p[:n]: None for p in self.score for n in range(1, len(p))}
        self.prefixes.update((p, s or -5e-324) for p, s in self.score.items())
        if any(MARK in p.lstrip(MARK) or ("\n" in p and p != "\n") for p in self.score):
            raise ValueError("a piece of this vocabulary goes on after a word's end")
        self.pairs = {p[i : i + 2] for p in self.score for i in range(len(p) - 1)}
        self.longest = max(map(len, self.score))
        self.data = np.frombuffer(b"".join(self.bytes_of), np.uint8)
        self.data_size = np.array([len(b) for b in self.bytes_of], np.int64)
        self.data_at = np.cumsum(self.data_size) - self.data_size
        self.opened: dict[tuple[str, int], list[tuple[float, list[int]]]] = {}
        self.table = WordTable(self._learn_all, "i", WORDS)
        self._make_trie()

    def _make_trie(self) -> None:
        """Beginnings of pieces as nodes (0: none, 1: the empty one), for many words at once; of the CLASSES commonest characters."""
        common = [c for c, _ in Counter("".join(self.prefixes)).most_common(CLASSES - 1)]
        self.class_of = np.zeros(0x110000, np.uint8)
        self.class_of[[ord(c) for c in common]] = np.arange(1, len(common) + 1)
        known, node = set(common), {"": 1}
        nodes = [p for p in sorted(self.prefixes, key=len) if known.issuperset(p)]
        node.update((p, k) for k, p in enumerate(nodes, 2))
        self.step = np.zeros((len(nodes) + 2, CLASSES), np.uint16 if len(nodes) < 2**16 - 2 else np.int32)
        chars = np.array([ord(p[-1]) for p in nodes], np.int64)
        self.step[[node[p[:-1]] for p in nodes], self.class_of[chars]] = np.arange(2, len(nodes) + 2)
        self.node_score = np.array([-1e300, -1e300, *(self.score.get(p, -1e300) for p in nodes)])
        self.node_id = np.array([-1, -1, *(self.ids.get(p, -1) for p in nodes)], np.int32)

    def forward(self, link: str) -> tuple[list[float], list[int], list[float]]:
        """Viterbi: for each end the best score, where its last piece begins, and the second best score by another last piece."""
        n = len(link)
        if n < 4096:
            best, back, second = [0.0] + [-1e300] * n, [0] * (n + 1), [-1e300] * (n + 1)
        else:  # the same in less memory
            best, back, second = array("d", [0.0]) + array("d", [-1e300]) * n, array("q", [0]) * (n + 1), array("d", [-1e300]) * (n + 1)
        get, unknown = self.prefixes.get, self.unknown
        for a in range(n):
            base, b = best[a], a + 1
            s = get(link[a], 0)
            if s is None or s == 0:
                t = base + unknown
                if t > best[b]:
                    second[b], best[b], back[b] = best[b], t, a
                elif t > second[b]:
                    second[b] = t
            while s != 0:  # None: a beginning of pieces, no piece itself
                if s is not None:
                    t = base + s
                    if t > best[b]:
                        second[b], best[b], back[b] = best[b], t, a
                    elif t > second[b]:
                        second[b] = t
                if b == n:
                    break
                b += 1
                s = get(link[a:b], 0)
        return best, back, second

    def cuts(self, link: str, n: int) -> list[tuple[float, list[int]]]:
        """The n best segmentations as (cost against the best, positions from 0 to the end): A-star backward from the end."""
        best, _, _ = self.forward(link)
        score, longest, unknown = self.score.get, self.longest, self.unknown
        # (cost, position, order of coming, (position, node behind it))
        heap: list[tuple[float, int, int, tuple]] = [(0.0, len(link), 0, (len(link), None))]
        out: list[tuple[float, list[int]]] = []
        came = 0
        while heap and len(out) < n:
            cost, at, _, node = heapq.heappop(heap)
            if at == 0:
                path = []
                while node:
                    path.append(node[0])
                    node = node[1]
                out.append((cost, path))
                continue
            for a in range(max(0, at - longest), at):
                s = score(link[a:at], unknown if a == at - 1 else None)
                if s is not None:
                    came += 1
                    heapq.heappush(heap, (cost + max(0.0, best[at] - (best[a] + s)), a, came, (a, node)))
            if len(heap) > 8 * n + 64:  # each has a result that costs as much as its key, so these are enough
                heap = heapq.nsmallest(n - len(out), heap)
        return out

    def ids_of(self, link: str, path: list[int]) -> list[int]:
        out: list[int] = []
        for a, b in zip(path, path[1:]):
            piece = self.ids.get(link[a:b])
            out.extend([piece] if piece is not None else (self.byte_id[x] for x in link[a:b].replace(LITERAL, MARK).encode("utf-8", "surrogatepass")))
        return out

    def link(self, link: str) -> tuple[list[int], float, float]:
        """(ids, score, what the second best costs) of a link.

        The second result of the search leaves the best path at one position by another edge, and the exact
        heuristics say what that costs; so the least such cost along the best path is its key.
        """
        best, back, second = self.forward(link)
        path, gap, at = [len(link)], 1e300, len(link)
        while at:
            gap = min(gap, best[at] - second[at])
            at = back[at]
            path.append(at)
        return self.ids_of(link, path[::-1]), best[-1], gap if gap < 1e299 else float("inf")

    def _links(self, word: str) -> list[str]:
        """The links of an entry of the table: a word after a space, after a line end that it begins with, or after more spaces."""
        out, rest = [], word
        if word[:1] == "\n":
            out, rest = ["\n"], word[1:]
        else:
            rest = MARK + word.replace(" ", MARK)
        pairs, at = self.pairs, 0
        for i in range(1, len(rest)):
            if rest[i - 1 : i + 1] not in pairs:
                out.append(rest[at:i])
                at = i
        if at < len(rest):
            out.append(rest[at:])
        return out

    def _learn(self, word: str) -> list[int]:
        """Ids after score and gap as 32-bit words, link by link."""
        ids: list[int] = []
        score, gap = 0.0, float("inf")
        for u in self._links(word):
            got = self.link(u)
            ids += got[0]
            score += got[1]
            gap = min(gap, got[2])
        return [*np.array([score, gap]).view(np.int32).tolist(), *ids]

    def _learn_all(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """The same of many words: the Viterbi pass of short ones made of common characters runs for all at once."""
        spelt = [w if w[:1] == "\n" else MARK + w.replace(" ", MARK) for w in words]
        n = np.fromiter(map(len, spelt), np.int64, len(spelt))
        sizes, parts = np.zeros(len(words), np.int64), []
        order = np.argsort(n, kind="stable")
        order = order[: np.searchsorted(n[order], SHORT, side="right")]
        for at in range(0, len(order), 8192):
            own = order[at : at + 8192]
            parts.append((own, *self._viterbi([spelt[k] for k in own.tolist()], n[own])))
        done = np.zeros(len(words), bool)
        flat, owner = [], []
        for own, good, rows, counts in parts:
            done[own[good]] = True
            sizes[own[good]] = counts
            flat.append(rows)
            owner.append(np.repeat(own[good], counts))
        for k in np.flatnonzero(~done).tolist():
            ids = np.array(self._learn(words[k]), np.int32)
            sizes[k] = len(ids)
            flat.append(ids)
            owner.append(np.full(len(ids), k))
        who = np.concatenate(owner)
        return np.concatenate(flat)[np.argsort(who, kind="stable")], sizes

    def _viterbi(self, words: list[str], n: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """forward() and link() of words side by side: (which could be done, their rows as _learn gives them, the rows' lengths)."""
        m, width = len(words), int(n.max())
        codes = np.frombuffer("".join(w.ljust(width, "\0") for w in words).encode("utf-32-le", "surrogatepass"), np.uint32).reshape(m, width).T
        kinds = np.ascontiguousarray(self.class_of[codes])
        inside = np.arange(width)[:, None] < n
        best, second = np.full((width + 1, m), -1e300), np.full((width + 1, m), -1e300)
        size, piece = np.zeros((width + 1, m), np.int64), np.full((width + 1, m), -1, np.int32)
        best[0] = 0
        alone = np.where(codes < 128, np.array(self.byte_id, np.int32)[np.minimum(codes, 127)], -1)
        for a in range(width):
            node, who = self.step[1][kinds[a]], np.arange(m)
            for d in range(1, width - a + 1):
                if d > 1:
                    node = self.step[node, kinds[a + d - 1, who]]
                    there = node != 0
                    node, who = node[there], who[there]
                    if not len(who):
                        break
                s, ids = self.node_score[node], self.node_id[node]
                if d == 1:
                    lone = s < -1e299
                    s, ids = np.where(lone, self.unknown, s), np.where(lone, alone[a], ids)
                t, old = best[a, who] + s, best[a + d, who]
                better = t > old
                second[a + d, who] = np.where(better, old, np.maximum(second[a + d, who], t))
                w = who[better]
                best[a + d, w], size[a + d, w], piece[a + d, w] = t[better], d, ids[better]
        good = ((kinds > 0) | (codes == 10) | ~inside).all(axis=0)
        at, who = n.copy(), np.arange(m)
        gap, counts, steps = np.full(m, 1e300), np.zeros(m, np.int64), []
        while len(who):
            b = at[who]
            gap[who] = np.minimum(gap[who], best[b, who] - second[b, who])
            got = piece[b, who]
            good[who[got < 0]] = False
            counts[who] += 1
            steps.append((who, got))
            at[who] = b - size[b, who]
            who = who[at[who] > 0]
        total = counts + 4
        begin = np.cumsum(total) - total
        rows = np.zeros(int(total.sum()), np.int32)
        numbers = np.stack([best[n, np.arange(m)], np.where(gap < 1e299, gap, np.inf)], axis=1)
        rows[np.add.outer(begin, np.arange(4))] = numbers.view(np.int32)
        for k, (who, got) in enumerate(steps):
            rows[(begin + total - 1 - k)[who]] = got
        keep = np.repeat(good, total)
        return good, rows[keep], total[good]

    def options(self, word: str, n: int) -> list[tuple[float, list[int]]]:
        """The n best of a word as (cost, ids)."""
        found = self.opened.get((word, n))
        if found is None:
            found = [(0.0, [])]
            for u in self._links(word):
                own = [(c, self.ids_of(u, p)) for c, p in self.cuts(u, n)]
                found = combined(found, own, n)
            if len(self.opened) > OPENED:
                self.opened.clear()
            if len(word) < 100:
                self.opened[word, n] = found
        return found

    def encode(self, texts: list[str], n: int = 1) -> list[Encoded]:
        """The best segmentation of each text, and the others of the n best."""
        words = [_words(t) for t in texts]
        flat = [w for own in words for w in own]
        starts, sizes = self.table.look_up(flat)
        if (sizes < 0).any():  # a word of a million pieces and more: without the table
            return [x for own in words for x in self._alone(own, n)]
        pool = self.table.pool()
        numbers = np.ascontiguousarray(pool[np.add.outer(starts, np.arange(4))]).view(np.float64) if len(flat) else np.zeros((0, 2))
        sizes = sizes - 4
        ids = pool[spread(starts + 4, sizes)].astype(np.int32)
        del pool
        ends = np.concatenate([[0], np.cumsum([len(own) for own in words])]).astype(np.int64)
        id_ends = np.concatenate([[0], np.cumsum(sizes)])
        out = []
        for own, a, b in zip(words, ends, ends[1:], strict=False):
            out.append(self._text(own, ids[id_ends[a] : id_ends[b]], numbers[a:b, 0], numbers[a:b, 1], id_ends[a : b + 1] - id_ends[a], n))
        return out

    def _alone(self, words: list[str], n: int) -> list[Encoded]:
        rows = [np.array(self._learn(w), np.int32) for w in words]
        if not rows:
            return [self._text(words, np.zeros(0, np.int32), np.zeros(0), np.zeros(0), np.zeros(1, np.int64), n)]
        numbers = np.stack([r[:4] for r in rows]).view(np.float64)
        ends = np.concatenate([[0], np.cumsum([len(r) - 4 for r in rows])])
        return [self._text(words, np.concatenate([r[4:] for r in rows]), numbers[:, 0], numbers[:, 1], ends, n)]

    def _text(self, words: list[str], ids: np.ndarray, scores: np.ndarray, gaps: np.ndarray, ends: np.ndarray, n: int) -> Encoded:
        score = float(scores.sum())
        others: list[tuple[float, np.ndarray]] = []
        if n > 1 and len(words):
            open_ = np.argsort(gaps, kind="stable")[: n - 1] if len(gaps) < n else np.flatnonzero(gaps <= np.partition(gaps, n - 2)[n - 2])
            open_ = open_[np.argsort(gaps[open_], kind="stable")][: n - 1]
            found: list[tuple[float, list]] = [(0.0, [])]
            for k in sorted(open_[np.isfinite(gaps[open_])].tolist()):
                own = [(c, [(k, other)]) for c, other in self.options(words[k], n)]
                found = combined(found, [(0.0, []), *own[1:]], n)
            for cost, changes in found[1:]:
                parts, at = [], 0
                for k, other in changes:
                    parts += [ids[at : ends[k]], np.array(other, np.int32)]
                    at = ends[k + 1]
                others.append((cost, np.concatenate([*parts, ids[at:]])))
        return Encoded(ids, score, float(gaps.min()) if len(gaps) else float("inf"), others)

    def nbest(self, text: str, n: int) -> list[tuple[float, list[int]]]:
        """The n best encodings of a whole text as (score, ids)."""
        got = self.encode([text], n)[0]
        return [(got.score, got.ids.tolist()), *((got.score - c, ids.tolist()) for c, ids in got.others)]

    def decode_all(self, ids: list[np.ndarray]) -> list[str]:
        """The text of each array of ids."""
        flat = np.concatenate(ids) if ids else np.zeros(0, np.int32)
        sizes = self.data_size[flat]
        data = self.data[spread(self.data_at[flat], sizes)].tobytes()
        ends = np.concatenate([[0], np.cumsum(sizes)])[np.concatenate([[0], np.cumsum([len(i) for i in ids])]).astype(np.int64)].tolist()
        return [data[a + 1 : b].decode("utf-8", "surrogatepass") if b > a else "" for a, b in zip(ends, ends[1:], strict=False)]

    def decode(self, ids: np.ndarray) -> str:
        return self.decode_all([ids])[0]


class Encoded(NamedTuple):
    """Ids of the best segmentation, its score, what the second best costs (infinite: there is none), and (cost, ids) of the other ones of the n best."""

    ids: np.ndarray
    score: float
    gap: float
    others: list[tuple[float, np.ndarray]]


def combined(a: list[tuple[float, list]], b: list[tuple[float, list]], n: int) -> list[tuple[float, list]]:
    """The n cheapest of one of a followed by one of b; what comes first in a, then in b, stays first among equals."""
    if len(b) == 1:
        return [(c, x + b[0][1]) for c, x in a]
    return sorted(((c + d, x + y) for c, x in a for d, y in b), key=itemgetter(0))[:n]


@functools.cache
def shared_pieces(path: str) -> Pieces:
    """One for each Python worker, so that its tables serve all tasks of the worker."""
    return Pieces(path)


def _marked(text: str) -> str:
    """Spaces as marks, after the mark that begins a text; a literal mark is a lone surrogate, which no text holds."""
    return MARK + text.replace(MARK, LITERAL).replace(" ", MARK)


_GLUED = re.compile(r" *[^ ]+| +$")


def _words(text: str) -> list[str]:
    """Entries of the table: a word as it is after one space (the one before the text counts), with the spaces
    before it but the first, or with the line end before it."""
    if not text:
        return []
    text = text.replace(MARK, LITERAL)
    if "  " not in text and " \n" not in text and text[0] != " ":
        return text.replace("\n", " \n").split(" ")
    out: list[str] = []
    for k, line in enumerate(text.split("\n")):
        own = _GLUED.findall(line if k else " " + line)
        if k and (not own or own[0][0] == " "):
            out.append("\n")
        elif k:
            own[0] = " \n" + own[0]
        out.extend(w[1:] for w in own)
    return out


#: What encode_documents can add to a table.
COLUMNS = {
    "ids": "array<int>", "n_pieces": "long", "ids_sha256": "string", "score": "double", "second_gap": "double",
    "nbest": "array<struct<score:double,ids:array<int>>>", "nbest_gaps": "array<double>", "nbest_sha256": "string",
    "decoded": "string", "decoded_sha256": "string", "round_trip": "boolean",
}


def _list_of(arrays: list[np.ndarray]) -> pa.ListArray:
    ends = np.concatenate([[0], np.cumsum([len(a) for a in arrays])])
    return pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(np.concatenate([*arrays, np.zeros(0, np.int32)]).astype(np.int32)))


def _nbest_digest(row: Encoded) -> str:
    """Of the ids of all n best in order, each after its length."""
    h = hashlib.sha256()
    for ids in (row.ids, *(x for _, x in row.others)):
        h.update(len(ids).to_bytes(8, "little") + ids.astype("<u4").tobytes())
    return h.hexdigest()


def _encode(path: str, schema: pa.Schema, wanted: tuple[str, ...], n: int):
    def column(name: str, rows: list[Encoded], decoded: list[str], texts: list[str]) -> pa.Array:
        if name == "ids":
            return _list_of([r.ids for r in rows])
        values = {
            "n_pieces": lambda: [len(r.ids) for r in rows],
            "ids_sha256": lambda: [hashlib.sha256(r.ids.astype("<u4").tobytes()).hexdigest() for r in rows],
            "score": lambda: [r.score for r in rows],
            "second_gap": lambda: [r.others[0][0] if r.others else None for r in rows],
            "nbest": lambda: [[{"score": r.score - c, "ids": ids} for c, ids in ((0.0, r.ids), *r.others)] for r in rows],
            "nbest_gaps": lambda: [[c for c, _ in r.others] for r in rows],
            "nbest_sha256": lambda: [_nbest_digest(r) for r in rows],
            "decoded": lambda: decoded,
            "decoded_sha256": lambda: [hashlib.sha256(d.encode("utf-8", "surrogatepass")).hexdigest() for d in decoded],
            "round_trip": lambda: [d == t for d, t in zip(decoded, texts, strict=True)],
        }
        return pa.array(values[name](), schema.field(name).type)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces = shared_pieces(path)
        decode = any(c in wanted for c in ("decoded", "decoded_sha256", "round_trip"))
        open_ = max(n, 2)  # the backward search runs whatever the columns: it gives the second best
        for whole in batches:
            for batch in slices(whole, size=2_000_000):
                texts = [t or "" for t in batch["text"].to_pylist()]
                rows = pieces.encode(texts, open_)
                decoded = pieces.decode_all([r.ids for r in rows]) if decode else []
                columns = {c: batch[c] for c in batch.schema.names} | {c: column(c, rows, decoded, texts) for c in wanted}
                yield from pa.table({c: columns[c] for c in schema.names}).cast(schema).to_batches()

    return run


def encode_documents(
    docs: DataFrame, path: str | None = None, columns: tuple[str, ...] = ("ids", "score", "second_gap", "decoded"), n: int = N_BEST
) -> DataFrame:
    """docs with the named ones of COLUMNS: ids; their number and digest (as little-endian 32-bit numbers); the
    best score and what the second best segmentation costs (null: there is none); the n best segmentations, what
    those after the first cost, and a digest of all their ids; the text that the ids give back, its digest, and
    whether it is the text that went in."""
    from pyspark.sql.pandas.types import to_arrow_schema

    rest = docs.drop(*columns)
    out = rest.withColumns({c: F.lit(None).cast(COLUMNS[c]) for c in columns}).schema
    return rest.mapInArrow(_encode(path or model_path(), to_arrow_schema(out), columns, n), out)


def digest(docs: DataFrame) -> DataFrame:
    """A row for each document: what encoding and decoding its whole text gave, and its N_BEST best segmentations. No text or id leaves the worker."""
    columns = ("n_pieces", "ids_sha256", "score", "second_gap", "nbest_gaps", "nbest_sha256", "decoded_sha256", "round_trip")
    return encode_documents(docs.select("doc_id", "text"), columns=columns).select("doc_id", *columns)

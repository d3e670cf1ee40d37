"""Source divergence, packing and the Merkle manifest against brute force, and their odd rows."""

import hashlib
import random
import re
import zlib
from collections import Counter
from itertools import pairwise

import numpy as np
import pytest
from pyspark.sql import functions as F

from lexiscope.llm import divergence, merkle, packing, word_ids
from lexiscope.llm.token_ids import tokenizer_path

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
DOCS = "doc_id long, source string, lang string, n_chars long, text string, leaf string, offset long, rank int"


def frame(spark, rows):
    """rows with columns whose names the operators use too."""
    return spark.createDataFrame([(*r, "x", 7, 7) for r in rows], DOCS)


ODD = [
    (1, "a", "en", 1, "Same words\nhere"), (1, "a", "en", 1, "Same words\nhere"), (1, "a", "en", 2, "other"), (2, None, "en", 1, None), (3, "", None, None, ""),
    (None, "é", "de", 3, "q\n"), (None, None, None, None, None), (6, "a", "en", 9, "long word " * 30000), (7, "a", "en", 1, "\n\n"), (8, "z", "fr", 1, "Ünï 12 <|endoftext|>"),
]


# ---- divergence


def audited(rows, min_docs=10, top=10):
    term = re.compile(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+")
    df, counts = {}, {}
    for _, source, lang, _, text in rows:
        c = Counter(term.findall((text or "").translate(LOWER)))
        counts.setdefault((lang or "", source or ""), Counter()).update(c)
        df.setdefault(lang or "", Counter()).update(c.keys())
    out = []
    for lang in df:
        kept = [t for t, n in df[lang].items() if n >= min_docs]
        groups = {s: c for (x, s), c in counts.items() if x == lang}

        def shares(c, kept=kept):
            n = sum(c[t] for t in kept)
            return {t: 1 + 10**9 * (c[t] + 2) // (n + 2 * len(kept)) for t in kept}

        f = lambda p, q: (p - q) ** 2 // (p + q)
        p, q = {s: shares(c) for s, c in groups.items()}, shares(sum(groups.values(), Counter()))
        for s in groups:
            pairs = [(-sum(f(p[s][t], p[o][t]) for t in kept), o.encode(), "pair") for o in groups if o != s]
            terms = sorted((-f(p[s][t], q[t]), t.encode(), "term") for t in kept if groups[s][t] and p[s][t] > q[t])[:top]
            for part in (sorted(pairs), terms):
                out += [(lang, s, kind, item.decode(), -v, k) for k, (v, item, kind) in enumerate(part, 1)]
    return sorted(out)


@pytest.mark.parametrize("entries", [15, 400_000])
def test_divergence_equals_brute_force(spark, entries):
    r = random.Random(1)
    words = [f"w{chr(97 + k % 26)}{chr(97 + k // 26)}" for k in range(80)] + ["Über", "ÜBER", "ß"]
    rows = [(i, r.choice(["hot"] * 5 + ["b", "c", "", None]), r.choice(["en", "en", "de", None]), 0, " ".join(r.choice(words[: r.choice([5, 30, 83])]) + r.choice([" ", "1", "-"]) for _ in range(r.randrange(40)))) for i in range(300)]
    rows += [(900 + i, s, "few", 0, f"once{chr(97 + i)}") for i, s in enumerate("abc")]
    got = divergence.audit(frame(spark, rows).repartition(5), entries=entries)
    assert sorted(tuple(x) for x in got.collect()) == audited(rows)


def test_divergence_of_odd_rows(spark):
    got = divergence.audit(frame(spark, ODD * 6).repartition(4))
    assert sorted(tuple(x) for x in got.collect()) == audited(ODD * 6)
    assert divergence.audit(frame(spark, ODD).limit(0)).count() == 0
    assert {(x.part, x.value) for x in divergence.audit(frame(spark, ODD[3:6])).collect()} <= {("pair", 0)}


def test_shares_stay_exact_beyond_64_bits(spark):
    cases = [(0, 1), (7, 9), (10**12, 10**13 + 7), (8 * 10**15 - 2, 8 * 10**15)]
    out = spark.createDataFrame(cases, "n long, d long").select("n", "d", divergence.share(F.col("n"), F.col("d")).alias("p")).collect()
    assert all(x.p == 1 + 10**9 * (x.n + 2) // x.d for x in out)


def test_a_long_run_of_sources_is_summed_by_source(spark):
    rows = [(i, f"s{i % 300:03}", "en", 0, "hot word") for i in range(30_000)]
    kept = divergence.kept_terms(frame(spark, rows).repartition(30), entries=50)
    got = {(x.term, x.source): (x.n, x.n_lang) for x in kept.collect()}
    assert got == {(t, f"s{k:03}"): (100, 30_000) for t in ("hot", "word") for k in range(300)}


# ---- packing


def laid_out(histogram, width):
    """Checks that every id of every piece lies in one place, and that sequences have no gaps; (sequences, ids)."""
    rows = packing.places(histogram, width)
    lengths = np.repeat(list(histogram), list(histogram.values()))
    ranks = np.concatenate([np.arange(c) for c in histogram.values()])
    piece, start, size, sequence, offset = packing.Places(rows).find(lengths, ranks)
    assert np.array_equal(np.bincount(piece, weights=size), lengths) and (size > 0).all()
    for key, at in ((piece, start), (sequence, offset)):
        order = np.lexsort((at, key))
        k, a, n = key[order], at[order], size[order]
        new = np.r_[True, k[1:] != k[:-1]]
        assert (a[new] == 0).all() and (a[1:][~new[1:]] == (a + n)[:-1][~new[1:]]).all()
    assert (offset + size).max() <= width and np.array_equal(np.unique(sequence), np.arange(sequence.max() + 1))
    return int(sequence.max()) + 1, int(lengths.sum())


@pytest.mark.parametrize("histogram", [{1: 1}, {2048: 7}, {5: 100_000}, {1100: 1000}, {1025: 1001, 1: 3}, {2000: 7000, 100: 5}, {700: 1, 1500: 1}])
def test_packs_of_few_lengths(histogram):
    n, ids = laid_out(histogram, 2048)
    assert n * 2048 <= 1.01 * ids + 2048


def test_packs_of_many_lengths():
    r = random.Random(5)
    for width in (8, 64, 2048):
        for _ in range(4):
            n, ids = laid_out({k: r.randrange(1, 40) for k in r.sample(range(1, width + 1), r.randrange(1, min(width, 900)))}, width)
            assert n * width <= 1.01 * ids + 2 * width


def test_patterns_of_a_huge_histogram_are_few():
    rows = packing.places({k: 10**9 + k for k in range(1, 2049)}, 2048)
    assert len(rows) < 200_000
    assert sum(x[2] * x[4] for x in rows.tolist()) == sum(k * (10**9 + k) for k in range(1, 2049))


def test_word_encoder_equals_the_plain_tokenizer():
    from tokenizers import Tokenizer

    tok, enc, r = Tokenizer.from_file(tokenizer_path("word_bpe_49k.json")), word_ids.WordEncoder(tokenizer_path("word_bpe_49k.json"), words=200), random.Random(1)
    parts = [*"abAB  \n\t .,'s!-0129éÉßœŒΣςσİıµ́ 　中文\x1c\x85ªº’ñ#😀ﬁẞÅ", "<|endoftext|>", "<|ENDOFTEXT|>", "'s", "can't", "ΣΑΣ", "é", "İI", "...", "ab.)", "x" * 50, "\r\n"]
    for _ in range(300):
        texts = ["".join(r.choice(parts) for _ in range(r.randrange(25))) for _ in range(10)]
        assert [x.tolist() for x in enc.encode(texts)] == [tok.encode(t, add_special_tokens=False).ids for t in texts]


def test_packed_documents_hold_each_id_once(spark):
    from tokenizers import Tokenizer

    tok, r = Tokenizer.from_file(tokenizer_path("word_bpe_49k.json")), random.Random(9)
    rows = [(100 + i, "s", "en", 0, " ".join(r.choice(["some", "Words", "and", "longerwords", "x."]) for _ in range(r.randrange(200)))) for i in range(150)]
    want = sorted((i or -1, [*tok.encode(t or "", add_special_tokens=False).ids, 1]) for i, _, _, _, t in rows + ODD)
    pieces = packing.pack_documents(frame(spark, rows + ODD).repartition(4), width=64, with_ids=True, shard_ids=900).collect()
    sequences: dict[int, list] = {}
    for p in pieces:
        assert p.ids_crc32 == zlib.crc32(np.array(p.ids, "<u4").tobytes()) and len(p.ids) == p.length > 0
        sequences.setdefault(p.sequence_id, []).append((p.offset, p.length))
    assert sorted(sequences) == list(range(len(sequences)))
    for own in sequences.values():
        assert sorted(own)[0][0] == 0 and all(a + n == b for (a, n), (b, _) in pairwise(sorted(own))) and sum(n for _, n in own) <= 64
    assert 64 * len(sequences) < 1.02 * sum(len(x) for _, x in want)
    # documents whose id is there once, piece by piece
    once = {i for i, n in Counter(i for i, _ in want).items() if n == 1}
    joined: dict[int, list] = {}
    for p in sorted(pieces, key=lambda p: p.start):
        if p.doc_id in once:
            assert p.start == len(joined.setdefault(p.doc_id, []))
            joined[p.doc_id] += p.ids
    assert joined == {i: x for i, x in want if i in once}
    assert sum(p.length for p in pieces if p.doc_id not in once) == sum(len(x) for i, x in want if i not in once)
    built = packing.sequences(packing.pack_documents(frame(spark, rows), width=64, with_ids=True)).collect()
    assert all(0 < len(x.ids) <= 64 and x.starts[0] == 0 for x in built)
    assert packing.digest(frame(spark, rows).limit(0)).count() == 0


# ---- Merkle manifest


def h(text):
    return hashlib.sha256(text.encode()).hexdigest()


def proved(rows):
    field = lambda v: "-" if v is None else f"{len(str(v).encode())}:{v}"
    leaf = lambda r, t: h("".join(map(field, (*r[:4], t))))

    def tree(nodes):
        ways, at = [[] for _ in nodes], list(range(len(nodes)))
        while len(nodes) > 1:
            for k, way in enumerate(ways):
                first = at[k] - at[k] % 3
                way.append((at[k] - first, [x for i, x in enumerate(nodes[first : first + 3], first) if i != at[k]]))
                at[k] //= 3
            nodes = [h("".join(nodes[k : k + 3])) for k in range(0, len(nodes), 3)]
        return nodes[0], ways

    by_source = {s: sorted(((r, leaf(r, r[4])) for r in rows if r[1] == s), key=lambda x: (x[0][0] is not None, x[0][0] or 0, x[1])) for s in {r[1] for r in rows}}
    names = sorted(by_source, key=lambda s: (s is not None, (s or "").encode()))
    trees = [tree([x for _, x in by_source[s]]) for s in names]
    root, tops = tree([t[0] for t in trees])
    out = []
    for s, (subroot, ways), top in zip(names, trees, tops, strict=True):
        for (r, own), way in zip(by_source[s], ways, strict=True):
            bad = r[0] is not None and zlib.crc32(str(r[0]).encode()) % 2 == 0 and r[4] is not None
            now = leaf(r, r[4].replace("\n", "")) if bad else own
            for k, others in way + top:
                now = h("".join([*others[:k], now, *others[k:]]))
            out.append((r[0], own, subroot, root, h("".join(x for _, others in way + top for x in others)), now, now == root))
    return sorted(out, key=str)


def test_merkle_manifest_equals_brute_force(spark):
    r = random.Random(4)
    rows = [(r.randrange(10**6), r.choice(["hot"] * 4 + ["b", "", None, *(f"s{k}" for k in range(9))]), "en", i, f"text {i}\nmore" if i % 3 else f"plain {i}") for i in range(700)]
    docs = frame(spark, rows).repartition(6)
    want = proved(rows)
    assert sorted((tuple(x) for x in merkle.digest(docs).collect()), key=str) == want
    for levels in (1, 2):  # a superstep for each level, and for two
        got = merkle.verify(merkle.proofs(docs, merkle.leaf_digest(), levels)).collect()
        assert sorted((x.doc_id, x.leaf, x.proof_sha256) for x in got) == sorted((x[0], x[1], x[4]) for x in want)
        assert all(x.verified and x.root == want[0][3] for x in got)


def test_merkle_manifest_of_odd_rows(spark):
    assert sorted((tuple(x) for x in merkle.digest(frame(spark, ODD)).collect()), key=str) == proved(ODD)
    assert sorted((tuple(x) for x in merkle.digest(frame(spark, ODD[:1])).collect()), key=str) == proved(ODD[:1])
    empty = merkle.digest(frame(spark, ODD).limit(0))
    assert empty.count() == 0 and empty.columns == merkle.digest(frame(spark, ODD[:1])).columns


# ---- decontamination over many blocks


def test_five_blocks_share_one_index_a_shard(monkeypatch):
    from lexiscope.llm import decontaminate

    r = random.Random(6)
    word = lambda: f"w{r.randrange(60)}"
    items = [(str(i), " ".join(word() for _ in range(r.choice([0, 2, 5, 30])))) for i in range(40)]
    texts = [" ".join(word() for _ in range(r.randrange(60))) + " " + r.choice(items)[1] for _ in range(80)] + [None, ""]
    whole = decontaminate.scan_shard(texts, [decontaminate.Phrases(items, 4)])
    built = []
    real = decontaminate.FMIndex
    monkeypatch.setattr(decontaminate, "FMIndex", lambda *a: built.append(1) or real(*a))
    parts = decontaminate.scan_shard(texts, [decontaminate.Phrases(items[k::5], 4) for k in range(5)])
    assert parts == whole and len(built) == 1 and sum(bool(s) for _, s, _ in whole) > 20

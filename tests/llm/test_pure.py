"""Methods on their own: brute force, round trips, independent libraries."""

import random
import tarfile
import zlib
from itertools import combinations

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from lexiscope.llm import chat, decontaminate, label_model, licenses, media, near_dup, pieces, quality, token_ids, toxicity


@given(st.text(alphabet="<|\\imendstart_>\nax", max_size=40))
def test_chat_escape_is_reversible(t):
    e = chat.escape(t)
    assert "<|" not in e and chat.unescape(e) == t
    assert chat.unescape_role(chat.escape_role(t)) == t and "\n" not in chat.escape_role(t)


@settings(deadline=None)
@given(st.lists(st.integers(0, 3), max_size=60))
def test_suffix_array(x):
    s = np.array(x, np.int64)
    if len(s):
        assert decontaminate.suffix_array(s).tolist() == sorted(range(len(s)), key=lambda i: x[i:])


def brute_hits(words, items, width=10):
    hit, found = set(), set()
    for item, text in items:
        for p in decontaminate.phrases_of(decontaminate.words_of(text), width):
            for i in range(len(words) - len(p) + 1):
                if tuple(words[i : i + len(p)]) == p:
                    hit.update(range(i, i + len(p)))
                    found.add(item)
    return hit, found


@pytest.mark.parametrize("seed", range(6))
def test_fm_index_scan_equals_brute_force(seed):
    r = random.Random(seed)
    word = lambda: r.choice(["a", "b", "c", "é", "zz"])
    items = [(str(i), " ".join(word() for _ in range(r.choice([0, 1, 2, 4, 12])))) for i in range(6)]
    texts = [" ".join(word() for _ in range(r.randrange(80))) for _ in range(8)] + [None, "", "A-B c"]
    texts += texts[:3]
    got = decontaminate.scan_shard(texts, [decontaminate.Phrases(items, 4)])
    for t, (n, spans, own) in zip(texts, got, strict=True):
        words = decontaminate.words_of(t)
        hit, found = brute_hits(words, items, 4)
        assert n == len(words) and own == found
        assert {i for a, b in spans for i in range(a, b)} == hit


def test_sketch_sets_and_exact_components():
    r = random.Random(1)
    hashes = near_dup._WordHashes()
    base = [f"w{i}" for i in range(60)]
    texts = []
    for _ in range(40):
        t = list(base)
        for _ in range(r.randrange(4)):
            t[r.randrange(60)] = f"x{r.randrange(9)}"
        texts.append(" ".join(t))
    sets = [near_dup.shingles(t, hashes) for t in texts]
    plain = [{tuple(t.split()[i : i + 3]) for i in range(58)} for t in texts]
    assert [len(s) for s in sets] == [len(p) for p in plain]
    parent = list(range(40))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i, j in combinations(range(40), 2):
        both = len(plain[i] & plain[j])
        if 100 * both >= 85 * (len(plain[i]) + len(plain[j]) - both):
            a, b = sorted((find(i), find(j)))
            parent[b] = a
    assert near_dup.exact_components(sets, 85).tolist() == [find(i) for i in range(40)]
    assert len(near_dup.shingles("One TWO", hashes)) == 1 and len(near_dup.shingles(" \t", hashes)) == len(near_dup.shingles(None, hashes)) == 0


def all_cuts(p, word):
    if not word:
        return [(0.0, ())]
    out = []
    for n in range(1, len(word) + 1):
        s = p.score.get(word[:n], p.unknown if n == 1 else None)
        if s is not None:
            out += [(s + t, (n, *c)) for t, c in all_cuts(p, word[n:])]
    return out


@pytest.fixture(scope="module")
def vocabulary():
    return pieces.Pieces(pieces.model_path())


@pytest.mark.parametrize("text", ["hello", "  a", "the▁x", "é\nb", "thanedble,", "\U0001f600!"])
def test_nbest_equals_enumeration(vocabulary, text):
    want = sorted((s for s, _ in all_cuts(vocabulary, pieces._marked(text))), reverse=True)[:5]
    assert [s for s, _ in vocabulary.nbest(text, 5)] == pytest.approx(want)
    best = vocabulary.encode([text])[0]
    assert best.score == pytest.approx(want[0]) and (len(want) < 2 or best.gap == pytest.approx(want[0] - want[1]))
    several = vocabulary.nbest(text, 5)
    assert all(vocabulary.decode(np.array(ids, np.int32)) == text for _, ids in several) and len({tuple(ids) for _, ids in several}) == len(several)


@pytest.mark.parametrize("seed", range(20))
def test_nbest_of_several_words_equals_enumeration(vocabulary, seed):
    r = random.Random(seed)
    text = "".join(r.choice([" ", "\n", "the", "a", "n", "e", "é", ",", "\U0001f600", "▁"]) for _ in range(r.randrange(1, 9)))
    cuts = sorted((s for s, _ in all_cuts(vocabulary, pieces._marked(text))), reverse=True)
    for n in (2, 4, 7):
        assert [s for s, _ in vocabulary.nbest(text, n)] == pytest.approx(cuts[:n])


def test_words_side_by_side_equal_words_one_by_one(vocabulary):
    r = random.Random(1)
    words = list({"".join(r.choice("abcdeé.,1ß中▁\U0001f600") for _ in range(r.randrange(0, 60))).replace("▁", pieces.LITERAL) for _ in range(2000)})
    words += ["\n", "\nab", "  x", " "]
    flat, sizes = vocabulary._learn_all(words)
    for w, row in zip(words, np.split(flat, np.cumsum(sizes)[:-1]), strict=True):
        one = vocabulary._learn(w)
        assert row[4:].tolist() == one[4:]
        assert row[:4].view(np.float64) == pytest.approx(np.array(one[:4], np.int32).view(np.float64))


@pytest.mark.parametrize("text", ["a" * 50_000, "ACGT" * 10_000, "=" * 30_000 + " end"], ids=["a", "ACGT", "="])
def test_long_runs_in_bounded_memory(vocabulary, text):
    import tracemalloc

    tracemalloc.start()
    got = vocabulary.encode([text], 4)[0]
    _, peak = tracemalloc.get_traced_memory()
    tracemalloc.stop()
    assert vocabulary.decode_all([got.ids, *(x for _, x in got.others)]) == [text] * 4
    assert [c for c, _ in got.others] == sorted(c for c, _ in got.others) and got.others[0][0] == pytest.approx(got.gap)
    assert peak < 400 * len(text) + 10_000_000


def test_a_run_of_a_megabyte(vocabulary):
    got = vocabulary.encode(["a" * 1_000_000], 2)[0]
    assert vocabulary.decode(got.ids) == "a" * 1_000_000 and len(got.others) == 1


@settings(deadline=None, max_examples=60)
@given(st.text(alphabet=st.characters(exclude_categories=["Cs"]), max_size=60))
def test_pieces_round_trip(t):
    p = pieces.shared_pieces(pieces.model_path())
    assert p.decode(p.encode([t])[0].ids) == t


@pytest.fixture(scope="module")
def plain_tokenizer():
    from tokenizers import Tokenizer

    return Tokenizer.from_file(token_ids.tokenizer_path())


ODD_ALPHABET = [*" \n\tab.,'1é<!#\r\x1c\x85\u2003ß中²ª", "'s", "<|endoftext|>", "\n\n", "  "]


@settings(deadline=None, max_examples=300)
@given(st.lists(st.sampled_from(ODD_ALPHABET), max_size=40).map("".join))
def test_word_tables_equal_a_fresh_tokenizer(plain_tokenizer, t):
    e = token_ids.shared_encoder(token_ids.tokenizer_path())
    assert np.frombuffer(e.encode([t])[0], e.type).tolist() == plain_tokenizer.encode(t, add_special_tokens=False).ids


def test_added_tokens_in_texts_are_tokens(plain_tokenizer):
    e = token_ids.shared_encoder(token_ids.tokenizer_path())
    texts = ["a <|endoftext|> b", "<|endoftext|>", "a x<|endoftext|>y  z\n<|endoftext|><|endoftext|>", "a <|endoftext| > b", "<|end oftext|>", ""]
    for t, got in zip(texts, e.encode(texts), strict=True):
        assert np.frombuffer(got, e.type).tolist() == plain_tokenizer.encode(t, add_special_tokens=False).ids
    assert e.ids("<|endoftext|>") == [50256]


def test_table_with_few_words_gives_the_same(plain_tokenizer):
    r = random.Random(2)
    texts = [" ".join("".join(r.choice("abcé.1") for _ in range(r.randrange(1, 6))) for _ in range(60)) for _ in range(40)]
    e = token_ids.Encoder(token_ids.tokenizer_path(), words=50)
    for at in range(0, 40, 4):
        got = e.encode(texts[at : at + 4])
        assert [np.frombuffer(g, e.type).tolist() for g in got] == [plain_tokenizer.encode(t, add_special_tokens=False).ids for t in texts[at : at + 4]]


def test_index_finds_keys_that_it_does_not_hold(tmp_path):
    keys = np.sort(np.concatenate([np.random.default_rng(1).integers(-(2**62), 2**62, 3000), [77, 77, 77]]))
    ends = np.cumsum(np.arange(len(keys) + 2) % 5 + 1)  # two documents without a key come first
    ids = np.arange(ends[-1]) % 60_000
    (tmp_path / "s.idx").write_bytes(index := token_ids.build_index(keys, ends))
    (tmp_path / "s.key").write_bytes(keys.astype("<i8").tobytes())
    (tmp_path / "s.bin").write_bytes(token_ids.HEAD + (2).to_bytes(8, "little") + ids.astype("<u2").tobytes())
    assert all(int(k).to_bytes(8, "little", signed=True) not in index for k in keys[abs(keys) > 2**32])
    s = token_ids.Shard(str(tmp_path / "s"), str(tmp_path))
    first, n = s.documents(np.unique(keys))
    assert sum(n) == len(keys) and s.n_docs == len(keys) + 2
    begins = np.concatenate([[0], ends[:-1]])
    for k, a, m in zip(np.unique(keys).tolist(), first.tolist(), n.tolist(), strict=True):
        assert s.find(k) == (a, m)
        assert [x.tolist() for x in s.get(k)] == [ids[begins[d] : ends[d]].tolist() for d in range(a, a + m)]
    assert len(s.get(77)) == 3 and s.find(78) == (0, 0) and s.get(78) == []


@given(st.sets(st.integers(-(2**63), 2**63 - 1), max_size=300))
def test_perfect_hash_is_minimal(keys):
    k = np.array(sorted(keys), np.int64)
    assert sorted(token_ids.PerfectHash.build(k)(k).tolist()) == list(range(len(k)))


@given(st.binary(max_size=400))
def test_png_round_trip(data):
    p = media.padded(data)
    assert len(p) % 64 == 0 and p and p.startswith(data)
    png = media.encode_png(p)
    assert media.decode_png(png) == p and media.read_head(png[: media.HEAD_BYTES]) == (64, len(p) // 64, 8)


def test_shard_is_a_tar(tmp_path):
    w = media.ShardWriter(str(tmp_path))
    first, again = w.put("aa", b"x" * 700), w.put("aa", b"x" * 700)
    second = w.put("bb", b"y")
    w.close()
    assert first == again == (512, 700) and second[0] % 512 == 0
    with tarfile.open(w.path) as t:
        assert [(m.name, m.size) for m in t] == [("aa.png", 700), ("bb.png", 1)] and t.extractfile("bb.png").read() == b"y"


@given(st.lists(st.integers(0, 9), max_size=12))
def test_longest_increasing(x):
    got = licenses.longest_increasing(x)
    assert all(x[a] < x[b] for a, b in zip(got, got[1:]))
    best = max((len(c) for n in range(len(x) + 1) for c in combinations(x, n) if all(a < b for a, b in zip(c, c[1:]))), default=0)
    assert len(got) == best


def test_license_scan():
    s = licenses.Scanner(licenses.NOTICES, 0.8)
    text = "Code. Licensed under the Apache License, Version 2.0. More words.\n" + "x " * 50 + "Released under the MIT License."
    assert [r[0] for r in s.scan(text)] == ["Apache-2.0", "MIT"]
    assert s.scan(None) == s.scan("") == s.scan("the the of of under license") == []
    noisy = licenses.NOTICES["MIT-text"].replace("free", "at no cost")
    assert s.scan(noisy)[0][0] == "MIT-text" and s.scan(noisy)[0][1] < 1


def test_license_scan_finds_each_of_many_notices():
    s = licenses.Scanner(licenses.NOTICES, 0.8)
    cc, mit = licenses.NOTICES["CC-BY-4.0"], licenses.NOTICES["MIT"]
    for n in (1, 2, 3, 5, 20):
        assert s.scan(" ".join([cc] * n)) == [("CC-BY-4.0", 1.0, 6 * k, 6 * k + 6) for k in range(n)]
    text = f"the code is {mit} and the docs are {mit} by the authors"
    assert s.scan(text) == [("MIT", 1.0, 3, 8), ("MIT", 1.0, 12, 17)]
    # neither is exact, and what lies between repeats their words
    text = "the code is released under mit license and the docs are released under our mit license by the authors"
    assert s.scan(text) == [("MIT", 0.8, 3, 7), ("MIT", 0.8, 11, 16)]
    long = licenses.NOTICES["MIT-text"].replace("free", "at no cost")
    assert [r[0] for r in s.scan(f"{long} the {long} to any {long}")] == ["MIT-text"] * 3


def test_licenses_need_the_words_that_tell_them_apart():
    s = licenses.Scanner(licenses.NOTICES, 0.8)
    of = lambda t: [r[0] for r in s.scan(t)]
    assert of("released under the terms of the gnu general public license either version 2 of the license") == ["GPL-2.0-terms"]
    assert of("released under the license") == of("licensed under the apache license version 1 1") == []
    assert of("licensed under cc by nc 4 0") == ["CC-BY-NC-4.0"] and of("licensed under cc by 4 0") == ["CC-BY-4.0"]
    for name in ("MIT-text", "BSD-2-Clause-text", "BSD-3-Clause-text", "GPL-2.0-header", "GPL-3.0-header", "LGPL-2.1-header", "MPL-2.0"):
        assert of("some code " + licenses.NOTICES[name] + " and more") == [name]
    assert licenses.Scanner({}, 0.8).scan("released under the mit license") == []
    more = licenses.read_notices({"Own-1": "You may, and must, keep this line and all lines below it."})
    assert [r[0] for r in licenses.Scanner(more, 0.8).scan("and you may and must keep this line and all lines below")] == ["Own-1"]


@pytest.mark.parametrize("seed", range(40))
def test_license_scan_equals_a_scan_of_all_stretches(seed):
    r = random.Random(seed)
    notices = {"A": "one TWO three four five", "B": "two three TWO six one seven eight", "C": "four four one"}
    s = licenses.Scanner(notices, 0.8)
    words = []
    for _ in range(r.randrange(1, 4)):
        own = notices[r.choice("ABC")].lower().split()
        if r.random() < 0.5:
            own[r.randrange(len(own))] = r.choice(["x", "one", "two"])
        words += [r.choice(["x", "y", "one", "four"]) for _ in range(r.randrange(4))] + own
    text = " ".join(words)

    def covers(name, a, b):
        notice = licenses.words_of(notices[name])
        pairs = licenses.align(licenses.words_of(text)[a:b], notice)
        return len(pairs) >= 0.8 * len(notice) and s.needed[name] <= {j for _, j in pairs}

    found = s.scan(text)
    assert all(covers(n, a, b) for n, _, a, b in found)  # nothing that isn't there
    for name, notice in notices.items():  # nothing left out: what qualifies meets a found one
        for a in range(len(words)):
            for b in range(a + 1, min(len(words), a + 2 * len(notice.split())) + 1):
                if covers(name, a, b):
                    assert any(x < b and a < y for _, _, x, y in found), (name, a, b)


def test_label_model_finds_accuracies_and_copies():
    r = np.random.default_rng(0)
    y = r.random(4000) < 0.3
    accuracy = [0.9, 0.8, 0.7, 0.85]
    votes = np.stack([np.where(r.random(4000) < a, y, ~y) * 2 - 1 for a in accuracy], axis=1)
    votes = np.concatenate([votes, votes[:, 2:3], votes[:, 2:3]], axis=1)  # one voter three times
    p, w = np.unique(votes, axis=0, return_counts=True)
    m = label_model.fit(p, w.astype(float), 0.3)
    assert np.abs(m.accuracy[[0, 1, 3]] - np.array([0.9, 0.8, 0.85])).max() < 0.06
    assert m.share[[2, 4, 5]].max() < 0.5 < m.share[0]


def test_toxicity_learns_beginnings_and_ignores_copies():
    r = random.Random(0)
    word = lambda: "".join(r.choice("abcdefg") for _ in range(5))
    rows = []
    for i in range(600):
        t = [word() for _ in range(40)]
        if i % 6 == 0:
            t[r.randrange(40)] = "zork" + word()
        rows.append((" ".join(t), int(i % 6 == 0)))
    rows += [("unlucky phrase " + rows[0][0] + f" {i}", 1) for i in range(60)]  # near copies of a toxic text
    m = toxicity.fit(rows)
    assert m.score("well zorkling then") >= 0.7 > m.score("an unlucky phrase") and m.score("") < 0.5 and m.score(None) < 0.5
    for rows in ([], [("well then", 0)], [("all bad", 1), ("worse", 1)]):  # labels of one kind or none
        m = toxicity.fit(rows)
        assert m.score("you idiot") > 0.5 > m.score("hello") and m.score("some scum there") > 0.5


def test_quality_measures():
    of = lambda t: dict(zip(quality.MEASURES, quality.measures(t, *quality.counted(t)), strict=True))
    assert of(None)["n_words"] == 0 and of("a a a b")["runs"] == 0.5 and of("x | y |")["bars"] == 0.5
    assert of("WE SHOUT LOUD")["capitals"] > 0.9 and of("a% b& c")["odd_tokens"] == pytest.approx(2 / 3)


def test_crc_of_ids():
    assert zlib.crc32(np.array([1, 2], "<u4").tobytes()) == zlib.crc32(b"\1\0\0\0\2\0\0\0")

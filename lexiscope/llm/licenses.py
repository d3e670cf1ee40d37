"""License scans by patience alignment.

A text is held against each notice of a small list. Words that are unique in both are anchors; the
longest increasing subsequence of their places is kept, and the stretches between kept anchors (and
their ends, word by word) are aligned again in the same way. Coverage is the share of the notice's
words that are aligned, and the words that tell a notice from the others (written in capitals in the
list, digits of a version too) have to be among them. Each window that may hold a notice is aligned by itself, so a text may hold
several notices, or one of them many times, in a row or with words of it between them. Of a notice of
LONG words and more, windows are chained from words that it has once: their places in text and notice
lie about as far apart all over a copy, so hits are parted by that distance, the longest increasing
subsequence of each part is a chain, and a chain is aligned once. The work grows with the text and the
notice then, not with the windows that both have.

Before that, a bound: coverage can't exceed the share of a notice's words that the text has at all, and
a notice without one of its needed words isn't there.

Defined cases: null and empty texts hold no notice; an empty list of notices finds none; of notices with the same coverage the first in
the list is named. Extra columns are carried along; the new columns replace their namesakes.
"""

from __future__ import annotations

from bisect import bisect_left
from collections import Counter
from collections.abc import Iterator
from math import ceil

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

_BSD_START = (
    "redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions "
    "are met redistributions of source code must retain the above copyright notice this list of conditions and the following disclaimer "
    "redistributions in binary form must reproduce the above copyright notice this list of conditions and the following disclaimer in the "
    "documentation and or other materials provided with the distribution"
)
_BSD_END = (
    "this software is provided by the copyright holders and contributors as is and any express or implied warranties including but not "
    "limited to the implied warranties of merchantability and fitness for a particular purpose are disclaimed in no event shall the "
    "copyright holder or contributors be liable for any direct indirect incidental special exemplary or consequential damages including "
    "but not limited to procurement of substitute goods or services loss of use data or profits or business interruption however caused "
    "and on any theory of liability whether in contract strict liability or tort including negligence or otherwise arising in any way "
    "out of the use of this software even if advised of the possibility of such damage"
)
_GNU = "this program is free software you can redistribute it and or modify it under the terms of the"
_GNU_END = "as published by the free software foundation either VERSION"
_LATER = "of the license or at your option any later version"
#: Public notices by SPDX name, short forms, headers and whole short licences. Words in capitals must be
#: aligned; the others may be missing as far as coverage allows. Longer texts come by read_notices().
NOTICES = {
    "Apache-2.0": "licensed under the APACHE license version 2 0",
    "Apache-2.0-header": (
        "licensed under the APACHE license version 2 0 the license you may not use this file except in compliance with the license you "
        "may obtain a copy of the license at"
    ),
    "Apache-2.0-header-end": (
        "unless required by applicable law or agreed to in writing software distributed under the license is distributed on an as is "
        "basis without warranties or conditions of any kind either express or implied see the license for the specific language "
        "governing permissions and limitations under the license"
    ),
    "MIT": "released under the MIT license",
    "MIT-text": (
        "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files "
        "the software to deal in the software without restriction including without limitation the rights to use copy modify merge "
        "publish distribute sublicense and or sell copies of the software and to permit persons to whom the software is furnished to do "
        "so subject to the following conditions the above copyright notice and this permission notice shall be included in all copies "
        "or substantial portions of the software the software is provided as is without warranty of any kind express or implied "
        "including but not limited to the warranties of merchantability fitness for a particular purpose and noninfringement in no "
        "event shall the authors or copyright holders be liable for any claim damages or other liability whether in an action of "
        "contract tort or otherwise arising from out of or in connection with the software or the use or other dealings in the software"
    ),
    "MIT-opening": (
        "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files "
        "the software to deal in the software without restriction"
    ),
    "ISC-text": (
        "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted provided "
        "that the above copyright notice and this permission notice appear in all copies"
    ),
    "BSD-opening": (
        "REDISTRIBUTION and use in source and binary forms with or without modification are permitted provided that the following conditions are met"
    ),
    "BSD-2-Clause-text": f"{_BSD_START} {_BSD_END}",
    "BSD-3-Clause-text": (
        f"{_BSD_START} NEITHER the name of the copyright holder nor the names of its contributors may be used to ENDORSE or promote "
        f"products derived from this software without specific prior written permission {_BSD_END}"
    ),
    "BSD-2-Clause": "licensed under the BSD 2 CLAUSE license",
    "BSD-3-Clause": "licensed under the BSD 3 CLAUSE license",
    "GPL": "under the terms of the GNU GENERAL PUBLIC license",
    "GPL-2.0": "this work is licensed under the GNU GENERAL PUBLIC license version 2",
    "GPL-2.0-terms": "under the terms of the GNU GENERAL PUBLIC license either VERSION 2 of the license",
    "GPL-2.0-header": f"{_GNU} GNU GENERAL PUBLIC license {_GNU_END} 2 {_LATER}",
    "GPL-3.0": "this work is licensed under the GNU GENERAL PUBLIC license version 3",
    "GPL-3.0-terms": "under the terms of the GNU GENERAL PUBLIC license either VERSION 3 of the license",
    "GPL-3.0-header": f"{_GNU} GNU GENERAL PUBLIC license {_GNU_END} 3 {_LATER}",
    "LGPL": "under the terms of the GNU LESSER GENERAL PUBLIC license",
    "LGPL-2.1-header": f"{_GNU} GNU LESSER GENERAL PUBLIC license {_GNU_END} 2 1 {_LATER}",
    "LGPL-3.0-header": f"{_GNU} GNU LESSER GENERAL PUBLIC license {_GNU_END} 3 {_LATER}",
    "AGPL": "under the terms of the GNU AFFERO GENERAL PUBLIC license",
    "MPL-2.0": (
        "this source code form is subject to the terms of the MOZILLA PUBLIC license v 2 0 if a copy of the mpl was not distributed with "
        "this file you can obtain one at"
    ),
    "CC-BY-4.0": "licensed under CC BY 4 0",
    "CC-BY-SA-4.0": "licensed under CC BY SA 4 0",
    "CC-BY-NC-4.0": "licensed under CC BY NC 4 0",
    "CC-BY-ND-4.0": "licensed under CC BY ND 4 0",
    "CC-BY-long": "licensed under the CREATIVE COMMONS attribution 4 0 international license",
    "CC0-1.0": "released under CC0 1 0 universal public domain dedication",
}
COVERAGE = 0.8
#: Words from which on a notice's copies are chained; of shorter ones every window is tried.
LONG = 100
_WORDS = bytes(c + 32 if 65 <= c <= 90 else c if 48 <= c <= 57 or 97 <= c <= 122 or c >= 128 else 32 for c in range(256))


def words_of(text: str | None) -> list[bytes]:
    return (text or "").encode("utf-8", "surrogatepass").translate(_WORDS).split()


def _needed(words: list[str], k: int) -> bool:
    """Whether the k-th word of a notice must be aligned: it is in capitals, or a digit of the version of a notice that has such words."""
    return words[k].isupper() or (words[k].isdigit() and any(w.isupper() for w in words))


def longest_increasing(values: list[int]) -> list[int]:
    """Indices of a longest strictly increasing subsequence (patience piles with links back)."""
    tops: list[int] = []
    at: list[int] = []
    back = [-1] * len(values)
    for i, v in enumerate(values):
        k = bisect_left(tops, v)
        if k:
            back[i] = at[k - 1]
        tops[k : k + 1] = [v]
        at[k : k + 1] = [i]
    out = []
    i = at[-1] if at else -1
    while i >= 0:
        out.append(i)
        i = back[i]
    return out[::-1]


def align(a: list[bytes], b: list[bytes]) -> list[tuple[int, int]]:
    """Pairs of places of equal words in a and b, increasing in both."""
    out: list[tuple[int, int]] = []
    todo = [(0, len(a), 0, len(b))]
    while todo:
        a0, a1, b0, b1 = todo.pop()
        while a0 < a1 and b0 < b1 and a[a0] == b[b0]:
            out.append((a0, b0))
            a0, b0 = a0 + 1, b0 + 1
        while a0 < a1 and b0 < b1 and a[a1 - 1] == b[b1 - 1]:
            a1, b1 = a1 - 1, b1 - 1
            out.append((a1, b1))
        if a0 == a1 or b0 == b1:
            continue
        in_a, in_b = Counter(a[a0:a1]), Counter(b[b0:b1])
        where = {w: i for i, w in enumerate(b[b0:b1], b0) if in_b[w] == 1 and in_a.get(w) == 1}
        anchors = [(i, where[w]) for i, w in enumerate(a[a0:a1], a0) if w in where]
        kept = [anchors[k] for k in longest_increasing([j for _, j in anchors])]
        if not kept:
            continue
        out.extend(kept)
        ends = [(a0 - 1, b0 - 1), *kept, (a1, b1)]
        todo.extend((x + 1, y, u + 1, v) for (x, u), (y, v) in zip(ends, ends[1:], strict=False))
    return sorted(out)


def _whole(found: list[tuple[int, int, int]]) -> list[tuple[int, int, int]]:
    """The distinct alignments (size, start, end) that don't hold two others one after the other."""
    found = sorted(set(found), key=lambda x: (x[1], x[2]))
    starts = [a for _, a, _ in found]
    ends = [b for _, _, b in found]
    for i in range(len(ends) - 2, -1, -1):
        ends[i] = min(ends[i], ends[i + 1])  # the first end of those that start here or later
    out = []
    for n, a, b in found:
        k = bisect_left(starts, ends[bisect_left(starts, a)])
        if k == len(ends) or ends[k] > b:
            out.append((n, a, b))
    return out


def read_notices(files: dict[str, str]) -> dict[str, str]:
    """Notices from whole licence texts by name, to add to NOTICES (texts, not paths: they may lie in any store); nothing in them is needed word for word."""
    return {name: b" ".join(words_of(text)).decode() for name, text in files.items()}


class Scanner:
    def __init__(self, notices: dict[str, str], coverage: float):
        self.notices = {n: words_of(t) for n, t in notices.items()}
        self.coverage = coverage
        self.needed = {n: frozenset(k for k, w in enumerate(words_of(t)) if _needed(t.split(), k)) for n, t in notices.items()}
        self.keys = {n: frozenset(self.notices[n][k] for k in own) for n, own in self.needed.items()}
        self.bags = {n: Counter(w) for n, w in self.notices.items()}
        self.vocabulary = frozenset().union(*self.notices.values()) if notices else frozenset()

    def scan(self, text: str | None) -> list[tuple[str, float, int, int]]:
        """(notice, coverage, first word, end) of each place that holds a notice; where several overlap, the longest alignment."""
        words = words_of(text)
        there = self.vocabulary.intersection(words)
        found: list[tuple[int, int, int, int, str, int]] = []
        for order, (name, notice) in enumerate(self.notices.items()):
            bag = self.bags[name]
            if not notice or not self.keys[name] <= there or sum(c for w, c in bag.items() if w in there) < self.coverage * len(notice):
                continue
            found.extend((-n, order, b - a, a, name, b) for n, a, b in self._places(words, notice, bag, self.needed[name]))
        out: list[tuple[str, float, int, int]] = []
        starts: list[int] = []
        for n, _, _, a, name, b in sorted(found):
            k = bisect_left(starts, a)
            if (k == 0 or out[k - 1][3] <= a) and (k == len(out) or b <= out[k][2]):
                starts.insert(k, a)
                out.insert(k, (name, -n / len(self.notices[name]), a, b))
        return out

    def _places(self, words: list[bytes], notice: list[bytes], bag: Counter, needed: frozenset[int]) -> list[tuple[int, int, int]]:
        """(aligned words, first word, end) of each alignment that covers the notice.

        Exact copies come first. Elsewhere each window that may be one is aligned by itself, as words
        around it would take its anchors; a window that holds two of them apart isn't one. A stretch
        in which no window covers the notice is aligned as a whole.
        """
        size, need = len(notice), self.coverage * len(notice)
        exact = []
        at = -size
        for i, w in enumerate(words):
            if i >= at + size and w == notice[0] and words[i : i + size] == notice:
                exact.append((size, i, i + size))
                at = i
        ends = [(0, 0, 0), *exact, (0, len(words), 0)]
        out = list(exact)
        for (_, _, lo), (_, hi, _) in zip(ends, ends[1:], strict=False):
            if hi - lo < need:
                continue
            part = words[lo:hi]
            if size >= LONG and (once := self.once(notice)):
                own = _whole([x for a, b in self._chains(part, size, once) for x in self._aligned(part, notice, a, b, needed)])
                out.extend((n, lo + a, lo + b) for n, a, b in own)
                continue
            own = _whole([x for a, b in self._windows(part, notice, bag) for x in self._aligned(part, notice, a, b, needed)])
            rest = []
            for a, b in self._stretches(part, notice, bag):
                if all(y <= a or x >= b for _, x, y in own):
                    rest.extend(self._aligned(part, notice, a, b, needed))
            own += rest
            out.extend((n, lo + a, lo + b) for n, a, b in own)
        return out

    def _aligned(self, words: list[bytes], notice: list[bytes], start: int, stop: int, needed: frozenset[int]) -> list[tuple[int, int, int]]:
        pairs = align(words[start:stop], notice)
        if not pairs or len(pairs) < self.coverage * len(notice) or not needed.issubset(j for _, j in pairs):
            return []
        return [(len(pairs), start + pairs[0][0], start + pairs[-1][0] + 1)]

    @staticmethod
    def once(notice: list[bytes]) -> dict[bytes, int]:
        """Places of the words that a notice has once."""
        counts = Counter(notice)
        return {w: k for k, w in enumerate(notice) if counts[w] == 1}

    def _chains(self, words: list[bytes], size: int, once: dict[bytes, int]) -> Iterator[tuple[int, int]]:
        """Windows around chains of words that the notice has once, with room for what it has before and after them."""
        hits = sorted((t - once[w], t, once[w]) for t, w in enumerate(words) if w in once)
        least = max(1, int(self.coverage * len(once) / 2))
        cuts = [k for k, (x, y) in enumerate(zip(hits, hits[1:], strict=False), 1) if y[0] - x[0] > size // 8]
        todo = [hits[a:b] for a, b in zip([0, *cuts], [*cuts, len(hits)], strict=True)]
        while todo:
            part = todo.pop()
            if len(part) < least:
                continue
            if part[-1][0] - part[0][0] > size // 2:  # of two copies: parted at the widest gap, the one nearest to the middle
                _, _, k = max((part[k][0] - part[k - 1][0], -abs(2 * k - len(part)), k) for k in range(1, len(part)))
                todo += [part[:k], part[k:]]
                continue
            own = sorted((t, n) for _, t, n in part)
            kept = [own[k] for k in longest_increasing([n for _, n in own])]
            if len(kept) >= least:
                (t0, before), (t1, n1) = kept[0], kept[-1]
                after = size - n1
                yield max(0, t0 - before - before // 4 - 2), min(len(words), t1 + after + after // 4 + 2)

    def _windows(self, words: list[bytes], notice: list[bytes], bag: Counter) -> Iterator[tuple[int, int]]:
        """Windows of twice the notice's length at most with enough of its words, from one that may be aligned first to one that may be last."""
        places = [i for i, w in enumerate(words) if w in bag]
        need, reach = self.coverage * len(notice), 2 * len(notice)
        spare = len(notice) - ceil(need) + 1
        first, last = frozenset(notice[:spare]), frozenset(notice[-spare:])
        least = max(1, ceil(need))
        for k, p in enumerate(places):
            if words[p] not in first or k + least > len(places) or places[k + least - 1] - p >= reach:
                continue
            held: Counter = Counter()
            both = 0
            for q in places[k:]:
                if q - p >= reach:
                    break
                w = words[q]
                held[w] += 1
                both += held[w] <= bag[w]
                if both >= need and w in last:
                    yield p, q + 1

    def _stretches(self, words: list[bytes], notice: list[bytes], bag: Counter) -> Iterator[tuple[int, int]]:
        """Stretches with enough words of the notice: around its words, twice its length at most, joined where they meet."""
        places = [i for i, w in enumerate(words) if w in bag]
        need, reach = self.coverage * len(notice), 2 * len(notice)
        k = 0
        last = None
        for j, p in enumerate(places):
            while p - places[k] >= reach:
                k += 1
            if j - k + 1 >= need:
                held = Counter(words[i] for i in places[k : j + 1])
                if sum(min(c, bag[w]) for w, c in held.items()) >= need:
                    if last and places[k] < last[1]:
                        if p + 1 - last[0] <= 2 * reach:
                            last = (last[0], p + 1)
                            continue
                    if last:
                        yield last
                    last = (places[k], p + 1)
        if last:
            yield last


LICENSES = "array<struct<license:string,coverage:double,start:long,stop:long>>"


def _scan(notices: dict[str, str], coverage: float, schema: pa.Schema):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        s = Scanner(notices, coverage)
        for batch in batches:
            rows = [[dict(zip(("license", "coverage", "start", "stop"), r, strict=True)) for r in s.scan(t.as_py())] for t in batch["text"]]
            columns = {n: batch[n] for n in batch.schema.names} | {"licenses": pa.array(rows, schema.field("licenses").type)}
            yield from pa.table({n: columns[n] for n in schema.names}).cast(schema).to_batches()

    return run


def scan_licenses(docs: DataFrame, notices: dict[str, str] | None = None, coverage: float = COVERAGE) -> DataFrame:
    """docs with licenses: notice, coverage and place (in words) of each notice, in order."""
    from pyspark.sql.pandas.types import to_arrow_schema

    rest = docs.drop("licenses")
    out = rest.withColumn("licenses", F.array().cast(LICENSES)).schema
    return rest.mapInArrow(_scan(NOTICES if notices is None else notices, coverage, to_arrow_schema(out)), out)


def digest(docs: DataFrame) -> DataFrame:
    d = scan_licenses(docs.select("doc_id", "text"))
    names = F.transform("licenses", lambda x: x["license"])
    return d.select(
        "doc_id", F.size("licenses").cast("long").alias("n_notices"),
        F.array_join(F.array_sort(F.array_distinct(names)), ",").alias("licenses"),
        F.coalesce(F.array_max(F.transform("licenses", lambda x: x["coverage"])), F.lit(0.0)).alias("best_coverage"),
        F.array_join(F.transform("licenses", lambda x: F.concat_ws("-", x["start"], x["stop"])), ",").alias("spans"),
    )

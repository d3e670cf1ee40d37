"""Values of op2, op3, op6 and op9 on the given tables and on odd rows; line dedup and media with clashing columns."""

import hashlib
import os
import struct
import tarfile
import zlib

import pytest
from pyspark.sql import functions as F

from lexiscope.llm import licenses, line_dedup, media, pieces, quality, queries, toxicity

TABLES = "/root/testdata/sf0.01"
MIT = "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the \"Software\"), to deal in the Software without restriction"
ROWS = [
    (1, None), (2, ""), (3, "released under the MIT license"), (3, "released under the MIT license"), (4, f"x y. {MIT} {MIT}"), (None, "plain words stand here"),
    (5, "idiot " * 40), (5, "idiot " * 40), (6, "word " * 50_000), (7, "é" * 64), (8, "a" * 64), (9, "a" * 65),
]


@pytest.fixture(scope="module")
def docs(spark):
    own = spark.createDataFrame(ROWS, "doc_id long, text string").repartition(3)
    for name in ("licenses", "score", "ids", "n_lines", "good", "predicted", "held_out", "quality"):  # names that operators make themselves
        own = own.withColumn(name, F.lit("clash"))
    return own


def tables(spark):
    if not os.path.isdir(TABLES):
        pytest.skip("no tables")
    return TABLES


def media_row(text):
    data = (text or "").encode()
    payload = data + bytes(-len(data) % 64 or (0 if data else 64))
    return len(data), len(payload), hashlib.sha256(payload).hexdigest(), zlib.crc32(payload[-64:])


def test_media_of_all_documents(spark, docs):
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{tables(spark)}/documents.parquet").collect()}
    got = queries.op2_media_columns(spark, TABLES).collect()
    assert {r.doc_id: (r.n_bytes, r.payload_bytes, r.payload_sha256, r.tail_crc32) for r in got} == {i: media_row(t) for i, t in texts.items()}
    odd = media.digest(docs).collect()
    key = lambda x: str(x)
    assert sorted(((r.doc_id, r.n_bytes, r.payload_bytes, r.payload_sha256, r.tail_crc32) for r in odd), key=key) == sorted(((i, *media_row(t)) for i, t in ROWS), key=key)
    by_payload = {}
    for r in odd + got:
        by_payload.setdefault(r.payload_sha256, set()).add((r.media_bytes, r.media_sha256, r.feature))
    assert all(len(x) == 1 for x in by_payload.values())


def test_media_files_are_what_the_rows_say(spark, tmp_path):
    """Any tar reader finds PNG files whose samples are the padded texts."""
    rows, folder = media.store_texts(spark.createDataFrame(ROWS, "doc_id long, text string"), folder=str(tmp_path / "m"))
    found = {}
    for p in (tmp_path / "m").rglob("*"):
        if p.is_file() and tarfile.is_tarfile(p):
            with tarfile.open(p) as t:
                for m in t.getmembers():
                    data = t.extractfile(m).read()
                    at, raw = 8, b""
                    assert data[:8] == b"\x89PNG\r\n\x1a\n"
                    while at < len(data):
                        n, kind = struct.unpack(">I4s", data[at : at + 8])
                        body = data[at + 8 : at + 8 + n]
                        assert struct.unpack(">I", data[at + 8 + n : at + 12 + n])[0] == zlib.crc32(kind + body)
                        raw += body if kind == b"IDAT" else b""
                        at += 12 + n
                    lines = zlib.decompress(raw)
                    assert all(lines[k] == 0 for k in range(0, len(lines), 65))
                    found[hashlib.sha256(data).hexdigest()] = hashlib.sha256(b"".join(lines[k + 1 : k + 65] for k in range(0, len(lines), 65))).hexdigest()
    digest = next(c for c in rows.columns if c in ("digest", "media_sha256"))
    assert {r[digest] for r in rows.collect()} == set(found) and {x[2] for x in (media_row(t) for _, t in ROWS)} == set(found.values())


def test_licences_of_odd_rows(docs):
    got = {}
    for r in licenses.digest(docs).collect():
        got.setdefault(r.doc_id, set()).add((r.n_notices, r.licenses, r.best_coverage, r.spans))
    assert all(len(x) == 1 for x in got.values())  # equal rows, equal values
    first = {i: next(iter(x)) for i, x in got.items()}
    none = (0, "", 0.0, "")
    assert [first[i] for i in (1, 2, None, 5, 6, 7)] == [none] * 6
    assert first[3] == (1, "MIT", 1.0, "0-5") and first[4][:2] == (2, "MIT-opening")
    # a tie in coverage goes to the notice that is named first
    scanner = licenses.Scanner({"B": "one two ALPHA", "A": "one two ALPHA"}, 0.8)
    assert [x[0] for x in scanner.scan("x one two alpha y")] == ["B"]


def test_long_notices_are_found_in_time_that_grows_with_them():
    import random
    import time

    r = random.Random(3)
    for n in (300, 1000, 5600):
        notice = [f"w{min(2999, int(r.paretovariate(0.7)))}" if r.random() < 0.6 else f"w{r.randrange(3000)}" for _ in range(n)]
        scanner = licenses.Scanner(licenses.read_notices({"X": " ".join(notice)}), 0.8)
        copy = [w if k % 50 else "changed" for k, w in enumerate(notice)]
        noise = [f"w{r.randrange(3000)}" for _ in range(400)]
        began = time.time()
        found = scanner.scan(" ".join(noise + copy + copy + noise))
        assert time.time() - began < 2 and len(found) == 2
        assert all(abs(a - (400 + k * n)) <= 2 and abs(b - (400 + (k + 1) * n)) <= 2 and c > 0.97 for k, (_, c, a, b) in enumerate(found))


def test_toxicity_of_all_documents(spark, docs):
    labels = {r.doc_id: r.toxic for r in spark.read.parquet(f"{tables(spark)}/labels.parquet").collect()}
    got = queries.op6_toxicity(spark, TABLES).collect()
    assert len(got) == spark.read.parquet(f"{TABLES}/documents.parquet").count()
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1) and r.predicted == (r.score >= 0.7) and 0 <= r.score <= 1 for r in got)
    held = [(labels[r.doc_id], r.predicted) for r in got if r.held_out and labels.get(r.doc_id) is not None]
    assert sum(y for y, p in held if p) >= 0.7 * sum(y for y, _ in held) and sum(p for y, p in held if not y) <= 0.02 * len(held)
    own = spark.createDataFrame([(5, 1), (6, 0), (3, 0), (4, 0), (99, None)], "doc_id long, toxic int")
    odd = {}
    for r in toxicity.digest(docs, own).collect():
        odd.setdefault(r.doc_id, set()).add((r.score, r.predicted))
    assert all(len(x) == 1 for x in odd.values()) and odd[1] == odd[2]  # null as empty
    assert next(iter(odd[5]))[1] == 1 and next(iter(odd[None]))[1] == 0


def test_quality_of_all_documents(spark, docs):
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{tables(spark)}/labels.parquet").collect()}
    out = queries.op9_quality(spark, TABLES)
    good = next(c for c in out.columns if c in ("good", "keep", "kept", "predicted"))
    got = [(labels[r.doc_id], int(r[good])) for r in out.collect() if labels.get(r.doc_id) is not None]
    assert sum(p for y, p in got if y) >= 0.98 * sum(y for y, _ in got) and sum(p for y, p in got if not y) <= 0.2 * sum(1 - y for y, _ in got)
    odd = {}
    for r in quality.digest(docs).collect():
        odd.setdefault(r.doc_id, set()).add(tuple(r))
    assert all(len(x) == 1 for x in odd.values()) and next(iter(odd[1]))[1:] == next(iter(odd[2]))[1:]


def test_clashing_columns_are_replaced(docs):
    lines = line_dedup.dedup_lines(docs)
    assert lines.columns.count("n_lines") == 1 and {r.n_lines for r in lines.collect()} == {1}
    scored = quality.score_documents(docs)
    assert len(scored.columns) == len(set(scored.columns)) and "licenses" in scored.columns
    ids = pieces.encode_documents(docs.select("doc_id", "text", "ids", "score"))
    assert ids.columns.count("ids") == 1 and ids.columns.count("score") == 1 and ids.where("doc_id = 7").first().ids != "clash"

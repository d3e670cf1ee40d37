import json

import pytest
from pyspark.sql import functions as F

from lexiscope import schemas
from lexiscope.sources import fetch as fetching
from lexiscope.sources import files, harvest, papers_api, sinks
from lexiscope.sources.papers_api import PagedPapers, SearchedPapers
from lexiscope.streaming.weekly import weekly_counts

CALLS: list = []
PAGE = "<r><record><header><identifier>oai:x:2401.00001</identifier></header><metadata><arXiv><id>2401.00001</id><created>2024-01-02</created><title>A  b</title><abstract>t</abstract><categories>cs.CL</categories><authors><author><keyname>L</keyname><forenames>F</forenames></author></authors></arXiv></metadata></record>{}</r>"


def fetch(name, token, first=None, last=None):
    if token is None:
        return PAGE.format("<resumptionToken>t2</resumptionToken>"), 200, 0
    return PAGE.format("<resumptionToken></resumptionToken>"), 200, 0


def test_jsonl_and_class_files(spark, tmp_path):
    (tmp_path / "p.jsonl").write_text('{"id": "http://x/1", "title": "a"}\n\nnot json\n')
    assert [r.id for r in files.read_jsonl(spark, str(tmp_path / "p.jsonl")).collect()] == ["http://x/1"]
    assert files.read_jsonl(spark, str(tmp_path / "none.jsonl"), strict=True).count() == 0
    (tmp_path / "g").mkdir()
    (tmp_path / "g/0.txt").write_text("Gan\n\nHa\n")
    assert {tuple(r) for r in files.read_class_files(spark, str(tmp_path / "g")).collect()} == {("Gan", 0), ("Ha", 0)}


def test_html_cache(spark, tmp_path):
    (tmp_path / "1.json").write_text(json.dumps(indent=2, obj={"_complete": False, "Intro": {"text": "t", "cleaned_text": "c", "detected": ["Gan"]}}))
    r = files.read_html_cache(spark, str(tmp_path)).first()
    assert (r.safe_id, r.complete, r.sections[0].title, r.sections[0].detected) == ("1", False, "Intro", ["Gan"])


def test_oai(spark, tmp_path):
    (tmp_path / "a.xml").write_text(PAGE.format(""))
    r = files.read_oai(spark, str(tmp_path)).first()
    assert (r.id, r.title, r.authors, r.categories) == ("https://arxiv.org/abs/2401.00001", "A b", ["F L"], ["cs.CL"])
    assert harvest.harvested(files.read_oai(spark, str(tmp_path)), "2024-01-08", 7).count() == 1


def test_paged_source_follows_tokens():
    reader = PagedPapers({"sets": "cs", "client": "tests.test_sources:fetch"}).reader(None)
    assert [p[1] for p in reader.read(reader.partitions()[0])] == [0, 1]


def test_weeks(spark, tmp_path):
    df = spark.createDataFrame([(1,)], "a int")
    files.write_week(df, str(tmp_path / "t"), "20240101_to_20240108")
    files.write_week(df, str(tmp_path / "t"), "20240108_to_20240115")
    assert files.available_weeks(spark, str(tmp_path / "t")) == ["20240101_to_20240108", "20240108_to_20240115"]


def test_weekly_stream_plan(spark, tmp_path):
    spark.sql("SELECT timestamp '2024-01-03' AS ts, 'a' AS language").write.parquet(str(tmp_path / "e"))
    stream = spark.readStream.schema("ts timestamp, language string").parquet(str(tmp_path / "e"))
    assert weekly_counts(stream).isStreaming
    assert str(weekly_counts(spark.read.parquet(str(tmp_path / "e"))).first().week_start) == "2024-01-01"


ENTRY = "<entry><id>http://x/abs/{0}</id><title>T {0}</title><summary>S</summary><published>2024-01-0{0}T00:00:00Z</published><updated>u</updated><author><name>A B</name></author><category term='cs.CL'/><link href='http://x/pdf/{0}' title='pdf'/></entry>"


def search(query, first, rows):
    return "<feed>" + "".join(ENTRY.format(k) for k in range(first + 1, min(first + rows, 5) + 1)) + "</feed>", 200, 0


def failing(*_):
    return "", 404, None


def test_search_pages_cap_and_entries(spark, tmp_path):
    reader = SearchedPapers({"query": "q", "client": "tests.test_sources:search", "pageSize": "2", "maxResults": "4"}).reader(None)
    pages = list(reader.read(reader.partitions()[0]))
    assert [p for p, _ in pages] == [0, 1] and [len(papers_api.ENTRY.findall(x)) for _, x in pages] == [2, 2]
    all_ = SearchedPapers({"query": "q", "client": "tests.test_sources:search", "pageSize": "2", "maxResults": "100"}).reader(None)
    assert len(list(all_.read(all_.partitions()[0]))) == 3
    for p, x in pages:
        (tmp_path / f"{p}.xml").write_text(x)
    rows = harvest.read_search(spark, str(tmp_path))
    assert {(r.id, r.title, r.pdf_url) for r in rows.collect()} == {(f"http://x/abs/{k}", f"T {k}", f"http://x/pdf/{k}") for k in range(1, 5)}
    best, over = harvest.capped(rows, 3)
    assert over and [r.id[-1] for r in best.collect()] == ["4", "3", "2"] and not harvest.capped(rows, 4)[1]


def test_attempts_grow_and_end_in_an_error():
    waits, answers = [], [("", 503, None), ("", 429, 5), (OSError("down"), 0, None), ("", 503, None), ("ok", 200, None)]

    def page():
        x = answers.pop(0)
        if isinstance(x[0], OSError):
            raise x[0]
        return x

    assert papers_api.with_attempts(page, 10_000, waits.append) == "ok" and waits == [300, 5, 60, 1200]
    with pytest.raises(papers_api.FetchError):
        papers_api.with_attempts(lambda: ("", 503, 0), 1, waits.append)
    waits.clear()
    with pytest.raises(papers_api.FetchError):
        papers_api.with_attempts(lambda: ("", 404, None), 1, waits.append)
    assert not waits


def test_harvest_is_used_where_the_search_fails_or_is_empty(spark, tmp_path):
    rows = lambda *ids: spark.createDataFrame([(i,) for i in ids], "id string")
    broken = lambda: rows("a").selectExpr("raise_error(id) AS id")
    of = lambda s, name: {(r.id, r._fetch_source) for r in harvest.with_fallback(spark, s, lambda: rows("o"), str(tmp_path / name)).collect()}
    assert of(lambda: rows("a"), "1") == {("a", "search_api")}
    assert of(broken, "2") == of(lambda: rows(), "3") == {("o", "oai_pmh")}


def test_harvest_keeps_the_first_of_an_id_and_the_windows_months(spark):
    rows = [("http://x/abs/2401.00001", "b", "2024-01-03", 2), ("http://x/abs/2401.00001", "a", "2024-01-03", 1), ("http://x/abs/2311.00002", "old", "2024-01-03", 3), ("cs/0101001", "plain", "2024-01-02", 4), ("y", "late", "2024-01-08", 5), ("z", "bad", "?", 6)]
    d = spark.createDataFrame(rows, "id string, title string, created string, place int")
    assert {r.title for r in harvest.harvested(d, "2024-01-08", 7, F.col("place")).collect()} == {"a", "plain"}


class Clock:
    def __init__(self, *times):
        self.times = list(times)

    def __call__(self):
        return self.times.pop(0)


def cut_off():
    yield b"abc"
    raise OSError("gone")


def test_pages_are_cut_by_size_time_and_errors():
    assert fetching.read_page([b"abc", b"def"], most=4) == (b"abcd", True)
    assert fetching.read_page([b"abc", b"def"], most=100) == (b"abcdef", True)
    assert fetching.read_page([b"abc", b"def"], most=100, seconds=1, clock=Clock(0, 5)) == (b"abc", False)
    assert fetching.read_page(cut_off()) == (b"abc", False)
    with pytest.raises(fetching.TooLarge):
        fetching.read_file([b"abc", b"def"], most=5)
    with pytest.raises(TimeoutError):
        fetching.read_file([b"abc"], seconds=1, clock=Clock(0, 2))
    waits, left = [], [OSError("1"), OSError("2"), None]

    def third():
        if (e := left.pop(0)) is not None:
            raise e
        return b"x"

    assert fetching.with_tries(third, sleep=waits.append) == (b"x", None) and waits == [15, 30]
    data, error = fetching.with_tries(lambda: (_ for _ in ()).throw(OSError("no")), sleep=waits.append)
    assert data is None and "no" in error and waits == [15, 30, 15, 30, 60]


def web(url):
    if url.endswith("2"):
        raise OSError("no such page")
    return [url.encode()]


def test_landing_tables(spark):
    d = spark.createDataFrame([("1", "http://x/abs/1"), ("2", "http://x/abs/2")], "safe_id string, url string")
    got = {r.safe_id: r for r in fetching.fetch_pages(d, "tests.test_sources:web").collect()}
    assert bytes(got["1"].body) == b"http://x/html/1" and got["1"].complete and got["2"].body is None and "no such page" in got["2"].error
    files_ = fetching.fetch_files(d, "tests.test_sources:web", tries=2, pause=0)
    assert [r.safe_id for r in fetching.not_landed(d, files_).collect()] == ["2"]


def test_caches_are_upserted_by_key(spark, tmp_path):
    folder = str(tmp_path / "html_cache")
    page = lambda i, t, html="<p>": (i, html, True, [(t, "x")])
    kinds = "safe_id string, html string, complete boolean, sections array<struct<title:string,text:string>>"
    sinks.write_html_cache(spark.createDataFrame([page(str(i), "old") for i in range(200)], kinds), folder)
    sinks.write_html_cache(spark.createDataFrame([page("7", "new"), page("7", "new"), page("x", "more", None)], kinds), folder)
    got = {r.safe_id: r for r in sinks.read_cache(spark, folder).collect()}
    assert len(got) == 201 and got["7"].sections[0].title == "new" and got["8"].sections[0].title == "old" and got["x"].unavailable and not got["7"].unavailable
    assert sinks.cached_ids(spark, folder, str(tmp_path / "none")).count() == 201
    assert [p.name for p in tmp_path.iterdir()] == ["html_cache"]


def test_manifest_twice_weeks_and_publishing(spark, tmp_path):
    from lexiscope.operators import dashboard

    root = str(tmp_path / "root")
    papers = spark.createDataFrame([("1",), ("2",)], "id string")
    m = dashboard.empty_manifest(papers, papers.limit(1)).withColumn("week_end", F.lit("2024-01-08"))
    sinks.write_manifest(m, root, "20240108_to_20240115")
    sinks.write_manifest(m, root, "20240101_to_20240108")
    weeks = dashboard.all_weeks(spark, root).collect()
    assert [(w.week_start, w.papers, w.flagged_papers, w.language_counts) for w in weeks] == [("2024-01-01", 2, 1, []), ("2024-01-08", 2, 1, [])]
    assert json.loads(sinks.read_text(spark, f"{root}/manifest_last_7_days.json"))["counts"]["papers"] == 2
    names = spark.createDataFrame([("Gan", 0), ("Ha", 1)], "language string, class_id int")
    sinks.write_language_data(names, spark.createDataFrame([("the",)], "language_lc string"), spark.createDataFrame([("Ha", "short")], "language string, flag_reason string"), f"{root}/language_data.json")
    data = files.read_language_data(spark, f"{root}/language_data.json").first()
    assert data.lang_classes == {"0": ["Gan"], "1": ["Ha"]} and data.languages_to_ignore == ["the"]
    (tmp_path / "root/weeks/20240101_to_20240108/html_cache").mkdir()
    done = sinks.publish(spark, root, str(tmp_path / "web"), ("language_data.json", "none.json"))
    assert "language_data.json" in done and "weeks/20240101_to_20240108/manifest.json" in done and not any("html_cache" in d or "none" in d for d in done)
    assert (tmp_path / "web/weeks/20240108_to_20240115/manifest.json").exists()
    site = dashboard.site_data(spark, root, spark.createDataFrame([], "id string, languages array<struct<language:string>>, sources_checked array<string>, sections array<struct<name:string,source:string,detected_languages:array<struct<language:string,class:int,needs_review:boolean,flag_reason:string>>>>"), spark.createDataFrame([], schemas.DETECTED), papers, "none")
    assert site["manifest"].first().counts.papers == 2 and site["language_data"].first().languages_to_ignore == ["the"] and site["top_languages"].count() == 0


def test_sections_come_from_records_where_the_manifest_lacks_them(spark):
    from lexiscope.operators import dashboard

    one = "struct<language:string,class:int,needs_review:boolean,flag_reason:string>"
    flagged = spark.createDataFrame([("http://x/1", None), ("http://x/2", [("own", "html", [])]), ("http://x/3", [])], f"id string, sections array<struct<name:string,source:string,detected_languages:array<{one}>>>")
    known = spark.createDataFrame([("https://x/1", {"b": (None, None), "a": ("pdf", [("Gan", 0, False, None)])}), ("https://x/2", {"z": ("pdf", [])})], f"paper_id string, sections map<string,struct<source:string,detected_languages:array<{one}>>>")
    known = known.withColumn("paper", F.lit(None).cast("struct<id:string>"))
    got = {r.id[-1]: [(s.name, s.source, len(s.detected_languages)) for s in r.sections] for r in dashboard.with_sections(flagged, known).collect()}
    assert got == {"1": [("a", "pdf", 1), ("b", "", 0)], "2": [("own", "html", 0)], "3": []}


def paged_folder(path, pages=5):
    """Two sets with pages of records, some of which repeat ids, as files by token."""
    one = "<record><header><identifier>oai:x:{0}</identifier></header><metadata><m xmlns='urn:x'><id>{0}</id><created>{1}</created><title>{2}</title><abstract>a</abstract><categories>cs.CL x</categories><authors><author><keyname>L</keyname><forenames>F</forenames></author></authors></m></metadata></record>"
    rows = []
    for name in ("a", "b"):
        for page in range(pages):
            (path / f"set={name}" / f"page={page}").mkdir(parents=True)
            own = [(f"2401.{(page * 3 + k) % 11:05}", f"2024-01-{1 + (page + 2 * k) % 9:02}", f"{name} {page} {k}") for k in range(4)]
            rows += [(name, page, k + 1, *x) for k, x in enumerate(own)]
            token = f"<resumptionToken>{page + 1}</resumptionToken>" if page + 1 < pages else "<resumptionToken/>"
            deleted = "<record><header status='deleted'><identifier>oai:x:gone</identifier></header></record>"
            (path / f"set={name}" / f"page={page}" / "x.txt").write_text("<r>" + deleted + "".join(one.format(*x) for x in own) + token + "</r>")
    return rows


def logged_client(folder, name, token, first=None, last=None):
    """folder_client that writes down what it is asked."""
    with open(f"{folder}/calls", "a") as f:
        f.write(f"{name} {token} {first} {last}\n")
    return papers_api.folder_client(folder, name, token)


def test_a_window_reaches_the_requests(spark, tmp_path):
    rows = paged_folder(tmp_path)
    out = harvest.harvest_records(spark, "a,b", "tests.test_sources:logged_client", "2024-01-08", 5, folder=str(tmp_path))
    firsts = {}
    for name, page, place, own, created, title in rows:
        if "2024-01-03" <= created < "2024-01-08":
            firsts.setdefault(own, (name, page, place, title))
    assert {r.id.rpartition("/")[2]: (r.set, r.page, r.place, r.title) for r in out.collect()} == firsts
    calls = (tmp_path / "calls").read_text().split("\n")[:-1]
    assert len(calls) == 10 and all(x.endswith(" 2024-01-01 2024-01-09") for x in calls)
    r = out.first()
    assert r.authors == ["F L"] and r.categories == ["cs.CL", "x"]


def test_a_stream_of_pages_starts_again_behind_the_last_one(spark, tmp_path):
    rows = paged_folder(tmp_path / "pages")
    stream = lambda: harvest.first_records(harvest.stream_records(spark, "a,b", "tests.test_sources:logged_client", folder=str(tmp_path / "pages")))

    calls = lambda: (tmp_path / "pages/calls").read_text().split("\n")[:-1] if (tmp_path / "pages/calls").exists() else []

    def run(done):
        q = stream().writeStream.outputMode("update").foreachBatch(lambda df, _: df.write.mode("append").parquet(str(tmp_path / "out"))).option("checkpointLocation", str(tmp_path / "cp")).start()
        try:
            for _ in range(200):
                if done(q):
                    break
                q.awaitTermination(0.2)
        finally:
            q.stop()

    run(lambda q: len(calls()) >= 4)
    assert len(calls()) < 10
    run(lambda q: q.lastProgress and str(q.lastProgress.sources[0].endOffset).count("null") == 2)
    calls = calls()
    assert {x.rsplit(" ", 2)[0] for x in calls} == {f"{n} {t}" for n in "ab" for t in ("None", "1", "2", "3", "4")}
    last = {}
    for r in spark.read.parquet(str(tmp_path / "out")).collect():
        own = (r.set, r.page, r.place, r.title)
        last[r.id] = min(last.get(r.id, own), own)
    firsts = {}
    for name, page, place, own, _, title in rows:
        firsts.setdefault(f"https://arxiv.org/abs/{own}", (name, page, place, title))
    assert last == {k: v for k, v in firsts.items()}


def test_offsets_are_tokens_and_ask_for_no_page_twice(tmp_path):
    paged_folder(tmp_path)
    reader = papers_api.HarvestedRecords({"sets": "a,b", "client": "tests.test_sources:logged_client", "folder": str(tmp_path)}).simpleStreamReader(None)
    at, got = reader.initialOffset(), []
    for _ in range(5):
        rows, at = reader.read(at)
        got += list(rows)
    assert len(got) == 40 and json.loads(at["sets"]) == {"a": None, "b": None}
    calls = (tmp_path / "calls").read_text().split("\n")[:-1]
    assert len(calls) == len(set(calls)) == 10
    assert list(reader.read(at)[0]) == [] and reader.read(at)[1] == at
    again = papers_api.HarvestedRecords({"sets": "a,b", "client": "tests.test_sources:logged_client", "folder": str(tmp_path)}).simpleStreamReader(None)
    assert list(again.readBetweenOffsets(reader.initialOffset(), at)) == got

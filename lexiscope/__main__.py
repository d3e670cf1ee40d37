"""python -m lexiscope ROOT FIRST LAST --lists language_data.json [--papers PATTERN] [--days N] [--again | --retry]"""

from __future__ import annotations

import argparse
import json
from datetime import date, timedelta

from lexiscope.plans import job
from lexiscope.session import build_session


def main(args: list[str] | None = None) -> None:
    p = argparse.ArgumentParser(prog="lexiscope", description="Screens weeks of papers and writes their manifests.")
    p.add_argument("root")
    p.add_argument("first", type=date.fromisoformat)
    p.add_argument("last", type=date.fromisoformat)
    p.add_argument("--lists", required=True, help="the reference lists as one JSON file")
    p.add_argument("--papers", help="JSON lines of papers, the newest file that fits; else those stored below the root")
    p.add_argument("--days", type=int, default=7)
    p.add_argument("--query", default="")
    p.add_argument("--again", action="store_true", help="repeat weeks on what is stored")
    p.add_argument("--retry", action="store_true", help="screen papers again that lack something")
    a = p.parse_args(args)
    spark = build_session()
    lists = job.read_lists(spark, a.lists)
    if a.retry:
        weeks = [a.first + timedelta(k) for k in range(0, (a.last - a.first).days, a.days)]
        out = {job.slug(w, w + timedelta(a.days)): job.retry_week(spark, a.root, w, w + timedelta(a.days), lists) for w in weeks}
    else:
        stored = job.stored_papers(spark, a.papers) if a.papers else None
        out = job.run_weeks(spark, a.root, a.first, a.last, lists, (lambda *_: stored()) if stored else None, a.days, query=a.query, again=a.again)
    print(json.dumps(out))


if __name__ == "__main__":
    main()

"""Command line for the three entry points.

  python -m corpusflow.cli ingest --polls DIR --pages PATH --run-date YYYY-MM-DD --points P --counts C --embedder hashing
                                [--budget 512] [--counter words|bytes|chars|tokenizer:PATH] [--by-day] [--newest-first]
  python -m corpusflow.cli pages --points P --index I [--limit 300]
  python -m corpusflow.cli scroll --points P --index I --source S [--page 0] [--out DIR]
  python -m corpusflow.cli search --points P --embedder hashing [--k 5] [--out DIR] "query text" ...
  python -m corpusflow.cli dashboard --counts C --date YYYY-MM-DD [--source S] [--qa PATH [--scorer lengths]] [--out DIR]

``--by-day``: the landing folder is laid out as landing_date=/source=, and only the folders
of each source's request window are read. ``--newest-first``: answers of sources that ask for the
newest articles first are put in that order; without it every answer is taken as it landed. ``pages`` stores the index of all pages, ``scroll``
reads one. Results are whole: with ``--out`` every table is written there as parquet and its
row count printed, without it every row is printed. Models are named: ``hashing``
and ``lengths`` are stand-ins for an embedder and a pair scorer.
"""

from __future__ import annotations

import argparse
import json
import os

from .operators import chunk as ch
from .session import get_spark


def give(name: str, df, out: str | None) -> None:
    """Write a whole table and print its row count, or print all its rows."""
    if out:
        path = os.path.join(out, name)
        df.write.mode("overwrite").parquet(path)
        print(f"== {name}: {df.sparkSession.read.parquet(path).count()} rows in {path}")
        return
    print(f"== {name}")
    for row in df.toLocalIterator():
        print(json.dumps(row.asDict(), default=str, ensure_ascii=False))


def main(argv=None):
    ap = argparse.ArgumentParser(prog="corpusflow")
    ap.add_argument("--master", default=None)
    sub = ap.add_subparsers(dest="cmd", required=True)
    a = sub.add_parser("ingest")
    a.add_argument("--polls", required=True)
    a.add_argument("--guardian", default=None)
    a.add_argument("--pages", required=True)
    a.add_argument("--run-date", required=True)
    a.add_argument("--points", required=True)
    a.add_argument("--counts", required=True)
    a.add_argument("--embedder", required=True)
    a.add_argument("--budget", type=int, default=ch.DEFAULT_BUDGET, help="tokens of a chunk at most")
    a.add_argument("--counter", default=None, help="token counter by name; without it chunks are of words")
    a.add_argument("--by-day", action="store_true")
    a.add_argument("--newest-first", action="store_true")
    i = sub.add_parser("pages")
    i.add_argument("--points", required=True)
    i.add_argument("--index", required=True)
    i.add_argument("--limit", type=int, default=300)
    w = sub.add_parser("scroll")
    w.add_argument("--points", required=True)
    w.add_argument("--index", required=True)
    w.add_argument("--source", required=True)
    w.add_argument("--page", type=int, default=0)
    w.add_argument("--out", default=None)
    s = sub.add_parser("search")
    s.add_argument("--points", required=True)
    s.add_argument("--k", type=int, default=5)
    s.add_argument("--embedder", required=True)
    s.add_argument("--out", default=None)
    s.add_argument("texts", nargs="+")
    d = sub.add_parser("dashboard")
    d.add_argument("--counts", required=True)
    d.add_argument("--date", required=True)
    d.add_argument("--source", default=None)
    d.add_argument("--qa", default=None)
    d.add_argument("--scorer", default=None)
    d.add_argument("--out", default=None)
    args = ap.parse_args(argv)
    spark = get_spark(args.master)
    if args.cmd == "ingest":
        from .plans import ingest
        from .sources import envelopes, registry
        if args.by_day:
            raw = envelopes.read_polls_window(spark, args.polls, args.run_date, registry.DEFAULT_REQUEST["window_days"], windows=registry.request_windows())
        else:
            raw = envelopes.read_polls(spark, args.polls)
        g = envelopes.read_polls(spark, args.guardian, "guardian") if args.guardian else None
        ingest.run_ingest(spark, raw, spark.read.parquet(args.pages), args.run_date, args.points, args.counts,
                          args.embedder, guardian_raw=g, budget=args.budget, counter=ch.counter(args.counter) if args.counter else None, newest=registry.newest_first_labels() if args.newest_first else ())
    elif args.cmd == "pages":
        from .operators import vectors
        from .sources import sinks
        vectors.page_index(sinks.read_points(spark, args.points), limit=args.limit).write.mode("overwrite").parquet(args.index)
    elif args.cmd == "scroll":
        from .operators import vectors
        from .sources import sinks
        page = vectors.read_page(sinks.read_points(spark, args.points), spark.read.parquet(args.index), args.source, args.page)
        give("scroll", page, args.out)
    elif args.cmd == "search":
        from .plans import search
        give("search", search.search_texts(spark, args.points, args.texts, args.k, embedder=args.embedder), args.out)
    else:
        from .plans import monitor
        qa = spark.read.parquet(args.qa) if args.qa else None
        for name, df in monitor.views(spark, args.counts, args.date, args.source, qa=qa, scorer=args.scorer).items():
            give(name, df, args.out)


if __name__ == "__main__":
    main()

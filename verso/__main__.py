"""Command line for the three jobs; run with spark-submit or ``python -m verso``.

    python -m verso corpus (--documents D [--pages P] | --payloads P) --output OUT [--csv OUT_CSV]
                           [--per-artist N|all] [--target N|all] [--artists NAME ...]
    python -m verso train  --primary TABLE [--secondary TABLE] --models DIR [--text-only] [--hold-out]
                           [--format csv|parquet]
    python -m verso score  --model DIR --input PARQUET --output DIR --keep COL ... [--stream]

Tables are parquet folders; a path that ends in csv is read as CSV, unless --format says
which it is. The session comes from the environment (``spark-submit`` settings or
``SparkSession.builder.getOrCreate()`` defaults); nothing is hard-wired.
"""

from __future__ import annotations

import argparse
import json

from verso.operators.corpus import SONGS_PER_ARTIST, TARGET_SONGS


def _limit(value: str) -> int | None:
    return None if value == "all" else int(value)


def main(argv: list[str] | None = None) -> None:
    from pyspark.sql import SparkSession

    parser = argparse.ArgumentParser(prog="verso")
    sub = parser.add_subparsers(dest="command", required=True)
    c = sub.add_parser("corpus", help="build the corpus from documents (+ pages) or landed payloads")
    source = c.add_mutually_exclusive_group(required=True)
    source.add_argument("--documents")
    source.add_argument("--payloads", help="parquet with doc_id, popularity, payload (JSON)")
    c.add_argument("--pages")
    c.add_argument("--output", required=True)
    c.add_argument("--csv", help="also write the corpus as CSV here")
    c.add_argument("--per-artist", type=_limit, default=SONGS_PER_ARTIST, help="songs per artist, or 'all'")
    c.add_argument("--target", type=_limit, default=TARGET_SONGS, help="stop after the artist that reaches this, or 'all'")
    c.add_argument("--artists", nargs="+", help="only these artists, in this order")
    t = sub.add_parser("train", help="train, evaluate and save; then merge, tune and save")
    t.add_argument("--primary", required=True)
    t.add_argument("--secondary")
    t.add_argument("--models", required=True)
    t.add_argument("--format", choices=["csv", "parquet"], help="of the corpora; default: as their paths say")
    t.add_argument("--text-only", action="store_true", help="keep rows without a year")
    t.add_argument("--hold-out", action="store_true", help="measure the merged model by a second fit")
    s = sub.add_parser("score", help="score a parquet folder of texts")
    s.add_argument("--model", required=True)
    s.add_argument("--input", required=True)
    s.add_argument("--output", required=True)
    s.add_argument("--text-col", default="lyrics")
    s.add_argument("--keep", nargs="+", required=True, help="columns that identify a row")
    s.add_argument("--stream", action="store_true")
    s.add_argument("--max-files-per-trigger", type=int)
    args = parser.parse_args(argv)

    spark = SparkSession.builder.appName(f"verso-{args.command}").getOrCreate()
    from verso.plans import jobs

    if args.command == "corpus":
        from verso.operators.counts import RowCounts
        from verso.plans.corpus import corpus_records_from_documents
        from verso.sources.payload import corpus_records_from_payloads

        if args.documents:
            records = corpus_records_from_documents(spark.read.parquet(args.documents))
        else:
            records = corpus_records_from_payloads(spark.read.parquet(args.payloads))
        details = spark.read.parquet(args.pages) if args.pages else None
        counts = RowCounts()
        report = jobs.corpus_job(records, details, args.output, args.csv, counts, top_k=args.per_artist, target=args.target, artists=args.artists)
        for row in report.orderBy("artist_name").toLocalIterator():
            print(f"{row['artist_name']}\t{row['songs']}")
        print(json.dumps(counts.get()))
    elif args.command == "train":
        out = jobs.train_job(spark, args.primary, args.models, args.secondary, with_year=not args.text_only, hold_out=args.hold_out, fmt=args.format)
        summary = {"initial_model": out.initial_model_path, "initial_metrics": out.initial_metrics.first().asDict(),
                   "merged_model": out.merged_model_path, "merged_cv_f1": out.merged_cv_f1, "rows": out.counts}
        if out.merged_metrics is not None:
            summary["merged_metrics"] = out.merged_metrics.first().asDict()
        print(json.dumps(summary))
    else:
        jobs.score_job(spark, args.model, args.input, args.output, tuple(args.keep), args.text_col, args.stream,
                       max_files_per_trigger=args.max_files_per_trigger)


if __name__ == "__main__":
    main()

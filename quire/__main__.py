"""Command line: run one of the three programs on an input file.

    python -m quire articles  <article-lines file> [--vocab T1,T2,...]
    python -m quire postings  <posting-lines file> [--vocab T1,T2,...] [--expected N] [--spread S]
                              [--kernels K] [--eta E] [--max-iterations M] [--resume FOLDER]
    python -m quire timeuse   <survey csv> [--infer]

Under spark-submit the session comes from the submit configuration; with
`--local N` a local[N] session is started instead.
"""

from __future__ import annotations

import argparse

from pyspark.sql import SparkSession

from quire.operators import clustering, postings
from quire.plans import programs
from quire.session import local_session


def main(argv: list[str] | None = None) -> None:
    parser = argparse.ArgumentParser(prog="quire")
    parser.add_argument("program", choices=["articles", "postings", "timeuse"])
    parser.add_argument("path")
    parser.add_argument("--local", metavar="N", default=None, help="start a local[N] session")
    parser.add_argument("--expected", type=int, default=None, help="required number of posting vectors")
    parser.add_argument("--vocab", type=lambda v: v.split(","), default=programs.LANGUAGES,
                        help="terms or tags, separated by commas, in tie-break order")
    parser.add_argument("--spread", type=int, default=postings.DEFAULT_SPREAD, help="distance of neighbouring tags")
    parser.add_argument("--kernels", type=int, default=clustering.DEFAULT_KERNELS, help="number of clusters")
    parser.add_argument("--eta", type=float, default=clustering.DEFAULT_ETA, help="movement below which k-means stops")
    parser.add_argument("--max-iterations", type=int, default=clustering.DEFAULT_MAX_ITERATIONS)
    parser.add_argument("--resume", metavar="FOLDER", default=None,
                        help="shared folder that keeps the k-means run, to go on from after a lost driver")
    parser.add_argument("--infer", action="store_true", help="infer the survey's column types in an extra pass")
    args = parser.parse_args(argv)
    spark = (local_session(args.local, app=f"quire-{args.program}") if args.local
             else SparkSession.builder.appName(f"quire-{args.program}").getOrCreate())
    try:
        if args.program == "articles":
            out = programs.rank_articles(spark, args.path, args.vocab)
            for name in ("naive", "index", "by_key"):
                print(name, out[name])
            print(out["timing"])
        elif args.program == "postings":
            programs.cluster_postings(spark, args.path, args.vocab, args.spread, args.kernels, args.eta,
                                      args.max_iterations, expected_vectors=args.expected,
                                      **({"resume": args.resume} if args.resume else {}))
        else:
            programs.summarise_time_use(spark, args.path, args.infer)
    finally:
        spark.stop()


if __name__ == "__main__":
    main()

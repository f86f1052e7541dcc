"""Command line over the jobs in ``plans``.

    python -m repopulse ingest   --source DIR --lake DIR [--timestamp ISO]
    python -m repopulse backfill --source DIR --lake DIR --start ISO --end ISO [--once]
    python -m repopulse stream   --source DIR --lake DIR --checkpoint DIR [--once | --append | --distinct "6 hours"]
    python -m repopulse report   --lake DIR --year 2026 star_velocity
    python -m repopulse sql      --lake DIR [--mart DIR] "select ... from raw ..."
    python -m repopulse build    --lake DIR --mart DIR [--unchecked]
    python -m repopulse refresh  --lake DIR --mart DIR
    python -m repopulse check    --lake DIR --mart DIR
    python -m repopulse trending --mart DIR [--days 30]
    python -m repopulse fit      --repos DIR --model DIR [--spark-ml]
    python -m repopulse embed    --mart DIR --repos DIR --index DIR --model MODEL [--top 500]
    python -m repopulse search   --index DIR --model MODEL "what to look for"

MODEL is the folder that ``fit`` wrote (weights of hashed words, or with ``--spark-ml`` a
Spark ML pipeline that hashes them), ``letters`` for letter counts, or
``package.module:function`` for a model of one's own: the function returns one that maps
a list of texts to vectors, and the executors can import it. Results are printed whole,
tab-separated, a row at a time.
"""

import argparse
import sys
from importlib import import_module

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession

from .operators import analyses
from .operators.catalog import top_pr_contributors
from .operators.embedding import (
    Encoder,
    embed_text,
    fit_hashing,
    fit_md5,
    hashing_encoder,
    letters26,
    load_md5,
    md5_encoder,
    model_encoder,
    save_md5,
)
from .operators.search import search_display
from .operators.trends import WINDOWS, ranked_pivot, trending_window
from .plans.embed import refresh_index, search_text
from .plans.ingest import backfill, ingest_hour
from .plans.refresh import refresh_mart
from .plans.trends import build_mart, check_all
from .plans.views import register_views
from .schemas import REPO
from .session import build_session
from .sources.archive import resolve_hour
from .sources.index import read_index
from .sources.lake import read_lake
from .sources.mart import read_mart
from .sources.tables import file_system
from .streaming.ingest import late_events, stream_append, stream_distinct, stream_ingest

REPORTS = {
    report.__name__: report
    for report in (
        analyses.top_starred_repos,
        analyses.star_velocity,
        analyses.pr_merge_rate,
        analyses.top_organizations,
        analyses.active_users,
        analyses.hourly_stars,
        analyses.emerging_repos,
        top_pr_contributors,
    )
}


def _arguments(argv: list[str] | None) -> argparse.Namespace:
    parser = argparse.ArgumentParser(prog="repopulse")
    jobs = parser.add_subparsers(dest="job", required=True)
    options = {
        "ingest": ("source", "lake"),
        "backfill": ("source", "lake", "start", "end"),
        "stream": ("source", "lake", "checkpoint"),
        "report": ("lake", "year"),
        "sql": ("lake",),
        "build": ("lake", "mart"),
        "refresh": ("lake", "mart"),
        "check": ("lake", "mart"),
        "trending": ("mart",),
        "fit": ("repos", "model"),
        "embed": ("mart", "repos", "index"),
        "search": ("index",),
    }
    for job, names in options.items():
        command = jobs.add_parser(job)
        for name in names:
            command.add_argument(f"--{name}", required=True)
    jobs.choices["ingest"].add_argument("--timestamp")
    for job in ("backfill", "stream"):
        jobs.choices[job].add_argument("--once", action="store_true")
    jobs.choices["fit"].add_argument("--spark-ml", action="store_true")
    jobs.choices["stream"].add_argument("--append", action="store_true")
    jobs.choices["stream"].add_argument("--distinct", metavar="DELAY")
    jobs.choices["build"].add_argument("--unchecked", action="store_true")
    jobs.choices["report"].add_argument("name", choices=sorted(REPORTS))
    jobs.choices["sql"].add_argument("--mart")
    jobs.choices["sql"].add_argument("statement")
    jobs.choices["trending"].add_argument("--days", type=int, choices=WINDOWS, default=30)
    jobs.choices["embed"].add_argument("--top", type=int, default=500)
    jobs.choices["embed"].add_argument("--model", required=True)
    jobs.choices["search"].add_argument("--model", required=True)
    jobs.choices["search"].add_argument("text")
    return parser.parse_args(argv)


def is_pipeline(spark: SparkSession, model: str) -> bool:
    """Whether a model's folder holds a Spark ML pipeline; else it holds md5 weights."""
    files, place = file_system(spark, f"{model.rstrip('/')}/metadata")
    return files.exists(place)


def _encoder(spark: SparkSession, model: str) -> Encoder:
    if model == "letters":
        return letters26
    module, colon, name = model.partition(":")
    if colon and not name.startswith("/"):
        return model_encoder(getattr(import_module(module), name))
    if is_pipeline(spark, model):
        return hashing_encoder(PipelineModel.load(model))
    return md5_encoder(load_md5(spark, model))


def _print(df: DataFrame) -> None:
    """Every row, fetched one partition at a time."""
    print(*df.columns, sep="\t")
    for row in df.toLocalIterator():
        print(*("" if value is None else value for value in row), sep="\t")
    sys.stdout.flush()


def main(argv: list[str] | None = None) -> None:
    args = _arguments(argv)
    spark = build_session(f"repopulse-{args.job}")
    if args.job == "ingest":
        print(ingest_hour(spark, args.source, resolve_hour(args.timestamp), args.lake))
    elif args.job == "backfill":
        start, end = resolve_hour(args.start), resolve_hour(args.end)
        backfill(spark, args.source, args.lake, start, end, args.once)
    elif args.job == "stream":
        places = args.source, args.lake, args.checkpoint
        if args.distinct:
            query = stream_distinct(spark, *places, delay=args.distinct)
        elif args.append:
            query = stream_append(spark, *places)
        else:
            query = stream_ingest(spark, *places, once=args.once)
        query.awaitTermination()
        if args.distinct:
            print(f"late events dropped: {late_events(query)}")
    elif args.job == "report":
        _print(REPORTS[args.name](read_lake(spark, args.lake), args.year))
    elif args.job == "sql":
        register_views(spark, args.lake, args.mart)
        _print(spark.sql(args.statement))
    elif args.job == "build":
        build_mart(spark, args.lake, args.mart, audit=not args.unchecked)
    elif args.job == "refresh":
        print("\n".join(refresh_mart(spark, args.lake, args.mart)))
    elif args.job == "check":
        _print(check_all(spark, args.lake, args.mart))
    elif args.job == "trending":
        mart = read_mart(spark, args.mart)
        _print(trending_window(mart, days=args.days))
        _print(ranked_pivot(mart, days=args.days))
    elif args.job == "fit":
        repos = spark.read.schema(REPO).parquet(args.repos)
        if args.spark_ml:
            fit_hashing(embed_text(repos)).write().overwrite().save(args.model)
        else:
            save_md5(spark, fit_md5(embed_text(repos)), args.model)
    elif args.job == "embed":
        repos = spark.read.schema(REPO).parquet(args.repos)
        mart, encoder = read_mart(spark, args.mart), _encoder(spark, args.model)
        refresh_index(spark, mart, repos, args.index, encoder, n=args.top)
    elif args.job == "search":
        results = search_text(spark, read_index(spark, args.index), args.text, _encoder(spark, args.model))
        _print(search_display(results))


if __name__ == "__main__":
    main()

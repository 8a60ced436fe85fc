"""Command line: sources, discover, prepare, verify, train-data, history."""

from __future__ import annotations

import argparse
import sys

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from tickloom import schema as schemas
from tickloom.functions.scalars import even_positions
from tickloom.operators import catalog, chunk, metrics, split, stats
from tickloom.plans import strategies, train
from tickloom.sources import listing, root


def _session() -> SparkSession:
    return SparkSession.builder.appName("tickloom").config("spark.sql.session.timeZone", "UTC").config("spark.sql.python.filterPushdown.enabled", "true").getOrCreate()


def main(argv: list[str] | None = None) -> int:
    parser = argparse.ArgumentParser(prog="tickloom")
    sub = parser.add_subparsers(dest="command", required=True)
    sub.add_parser("sources", help="declared dataset sources")
    p = sub.add_parser("discover", help="tasks below a root with their numbers of episodes")
    p.add_argument("uri")
    p.add_argument("--glob", default="*.mcap")
    p = sub.add_parser("prepare", help="convert recordings to an episode dataset")
    p.add_argument("--dataset-source", required=True)
    p.add_argument("--source-uri", required=True)
    p.add_argument("--tasks", nargs="+", required=True)
    p.add_argument("--max-episodes-per-task", type=int, default=300)
    p.add_argument("--root")
    p.add_argument("--reconvert", action="store_true")
    p.add_argument("--decoders", help="encoding=module:function,... of messages in other encodings")
    p = sub.add_parser("verify", help="ranges, padding and evenly spaced frames of a dataset")
    p.add_argument("root")
    p.add_argument("--chunk", type=int, default=50)
    p.add_argument("--frames", type=int, default=5)
    p.add_argument("--episode", type=int, help="look at this episode alone")
    p = sub.add_parser("train-data", help="the rows that training would read: how many a side has, and their statistics")
    p.add_argument("root")
    p.add_argument("--dataset-source", required=True)
    p.add_argument("--chunk", type=int, default=50)
    p.add_argument("--action-space")
    p.add_argument("--relative", action="store_true")
    p.add_argument("--relative-exclude", nargs="*", default=[])
    p.add_argument("--val-fraction", type=float, default=0.0)
    p.add_argument("--test-fraction", type=float, default=0.0)
    p.add_argument("--seed", type=int, default=0)
    p.add_argument("--stats-rows", type=int, default=500, help="rows that statistics are taken from, 0 for all")
    p = sub.add_parser("history", help="the last runs")
    p.add_argument("path")
    p.add_argument("--limit", type=int, default=20)
    args = parser.parse_args(argv)

    if args.command == "sources":
        for name in schemas.available_sources():
            s = schemas.load_schema(name)
            print(f"{name}\t{s.ingestion_strategy}\t{s.tick_fps:g} fps\tstate {s.state_dim}\taction {s.action_dim}")
        return 0
    spark = _session()
    if args.command == "discover":
        catalog.task_counts(catalog.task_catalog(strategies.episodes(spark, args.uri, args.glob)), "path_task").show(1000, False)
    elif args.command == "prepare":
        s = schemas.load_schema(args.dataset_source)
        target = root.resolve_root(args.root, args.dataset_source, args.tasks)
        options = {"decoders": args.decoders} if args.decoders else {}
        info = strategies.run(spark, s, strategies.Request(args.source_uri, args.tasks, args.max_episodes_per_task, target, reconvert=args.reconvert, options=options))
        print(f"{info['total_episodes']} episodes, {info['total_frames']} frames")
        for episode, reason in info["rejected"]:
            print(f"rejected: {episode}: {reason}")
    elif args.command == "verify":
        rows = root.read_training_rows(spark, args.root, args.chunk)
        if args.episode is not None:
            rows = rows.where(F.col("episode_index") == args.episode)
        stats.vector_stats(rows, "observation.state").orderBy("pos").show(100, False)
        chunk.pad_fraction(rows.select(F.col("action_is_pad").alias("is_pad"))).show()
        rows.groupBy("episode_index").agg(F.count("*").alias("n")).select("episode_index", even_positions(F.col("n"), args.frames).alias("frames")).orderBy("episode_index").show(20, False)
    elif args.command == "train-data":
        s = schemas.load_schema(args.dataset_source)
        request = train.TrainRequest(args.root, args.chunk, args.action_space, args.relative, tuple(args.relative_exclude), args.val_fraction, args.test_fraction, args.seed, args.stats_rows or None)
        episodes = spark.read.parquet(f"{args.root}/meta/episodes/chunk-000")
        counts = split.split_counts(episodes, "episode_index", args.val_fraction, args.test_fraction, args.seed)
        split.check_split(counts, args.val_fraction, args.test_fraction)
        for row in counts.orderBy("split").collect():
            print(f"{row['split']}: {row.n_episodes} episodes")
        rows = train.training_rows(spark, s, request)
        print(f"train: {rows.count()} rows")
        for name, found in train.dataset_stats(rows, request.stats_rows).items():
            print(name)
            found.orderBy("pos").show(100, False)
    elif args.command == "history":
        runs = metrics.history_tail(listing.run_history(spark, args.path), "timestamp", ["run_name"], args.limit)
        runs.select("timestamp", "run_name", "status", F.try_element_at("metrics", F.lit("loss")).alias("loss")).show(args.limit, False)
    return 0


if __name__ == "__main__":
    sys.exit(main())

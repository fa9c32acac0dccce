"""Command line of the jobs: ``spark-submit --py-files ... jobs.py <job> [options]``."""

from __future__ import annotations

import argparse
import time
from datetime import datetime, timezone

from pyspark.sql import SparkSession

from wirecount import session
from wirecount.operators.keywords import english_stop_words
from wirecount.operators.metrics import samples
from wirecount.plans import channels, ingest, rollups
from wirecount.sources import entries, snapshots, tables, topic
from wirecount.streaming import progress
from wirecount.streaming.hourly import start_hourly
from wirecount.streaming.ingest import start_ingest


def parser() -> argparse.ArgumentParser:
    top = argparse.ArgumentParser(prog="jobs.py")
    jobs = top.add_subparsers(dest="job", required=True)

    def job(name, text):
        p = jobs.add_parser(name, help=text)
        p.add_argument("--as-of", type=datetime.fromisoformat, help="clock of the job, UTC")
        return p

    job("create-tables", "create the keyword and metric tables")

    p = job("add-channels", "add the channels of a CSV list")
    p.add_argument("--csv", required=True)
    p.add_argument("--state", required=True, help="folder of channel and mark snapshots")

    p = job("show-channels", "print the registry and its size")
    p.add_argument("--state", required=True)

    p = job("reset-channels", "start over with an empty registry")
    p.add_argument("--state", required=True)

    p = job("ingest", "send the new entries of landed feed documents")
    p.add_argument("--state", required=True)
    p.add_argument("--landing", required=True)
    p.add_argument("--dialect", choices=sorted(entries.DIALECTS), default="rss")
    p.add_argument("--out", help="folder for messages, instead of Kafka")
    p.add_argument("--servers", help="Kafka bootstrap servers")
    p.add_argument("--rejects")
    p.add_argument("--landed-after", type=datetime.fromisoformat,
                   help="leave out documents that landed before, UTC")
    p.add_argument("--checkpoint", help="run as a stream that continues from here")

    p = job("hourly", "count keywords of the topic, hour by hour")
    p.add_argument("--checkpoint", required=True)
    p.add_argument("--servers", help="Kafka bootstrap servers")
    p.add_argument("--path", help="folder of a file-backed topic, instead of Kafka")
    p.add_argument("--label-from", choices=("processing", "arrival", "published"),
                   default="processing")
    p.add_argument("--label-at", choices=("start", "end"), default="start")
    p.add_argument("--tasks", type=int)
    p.add_argument("--dedup-within", help="such as '24 hours': drop messages sent again")
    p.add_argument("--lemmas", help="parquet dictionary with token and lemma")
    p.add_argument("--stop-words", help="parquet table of words; Spark's English list without")
    p.add_argument("--rejects", help="folder for messages that cannot be read")
    p.add_argument("--once", action="store_true", help="take what is there and stop")

    p = job("topic-size", "record how many messages the topic holds, from the offsets the hourly "
            "stream has noted unless a topic is named")
    p.add_argument("--servers")
    p.add_argument("--path")

    p = job("rollup", "write yesterday, and last month on the 1st")
    p.add_argument("--label-at", choices=("start", "end"), default="start")
    p.add_argument("--exact", action="store_true", default=True, help="the default")
    p.add_argument("--cascade", dest="exact", action="store_false",
                   help="sum the hourly and daily tops instead of all counts")
    p.add_argument("--scheduled", action="store_true")

    job("expire", "drop hourly rows past their time and merge the batches of past days")
    return top


def main(argv: list[str] | None = None):
    args = parser().parse_args(argv)
    spark = session.create(f"wirecount-{args.job}")
    as_of = args.as_of or datetime.now(timezone.utc).replace(tzinfo=None)
    start = time.perf_counter()
    result = run(args, spark, as_of)
    if spark.catalog.tableExists(tables.METRICS):
        taken = round(1000 * (time.perf_counter() - start))
        tables.append_metrics(samples(spark, as_of, "timing", **{f"job_{args.job}": taken}))
    return result


def run(args: argparse.Namespace, spark: SparkSession, as_of: datetime):
    if args.job == "create-tables":
        return tables.create_tables(spark)
    if args.job == "add-channels":
        inserted, total, bad = channels.add_channels(spark, args.csv, args.state, as_of)
        print(f"{inserted} channels added, {total} in all")
        bad.show(truncate=False)
        return inserted
    if args.job == "show-channels":
        registry = snapshots.load_registry(spark, args.state)
        registry.show(truncate=False)
        print(f"{registry.count()} channels")
        return None
    if args.job == "reset-channels":
        return snapshots.reset_channels(spark, args.state)
    if args.job == "ingest":
        send = ingest.to_folder(args.out) if args.out else ingest.to_topic(
            **{"kafka.bootstrap.servers": args.servers})
        if args.checkpoint:
            stream = entries.stream_entries_xml(spark, args.landing, args.dialect)
            return start_ingest(stream, args.state, send, args.checkpoint,
                                rejects_path=args.rejects).awaitTermination()
        return ingest.ingest_landed(
            spark, args.landing, args.state, send, args.dialect, landed_after=args.landed_after,
            rejects_path=args.rejects, as_of=as_of, channel_set=True)
    if args.job == "hourly":
        stream = topic.topic_stream(spark, "parquet", args.path) if args.path else (
            topic.topic_stream(spark, **topic.kafka_options(args.servers)))
        lemmas = spark.read.parquet(args.lemmas) if args.lemmas else None
        stop_words = spark.read.parquet(args.stop_words) if args.stop_words else (
            english_stop_words())
        if args.path:
            session.size_shuffles(spark, session.input_bytes(spark, args.path))
        progress.create(spark)
        progress.watch(spark)
        return start_hourly(
            stream, args.checkpoint, every=None if args.once else "1 hour",
            label_from=args.label_from, label_at=args.label_at, tasks=args.tasks,
            dedup_within=args.dedup_within, rejects_path=args.rejects,
            stop_words=stop_words, lemmas=lemmas).awaitTermination()
    if args.job == "topic-size" and not args.path and not args.servers:
        progress.create(spark)
        return ingest.record_noted_topic_size(spark, as_of)
    if args.job == "topic-size":
        held = topic.topic_table(spark, "parquet", args.path) if args.path else (
            topic.topic_table(spark, **topic.kafka_options(args.servers)))
        return ingest.record_topic_size(held, as_of)
    if args.job == "rollup":
        return rollups.run_rollups(spark, as_of, label_at=args.label_at, exact=args.exact,
                                   scheduled=args.scheduled)
    return rollups.expire(spark, as_of)


if __name__ == "__main__":
    main()

"""Command line: ``spark-submit run_job.py JOB ...``."""

from __future__ import annotations

import argparse
from collections.abc import Callable

from skytally.plans import jobs
from skytally.session import build_session
from skytally.sinks.tables import ResultSink, batch_folder_writer, connector_batch_writer, search_index_sink
from skytally.sources.messages import kafka_options, kafka_writer_options, message_stream
from skytally.streaming.control import await_any


def _pairs(values: list[str]) -> dict[str, str]:
    return dict(value.split("=", 1) for value in values)


def parser() -> argparse.ArgumentParser:
    top = argparse.ArgumentParser(prog="skytally", description="On-time analytics jobs on Spark")
    commands = top.add_subparsers(dest="job", required=True)

    def command(name: str, text: str, source: bool = True, target: bool = True) -> argparse.ArgumentParser:
        sub = commands.add_parser(name, help=text)
        sub.add_argument("--source", required=source, help="file, folder or glob")
        sub.add_argument("--target", required=target, help="output folder or index name prefix")
        return sub

    prepare = command("preprocess", "raw text files to the published Parquet table")
    prepare.add_argument("--by-name", action="store_true", help="match columns by the files' header")
    analyse = command("analyse", "published table to result tables")
    analyse.add_argument("--tables", nargs="*", help="only these result tables")
    analyse.add_argument("--separate", action="store_true", help="one scan per table instead of one for all")
    analyse.add_argument("--parallel", type=int, default=4)
    summary = command("summarise", "raw text files to the airline and route summary")
    ranking = command("rank", "raw text files to the top destinations")
    ranking.add_argument("--k", type=int, default=100)
    for sub in (summary, ranking):
        sub.add_argument("--infer", action="store_true", help="infer column types")
    for sub in (analyse, summary, ranking):
        sub.add_argument("--format", default="parquet", help="Spark writer format")
        sub.add_argument("--index-nodes", help="write to the search index at this address instead")
        sub.add_argument("--option", action="append", default=[], metavar="KEY=VALUE", help="writer option")
    train = command("train", "published table to classifiers")
    train.add_argument("--models", nargs="*", default=list(jobs.MODELS), choices=list(jobs.MODELS))
    score = command("score", "predictions of a saved classifier for a published table")
    score.add_argument("--model", required=True)
    score.add_argument("--preview", type=int, default=0, help="show so many scored rows")
    compact = command("compact", "batch folders to one table with the current row of each key")
    compact.add_argument("--keys", nargs="+", required=True)
    months = command("runs", "delayed days of a published table by month, for the longest runs over New Year")
    months.add_argument("--entity", default="carrier", choices=list(jobs.ENTITIES))
    months.add_argument("--months", nargs="*", metavar="YYYY-MM", help="read and replace only these")
    merge = command("merge", "new batch folders into a bucketed table, reading only what they touch")
    merge.add_argument("--keys", nargs="+", required=True)
    merge.add_argument("--sums", nargs="*", default=[], help="columns to add up instead of keeping the latest row")
    merge.add_argument("--buckets", type=int, default=64, help="fixed when the table is made")
    publish = command("publish", "raw text files to JSON messages", target=False)
    publish.add_argument("--format", default="text", choices=["text", "kafka"])
    publish.add_argument("--servers", help="brokers, for kafka")
    publish.add_argument("--topic", help="for kafka")
    publish.add_argument("--option", action="append", default=[], metavar="KEY=VALUE")
    publish.add_argument("--fill", action="store_true", help="send 0.0 for empty delays")
    speed = command("speed", "message stream to raw rows and running counts", source=False)
    speed.add_argument("--format", default="text", choices=["text", "kafka"])
    speed.add_argument("--servers", help="brokers, for kafka")
    speed.add_argument("--topic", help="for kafka")
    speed.add_argument("--windows", action="store_true", help="also count per origin city and minute of departure")
    speed.add_argument("--lateness", default="1 day", help="how late a message may come for its window")
    speed.add_argument("--keep-late", action="store_true", help="also count by minute with late messages as corrections")
    speed.add_argument("--once-within", help="drop messages sent again within this time, such as '1 day'")
    speed.add_argument("--option", action="append", default=[], metavar="KEY=VALUE")
    speed.add_argument("--index-nodes", help="append to the search index at this address instead of folders")
    speed.add_argument("--checkpoint", required=True)
    speed.add_argument("--interval", default="30 seconds")
    speed.add_argument("--state-partitions", type=int, help="partitions of the count's state, fixed at its first start")
    speed.add_argument("--timeout", type=float, help="stop after this many seconds")
    return top


def _options(args: argparse.Namespace, defaults: Callable[[str, str], dict[str, str]]) -> dict[str, str]:
    """Connector options; those given one by one win over the defaults of a broker and topic."""
    known = defaults(args.servers, args.topic) if args.format == "kafka" and args.servers and args.topic else {}
    return known | _pairs(args.option)


def _sink(args: argparse.Namespace) -> ResultSink:
    if args.index_nodes:
        return search_index_sink(args.target, args.index_nodes)
    return ResultSink(args.target, args.format, _pairs(args.option))


def main(argv: list[str] | None = None) -> None:
    args = parser().parse_args(argv)
    spark = build_session(f"skytally {args.job}")
    if args.job == "preprocess":
        print(jobs.preprocess(spark, args.source, args.target, args.by_name))
    elif args.job == "analyse":
        jobs.analyse(spark, args.source, _sink(args), args.tables, not args.separate, args.parallel)
    elif args.job == "summarise":
        jobs.summarise(spark, args.source, _sink(args), args.infer)
    elif args.job == "rank":
        jobs.rank_destinations(spark, args.source, _sink(args), args.k, args.infer)
    elif args.job == "train":
        jobs.train(spark, args.source, args.target, args.models).show(truncate=False)
    elif args.job == "score":
        jobs.score(spark, args.source, args.model, args.target, args.preview)
    elif args.job == "compact":
        jobs.compact(spark, args.source, args.target, args.keys)
    elif args.job == "runs":
        months = [tuple(int(x) for x in m.split("-")) for m in args.months] if args.months else None
        jobs.append_delay_months(spark, args.source, args.target, args.entity, months)
        jobs.longest_delay_runs(spark, args.target, args.entity).show(truncate=False)
    elif args.job == "merge":
        print(jobs.merge(spark, args.source, args.target, args.keys, args.buckets, args.sums))
    elif args.job == "publish":
        options = _options(args, kafka_writer_options)
        jobs.publish(spark, args.source, args.format, args.target, options, args.fill)
    elif args.job == "speed":
        path = args.source if args.format == "text" else None
        stream = message_stream(spark, args.format, _options(args, kafka_options), path)
        started = []
        if args.once_within:
            once = f"{args.checkpoint}_messages"
            query, stream = jobs.without_redeliveries(
                spark, stream, once, f"{args.checkpoint}_once", args.once_within, args.interval, None, args.state_partitions
            )
            started.append(query)
        windows = late = None
        if args.index_nodes:
            sink = search_index_sink(args.target, args.index_nodes)
            writers = jobs.connector_writers(sink)
            if args.windows:
                windows = connector_batch_writer(sink, "by_minute", ["window_start", "OriginCityName"])
        else:
            writers = jobs.folder_writers(args.target)
            windows = batch_folder_writer(f"{args.target}/by_minute") if args.windows else None
        if args.keep_late:
            late = f"{args.checkpoint}_late_windows" if args.index_nodes else f"{args.target}/late_by_minute"
        layer = jobs.speed_layer(
            stream, *writers, args.checkpoint, args.interval, args.state_partitions, windows, args.lateness, late
        )
        await_any([*started, *layer], args.timeout)

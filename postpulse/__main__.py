"""Command line: python -m postpulse {collect,store,batch,live,compare,predict} ..."""

from __future__ import annotations

import argparse

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from .operators.metrics import WINDOW
from .operators.sentiment import read_lexicon
from .plans import batch, collect, compare, live, predict
from .session import build_session, shared_dir
from .sources.posts import read_posts, store_posts, stream_posts, wait_for_folder
from .sources.raw import LineCounts, parse_posts, select_posts, stream_lines, stream_topic_lines
from .streaming.losses import LossLog, as_rows, store_limits, watching
from .streaming.sinks import write_csv
from .streaming.windows import end, open_ending, wait_for

POSTS, KAFKA = "posts:", "kafka://"


def _arguments() -> argparse.Namespace:
    parser = argparse.ArgumentParser(prog="postpulse", description="Per-topic post analytics.")
    jobs = parser.add_subparsers(dest="job", required=True)

    def job(name: str, text: str) -> argparse.ArgumentParser:
        command = jobs.add_parser(name, help=text)
        command.add_argument(
            "--input", required=True,
            help="folder of raw lines, kafka://servers/topic (streams), or posts:FOLDER of the store job",
        )
        command.add_argument("--output", required=True)
        return command

    def streaming(command: argparse.ArgumentParser) -> None:
        command.add_argument("--checkpoint", help="default: under the shared folder")
        command.add_argument("--trigger", help='interval such as "30 seconds"; default: drain and stop')
        command.add_argument("--max-files", type=int, help="files per micro-batch; default: all there are")

    def selecting(command: argparse.ArgumentParser) -> None:
        command.add_argument("--langs", default="")
        command.add_argument("--terms", default="")
        command.add_argument("--users", default="")

    def windowed(command: argparse.ArgumentParser) -> None:
        streaming(command)
        selecting(command)
        command.add_argument("--window", default=WINDOW)
        command.add_argument("--delay", default="10 seconds", help="how long late posts are waited for")
        command.add_argument("--time-domain", choices=["event", "processing"], default="event")
        command.add_argument("--state-partitions", type=int)
        command.add_argument(
            "--final", action="store_true", help="the input is complete: close the last windows, too"
        )

    streaming(job("collect", "store raw lines"))
    streaming(job("store", "decode raw lines once into a folder of typed posts"))
    command = job("batch", "all metrics as CSV")
    selecting(command)
    command.add_argument("--lexicon", required=True)
    command.add_argument("--lexicon-table", action="store_true", help="join the lexicon, of any size")
    command = job("live", "windowed metrics as index documents")
    windowed(command)
    command.add_argument("--lexicon", required=True)
    command.add_argument(
        "--remember", help='popular users with their first record ever, kept for so long: "30 days"'
    )
    command.add_argument("--bulks", action="store_true", help="documents with ids, sent in bulks to an index store")
    command.add_argument(
        "--wider", default="", help='more window widths, multiples of --window, for the summary: "1 hour,1 day"'
    )
    command = job("compare", "windowed metrics against batch results")
    windowed(command)
    command.add_argument("--baselines", required=True, help="output folder of the batch job")
    command.add_argument("--baseline-windows", type=int, help="default: those of the batch's period")
    command.add_argument("--in-state", action="store_true", help="load the baselines into state, once")
    command = job("predict", "next-window predictions")
    windowed(command)
    command.add_argument("--baselines", required=True, help="output folder of the batch job")
    return parser.parse_args()


def _lines(spark: SparkSession, source: str, max_files: int | None) -> DataFrame:
    if source.startswith(KAFKA):
        servers, topic = source.removeprefix(KAFKA).rsplit("/", 1)
        return stream_topic_lines(spark, **{"kafka.bootstrap.servers": servers, "subscribe": topic})
    return stream_lines(spark, source, max_files)


def _selected(given: argparse.Namespace, posts: DataFrame) -> DataFrame:
    return select_posts(posts, given.langs, given.terms, given.users)


def _batch(spark: SparkSession, given: argparse.Namespace) -> None:
    lexicon = read_lexicon(spark, given.lexicon, given.lexicon_table)
    if given.input.startswith(POSTS):
        posts = read_posts(spark, given.input.removeprefix(POSTS))
        batch.run(_selected(given, posts), given.output, lexicon)
    elif given.input.startswith(KAFKA):
        raise SystemExit("batch reads folders; use collect or store for a Kafka topic")
    else:
        batch.run_lines(
            spark, given.input, given.output, lexicon, select=lambda posts: _selected(given, posts)
        )


def _store(
    spark: SparkSession, given: argparse.Namespace, folder: str, aside: str, checkpoint: str, log: LossLog
) -> list[StreamingQuery]:
    """Stores the posts of raw lines in ``folder`` and their limit notices
    aside. A run that drains its input also writes what became of its lines."""
    lines = _lines(spark, given.input, given.max_files)
    storing = store_posts(parse_posts(lines, counts=log.counts), folder, checkpoint, given.trigger)
    limits = store_limits(lines, f"{aside}/limits", f"{checkpoint}-limits", given.trigger)
    if given.trigger is None:
        wait_for([storing, limits])
        write_csv(as_rows(spark, log.after(storing)), f"{aside}/losses.csv", one_file=True)
    return [storing, limits]


def _posts(
    spark: SparkSession, given: argparse.Namespace, checkpoint: str, log: LossLog
) -> tuple[DataFrame, list[StreamingQuery]]:
    """A stream of typed posts, and the queries that feed it. Raw lines are
    decoded once, into a store that all queries of the job read from."""
    feeding: list[StreamingQuery] = []
    if given.input.startswith(POSTS):
        folder = given.input.removeprefix(POSTS)
    else:
        folder = f"{checkpoint}/posts"
        feeding = _store(spark, given, folder, given.output, f"{checkpoint}/store", log)
        if given.trigger is not None:
            wait_for_folder(feeding[0], folder)
    return _selected(given, stream_posts(spark, folder, given.max_files)), feeding


def _run_windowed(spark: SparkSession, given: argparse.Namespace, checkpoint: str, log: LossLog) -> None:
    posts, feeding = _posts(spark, given, checkpoint, log)
    closing = open_ending(posts, f"{checkpoint}/closing")
    timing = {
        "window": given.window,
        "delay": given.delay,
        "time_domain": given.time_domain,
        "trigger": given.trigger,
        "partitions": given.state_partitions,
        "closing": closing,
    }

    def drain() -> None:
        if given.job == "live":
            queries = live.run(
                posts, given.output, checkpoint, read_lexicon(spark, given.lexicon),
                remember=given.remember, bulks=given.bulks,
                wider=[width.strip() for width in given.wider.split(",") if width.strip()], **timing,
            )
        elif given.job == "compare":
            queries = compare.run(
                posts, given.baselines, given.baseline_windows, given.output, checkpoint,
                in_state=given.in_state, **timing,
            )
        else:
            queries = predict.run(posts, given.baselines, given.output, checkpoint, **timing)
        wait_for([*feeding, *queries])

    drain()
    if given.final:
        end(spark, closing, posts.schema)
        drain()


def main() -> None:
    given = _arguments()
    spark = build_session(f"postpulse {given.job}")
    if given.job == "batch":
        _batch(spark, given)
        return
    checkpoint = given.checkpoint or f"{shared_dir(spark)}/{given.job}"
    if given.job in ("collect", "store") and given.input.startswith(POSTS):
        raise SystemExit(f"{given.job} reads raw lines, not stored posts")
    if given.job == "collect":
        lines = _lines(spark, given.input, given.max_files)
        collect.run(lines, given.output, checkpoint, given.trigger).awaitTermination()
        return
    with watching(spark, LineCounts(given.job)) as log:
        if given.job == "store":
            wait_for(_store(spark, given, given.output, f"{given.output}-aside", checkpoint, log))
            return
        if given.final and given.trigger:
            raise SystemExit("--final is for runs without --trigger")
        _run_windowed(spark, given, checkpoint, log)


if __name__ == "__main__":
    main()

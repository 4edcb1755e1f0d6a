"""The index sink: commits, retries, replays."""

import json
import os
import shutil

import pytest
from helpers import make_posts, rows_of
from pyspark.sql import functions as F
from test_streaming import LEXICON, feed, some_posts, stream

from postpulse.operators import metrics
from postpulse.plans import live
from postpulse.streaming import index
from postpulse.streaming.documents import LIVE_INDEX, documents
from postpulse.streaming.windows import end, event_time, open_ending


def flaky_sink(times, whole=True):
    """A sink whose every task's first sends fail, after half of the bulk."""

    class Flaky(index.Bulks):
        left = times

        def send(self, lines):
            if self.left:
                self.left -= 1
                super().send(lines)
                self._out.write(json.dumps({"index": "x", "id": "y", "value": "z"})[:25].encode())
                raise OSError("the store is away")
            super().send(lines)

    class Writer(index.IndexStreamWriter):
        transport = Flaky

    class Sink(index.IndexSink):
        @classmethod
        def name(cls):
            return f"flaky{times}"

        def streamWriter(self, schema, overwrite):
            return Writer(self._options())

    return Sink


def expected(spark, rows):
    counts = metrics.total_count(make_posts(spark, rows), "60 seconds")
    return rows_of(documents(counts, "total_count"), "value")


def run(spark, folder, closing, **options):
    posts = stream(spark, folder / "in", 1)
    rows = index.index_rows(metrics.total_count(event_time(posts, closing=closing), "60 seconds"), "total_count", "totals")
    query = index.start_index(rows, "totals", str(folder / "store"), str(folder / "cp"), partitions=2, **options)
    query.awaitTermination()
    return index.read_index(spark, str(folder / "store"))


@pytest.mark.parametrize("failures", [0, 2])
def test_each_document_once_over_batches_retries_and_replays(spark, tmp_path, failures):
    rows = some_posts(200, seed=3)[:-2]
    feed(spark, rows, tmp_path / "in", files=3)
    closing = open_ending(stream(spark, tmp_path / "in"), str(tmp_path / "closing"))
    sink = flaky_sink(failures) if failures else index.IndexSink
    options = {"sink": sink, "bulkDocuments": "7", "pause": "0.01", "tries": "4"}
    first = run(spark, tmp_path, closing, **options)
    some = rows_of(first, "value")
    whole = expected(spark, rows)
    assert 0 < len(some) < len(whole) and set(some) <= set(whole)
    end(spark, closing, stream(spark, tmp_path / "in").schema)
    found = run(spark, tmp_path, closing, **options)
    assert rows_of(found, "value") == whole
    assert found.select("id").distinct().count() == len(whole)
    # The last micro-batch was committed here, but Spark doesn't know: it runs again.
    commits = tmp_path / "cp" / "totals" / "commits"
    last = max(int(name) for name in os.listdir(commits) if name.isdigit())
    for name in (str(last), f".{last}.crc"):
        if (commits / name).exists():
            shutil.move(commits / name, tmp_path / f"gone{name}")
    named = sorted(os.listdir(tmp_path / "store" / "commits"))
    again = run(spark, tmp_path, closing, **options)
    assert rows_of(again, "value") == whole
    assert sorted(os.listdir(tmp_path / "store" / "commits")) == named


def test_a_store_that_stays_away_fails_the_batch_and_leaves_nothing(spark, tmp_path):
    rows = some_posts(60)
    feed(spark, rows, tmp_path / "in")
    closing = open_ending(stream(spark, tmp_path / "in"), str(tmp_path / "closing"))
    with pytest.raises(Exception, match="the store is away"):
        run(spark, tmp_path, closing, sink=flaky_sink(9), pause="0.01", tries="3")
    assert index.read_index(spark, str(tmp_path / "store")).count() == 0
    # Started again with a store that is back.
    end(spark, closing, stream(spark, tmp_path / "in").schema)
    assert rows_of(run(spark, tmp_path, closing), "value") == expected(spark, rows)


def test_bulks_are_flushed_by_number_and_bytes(tmp_path):
    class Noting(index.Bulks):
        seen = []

        def send(self, lines):
            self.seen.append(len(lines))

    class Writer(index.IndexBatchWriter):
        transport = Noting

    rows = [{"index": "i", "id": str(k), "value": "v" * 100} for k in range(20)]
    options = {"path": str(tmp_path)}
    sent = Writer({**options, "bulkdocuments": "6"}).write(iter(rows))
    assert Noting.seen == [6, 6, 6, 2] and (sent.documents, sent.bulks) == (20, 4)
    Noting.seen.clear()
    Writer({**options, "bulkbytes": "450"}).write(iter(rows))
    assert Noting.seen == [3] * 6 + [2]
    assert Writer(options).write(iter([])).documents == 0


def test_batches_and_later_commits(spark, tmp_path):
    spark.dataSource.register(index.IndexSink)
    root = str(tmp_path / "store")
    assert index.read_index(spark, root).count() == 0

    def write(values, commit):
        rows = spark.createDataFrame([("i", k, v) for k, v in values], index.SCHEMA)
        rows.write.format("postpulse_index").mode("append").option("path", root).option("commit", commit).save()

    write([("a", "1"), ("b", "1")], "q-0000000001")
    write([("a", "2"), ("c", "2")], "q-0000000002")
    write([("a", "3")], "q-0000000002")  # made before
    assert rows_of(index.read_index(spark, root), "id", "value") == [("a", "2"), ("b", "1"), ("c", "2")]


def test_ids_tell_keys_apart(spark):
    rows = spark.createDataFrame(
        [("a", "bc"), ("ab", "c"), ("", "abc"), (None, "abc"), ("-", "abc")], "hashtag string, topic string"
    ).selectExpr("timestamp_seconds(0) AS window_start", "0L AS timestamp", "*", "1L AS cnt")
    assert index.index_rows(rows, "hashtag", "h").select("id").distinct().count() == 5
    assert index.index_rows(rows, "hashtag", "g").unionByName(index.index_rows(rows, "hashtag", "h")).select("id").distinct().count() == 10


def test_live_job_sends_bulks(spark, tmp_path):
    rows = some_posts(80, seed=4)
    posts = feed(spark, rows, tmp_path / "in")
    queries = live.run(stream(spark, tmp_path / "in"), str(tmp_path / "store"), str(tmp_path / "cp"), LEXICON,
                       delay="0 seconds", partitions=2, bulks=True)
    for query in queries:
        query.awaitTermination()
    found = index.read_index(spark, str(tmp_path / "store"))
    closed = F.col("window_start") < F.lit(rows[-1]["ts"])
    for metric, operator in (("total_count", metrics.total_count), ("word", metrics.word_count)):
        whole = documents(operator(posts, "60 seconds").filter(closed), metric)
        assert rows_of(found.filter(F.col("index") == LIVE_INDEX[metric]), "value") == rows_of(whole, "value")
    assert {row["index"] for row in found.select("index").distinct().collect()} == set(LIVE_INDEX.values())

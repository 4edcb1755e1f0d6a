"""The live source of lines: order, admission, restarts, splits, its filter."""

import random

import pytest
from helpers import raw_line, rows_of

from postpulse.sources import lines, raw
from postpulse.streaming.windows import run_to_table


def drain(spark, folder, **options):
    rows = lines.stream_folder(spark, str(folder / "in"), str(folder / "order"), **options)
    return run_to_table(rows, "lines", str(folder / "out"), str(folder / "cp"))


def write(folder, name, text):
    (folder / "in").mkdir(exist_ok=True)
    (folder / "in" / name).write_bytes(text.encode())


def test_steps_and_restarts_lose_and_repeat_nothing(spark, tmp_path):
    """Names are no order: a file that comes later may sort before."""
    for name in "dbf":
        write(tmp_path, name, f"{name}1\n{name}2\r\n\n{name}3")
    write(tmp_path, "_hidden", "no")
    write(tmp_path, ".hidden", "no")
    seen = []
    for _ in range(4):
        found = sorted(row.value for row in drain(spark, tmp_path, batchFiles=2).collect())
        seen.append(len(found))
        if len(seen) == 1:  # in mid-folder
            write(tmp_path, "a", "a1\n")
    assert seen == [8, 13, 13, 13]
    assert found == sorted([f"{name}{i}" for name in "dbf" for i in (1, 2, 3)] + ["", "", "", "a1"])
    write(tmp_path, "c", "c1\nc2\n")
    assert drain(spark, tmp_path, batchBytes=1).count() == 15


def test_a_batch_that_failed_is_repeated(spark, tmp_path):
    from pyspark.sql import functions as F

    for name in "ab":
        write(tmp_path, name, f"{name}1\n{name}2\n")

    def start(rows):
        return run_to_table(rows, "lines", str(tmp_path / "out"), str(tmp_path / "cp"))

    rows = lines.stream_folder(spark, str(tmp_path / "in"), str(tmp_path / "order"), batchFiles=1)
    with pytest.raises(Exception, match="broken task"):
        start(rows.select(F.coalesce(F.raise_error(F.lit("broken task")).cast("string"), "value").alias("value")))
    counts = [start(rows).count() for _ in range(3)]
    assert counts == [2, 4, 4]


@pytest.mark.parametrize("seed", range(30))
def test_splits_meet_at_line_ends(tmp_path, seed, monkeypatch):
    rng = random.Random(seed)
    monkeypatch.setattr(lines, "CHUNK", rng.choice([1, 3, 1000]))
    text = "".join(rng.choice(["a", "é", "\n", "\r\n", "bb"]) for _ in range(rng.randrange(0, 60)))
    data = text.encode()
    (tmp_path / "f").write_bytes(data)
    expected = [line.removesuffix(b"\r") for line in data.split(b"\n")]
    if not data or data.endswith(b"\n"):
        expected.pop()
    size = rng.randrange(1, 12)
    found = []
    for lo in range(0, len(data), size):
        found += lines._lines(lines.Part(str(tmp_path / "f"), lo, min(lo + size, len(data))))
    assert found == expected


def test_admission_is_bounded(tmp_path):
    for k in range(7):
        write(tmp_path, f"f{k}", "x" * 9 + "\n")
    write(tmp_path, "large", "y" * 500 + "\n")
    options = {"path": str(tmp_path / "in"), "order": str(tmp_path / "order"), "batchbytes": "25", "splitbytes": "100"}
    reader = lines.LineReader(options)
    at, steps = reader.initialOffset(), []
    while (end := reader.latestOffset()) != at:
        assert reader.latestOffset() == end  # until it is planned
        parts = reader.partitions(at, end)
        steps.append((end["files"], len(parts)))
        at = end
        reader = lines.LineReader(options)  # another driver goes on
    assert steps == [(2, 2), (4, 4 - 2), (6, 2), (7, 1), (8, 6)]
    assert reader.partitions({"files": 0}, {"files": 2}) == lines.LineReader(options).partitions({"files": 0}, {"files": 2})
    assert reader.latestOffset() == at  # a replay of old batches doesn't move it back


def test_the_language_filter_is_pushed_and_changes_nothing(spark, tmp_path):
    some = [raw_line(i, id=i, lang=lang) for i, lang in enumerate(["en", "de", "fr", "es", "en", None])]
    some += [raw_line(9, id=9, lang="fr").replace('"lang":"fr"', '"lang" : "d\\u0065"'), '{"limit":{"track":1,"timestamp_ms":"5"}}', "junk"]
    some += [raw_line(10, id=10, lang="es", retweeted_status={"id": 1, "lang": "en", "text": "x", "user": {"id": 2}})]
    write(tmp_path, "a", "\n".join(some))
    found = drain(spark, tmp_path, langs="en, de")
    assert found.count() == 7  # not the posts in French, in Spanish and in none
    posts = raw.select_posts(raw.parse_posts(found), langs="en,de")
    whole = raw.select_posts(raw.parse_posts(raw.read_lines(spark, str(tmp_path / "in"))), langs="en,de")
    assert rows_of(posts, "id") == rows_of(whole, "id") == [(0,), (1,), (4,), (9,)]
    assert raw.parse_limits(found).count() == 1

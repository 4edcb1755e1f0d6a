"""Whitening and hard negatives against brute force."""

from __future__ import annotations

import random
from collections import defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from postpulse.llm import hard_negatives as hard
from postpulse.llm import whitening
from postpulse.llm.queries import QUERIES

MATRICES = {
    "meets an eigenvalue": np.diag([0.0, 1.0, 2.0]),
    "identity": np.eye(5),
    "repeated": np.diag([3.0, 3.0, 1.0, 1.0, 0.0, 0.0, 2.0]),
    "zero": np.zeros((4, 4)),
    "rank one": np.outer([1.0, 2.0, 3.0], [1.0, 2.0, 3.0]),
    "wide range": np.diag(10.0 ** np.arange(-8, 8)),
}


@pytest.mark.parametrize("name", list(MATRICES))
def test_spectrum(name):
    matrix = MATRICES[name]
    turn, _ = np.linalg.qr(np.random.default_rng(1).standard_normal(matrix.shape))
    for given in (matrix, turn @ matrix @ turn.T):
        values, vectors = whitening.spectrum(given, len(given))
        size = max(np.abs(given).max(), 1e-300)
        assert np.abs(values - np.linalg.eigvalsh(given)[::-1]).max() < 1e-12 * size + 1e-300
        assert np.abs(given @ vectors - vectors * values).max() < 1e-12 * size + 1e-300
        assert np.abs(vectors.T @ vectors - np.eye(len(given))).max() < 1e-12


def test_polar_is_orthogonal():
    rng = np.random.default_rng(2)
    for n in (1, 2, 17, 64):
        matrix = rng.standard_normal((n, n))
        factor = whitening.polar(matrix)
        assert np.abs(factor.T @ factor - np.eye(n)).max() < 1e-12
        rest = factor.T @ matrix
        assert np.abs(rest - rest.T).max() < 1e-10 and np.linalg.eigvalsh((rest + rest.T) / 2).min() > -1e-9


def brute_white(rows, most=16):
    x = [(i, [int(np.floor(64 * float(np.float32(c)))) + 1_000_000 for c in v]) for i, v in rows]
    fit = np.array(sorted({tuple(v) for _, v in x}), np.int64)
    n, sums = len(fit), fit.sum(axis=0)
    centred = fit - sums / n
    cov = centred.T @ centred / n
    values, vectors = np.linalg.eigh(cov)
    values, vectors = values[::-1][:most], vectors[:, ::-1][:, :most]
    out = {}
    for i, v in x:
        dev = sum((n * a - int(s)) ** 2 for a, s in zip(v, sums))
        out.setdefault(i, []).append((dev, (np.array(v) - sums / n) @ vectors / np.sqrt(values)))
    return out, n, values / np.trace(cov)


def test_whitening_equals_brute_force(spark, sf_dir):
    rows = [(r["vec_id"], r["embedding"]) for r in spark.read.parquet(f"{sf_dir}/embeddings.parquet").collect()]
    expected, n, explained = brute_white(rows)
    found = QUERIES["op11_embedding_whitening"](spark, sf_dir)
    assert dict(found.dtypes)["deviation"] == "bigint" and dict(found.dtypes)["component"] == "int"
    found = found.collect()
    assert len(found) == 16 * len(rows)
    signs = {}
    for row in found:
        dev, white = expected[row["vec_id"]][0]
        k = row["component"] - 1
        assert row["n"] == n and row["deviation"] == dev and 0 <= row["identity_error"] < 1e-9
        assert abs(row["explained"] - explained[k]) < 1e-12
        if abs(white[k]) > 1e-3:
            sign = signs.setdefault(k, np.sign(white[k]) * np.sign(row["whitened"]))
            assert abs(sign * row["whitened"] - white[k]) < 1e-8
    assert len({r["identity_error"] for r in found}) == 1


def test_whitening_cases(spark):
    rng = np.random.default_rng(3)
    good = [(i, [float(c) for c in rng.standard_normal(4)]) for i in range(40)]
    nan, inf = float("nan"), float("inf")
    odd = [(100, None), (101, []), (102, [nan, 0.0, 0.0, 0.0]), (103, [inf, 0.0, 0.0, 0.0]), (104, [None, 1.0, 1.0, 1.0]),
           (105, [1.0, 2.0]), (None, good[0][1]), (3, good[3][1]), (106, [0.0] * 4)]
    table = spark.createDataFrame([*good, *odd], "vec_id long, embedding array<float>").withColumn("x", F.lit("x"))
    table = table.withColumn("component", F.lit(0)).withColumn("_at", F.lit(0)).repartition(5)
    found = whitening.whiten(table).collect()
    expected, n, _ = brute_white([*good, (None, good[0][1]), (3, good[3][1]), (106, [0.0] * 4)])
    assert n == 41 and len(found) == 4 * 43
    assert {r["vec_id"] for r in found} == {*range(40), None, 106}
    assert all(int(r["deviation"]) == expected[r["vec_id"]][0][0] for r in found)
    assert whitening.whiten(table.limit(0)).count() == 0
    assert whitening.whiten(table.filter("vec_id = 3")).count() == 0  # one distinct vector
    flat = spark.createDataFrame([(i, [float(i), 2.0 * i]) for i in range(9)], "vec_id long, embedding array<double>")
    assert {r["component"] for r in whitening.whiten(flat).collect()} == {1}  # no variance but along a line
    far = spark.createDataFrame([(0, [1e38, 0.0]), (1, [-1e38, 1.0]), (2, [0.0, 5.0])], "vec_id long, embedding array<double>")
    assert whitening.whiten(far).agg(F.max("identity_error")).first()[0] < 1e-9


def brute_negatives(rows, is_anchor, positives=5, negatives=5):
    given = {(i, label, tuple(int(np.floor(256 * float(np.float32(c)))) for c in v)) for i, label, v in rows}
    out = []
    for a, label, q in sorted(given):
        if not is_anchor(a):
            continue
        scored = [(-sum(x * y for x, y in zip(q, v)), i, own) for i, own, v in given]
        near = sorted((s, i) for s, i, own in scored if own == label and i != a)[:positives]
        for ps, p in near:
            fit = sorted((s, i) for s, i, own in scored if own != label and 80 * -ps <= 100 * -s <= 100 * -ps)
            out += [(a, p, k + 1, i, -ps, -s) for k, (s, i) in enumerate(fit[:negatives])]
    return sorted(out)


COLUMNS = ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]


def clustered(seed, n, d=8, clusters=6, labels=4):
    rng = np.random.default_rng(seed)
    centres = rng.standard_normal((clusters, d))
    picked = rng.integers(0, clusters, n)
    vectors = np.round(centres[picked] + 0.2 * rng.standard_normal((n, d)), 1 if seed % 2 else 6)
    return [(i, int(rng.integers(0, labels)), [float(c) for c in v]) for i, v in enumerate(vectors)]


@pytest.mark.parametrize("seed", [1, 2])
def test_hard_negatives_equal_brute_force(spark, seed, monkeypatch):
    # Small blocks and batches: many cells with several blocks, several rounds.
    for name, value in {"BLOCK": 16, "SEARCHES": 3, "FIRST_CELLS": 1, "GROWTH": 3, "SCORES": 64}.items():
        monkeypatch.setattr(hard, name, value)
    rows = clustered(seed, 300)
    rows += [(1000 + i, 1, rows[0][2]) for i in range(60)]  # a vector that many rows share
    table = spark.createDataFrame(rows, "vec_id long, label int, embedding array<float>").repartition(3)
    found = hard.hard_negatives(table, F.col("vec_id") % 7 == 0)
    expected = brute_negatives(rows, lambda i: i % 7 == 0)
    assert len(expected) > 500
    assert sorted(map(tuple, found.select(*COLUMNS).collect())) == expected


def test_search_stops_at_certified_windows(spark, monkeypatch):
    """Far clusters are not visited."""
    monkeypatch.setattr(hard, "FIRST_CELLS", 1)
    seen = []
    block = hard._search_block
    monkeypatch.setattr(hard, "_search_block", lambda rows, asked, most: block(rows, asked, most))
    rng = np.random.default_rng(8)
    corners = 3 * rng.standard_normal((8, 16))
    rows = [(i, i % 2, [float(c) for c in corners[i % 8] + 0.01 * rng.standard_normal(16)]) for i in range(800)]
    table = spark.createDataFrame(rows, "vec_id long, label long, embedding array<double>")
    index = hard.build(hard._entries(hard.prepared(table), 6))
    probe = index.rows.limit(1).select(
        F.lit(1).cast("long").alias("search"), "vec", "label", F.lit(True).alias("same"),
        F.lit(-(1 << 62)).alias("low"), F.lit(1 << 62).alias("high"),
    )
    for row in probe.mapInArrow(hard._probes(index.books, index.directory, 0, 1), hard._PROBES).collect():
        seen += row["cells"]
    assert len(seen) == 1 and (index.directory.parts > 0).sum() > 1
    found = hard.search(index, probe, 6).collect()
    assert len(found) == 6


def test_cells_come_by_bound():
    rng = random.Random(4)
    for _ in range(50):
        one = np.array([rng.choice([0.0, 1.0, 2.5, rng.random()]) for _ in range(rng.randrange(1, 9))])
        two = np.array([rng.choice([0.0, 1.0, 2.5, rng.random()]) for _ in range(rng.randrange(1, 9))])
        cells = list(hard.cells_by_bound(one, two))
        assert sorted((i, j) for _, i, j in cells) == [(i, j) for i in range(len(one)) for j in range(len(two))]
        assert all(s == one[i] + two[j] for s, i, j in cells)
        assert all(a[0] >= b[0] for a, b in zip(cells, cells[1:]))


def test_bounds_hold(spark):
    rows = clustered(5, 200)
    table = spark.createDataFrame(rows, "vec_id long, label int, embedding array<float>")
    index = hard.build(hard._entries(hard.prepared(table), 6))
    found = index.rows.collect()
    x = np.array([r["vec"] for r in found], np.float64)
    first, second = index.books.bounds(x)
    width = len(index.books.books[1])
    blocks = defaultdict(int)
    for r in found:
        i, j = divmod(r["cell"], width)
        assert ((x @ np.array(r["vec"], np.float64)) <= first[:, i] + second[:, j]).all()
        blocks[r["block"]] += 1
        assert index.directory.starts[i, j] <= r["block"] < index.directory.starts[i, j] + index.directory.parts[i, j]
    assert sum(blocks.values()) == len(found)


def test_hard_negative_cases(spark):
    nan = float("nan")
    rows = [
        (0, 1, [1.0, 0.0]), (0, 1, [1.0, 0.0]), (7, 1, [0.9, 0.1]), (8, 2, [0.89, 0.2]), (9, 2, [0.0, 0.0]), (10, 1, [-1.0, 0.0]),
        (11, 3, [0.9, 0.1]), (None, 1, [1.0, 0.0]), (12, None, [1.0, 0.0]), (13, 1, None), (14, 1, []), (15, 1, [nan, 1.0]),
        (16, 1, [None, 1.0]), (17, 1, [1.0]), (18, -5, [0.85, 0.3]), (100, 9, [0.1, 0.1]), (200, 1, [0.0, 0.0]),
    ]
    table = spark.createDataFrame(rows, "vec_id long, label int, embedding array<float>")
    table = table.withColumn("search", F.lit("x")).withColumn("block", F.lit(1)).withColumn("rank", F.lit(2))
    found = hard.hard_negatives(table, F.col("vec_id") % 100 == 0)
    kept = [r for r in rows if r[0] is not None and r[1] is not None and r[2] and len(r[2]) == 2 and not any(c is None or c != c for c in r[2])]
    assert sorted(map(tuple, found.select(*COLUMNS).collect())) == brute_negatives(kept, lambda i: i % 100 == 0)
    assert hard.hard_negatives(table.limit(0), F.col("vec_id") == 0).count() == 0
    assert hard.hard_negatives(table, F.col("vec_id") == 555).count() == 0
    alone = spark.createDataFrame([(0, 1, [2.0])], "vec_id long, label int, embedding array<float>")
    assert hard.hard_negatives(alone, F.col("vec_id") == 0).count() == 0

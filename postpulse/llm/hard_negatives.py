"""Hard-negative mining by an inverted multi-index.

Components become integers, ``floor(256 * x)``; a score is the integer inner
product with the anchor. An anchor's positives are its best other rows of the
same label; the hard negatives of a positive are the best rows of other labels
whose score lies in a window below the positive's.

Vectors are halved. Each half has a codebook, fitted on a bounded sample; a cell
is a pair of codes, and every row lies in one cell. A half's score is at most
that of the code plus the code's radius (the farthest row that has it) times
the length of the anchor's half, so the sum of two such bounds holds for all of
a cell. The multi-sequence heap visits an anchor's cells by falling sums. After
each batch of cells the search stops for windows that are certified: those
that are full of rows scoring above the bound of the next cell, or whose lower
end lies above it. The rest get a batch of cells several times as large; with
vectors that no codebook tells apart all cells are visited in a few rounds, and
the result is the same. Nothing is approximate.

Cells lie in blocks of about ``BLOCK`` rows; a cell with more has several. A
search visits a block once for all of the batch's cells in it, and the searches
of a block are split among tasks, so neither a full cell nor a vector that many
anchors share makes a large task. Rows with equal vector and label are one
entry, with its smallest ids, as many as any result can use; equal anchors are
searched once.

Defined results: rows with a null label or id, a null or empty vector, or a
null or non-finite component take no part, nor do rows whose vector has another
length than most (the shorter one, in a tie). Zero vectors do take part. Rows
that repeat id, label and vector count once; a row is no positive of its own id.
An anchor without a positive, or a positive without a negative, gives no rows;
an empty table gives none. Ties go to the smaller id. Components beyond 2**20
after scaling are taken as that, so that scores stay exact. Columns other than
vec_id, label and embedding are not looked at.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import stage

#: Fixed value: the scale of components.
SCALE = 256
LIMIT = float(1 << 20)
#: The codebooks' sample: at most so many rows, and values in all.
SAMPLE_ROWS = 8192
SAMPLE_VALUES = 1 << 21
MOST_CODES = 128
LLOYD_STEPS = 8
#: Rows of a block, searches of a task, and scores of a step in it.
BLOCK = 4096
SEARCHES = 2048
SCORES = 1 << 20
#: Cells of the first batch; each next one is so many times larger.
FIRST_CELLS, GROWTH = 8, 8


def prepared(rows: DataFrame) -> DataFrame:
    """(vec_id, label, vec) of the rows that take part, each once."""
    v = F.col("embedding")
    finite = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))

    def whole(x):
        return F.floor(F.greatest(F.least(x.cast("double") * SCALE, F.lit(LIMIT)), F.lit(-LIMIT))).cast("int")

    kept = rows.filter(
        F.col("vec_id").isNotNull() & F.col("label").isNotNull() & (F.size(v) > 0) & finite
    ).select(F.col("vec_id").cast("long"), F.col("label").cast("long"), F.transform(v, whole).alias("vec"))
    sizes = kept.groupBy(F.size("vec").alias("d")).agg(F.count("*").alias("n"))
    usual = sizes.orderBy(F.desc("n"), "d").first()
    if usual is None:
        return kept.limit(0)
    return kept.filter(F.size("vec") == usual["d"]).dropDuplicates()


def _entries(rows: DataFrame, most: int) -> DataFrame:
    """(vec, label, ids): each vector and label once, with its smallest ids."""
    by_id = Window.partitionBy("vec", "label").orderBy("vec_id")
    return (
        rows.withColumn("_r", F.row_number().over(by_id))
        .filter(F.col("_r") <= most)
        .groupBy("vec", "label")
        .agg(F.array_sort(F.collect_list("vec_id")).alias("ids"))
    )


def _vectors(column) -> np.ndarray:
    parts = column.chunks if isinstance(column, pa.ChunkedArray) else [column]
    flat = [part.flatten().to_numpy(zero_copy_only=False) for part in parts]
    return np.concatenate(flat).astype(np.float64).reshape(len(column), -1)


@dataclass(frozen=True)
class Codebooks:
    """Codes of the halves; radii: of each code, over all rows."""

    cut: int
    books: tuple[np.ndarray, np.ndarray]
    radii: tuple[np.ndarray, np.ndarray] | None = None

    def halves(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        return x[:, : self.cut], x[:, self.cut :]

    def codes(self, x: np.ndarray) -> list[tuple[np.ndarray, np.ndarray]]:
        """For each half: the nearest code of each row, and how far it is."""
        made = []
        for half, book in zip(self.halves(x), self.books):
            code = _nearest(half, book)
            made.append((code, np.sqrt(((half - book[code]) ** 2).sum(axis=1))))
        return made

    def bounds(self, x: np.ndarray) -> list[np.ndarray]:
        """For each half: no row with a code scores higher (rows x codes)."""
        made = []
        for half, book, radius in zip(self.halves(x), self.books, self.radii):
            length = np.sqrt((half**2).sum(axis=1, keepdims=True))
            reach = length * (radius + np.sqrt((book**2).sum(axis=1)))
            # Room for the rounding of doubles.
            made.append(half @ book.T + length * radius + 1e-9 * (reach + 1))
        return made


def _nearest(points: np.ndarray, book: np.ndarray) -> np.ndarray:
    return np.argmin((book**2).sum(axis=1) - 2 * (points @ book.T), axis=1)


def learn(sample: np.ndarray, codes: int) -> Codebooks:
    """Codebooks by Lloyd's steps from distinct points of the sample."""
    cut = sample.shape[1] // 2
    books = []
    for half in (sample[:, :cut], sample[:, cut:]):
        distinct = np.unique(half, axis=0)
        order = np.random.default_rng(5).permutation(len(distinct))
        book = distinct[order[:codes]]
        for _ in range(LLOYD_STEPS):
            code = _nearest(half, book)
            n = np.bincount(code, minlength=len(book))
            sums = np.zeros_like(book)
            np.add.at(sums, code, half)
            book = np.where(n[:, None] > 0, sums / np.maximum(n, 1)[:, None], book)
        books.append(book)
    return Codebooks(cut, (books[0], books[1]))


def cells_by_bound(first: np.ndarray, second: np.ndarray) -> Iterator[tuple[float, int, int]]:
    """(bound, i, j) for all pairs, by falling ``first[i] + second[j]``: the
    multi-sequence heap. A pair enters once both pairs before it have left."""
    one, two = np.argsort(-first, kind="stable"), np.argsort(-second, kind="stable")
    heap = [(-(first[one[0]] + second[two[0]]), 0, 0)]
    reached = np.zeros(len(one), np.int64)  # so many of this row's pairs have left
    while heap:
        negative, a, b = heapq.heappop(heap)
        yield -negative, int(one[a]), int(two[b])
        reached[a] = b + 1
        if b + 1 < len(two) and (a == 0 or reached[a - 1] > b + 1):
            heapq.heappush(heap, (-(first[one[a]] + second[two[b + 1]]), a, b + 1))
        if a + 1 < len(one) and reached[a + 1] == b:
            heapq.heappush(heap, (-(first[one[a + 1]] + second[two[b]]), a + 1, b))


@dataclass(frozen=True)
class Directory:
    """Where cells lie: starts[i, j] is the first block of a cell, parts[i, j]
    how many it has (0: an empty cell). Cells that share a block are whole."""

    starts: np.ndarray
    parts: np.ndarray

    @staticmethod
    def of(counts: np.ndarray) -> Directory:
        starts, parts = np.zeros(counts.shape, np.int64), np.zeros(counts.shape, np.int64)
        block, held = 0, 0
        for at in zip(*np.nonzero(counts)):
            n = int(counts[at])
            if held and held + n > BLOCK:
                block, held = block + 1, 0
            starts[at], parts[at] = block, -(-n // BLOCK)
            held += n
            if held >= BLOCK:
                block, held = block + int(parts[at]), 0
        return Directory(starts, parts)


@dataclass(frozen=True)
class Index:
    """rows: (cell, block, vec, label, ids), stored; cell is i * codes + j."""

    rows: DataFrame
    books: Codebooks
    directory: Directory


def build(entries: DataFrame) -> Index | None:
    """The index of the entries (vec, label, ids), None if there are none."""
    facts = entries.agg(F.count("*").alias("n"), F.max(F.size("vec")).alias("d")).first()
    if not facts["n"]:
        return None
    size = max(2, min(SAMPLE_ROWS, SAMPLE_VALUES // facts["d"]))
    chosen = F.pmod(F.xxhash64("vec", "label"), F.lit(max(1, facts["n"] // size))) == 0
    sample = entries.filter(chosen).orderBy(F.xxhash64("vec"), "vec", "label").limit(size).select("vec")
    known = np.array([row[0] for row in sample.collect()], np.float64).reshape(-1, facts["d"])
    codes = int(min(MOST_CODES, max(4, 2 * np.sqrt(facts["n"] / 1024))))
    books = learn(known, codes)
    width = len(books.books[1])

    def coded(batches):
        for batch in batches:
            if batch.num_rows:
                (i, far), (j, farther) = books.codes(_vectors(batch.column("vec")))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(i * width + j), pa.array(far), pa.array(farther),
                     *(batch.column(n) for n in ("vec", "label", "ids"))],
                    names=["cell", "far1", "far2", "vec", "label", "ids"],
                )

    rows = entries.select("vec", "label", "ids").mapInArrow(
        coded, "cell long, far1 double, far2 double, vec array<int>, label long, ids array<long>"
    )
    rows = stage(rows, "hard-coded")
    # One row a cell, so at most MOST_CODES ** 2.
    counts, radii = np.zeros((len(books.books[0]), width), np.int64), [np.zeros(len(b)) for b in books.books]
    per_cell = rows.groupBy("cell").agg(F.count("*").alias("n"), F.max("far1").alias("a"), F.max("far2").alias("b"))
    for row in per_cell.collect():
        i, j = divmod(row["cell"], width)
        counts[i, j] = row["n"]
        radii[0][i], radii[1][j] = max(radii[0][i], row["a"]), max(radii[1][j], row["b"])
    directory = Directory.of(counts)
    books = Codebooks(books.cut, books.books, (radii[0], radii[1]))
    places = entries.sparkSession.createDataFrame(
        [(int(i) * width + int(j), int(directory.starts[i, j]), int(directory.parts[i, j])) for i, j in zip(*np.nonzero(counts))],
        "cell long, start long, parts long",
    )
    # A cell's rows are dealt over its blocks, whatever the vectors are.
    block = F.col("start") + F.pmod(F.xxhash64("vec", "label"), F.col("parts"))
    rows = rows.join(F.broadcast(places), "cell").select("cell", block.alias("block"), "vec", "label", "ids")
    return Index(stage(rows, "hard-index"), books, directory)


_PROBE = pa.schema(
    [("search", pa.int64()), ("block", pa.int64()), ("cells", pa.list_(pa.int64())), ("bound", pa.float64()),
     ("vec", pa.list_(pa.int32())), ("label", pa.int64()), ("same", pa.bool_()), ("low", pa.int64()),
     ("high", pa.int64())]
)
_PROBES = (
    "search long, block long, cells array<long>, bound double, vec array<int>, label long, "
    "same boolean, low long, high long"
)
#: What a search finds: an entry's score and ids.
_FOUND = "search long, score long, ids array<long>"
_FOUND_ARROW = pa.schema([("search", pa.int64()), ("score", pa.int64()), ("ids", pa.list_(pa.int64()))])
_OWN = ("vec", "label", "same", "low", "high")


def _probes(index_books: Codebooks, directory: Directory, skip: int, take: int):
    """For each search the blocks of its next ``take`` cells after ``skip``, and
    the bound of the cell after those (minus infinity, if there is none)."""
    width = len(index_books.books[1])

    def run(batches):
        for batch in batches:
            if not batch.num_rows:
                continue
            first, second = index_books.bounds(_vectors(batch.column("vec")))
            rows, blocks, cells, bounds = [], [], [], []
            for k in range(batch.num_rows):
                own: dict[int, list[int]] = {}
                n, bound = 0, -np.inf
                for sum_, i, j in cells_by_bound(first[k], second[k]):
                    if not directory.parts[i, j]:
                        continue
                    if n == skip + take:
                        bound = sum_
                        break
                    if n >= skip:
                        start = int(directory.starts[i, j])
                        for part in range(int(directory.parts[i, j])):
                            own.setdefault(start + part, []).append(i * width + j)
                    n += 1
                rows += [k] * len(own)
                blocks += own
                cells += own.values()
                bounds += [bound] * len(own)
            taken = batch.select(["search", *_OWN]).take(pa.array(rows, pa.int64()))
            yield pa.RecordBatch.from_arrays(
                [taken.column("search"), pa.array(blocks, pa.int64()), pa.array(cells, pa.list_(pa.int64())),
                 pa.array(bounds, pa.float64()), *(taken.column(n) for n in _OWN)],
                schema=_PROBE,
            )

    return run


def _search_block(rows: pa.Table, asked: pa.Table, most: int) -> pa.Table:
    """The ``most`` best entries of a block within each search's window."""
    if not len(rows) or not len(asked):
        return _FOUND_ARROW.empty_table()
    rows = rows.combine_chunks()
    ids = rows["ids"].combine_chunks()
    first_id = ids.flatten().to_numpy()[ids.offsets.to_numpy()[:-1] - ids.offsets.to_numpy()[0]]
    vectors, labels, cells = _vectors(rows["vec"]), rows["label"].to_numpy(), rows["cell"].to_numpy()
    wanted = _vectors(asked["vec"])
    column = {n: asked[n].to_numpy() for n in ("search", "label", "low", "high")}
    same = np.array(asked["same"].to_pylist(), bool)
    known, at = np.unique(cells, return_inverse=True)
    found: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
    step = max(1, SCORES // len(cells))
    for lo in range(0, len(wanted), step):
        part = slice(lo, lo + step)
        # Exact in doubles: see LIMIT.
        score = _scores(wanted[part], vectors)
        open_ = np.zeros((len(score), len(known)), bool)
        for k, own in enumerate(asked["cells"][lo : lo + step].to_pylist()):
            open_[k] = np.isin(known, own)
        fits = open_[:, at]
        fits &= (labels == column["label"][part, None]) == same[part, None]
        fits &= (score >= column["low"][part, None]) & (score <= column["high"][part, None])
        q, c = np.nonzero(fits)
        if not len(q):
            continue
        if len(q) > 4 * most * len(score):
            # Only rows that reach the score of the last place, ties included.
            held = np.where(fits, score, np.iinfo(np.int64).min)
            least = np.partition(held, -min(most, held.shape[1]), axis=1)[:, -min(most, held.shape[1])]
            near = score[q, c] >= least[q]
            q, c = q[near], c[near]
        own = score[q, c]
        order = np.lexsort((first_id[c], -own, q))
        q, c, own = q[order], c[order], own[order]
        place = np.arange(len(q)) - np.searchsorted(q, q, "left")
        keep = place < most
        found.append((column["search"][part][q[keep]], own[keep], c[keep]))
    if not found:
        return _FOUND_ARROW.empty_table()
    search, score, c = map(np.concatenate, zip(*found))
    return pa.Table.from_arrays([pa.array(search), pa.array(score), ids.take(pa.array(c))], schema=_FOUND_ARROW)


def _scores(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    most = left.shape[1] * (np.abs(left).max(initial=0) + 1) * (np.abs(right).max(initial=0) + 1)
    if most < 1 << 53:
        return (left @ right.T).astype(np.int64)
    return left.astype(np.int64) @ right.astype(np.int64).T


def _ranked(best: DataFrame, most: int) -> DataFrame:
    """(search, score, vec_id, place): the best rows of the entries found."""
    rows = best.select("search", "score", F.explode("ids").alias("vec_id"))
    by_row = Window.partitionBy("search").orderBy(F.desc("score"), "vec_id")
    return rows.withColumn("place", F.row_number().over(by_row)).filter(F.col("place") <= most)


def search(index: Index, searches: DataFrame, most: int) -> DataFrame:
    """(search, score, vec_id): the ``most`` best rows of each search, by score
    and id. searches: (search, vec, label, same, low, high); ``same`` asks for
    rows of the label, else for those of others."""
    open_ = stage(searches.select("search", *_OWN), "hard-searches")
    by_entry = Window.partitionBy("search").orderBy(F.desc("score"), F.col("ids")[0])
    n_cells = int((index.directory.parts > 0).sum())
    done, take, best = 0, FIRST_CELLS, None

    def run(rows: pa.Table, asked: pa.Table) -> pa.Table:
        return _search_block(rows, asked, most)

    while True:
        probes = stage(open_.mapInArrow(_probes(index.books, index.directory, done, take), _PROBES), "hard-probes")
        # A block's searches are split, and only for those parts is it copied.
        per_block = probes.groupBy("block").agg(F.ceil(F.count("*") / SEARCHES).cast("long").alias("parts"))
        dealt = probes.join(per_block, "block").withColumn("part", F.pmod(F.xxhash64("search"), F.col("parts")))
        copies = per_block.withColumn("part", F.explode(F.sequence(F.lit(0).cast("long"), F.col("parts") - 1)))
        rows = index.rows.join(copies.drop("parts"), "block")
        found = (
            rows.groupBy("block", "part")
            .cogroup(dealt.drop("parts").groupBy("block", "part"))
            .applyInArrow(run, _FOUND)
        )
        found = best.unionByName(found) if best is not None else found
        # Cut to the entries that matter before any shuffle.
        found = found.withColumn("_r", F.row_number().over(by_entry)).filter(F.col("_r") <= most).drop("_r")
        best = stage(found, "hard-best")
        done += take
        take = done * (GROWTH - 1)
        if done >= n_cells:
            break
        bounds = probes.groupBy("search").agg(F.first("bound").alias("bound"))
        last = _ranked(best, most).filter(F.col("place") == most).select("search", F.col("score").alias("last"))
        state = open_.join(bounds, "search").join(last, "search", "left")
        certified = (F.col("bound") < F.col("low")) | F.coalesce(F.col("last") > F.col("bound"), F.lit(False))
        open_ = stage(state.filter(~certified).select("search", *_OWN), "hard-searches")
        if open_.isEmpty():
            break
    return _ranked(best, most).drop("place")


def hard_negatives(
    rows: DataFrame,
    is_anchor: Column,
    positives: int = 5,
    negatives: int = 5,
    least: tuple[int, int] = (4, 5),
) -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score,
    negative_score) for the rows (vec_id, label, embedding) that ``is_anchor``,
    a condition on vec_id, picks. A negative scores at most what the positive
    does, and at least the part ``least`` of it."""
    most = max(positives + 1, negatives)
    given = stage(prepared(rows), "hard-rows")
    index = build(stage(_entries(given, most), "hard-entries"))
    schema = (
        "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long"
    )
    if index is None:
        return rows.sparkSession.createDataFrame([], schema)
    anchors = given.filter(is_anchor)
    groups = anchors.groupBy("vec", "label").agg(F.min("vec_id").alias("key"))
    # Rows that repeat an id with another vector or label have keys of their own.
    groups = stage(groups.withColumn("search", F.xxhash64("key", "vec", "label")), "hard-anchors")
    everything = 1 << 62
    first = groups.select(
        "search", "vec", "label", F.lit(True).alias("same"), F.lit(-everything).alias("low"),
        F.lit(everything).alias("high"),
    )
    near = stage(search(index, first, positives + 1), "hard-near")
    own = anchors.join(groups, ["vec", "label"]).select("search", F.col("vec_id").alias("anchor_id"))
    by_score = Window.partitionBy("search", "anchor_id").orderBy(F.desc("score"), "vec_id")
    pairs = (
        own.join(near, "search")
        .filter(F.col("vec_id") != F.col("anchor_id"))
        .withColumn("_r", F.row_number().over(by_score))
        .filter(F.col("_r") <= positives)
        .select("search", "anchor_id", F.col("vec_id").alias("positive_id"), F.col("score").alias("positive_score"))
    )
    pairs = stage(pairs, "hard-pairs")
    num, den = least
    # The least whole number that is at least num / den of the score; ``div``
    # cuts towards zero.
    low = F.expr(
        f"CASE WHEN positive_score >= 0 THEN (positive_score * {num} + {den - 1}) div {den} "
        f"ELSE (positive_score * {num}) div {den} END"
    )
    window = F.xxhash64("search", "positive_score").alias("window")
    windows = pairs.select("search", "positive_score").distinct().select("*", low.alias("low"), window)
    asked = windows.filter(F.col("low") <= F.col("positive_score")).join(groups.drop("key"), "search")
    second = asked.select(
        F.col("window").alias("search"), "vec", "label", F.lit(False).alias("same"), "low",
        F.col("positive_score").alias("high"),
    )
    below = search(index, second, negatives)
    below = below.select(
        F.col("search").alias("window"), F.col("score").alias("negative_score"), F.col("vec_id").alias("negative_id")
    )
    order = Window.partitionBy("anchor_id", "positive_id", "search").orderBy(F.desc("negative_score"), "negative_id")
    return (
        pairs.withColumn("window", window)
        .join(below, "window")
        .withColumn("rank", F.row_number().over(order))
        .select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")
    )

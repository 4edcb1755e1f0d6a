"""Nearest neighbours by inner product, by multi-index hashing.

Vectors are put on a sphere (one more coordinate, so that the order by inner
product is the order by distance), centred, and turned by rotations learned on
a bounded sample (alternating sign and orthogonal fits from several starts);
the signs are the binary codes. Codes are cut into substrings, and one table
holds every code under the number and value of each of its substrings. A query
probes every value within that substring's share of the Hamming radius: an
equi-join, which by the pigeonhole principle finds every code within the radius.
The codes found are checked as a whole and reranked by their floats. Values
that many codes share are salted: their codes are dealt over several keys, all
of which a probe asks for.

What a width of the substrings costs a query (values probed, codes met, codes
within the radius) is measured on the sample; the cheapest width is used. Where
comparing all codes costs less than any width, as it does for codes that are
nearly random, blocks of queries meet blocks of the index instead: the same
codes are found.

The radius is learned with a bounded number of queries, whose true neighbours
are looked for among all vectors, so that ``recall`` of them lie within it; it
shrinks as the vectors get denser. Queries that find fewer than they should are
searched again with twice the radius, for as long as probing pays, and then
without one, so results are never short.

Equal vectors are indexed once, with their ``k + 1`` smallest ids (a query can
use no more), and equal queries are searched once, so a vector that a third of
all rows share costs no more than another. Blocks have bounded sizes.

Defined results: vectors that are null, empty, zero, or hold null or non-finite
components take no part, nor do rows without an id or vectors of another length
than most (the shorter one, in a tie). Repeated rows count once; a row is no
candidate for a query of its own id. Ties go to the smaller id.
"""

from __future__ import annotations

from dataclasses import dataclass, replace
from functools import reduce
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import stage

#: The sample for rotations and costs: at most so many rows, and values in all.
#: Its first rows are the queries that the radius is learned with.
SAMPLE_ROWS = 8192
SAMPLE_VALUES = 1 << 21
SAMPLE_QUERIES = 512
CALIBRATED_ROWS = 2048
ROTATIONS = 4
ROTATION_BITS = 64
SUBSTRING = 16
#: Widths to choose from, for the index of all codes.
WIDTHS = (8, 16, 32)
#: Costs, in those of one code met by a probe: a value probed, a code within the
#: radius (its vector is fetched), a code compared in a block.
PROBE_COST, NEAR_COST, SCAN_COST = 1.0, 8.0, 0.5
#: The least radius of a second round.
MIN_GROWN = 8
#: Values are counted in so many slots; those in slots of more codes than this,
#: and than four times the mean, are dealt over several keys.
SLOTS = 1 << 16
HOT_CODES = 10_000
INDEX_BLOCK = 16_384
QUERY_BLOCK = 2_048
PAIRS = 1 << 18


@dataclass(frozen=True)
class Coder:
    """Learned codes: the sphere's radius, centre and rotations."""

    norm: float
    mean: np.ndarray
    planes: np.ndarray
    radius: int
    #: Rounds of the search: radius, and width of the index or None for blocks.
    rounds: tuple[tuple[int, int | None], ...] = ()

    @property
    def bits(self) -> int:
        return self.planes.shape[1]

    def lifted(self, vectors: np.ndarray, query: bool) -> np.ndarray:
        """Index vectors get the missing length as one more coordinate; queries
        are scaled to the sphere."""
        if query:
            lengths = np.linalg.norm(vectors, axis=1, keepdims=True)
            return np.hstack([vectors / lengths * self.norm, np.zeros((len(vectors), 1))])
        rest = np.clip(self.norm**2 - (vectors**2).sum(axis=1, keepdims=True), 0, None)
        return np.hstack([vectors, np.sqrt(rest)])

    def codes(self, vectors: np.ndarray, query: bool) -> np.ndarray:
        """Rows of uint64 words; the last word is padded with zeros."""
        signs = (self.lifted(vectors, query) - self.mean) @ self.planes > 0
        packed = np.packbits(signs, axis=1)
        padded = np.zeros((len(vectors), -(-packed.shape[1] // 8) * 8), np.uint8)
        padded[:, : packed.shape[1]] = packed
        return padded.view(np.uint64)


def _rotation(points: np.ndarray, start: np.ndarray, steps: int = 25) -> np.ndarray:
    """The rotation that brings points near to the corners of a cube."""
    turn = start
    for _ in range(steps):
        left, _, right = np.linalg.svd(points.T @ np.sign(points @ turn))
        turn = left @ right
    return turn


def hamming(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    return np.bitwise_count(left ^ right).sum(axis=-1, dtype=np.int64)


def learn(sample: np.ndarray, norm: float) -> Coder:
    """A coder from a sample of distinct vectors, without a radius yet."""
    rng = np.random.default_rng(7)
    blank = Coder(norm, np.zeros(sample.shape[1] + 1), np.zeros((sample.shape[1] + 1, 1)), 0)
    points = blank.lifted(sample, False)
    mean = points.mean(axis=0)
    centred = points - mean
    _, vectors = np.linalg.eigh(centred.T @ centred)
    main = vectors[:, ::-1][:, : min(ROTATION_BITS, sample.shape[1])]
    flat, planes = centred @ main, []
    for _ in range(ROTATIONS):
        start, _ = np.linalg.qr(rng.standard_normal((main.shape[1], main.shape[1])))
        planes.append(main @ _rotation(flat, start))
    return Coder(norm, mean, np.hstack(planes), 0)


def _neighbours_apart(coded: DataFrame, queries: np.ndarray, keys: np.ndarray, coder: Coder, k: int) -> np.ndarray:
    """Hamming distances between a few queries (keys: rows of key, hash) and
    their true k nearest rows of the whole index. A task keeps k of each query."""
    wanted = coder.codes(queries, True)

    def run(batches):
        score, apart = np.zeros((len(queries), 0)), np.zeros((len(queries), 0), np.int64)
        for batch in batches:
            for lo in range(0, batch.num_rows, CALIBRATED_ROWS):
                part = batch.slice(lo, CALIBRATED_ROWS)
                own, codes = _matrix(part.column("vec"), np.float64), _matrix(part.column("code"), np.uint64)
                met = queries @ own.T
                for at, column in enumerate(("key", "hash")):
                    same = keys[:, at, None] == part.column(column).to_numpy()
                    itself = same if at == 0 else itself & same
                met[itself] = -np.inf
                best = np.argsort(-met, axis=1)[:, :k]
                near = hamming(wanted[:, None], codes[best])
                score = np.hstack([score, np.take_along_axis(met, best, 1)])
                apart = np.hstack([apart, near])
                best = np.argsort(-score, axis=1)[:, :k]
                score, apart = np.take_along_axis(score, best, 1), np.take_along_axis(apart, best, 1)
        query, _ = np.indices(score.shape)
        known = score > -np.inf
        if known.any():
            columns = (query[known], score[known], apart[known])
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names=["query", "score", "apart"])

    found = coded.select("key", "hash", "vec", "code").mapInArrow(run, "query long, score double, apart long")
    order = Window.partitionBy("query").orderBy(F.desc("score"), "apart")
    best = found.withColumn("_r", F.row_number().over(order)).filter(F.col("_r") <= k)
    return np.array([row["apart"] for row in best.select("apart").collect()], np.int64)


def calibrated(coder: Coder, coded: DataFrame, sample: np.ndarray, keys: np.ndarray, total: int, k: int, recall: float):
    """The coder with a radius that holds ``recall`` of the true neighbours of
    the sample's first rows, and the rounds that find them at the least cost."""
    queries = sample[:SAMPLE_QUERIES]
    apart = _neighbours_apart(coded, queries, keys[: len(queries)], coder, k)
    if not len(apart):
        return replace(coder, radius=coder.bits, rounds=((coder.bits, None),))
    radius = int(np.quantile(apart, recall, method="higher"))
    asked, codes = coder.codes(queries, True), coder.codes(sample, False)
    return replace(coder, radius=radius, rounds=search_rounds(asked, codes, coder.bits, radius, total))


def shares(bits: int, width: int, radius: int) -> list[int]:
    """What each substring may differ by. If all differed by more, the codes
    would be further apart than the radius. -1: the substring needn't be probed."""
    parts = -(-bits // width)
    least, rest = divmod(radius, parts)
    return [least - (part > rest) for part in range(parts)]


def cheapest_width(asked: np.ndarray, codes: np.ndarray, bits: int, radius: int, total: int) -> int | None:
    """The width by which the sample's queries would find all of ``total`` codes
    within the radius at the least cost; None where comparing all costs less."""
    best, cheapest = None, SCAN_COST * total
    scale = total / (len(asked) * len(codes))
    close = sum(int((hamming(query, codes) <= radius).sum()) for query in asked)
    for width in WIDTHS:
        probes = shares(bits, width, radius)
        cost = PROBE_COST * sum(_n_masks(width, share) for share in probes) + NEAR_COST * close * scale
        if cost >= cheapest:
            continue
        own, wanted = (x.view(f"u{width // 8}") for x in (codes, asked))
        for part, share in enumerate(probes):
            near = np.bitwise_count(wanted[:, part, None] ^ own[:, part]) <= share
            cost += int(near.sum()) * scale
        if cost < cheapest:
            best, cheapest = width, cost
    return best


def search_rounds(asked: np.ndarray, codes: np.ndarray, bits: int, radius: int, total: int):
    """Radii to search with, one after the other, until a query has enough."""
    width = cheapest_width(asked, codes, bits, radius, total)
    rounds = [(radius, width)]
    while width is not None:
        radius = min(bits, max(2 * radius, MIN_GROWN))
        width = cheapest_width(asked, codes, bits, radius, total)
        rounds.append((radius, width) if width is not None else (bits, None))
    if rounds[-1][0] < bits:
        rounds.append((bits, None))
    return tuple(rounds)


def _masks(bits: int, most: int) -> np.ndarray:
    """All values of so many bits with at most ``most`` set."""
    found = [0]
    for n in range(1, most + 1):
        found += [sum(1 << b for b in chosen) for chosen in combinations(range(bits), n)]
    return np.array(found, np.int64)


def _n_masks(bits: int, most: int) -> int:
    n, total = 1, 1
    for i in range(1, min(most, bits) + 1):
        n = n * (bits - i + 1) // i
        total += n
    return total


def _probed(codes: np.ndarray, queries: np.ndarray, radius: int):
    """Pairs (query, code) that share a substring within its part of the radius."""
    parts = codes.view(np.uint16).shape[1]
    share = radius // parts
    masks = _masks(SUBSTRING, share)
    own, asked = codes.view(np.uint16), queries.view(np.uint16)
    for part in range(parts):
        order = np.argsort(own[:, part], kind="stable")
        starts = np.searchsorted(own[order, part], np.arange((1 << SUBSTRING) + 1))
        step = max(1, PAIRS // len(masks))
        for lo in range(0, len(queries), step):
            values = asked[lo : lo + step, part, None].astype(np.int64) ^ masks
            counts = (starts[values + 1] - starts[values]).ravel()
            hit = np.flatnonzero(counts)
            counts = counts[hit]
            begins = starts[values.ravel()[hit]]
            within = np.arange(counts.sum()) - np.repeat(np.cumsum(counts) - counts, counts)
            yield np.repeat(lo + hit // len(masks), counts), order[np.repeat(begins, counts) + within]


def _scanned(codes: np.ndarray, queries: np.ndarray):
    step = max(1, PAIRS // max(1, len(codes)))
    for lo in range(0, len(queries), step):
        n = len(queries[lo : lo + step])
        yield np.repeat(np.arange(lo, lo + n), len(codes)), np.tile(np.arange(len(codes)), n)


def within_radius(codes: np.ndarray, queries: np.ndarray, radius: int):
    """All pairs (query, code) within the radius, in chunks; a pair may come in
    more than one chunk."""
    parts = codes.view(np.uint16).shape[1]
    if parts * _n_masks(SUBSTRING, radius // parts) < len(codes):
        chunks = _probed(codes, queries, radius)
    else:
        chunks = _scanned(codes, queries)
    for q, c in chunks:
        near = hamming(queries[q], codes[c]) <= radius
        yield q[near], c[near]


def _best(q, c, score, first_id, most: int):
    """The best of each query, by score, then id; each pair once."""
    order = np.lexsort((first_id[c], -score, q))
    q, c, score = q[order], c[order], score[order]
    again = np.zeros(len(q), bool)
    again[1:] = (q[1:] == q[:-1]) & (c[1:] == c[:-1])
    q, c, score = q[~again], c[~again], score[~again]
    starts = np.searchsorted(q, q, "left")
    keep = np.arange(len(q)) - starts < most
    return q[keep], c[keep], score[keep]


_FOUND = "qkey long, qhash long, ids array<long>, score double"
_FOUND_ARROW = pa.schema(
    [("qkey", pa.int64()), ("qhash", pa.int64()), ("ids", pa.list_(pa.int64())), ("score", pa.float64())]
)


def _matrix(column, dtype) -> np.ndarray:
    rows = column.to_pylist()
    return np.frombuffer(b"".join(rows), dtype).reshape(len(rows), -1)


def _search_block(index: pa.Table, asked: pa.Table, radius: int, most: int) -> pa.Table:
    if not len(index) or not len(asked):
        return _FOUND_ARROW.empty_table()
    codes, queries = _matrix(index["code"], np.uint64), _matrix(asked["code"], np.uint64)
    vectors, wanted = _matrix(index["vec"], np.float64), _matrix(asked["vec"], np.float64)
    ids = index["ids"].to_pylist()
    first = np.array([own[0] for own in ids], np.int64)
    kept = (np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0))
    pending, n = [kept], 0
    for q, c in within_radius(codes, queries, radius):
        score = np.einsum("ij,ij->i", wanted[q], vectors[c])
        pending.append(_best(q, c, score, first, most))
        n += len(pending[-1][0])
        if n > 4 * PAIRS:
            pending = [_best(*map(np.concatenate, zip(*pending)), first, most)]
            n = len(pending[0][0])
    q, c, score = _best(*map(np.concatenate, zip(*pending)), first, most)
    return pa.Table.from_arrays(
        [asked["qkey"].take(pa.array(q)), asked["qhash"].take(pa.array(q)),
         pa.array([ids[i] for i in c], pa.list_(pa.int64())), pa.array(score)],
        schema=_FOUND_ARROW,
    )


def _coded(rows: DataFrame, coder: Coder, query: bool) -> DataFrame:
    """Rows with the vector as bytes (doubles) and its code."""
    kept = [f for f in rows.schema if f.name != "embedding"]
    names = [f.name for f in kept]
    schema = T.StructType([*kept, T.StructField("vec", T.BinaryType()), T.StructField("code", T.BinaryType())])

    def run(batches):
        for batch in batches:
            if batch.num_rows:
                column = batch.column("embedding")
                vectors = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
                vectors = vectors.reshape(batch.num_rows, -1)
                made = [
                    pa.array([row.tobytes() for row in x], pa.binary())
                    for x in (vectors, coder.codes(vectors, query))
                ]
                yield pa.RecordBatch.from_arrays(
                    [*(batch.column(n) for n in names), *made], names=[*names, "vec", "code"]
                )

    return rows.mapInArrow(run, schema)


def _usable(vectors: DataFrame) -> DataFrame:
    """(vec_id, embedding), each pair once, of the rows that take part."""
    v = F.col("embedding")
    finite = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    rows = vectors.select(F.col("vec_id").cast("long"), "embedding").filter(
        F.col("vec_id").isNotNull() & v.isNotNull() & finite & F.exists(v, lambda x: x != 0)
    )
    sizes = rows.groupBy(F.size(v).alias("d")).agg(F.count("*").alias("n"))
    usual = sizes.orderBy(F.desc("n"), "d").first()
    if usual is None:
        return rows.limit(0)
    return rows.filter(F.size(v) == usual["d"]).dropDuplicates(["vec_id", "embedding"])


def _in_blocks(index: DataFrame, asked: DataFrame, radius: int, most: int, blocks: int, parts: int) -> DataFrame:
    left = index.withColumn("part", F.explode(F.sequence(F.lit(0), F.lit(parts - 1))))
    right = asked.withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))))

    def run(own: pa.Table, queries: pa.Table) -> pa.Table:
        return _search_block(own, queries, radius, most)

    return left.groupBy("block", "part").cogroup(right.groupBy("block", "part")).applyInArrow(run, _FOUND)


def _addresses(rows: DataFrame, width: int, probes: list[int]) -> DataFrame:
    """(key, hash, words, part, value) for every value within ``probes`` of a
    substring of a row's code; an own value has a distance of 0."""
    masks = [_masks(width, share) if share >= 0 else np.zeros(0, np.int64) for share in probes]

    def run(batches):
        for batch in batches:
            codes = _matrix(batch.column("code"), np.uint64)
            own = codes.view(f"u{width // 8}")
            for part, mask in enumerate(masks):
                step = max(1, PAIRS // max(1, len(mask)))
                for lo in range(0, len(codes) if len(mask) else 0, step):
                    values = own[lo : lo + step, part, None].astype(np.int64) ^ mask
                    rows = np.repeat(np.arange(lo, lo + len(values)), len(mask))
                    words = codes[rows].view(np.int64)
                    ends = np.arange(0, words.size + 1, words.shape[1], dtype=np.int32)
                    yield pa.RecordBatch.from_arrays(
                        [batch.column("key").take(pa.array(rows)), batch.column("hash").take(pa.array(rows)),
                         pa.ListArray.from_arrays(pa.array(ends), pa.array(words.ravel())),
                         pa.array(np.full(len(rows), part, np.int32)), pa.array(values.ravel())],
                        names=["key", "hash", "words", "part", "value"],
                    )

    return rows.mapInArrow(run, "key long, hash long, words array<long>, part int, value long")


def _slot() -> Column:
    return F.pmod(F.xxhash64("part", "value"), F.lit(SLOTS)).cast("int").alias("slot")


def _hot_slots(entries: DataFrame) -> DataFrame:
    """(slot, salts): slots of many codes. No more than a quarter of all slots
    hold over four times the mean, so that is the most rows there are."""
    counts = entries.groupBy(_slot()).agg(F.count("*").alias("n"))
    total = counts.agg(F.sum("n")).first()[0] or 0
    limit = max(HOT_CODES, 4 * total // SLOTS)
    return counts.filter(F.col("n") > limit).select("slot", F.ceil(F.col("n") / limit).cast("int").alias("salts"))


def within_radius_by_index(coded: DataFrame, asked: DataFrame, radius: int, width: int, bits: int) -> DataFrame:
    """(qkey, qhash, key, hash): each pair of a query (key, hash, code) and a
    code of the index (key, hash, code) within the radius, once."""
    probes = shares(bits, width, radius)
    entries = _addresses(coded, width, [0 if share >= 0 else -1 for share in probes])
    hot = stage(_hot_slots(entries), "ann-hot")

    def salted(rows: DataFrame, salt) -> DataFrame:
        rows = rows.withColumn("slot", _slot()).join(F.broadcast(hot), "slot", "left")
        return rows.withColumn("salt", salt(F.coalesce("salts", F.lit(1)))).drop("slot", "salts")

    entries = salted(entries, lambda n: F.pmod(F.xxhash64("key", "hash"), n).cast("int"))
    wanted = _addresses(asked, width, probes).withColumnsRenamed({"key": "qkey", "hash": "qhash", "words": "qwords"})
    wanted = salted(wanted, lambda n: F.explode(F.sequence(F.lit(0), n - 1)))
    n_words = -(-bits // 64)
    met = wanted.join(entries, ["part", "value", "salt"]).select(
        "qkey", "qhash", "key", "hash", "part",
        *(F.col("qwords")[w].bitwiseXOR(F.col("words")[w]).alias(f"_x{w}") for w in range(n_words)),
    )
    apart = sum((F.bit_count(f"_x{w}") for w in range(1, n_words)), F.bit_count("_x0"))
    # A pair counts where its first substring within its share meets.
    earlier = F.lit(False)
    for part, share in enumerate(probes):
        if share >= 0:
            word, at = divmod(part * width, 64)
            differing = F.shiftrightunsigned(f"_x{word}", at).bitwiseAND(F.lit((1 << width) - 1))
            earlier = earlier | ((F.col("part") > part) & (F.bit_count(differing) <= share))
    return met.filter(apart <= radius).filter(~earlier).select("qkey", "qhash", "key", "hash")


def _by_index(index: DataFrame, asked: DataFrame, radius: int, width: int, bits: int) -> DataFrame:
    """The codes within the radius, scored by their vectors."""
    queries = asked.withColumnsRenamed({"qkey": "key", "qhash": "hash"})
    pairs = within_radius_by_index(
        index.select("key", "hash", "code"), queries.select("key", "hash", "code"), radius, width, bits
    )
    pairs = pairs.join(index.select("key", "hash", "ids", F.col("vec").alias("own")), ["key", "hash"])
    pairs = pairs.join(asked.select("qkey", "qhash", "vec"), ["qkey", "qhash"])

    def run(batches):
        for batch in batches:
            if batch.num_rows:
                own, wanted = _matrix(batch.column("own"), np.float64), _matrix(batch.column("vec"), np.float64)
                score = pa.array(np.einsum("ij,ij->i", wanted, own))
                kept = [batch.column(name) for name in ("qkey", "qhash", "ids")]
                yield pa.RecordBatch.from_arrays([*kept, score], names=["qkey", "qhash", "ids", "score"])

    return pairs.select("qkey", "qhash", "ids", "own", "vec").mapInArrow(run, _FOUND)


def _best_rows(found: DataFrame, most: int) -> DataFrame:
    """(qkey, qhash, vec_id, score): the best rows of each distinct query."""
    by_vector = Window.partitionBy("qkey", "qhash").orderBy(F.desc("score"), F.col("ids")[0])
    best = found.withColumn("_r", F.row_number().over(by_vector)).filter(F.col("_r") <= most)
    rows = best.select("qkey", "qhash", "score", F.explode("ids").alias("vec_id"))
    by_row = Window.partitionBy("qkey", "qhash").orderBy(F.desc("score"), "vec_id")
    return rows.withColumn("_r", F.row_number().over(by_row)).filter(F.col("_r") <= most).drop("_r")


def nearest(vectors: DataFrame, is_query, k: int = 20, recall: float = 0.97) -> DataFrame:
    """(query_id, rank, vec_id, score): the k nearest of the rows (vec_id,
    embedding) for those that ``is_query`` (a condition) picks."""
    most = k + 1
    rows = stage(_usable(vectors), "ann-rows")
    by_id = Window.partitionBy("embedding").orderBy("vec_id")
    index = (
        rows.withColumn("_r", F.row_number().over(by_id))
        .filter(F.col("_r") <= most)
        .groupBy("embedding")
        .agg(F.array_sort(F.collect_list("vec_id")).alias("ids"))
    )
    index = stage(index, "ann-distinct")
    length = F.sqrt(F.aggregate("embedding", F.lit(0.0), lambda a, x: a + x.cast("double") * x.cast("double")))
    facts = index.agg(F.count("*").alias("n"), F.max(length).alias("norm"), F.max(F.size("embedding")).alias("d")).first()
    wanted = rows.filter(is_query)
    if not facts["n"] or wanted.isEmpty():
        return wanted.select(
            F.col("vec_id").alias("query_id"), F.lit(1).alias("rank"), "vec_id", F.lit(0.0).alias("score")
        ).limit(0)
    size = max(2, min(SAMPLE_ROWS, SAMPLE_VALUES // facts["d"]))
    own_key = {"key": F.col("ids")[0], "hash": F.xxhash64("embedding")}
    sample = index.withColumns(own_key).orderBy(F.xxhash64("key"), "key", "hash").limit(size)
    sample = sample.select("key", "hash", "embedding").collect()
    known = np.array([row["embedding"] for row in sample], np.float64)
    keys = np.array([(row["key"], row["hash"]) for row in sample], np.int64)
    coder = learn(known, facts["norm"])

    blocks = -(-facts["n"] // INDEX_BLOCK)
    block = F.pmod(F.xxhash64(F.col("ids")[0], F.lit(1)), F.lit(blocks)).cast("int")
    coded = stage(_coded(index.withColumns({"block": block, **own_key}), coder, False), "ann-index")
    coder = calibrated(coder, coded, known, keys, facts["n"], k, recall)
    asked = wanted.groupBy("embedding").agg(F.min("vec_id").alias("qkey"))
    asked = asked.withColumn("qhash", F.xxhash64("embedding"))
    asked = stage(_coded(asked, coder, True), "ann-queries")
    parts = -(-asked.count() // QUERY_BLOCK)
    asked = asked.withColumn("part", F.pmod(F.xxhash64("qkey", "qhash"), F.lit(parts)).cast("int"))

    enough = min(most, rows.limit(most).count())
    results, short = [], asked
    for radius, width in coder.rounds:
        if width is None:
            hits = _in_blocks(coded, short, radius, most, blocks, parts)
        else:
            hits = _by_index(coded, short, radius, width, coder.bits)
        best = stage(_best_rows(hits, most), "ann-found")
        if radius >= coder.bits:
            results.append(best)
            break
        full = best.groupBy("qkey", "qhash").agg(F.count("*").alias("n")).filter(F.col("n") >= enough)
        results.append(best.join(full, ["qkey", "qhash"], "left_semi"))
        short = stage(short.join(full, ["qkey", "qhash"], "left_anti"), "ann-short")
        if short.isEmpty():
            break
    found = reduce(DataFrame.unionByName, results)

    ids = wanted.groupBy("embedding").agg(F.min("vec_id").alias("qkey")).withColumn("qhash", F.xxhash64("embedding"))
    ids = wanted.join(ids, "embedding").select("qkey", "qhash", F.col("vec_id").alias("query_id"))
    order = Window.partitionBy("query_id", "qkey", "qhash").orderBy(F.desc("score"), "vec_id")
    return (
        ids.join(found, ["qkey", "qhash"])
        .filter(F.col("vec_id") != F.col("query_id"))
        .withColumn("rank", F.row_number().over(order))
        .filter(F.col("rank") <= k)
        .select("query_id", "rank", "vec_id", "score")
    )

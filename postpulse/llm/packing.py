"""Best-fit packing of documents into bins of a token capacity.

Bins are ordered by the room they have left. A document goes into the tightest
bin that is compatible with it: each bin carries bitmaps of its sources and of
its duplicate clusters, and the search goes on to the next larger residual
until a bin has neither the document's cluster nor ``per_source`` documents of
its source. (The source bitmap has a layer for each of them: bit s of layer k
says that source s is there k times.) Longer documents fill bins of their own
with whole pieces first; what is left of them is packed like any other.

Documents are dealt by hash to shards of about ``shard_rows``, equal rows in
turn to one shard after the other; shards are
packed side by side, largest documents first, and share no bins, so a cluster
or source that holds a third of all rows is met by every shard in part.

Defined results: a document without words has one row without a bin; null
sources are one source; a null cluster conflicts with nothing; repeated rows
are packed each for itself; ties in size go by document id, then cluster.
"""

from __future__ import annotations

from collections import Counter

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

CAPACITY = 2048
PER_SOURCE = 4
SHARD_ROWS = 4096
#: Repeated rows are numbered in blocks of so many.
REPEATS = 4096
RESULT = (
    "doc_id long, source string, cluster long, size long, "
    "piece int, start long, n long, bin long, position long"
)


class Bins:
    """The bins of one shard."""

    def __init__(self, capacity: int, per_source: int) -> None:
        self.capacity = capacity
        self.clusters: list[int] = []
        self.sources: list[list[int]] = []
        self.layers = per_source
        self.by_room: dict[int, list[int]] = {}
        self.rooms = 0  # bit r: some bin has r left

    def _open(self, room: int, k: int) -> None:
        self.by_room.setdefault(room, []).append(k)
        self.rooms |= 1 << room

    def _new(self) -> int:
        self.clusters.append(0)
        self.sources.append([0] * self.layers)
        return len(self.clusters) - 1

    def place(self, size: int, source: int, cluster: int) -> tuple[int, int]:
        """The bin and the position in it. source: a bit; cluster: a bit or 0."""
        room, k = self._tightest(size, source, cluster)
        if k is None:
            room, k = self.capacity, self._new()
        else:
            own = self.by_room[room]
            own.remove(k)
            if not own:
                del self.by_room[room]
                self.rooms ^= 1 << room
        self.clusters[k] |= cluster
        for i, layer in enumerate(self.sources[k]):
            if not layer & source:
                self.sources[k][i] = layer | source
                break
        self._open(room - size, k)
        return k, self.capacity - room

    def _tightest(self, size: int, source: int, cluster: int) -> tuple[int, int | None]:
        left = self.rooms >> size
        room = size
        while left:
            step = (left & -left).bit_length() - 1
            room += step
            for k in self.by_room[room]:
                if not self.clusters[k] & cluster and not self.sources[k][-1] & source:
                    return room, k
            left >>= step + 1
            room += 1
        return 0, None


def _pack_shard(table: pa.Table, capacity: int, per_source: int) -> pa.Table:
    rows = table.select(["doc_id", "source", "cluster", "size"]).to_pylist()
    shard = table["_shard"][0].as_py()
    several = Counter(row["cluster"] for row in rows if row["cluster"] is not None)
    bits: dict[int, int] = {}
    sources: dict[str | None, int] = {}
    bins = Bins(capacity, per_source)
    out = []

    def order(row):
        doc, cluster = row["doc_id"], row["cluster"]
        return -(row["size"] % capacity), doc is None, doc or 0, cluster is None, cluster or 0

    for row in sorted(rows, key=order):
        full, rest = divmod(row["size"], capacity)
        for piece in range(full):
            k = bins._new()
            out.append(row | {"piece": piece, "start": piece * capacity, "n": capacity, "bin": k, "position": 0})
        if rest:
            cluster = row["cluster"]
            bit = 0
            if cluster is not None and several[cluster] > 1:
                bit = bits.setdefault(cluster, 1 << len(bits))
            source = sources.setdefault(row["source"], 1 << len(sources))
            k, position = bins.place(rest, source, bit)
            out.append(
                row | {"piece": full, "start": full * capacity, "n": rest, "bin": k, "position": position}
            )
        elif not full:
            out.append(row | {"piece": 0, "start": 0, "n": 0, "bin": None, "position": None})
    for row in out:
        if row["bin"] is not None:
            row["bin"] += shard << 32
    schema = pa.schema(
        [("doc_id", pa.int64()), ("source", pa.string()), ("cluster", pa.int64()), ("size", pa.int64()),
         ("piece", pa.int32()), ("start", pa.int64()), ("n", pa.int64()), ("bin", pa.int64()),
         ("position", pa.int64())]
    )
    return pa.Table.from_pylist(out, schema)


def pack(
    docs: DataFrame,
    capacity: int = CAPACITY,
    per_source: int = PER_SOURCE,
    shard_rows: int = SHARD_ROWS,
) -> DataFrame:
    """One row per piece of (doc_id, source, cluster, size): which words of the
    document it holds (start, n), its bin and its position there. ``docs``
    should be stored rows: they are counted, then packed."""
    docs = docs.select(
        F.col("doc_id").cast("long"), F.col("source").cast("string"),
        F.col("cluster").cast("long"), F.col("size").cast("long"),
    )
    shards = max(1, -(-docs.count() // shard_rows))
    first = F.pmod(F.xxhash64(*docs.columns), F.lit(shards))
    shard = F.pmod(first + F.col("_block") * REPEATS + F.col("_at"), F.lit(shards)).cast("long")

    def run(table: pa.Table) -> pa.Table:
        return _pack_shard(table, capacity, per_source)

    # Equal rows are counted and numbered, in blocks that bound the arrays.
    last = F.floor((F.col("_n") - 1) / REPEATS)
    numbered = (
        docs.groupBy(*docs.columns)
        .agg(F.count("*").alias("_n"))
        .withColumn("_block", F.explode(F.sequence(F.lit(0).cast("long"), last)))
        .withColumn("_in", F.least(F.lit(REPEATS).cast("long"), F.col("_n") - F.col("_block") * REPEATS))
        .withColumn("_at", F.explode(F.sequence(F.lit(0).cast("long"), F.col("_in") - 1)))
    )
    dealt = numbered.select(*docs.columns, shard.alias("_shard"))
    return dealt.groupBy("_shard").applyInArrow(run, RESULT)

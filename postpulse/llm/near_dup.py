"""Near duplicates by BagMinHash: weighted-Jaccard signatures, bands, and
verified multiset overlap.

A document is the multiset of its five-word shingles (one shingle of all words
where it has fewer). Every shingle owns independent Poisson processes, one for
each dyadic interval of its weight (0 to 1, 1 to 2, 2 to 4, ...), whose points
carry a time, a signature component and a place in the interval; the points
below the shingle's count belong to the document, and the earliest of them in
each component is its signature. Two documents agree in a component with a
probability of exactly their weighted Jaccard similarity. Points are only
generated until every component has one, some m log m per document.

Signatures are cut into bands; documents that share a band meet in a bucket.
Equal texts are one class before that. In a bucket documents are compared with
its best connected member: a large group of near copies joins without its
pairs. What is still apart is compared in blocks, each pair of blocks in one
task, which counts what texts share by the holders of each shingle and gives
only the edges that join classes. So every similar pair that shares a bucket is
found or in one class at the end. A comparison counts the shingles of both
texts exactly.

Defined results: null and empty texts have no shingles and are a class each;
rows that repeat an id belong to the classes of their own texts; rows without an
id are classed by their texts, too, and named by the smallest id of their class
(null, if none has one). An empty table gives no rows.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import stage
from .components import components
from .words import Piece, free, give_back, likely, lists, maybe, mix, pieces, span_hashes

SHINGLE = 5
BANDS, ROWS = 24, 4
#: Similarity of 0.8 or more, as a fraction.
SIMILAR = (4, 5)
#: Documents, and shingles, of a block (about).
BLOCK_ROWS = 512
BLOCK_TOKENS = 1 << 19
#: Holders of shingles that a step counts.
HOLDERS = 1 << 19

_NEXT = np.uint64(0x9E3779B97F4A7C15)
_COMPONENT = np.uint64(0xA0761D6478BD642F)
_PLACE = np.uint64(0xE7037ED1A0B428DB)


def shingles(piece: Piece) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(text, shingle hash, count), by text."""
    words = piece.word_hashes()
    size = np.minimum(piece.n_words, SHINGLE)
    last = np.repeat(piece.word_bounds[1:] - size, piece.n_words)
    first = np.flatnonzero(np.arange(len(words)) <= last)
    docs = piece.word_docs()[first]
    hashes = span_hashes(words, first, first + size[docs])
    order = np.lexsort((hashes, docs))
    docs, hashes = docs[order], hashes[order]
    new = np.ones(len(docs), bool)
    new[1:] = (docs[1:] != docs[:-1]) | (hashes[1:] != hashes[:-1])
    at = np.flatnonzero(new)
    return docs[at], hashes[at], np.diff(np.append(at, len(docs)))


def _uniform(bits: np.ndarray) -> np.ndarray:
    return ((bits >> np.uint64(11)).astype(np.float64) + 0.5) * 2.0**-53


def bag_minhash(docs, hashes, counts, n: int, m: int) -> np.ndarray:
    """Signatures (n x m) of the multisets; all zero for an empty one."""
    row, low, width = [np.arange(len(docs))], [np.zeros(len(docs))], [np.ones(len(docs))]
    edge = 1
    while len(more := np.flatnonzero(counts > edge)):
        row.append(more)
        low.append(np.full(len(more), float(edge)))
        width.append(np.full(len(more), float(edge)))
        edge *= 2
    row, low, width = map(np.concatenate, (row, low, width))
    doc, count = docs[row], counts[row]
    seed = mix(hashes[row] ^ mix(low.astype(np.uint64) + _NEXT))
    total = np.bincount(docs, weights=counts, minlength=n)
    limit = (np.log(m) + 3) / np.maximum(total, 1)

    drawn = np.zeros(len(row), np.uint64)
    bits = np.zeros(len(row), np.uint64)
    time = np.zeros(len(row))

    def draw(at):
        drawn[at] += np.uint64(1)
        bits[at] = mix(seed[at] + drawn[at] * _NEXT)
        time[at] -= np.log(_uniform(bits[at])) / (m * width[at])

    best, name = np.full(n * m, np.inf), np.zeros(n * m, np.uint64)
    draw(np.arange(len(row)))
    while True:
        at = np.flatnonzero(time <= limit[doc])
        while len(at):
            place = low[at] + width[at] * _uniform(mix(bits[at] ^ _PLACE))
            real = at[place < count[at]]
            component = mix(bits[real] ^ _COMPONENT) % np.uint64(m)
            slot = doc[real] * m + component.astype(np.int64)
            np.minimum.at(best, slot, time[real])
            first = best[slot] == time[real]
            name[slot[first]] = bits[real[first]]
            draw(at)
            at = at[time[at] <= limit[doc[at]]]
        open_ = np.isinf(best).reshape(n, m).any(axis=1) & (total > 0)
        if not open_.any():
            return name.reshape(n, m)
        limit[open_] *= 2


def band_hashes(signatures: np.ndarray) -> np.ndarray:
    cut = signatures.reshape(len(signatures), BANDS, ROWS)
    found = np.broadcast_to(mix(np.arange(1, BANDS + 1, dtype=np.uint64) * _NEXT), cut.shape[:2])
    for i in range(ROWS):
        found = mix(found ^ cut[:, :, i])
    return found.view(np.int64)


def _keys(piece: Piece) -> list[bytes | None]:
    """A digest of each text's words; None without words."""
    words, at = piece.word_hashes(), piece.word_bounds
    return [
        hashlib.blake2b(words[a:b].tobytes(), digest_size=16).digest() if b > a else None
        for a, b in zip(at[:-1], at[1:])
    ]


def _signed(batches):
    for batch in batches:
        for piece in pieces(batch.column("text")):
            n = piece.hi - piece.lo
            signatures = bag_minhash(*shingles(piece), n, BANDS * ROWS)
            counts = np.where(piece.n_words > 0, BANDS, 0)
            bands = band_hashes(signatures)[piece.n_words > 0].ravel()
            weight = np.where(piece.n_words > 0, np.maximum(piece.n_words - SHINGLE + 1, 1), 0)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id").slice(piece.lo, n), batch.column("digest").slice(piece.lo, n),
                 pa.array(_keys(piece), pa.binary()), pa.array(weight.astype(np.int64)), lists(bands, counts)],
                names=["doc_id", "digest", "key", "weight", "bands"],
            )
    give_back()


def _tokens(batches):
    """Each shingle of a text with its number among equal ones, so that the
    overlap of sets of these is that of the multisets."""
    for batch in batches:
        keys = batch.column("key")
        for piece in pieces(batch.column("text")):
            docs, hashes, counts = shingles(piece)
            nth = np.arange(counts.sum()) - np.repeat(np.cumsum(counts) - counts, counts)
            values = mix(np.repeat(hashes, counts) + nth.astype(np.uint64) * _NEXT).view(np.int64)
            sizes = np.bincount(docs, weights=counts, minlength=piece.hi - piece.lo).astype(np.int64)
            own = pa.array(_keys(piece), pa.binary())
            asked = keys.slice(piece.lo, piece.hi - piece.lo)
            same = np.array([a == b for a, b in zip(own.to_pylist(), asked.to_pylist())], bool)
            made = pa.RecordBatch.from_arrays([asked, lists(values, sizes)], names=["key", "tokens"])
            yield made.filter(pa.array(same))
    give_back()


def signatures(docs: DataFrame) -> DataFrame:
    """(doc_id, digest, key, weight, bands); digest: of the text, key: the same
    for equal words."""
    rows = docs.select(F.col("doc_id").cast("long"), "text", _digest("text").alias("digest"))
    return rows.mapInArrow(_signed, "doc_id long, digest binary, key binary, weight long, bands array<long>")


def _similar(pairs: DataFrame, tokens: DataFrame) -> DataFrame:
    """The pairs (a, b) whose texts' multisets overlap enough."""
    left = tokens.select(F.col("key").alias("a"), F.col("tokens").alias("ta"))
    right = tokens.select(F.col("key").alias("b"), F.col("tokens").alias("tb"))
    both = F.size(F.array_intersect("ta", "tb"))
    num, den = SIMILAR
    # both / (a + b - both) >= num / den
    enough = both * (num + den) >= num * (F.size("ta") + F.size("tb"))
    return pairs.join(left, "a").join(right, "b").filter(enough).select("a", "b")


def _centres(rows: DataFrame) -> DataFrame:
    """The best connected row of each bucket."""
    order = Window.partitionBy("bucket").orderBy(F.desc("degree"), "key")
    return rows.withColumn("_rank", F.row_number().over(order)).filter(F.col("_rank") == 1)


def _star_pairs(rows: DataFrame) -> DataFrame:
    """Pairs of a bucket's rows with its centre, of fitting weights, each once."""
    middle = _centres(rows).select("bucket", F.col("key").alias("ckey"), F.col("weight").alias("cweight"))
    num, den = SIMILAR
    fits = (F.col("weight") * den >= F.col("cweight") * num) & (F.col("cweight") * den >= F.col("weight") * num)
    return (
        rows.join(middle, "bucket")
        .filter((F.col("key") != F.col("ckey")) & fits)
        .select(F.least("key", "ckey").alias("a"), F.greatest("key", "ckey").alias("b"))
        .distinct()
    )


def _mixed(rows: DataFrame, labels: DataFrame, seen: int) -> DataFrame:
    """The buckets with several classes and more than ``seen`` rows, with classes."""
    mixed = rows.join(labels, "key")
    undone = mixed.groupBy("bucket").agg(
        F.min("class").alias("_low"), F.max("class").alias("_high"), F.count("*").alias("_n")
    )
    undone = undone.filter((F.col("_low") != F.col("_high")) & (F.col("_n") > seen)).select("bucket")
    return stage(mixed.join(undone, "bucket"), "dup-mixed")


def _merged(labels: DataFrame, edges: DataFrame) -> DataFrame:
    """Labels after the classes of each edge's ends have become one."""
    edges = stage(edges, "dup-edges")
    if edges.isEmpty():
        return labels
    own = labels.select(F.col("key").alias("a"), F.col("class").alias("ca"))
    other = labels.select(F.col("key").alias("b"), F.col("class").alias("cb"))
    found = components(
        edges.join(own, "a").join(other, "b").select(F.col("ca").alias("a"), F.col("cb").alias("b"))
    )
    merged = labels.join(found.withColumnRenamed("node", "class"), "class", "left")
    return stage(merged.select("key", F.coalesce("label", "class").alias("class")), "dup-labels")


def _in_blocks(mixed: DataFrame, tokens: DataFrame) -> DataFrame:
    """Edges (a, b) that join the classes of buckets as far as their members'
    similarity does.

    The members of all buckets with the same centre are one group, dealt out to
    blocks; every two blocks meet in one task. A task gives no pairs, only the
    few edges that join classes."""
    middle = _centres(mixed).select("bucket", F.col("key").alias("centre"))
    members = mixed.join(middle, "bucket").select("centre", "key", "class", "weight").distinct()
    sizes = members.groupBy("centre").agg(
        F.greatest(
            F.ceil(F.count("*") / BLOCK_ROWS), F.ceil(F.sum("weight") / BLOCK_TOKENS)
        ).cast("long").alias("blocks")
    )
    own = F.pmod(F.xxhash64("key"), F.col("blocks"))
    dealt = members.join(sizes, "centre").withColumn("own", own)
    dealt = dealt.withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)))
    placed = dealt.select(
        "centre", "key", "class", F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j")
    )
    # Pairs of blocks that are of one class have nothing to join.
    apart = placed.groupBy("centre", "i", "j").agg(F.min("class").alias("_low"), F.max("class").alias("_high"))
    apart = apart.filter(F.col("_low") != F.col("_high")).select("centre", "i", "j")
    placed = placed.join(apart, ["centre", "i", "j"]).join(tokens, "key")
    return placed.groupBy("centre", "i", "j").applyInArrow(_joining_edges, "a binary, b binary")


def _joining_edges(table: pa.Table) -> pa.Table:
    keys, names = table["key"].to_pylist(), table["class"].to_pylist()
    lengths = np.concatenate([c.value_lengths().to_numpy() for c in table["tokens"].chunks]).astype(np.int64)
    flat = np.concatenate([c.flatten().to_numpy() for c in table["tokens"].chunks])
    bounds = np.concatenate([[0], np.cumsum(lengths)])
    _, flat = np.unique(flat, return_inverse=True)
    order = np.argsort(flat, kind="stable")
    holders = np.repeat(np.arange(len(keys)), lengths)[order]
    starts = np.searchsorted(flat[order], np.arange(flat.max(initial=-1) + 2))
    numbers = {name: n for n, name in enumerate(dict.fromkeys(names))}
    label = np.array([numbers[name] for name in names])
    num, den = SIMILAR
    edges = []
    # One side of any edge is outside the class that is largest here.
    for u in np.flatnonzero(label != np.bincount(label).argmax()):
        tokens = flat[bounds[u] : bounds[u + 1]]
        counts = starts[tokens + 1] - starts[tokens]
        total = np.cumsum(counts)
        shared = np.zeros(len(keys), np.int64)
        # So many holders at a time, whatever the text's length.
        for part in np.split(np.arange(len(tokens)), np.searchsorted(total, np.arange(HOLDERS, total[-1], HOLDERS))):
            own = counts[part]
            within = np.arange(own.sum()) - np.repeat(np.cumsum(own) - own, own)
            shared += np.bincount(holders[np.repeat(starts[tokens[part]], own) + within], minlength=len(keys))
        near = np.flatnonzero((shared * (num + den) >= num * (lengths + lengths[u])) & (label != label[u]))
        for v in near:
            if label[v] != label[u]:
                edges.append((keys[u], keys[v]))
                label[label == label[v]] = label[u]
    kind = pa.schema([("a", pa.binary()), ("b", pa.binary())])
    return pa.Table.from_arrays([pa.array(x, pa.binary()) for x in (zip(*edges) if edges else ((), ()))], schema=kind)


def _several(rows: DataFrame) -> DataFrame:
    """The rows (bucket, key, weight) of buckets that have more than one, with
    the degree of their keys: how many others they meet."""
    several = rows.groupBy("bucket").agg(F.count("*").alias("n")).filter(F.col("n") > 1)
    rows = stage(rows.join(several, "bucket"), "dup-buckets")
    degree = rows.groupBy("key").agg(F.sum(F.col("n") - 1).alias("degree"))
    return stage(rows.drop("n").join(degree, "key"), "dup-buckets")


def _digest(text: str) -> Column:
    """Names a text where ids don't: rows may repeat an id, or have none."""
    return F.unhex(F.md5(F.col(text)))


def _texts(docs: DataFrame, nodes: DataFrame) -> DataFrame:
    """(key, text) of the nodes (key, doc_id, digest); some texts of other keys
    that share an id may come along."""
    rows = docs.select(F.col("doc_id").cast("long"), "text")
    known = nodes.filter(F.col("doc_id").isNotNull()).select("doc_id", "key")
    found = likely(rows, "doc_id", known).join(known, "doc_id").select("key", "text")
    # Texts that no row with an id has, each once.
    nameless = rows.filter(F.col("doc_id").isNull()).select("text", _digest("text").alias("digest"))
    unknown = nodes.filter(F.col("doc_id").isNull()).select("digest", "key")
    return found.unionByName(nameless.dropDuplicates(["digest"]).join(unknown, "digest").select("key", "text"))


def classes_of_keys(docs: DataFrame, signed: DataFrame) -> DataFrame:
    """(key, class) of the keys that share a bucket with others."""
    reps = signed.filter(F.col("key").isNotNull()).groupBy("key").agg(
        F.min("doc_id").alias("doc_id"), F.min("digest").alias("digest"),
        F.first("weight").alias("weight"), F.first("bands").alias("bands"),
    )
    reps = stage(reps, "dup-reps")
    rows = _several(reps.select(F.explode("bands").alias("bucket"), "key", "weight"))
    nodes = reps.select("key", "doc_id", "digest").join(rows.select("key").distinct(), "key")
    nodes = stage(nodes, "dup-nodes")
    tokens = stage(_texts(docs, nodes).mapInArrow(_tokens, "key binary, tokens array<long>"), "dup-tokens")

    labels = nodes.select("key", F.col("key").alias("class"))
    labels = _merged(labels, _similar(_star_pairs(rows), tokens))
    # In a bucket of two the star has compared all there is.
    return _merged(labels, _in_blocks(_mixed(rows, labels, 2), tokens))


def _classed(docs: DataFrame) -> DataFrame:
    """(doc_id, digest, class) for each row of docs; texts without words have a
    null class."""
    signed = stage(signatures(docs), "dup-signed")
    labels = classes_of_keys(docs, signed)
    own = signed.select("doc_id", "digest", "key").join(labels, "key", "left")
    return own.select("doc_id", "digest", F.coalesce("class", "key").alias("class"))


def near_duplicates(docs: DataFrame) -> DataFrame:
    """(doc_id, class_id) for each row of docs (doc_id, text): the smallest id
    of its text's class of near duplicates."""
    own = _classed(docs.select("doc_id", "text"))
    first = own.filter(F.col("class").isNotNull()).groupBy("class").agg(F.min("doc_id").alias("first"))
    return own.join(first, "class", "left").select("doc_id", F.coalesce("first", "doc_id").alias("class_id"))


def keep_first(docs: DataFrame) -> DataFrame:
    """One row of each class of docs (doc_id, text and any others): that of the
    smallest id, rows without one last, then of the least digest of the text;
    of rows that are alike in both, any. Texts without words all stay. Texts
    that can't be among those to drop aren't shuffled."""
    own = stage(_classed(docs.select("doc_id", "text")).filter(F.col("class").isNotNull()), "dup-classed")
    alike = own.groupBy("class", "doc_id", "digest").agg(F.count("*").alias("n"))
    order = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "digest")
    firsts = own.groupBy("class").agg(F.min(order).alias("first"), F.count("*").alias("size"))
    firsts = firsts.filter(F.col("size") > 1)
    lost = ~(F.col("doc_id").eqNullSafe(F.col("first.doc_id")) & (F.col("digest") == F.col("first.digest")))
    touched = alike.join(firsts, "class").withColumn("lost", lost).filter(F.col("lost") | (F.col("n") > 1))
    id_, digest, seen, lost_ = (free(name, docs) for name in ("_id", "_digest", "_seen", "_lost"))
    touched = stage(
        touched.select(F.col("doc_id").alias(id_), F.col("digest").alias(digest), F.col("lost").alias(lost_)), "dup-touched"
    )
    keyed = docs.withColumns({id_: F.col("doc_id").cast("long"), digest: _digest("text")})
    rows = maybe(keyed, digest, touched, seen)
    surely = rows.filter(~F.col(seen)).select(*docs.columns)
    rows, touched = rows.filter(F.col(seen)).alias("r"), touched.alias("t")
    same = F.col(f"r.{id_}").eqNullSafe(F.col(f"t.{id_}")) & (F.col(f"r.{digest}") == F.col(f"t.{digest}"))
    met = rows.join(touched, same, "left").select("r.*", F.col(f"t.{lost_}").alias(lost_))
    others = met.filter(F.col(lost_).isNull()).select(*docs.columns)
    alike = met.filter(~F.col(lost_)).dropDuplicates([id_, digest]).select(*docs.columns)
    return surely.unionByName(others).unionByName(alike)

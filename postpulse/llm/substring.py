"""Repeated passages by relative Lempel-Ziv factors.

The reference of a document are the texts of all smaller ids. A factor copies a
run of words from one place of one of them: it starts at the first window of
``SPAN`` words that the reference holds and goes on for as long as that place's
next words are the document's. A window that crosses the end of a factor may
still be in the reference, at another place; it then starts a factor of its
own, which overlaps the one before. So every factor has SPAN words or more, all
windows that the reference holds are inside of factors, and the words of the
factors are what is removed.

The reference is indexed by blocks chosen by content: of the ``GRAM``-word
grams in each window of SPAN words, the one with the least hash is its anchor.
Equal windows have equal anchors, so only windows whose anchor occurs in
another document can repeat; only these are looked up, by a 128-bit hash of all
their words. A window's place in the reference is its first one: the smallest
id that holds it, and there the first word. A factor therefore ends where that
place changes, even if a later copy would match longer. Texts with equal words
are indexed once, by the smallest id: the others are one factor each.

Defined results: null and empty texts have no words; a text shorter than SPAN
words has no span; a row without an id is neither a reference nor changed; rows
that repeat an id don't refer to each other, and each text has its own factors; a
passage that only repeats
within one document stays.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import stage
from .words import Piece, byte_values, flat, likely, lists, mix, pieces, span_hashes

SPAN = 50
GRAM = 18

#: A text with many copies is dealt over so many tasks where copies are joined.
SALTS = 16

_DOC = np.uint64(0x9E3779B97F4A7C15)


def _least(values: np.ndarray, size: int) -> np.ndarray:
    """Minimum of each run of ``size`` values, by doubling."""
    width = 1
    while width * 2 <= size:
        values = np.minimum(values[:-width], values[width:])
        width *= 2
    rest = size - width
    return np.minimum(values[:-rest], values[rest:]) if rest else values


def anchors(piece: Piece, words: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The first word and the anchor of each window of a piece."""
    if len(words) < SPAN:
        return np.zeros(0, np.int64), np.zeros(0, np.uint64)
    at = np.arange(len(words) - GRAM + 1)
    least = _least(span_hashes(words, at, at + GRAM), SPAN - GRAM + 1)
    last = np.repeat(piece.word_bounds[1:], piece.n_words) - SPAN
    first = np.flatnonzero(np.arange(len(words)) <= last)
    return first, least[first]


def _read(batches):
    """Per document: its words' number and digest, and its anchors."""
    for batch in batches:
        for piece in pieces(batch.column("text")):
            n = piece.hi - piece.lo
            first, least = anchors(piece, piece.word_hashes())
            docs = piece.word_docs()[first]
            new = np.ones(len(docs), bool)
            new[1:] = (docs[1:] != docs[:-1]) | (least[1:] != least[:-1])
            raw = piece.data.tobytes()
            digests = [
                hashlib.sha256(b" ".join(raw[a:b].split())).hexdigest()
                for a, b in zip(piece.bounds[:-1], piece.bounds[1:])
            ]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id").slice(piece.lo, n), batch.column("key").slice(piece.lo, n),
                 pa.array(piece.n_words), pa.array(digests),
                 lists(least[new].view(np.int64), np.bincount(docs[new], minlength=n))],
                names=["doc_id", "key", "n_words", "sha256", "anchors"],
            )


def _docs_of(column: pa.Array, lo: int, hi: int) -> tuple[np.ndarray, np.ndarray]:
    """Row (from lo) and value of the elements of a list column's rows."""
    part = column.slice(lo, hi - lo)
    sizes = part.value_lengths().to_numpy(zero_copy_only=False)
    return np.repeat(np.arange(hi - lo), sizes), part.flatten().to_numpy(zero_copy_only=False)


def _first_places(docs: np.ndarray, hashes: np.ndarray, places: np.ndarray) -> np.ndarray:
    """Where each window's document holds the window first."""
    order = np.lexsort((places, hashes, docs))
    new = np.ones(len(order), bool)
    new[1:] = (docs[order][1:] != docs[order][:-1]) | (hashes[order][1:] != hashes[order][:-1])
    firsts = np.empty_like(places)
    firsts[order] = places[order][np.flatnonzero(new)[np.cumsum(new) - 1]]
    return firsts


def _windows(batches):
    """The windows whose anchor is shared: hash, text, first word, and the first
    word of the same window's first place in the text."""
    for batch in batches:
        ids, keys = (batch.column(name).to_numpy(zero_copy_only=False) for name in ("doc_id", "key"))
        for piece in pieces(batch.column("text")):
            words = piece.word_hashes()
            first, least = anchors(piece, words)
            docs = piece.word_docs()[first]
            of, shared = _docs_of(batch.column("anchors"), piece.lo, piece.hi)
            known = np.sort(shared.view(np.uint64) ^ mix(of.astype(np.uint64) * _DOC))
            asked = least ^ mix(docs.astype(np.uint64) * _DOC)
            at = np.minimum(np.searchsorted(known, asked), max(len(known) - 1, 0))
            hit = known[at] == asked if len(known) else np.zeros(len(asked), bool)
            first, docs = first[hit], docs[hit]
            other = span_hashes(byte_values(1)[piece.data], piece.starts, piece.ends)
            hashes = span_hashes(words, first, first + SPAN)
            places = (first - piece.word_bounds[docs]).astype(np.int32)
            yield pa.RecordBatch.from_arrays(
                [pa.array(hashes.view(np.int64)),
                 pa.array(span_hashes(other, first, first + SPAN).view(np.int64)),
                 pa.array(ids[piece.lo : piece.hi][docs].astype(np.int64)),
                 pa.array(keys[piece.lo : piece.hi][docs].astype(np.int64)),
                 pa.array(places), pa.array(_first_places(docs, hashes, places))],
                names=["h1", "h2", "doc_id", "key", "start", "place"],
            )


def _texts(docs: DataFrame) -> DataFrame:
    """The key tells the texts of rows that repeat an id apart."""
    return docs.select(F.col("doc_id").cast("long"), F.xxhash64("text").alias("key"), "text")


def read(docs: DataFrame) -> DataFrame:
    """(doc_id, key, n_words, sha256, anchors) of rows (doc_id, text)."""
    fields = "doc_id long, key long, n_words long, sha256 string, anchors array<long>"
    return _texts(docs).mapInArrow(_read, fields)


def lookups(docs: DataFrame, known: DataFrame) -> DataFrame:
    """(doc_id, key, start, ref_doc, ref_start): every window of a document, but
    for later copies of whole texts, that is also in a document of a smaller id,
    with its first place there."""
    first = known.groupBy("sha256").agg(F.min("doc_id").alias("doc_id"))
    # One row for each distinct text.
    distinct = known.join(first, ["sha256", "doc_id"]).dropDuplicates(["doc_id", "sha256"])
    used = distinct.select("doc_id", "key", F.explode("anchors").alias("anchor"))
    several = used.groupBy("anchor").agg(F.min("doc_id").alias("low"), F.max("doc_id").alias("high"))
    several = several.filter(F.col("low") < F.col("high")).select("anchor")
    shared = used.join(several, "anchor").groupBy("doc_id", "key").agg(F.collect_set("anchor").alias("anchors"))
    shared = stage(shared, "rlz-shared")
    texts = likely(_texts(docs), "doc_id", shared).join(shared, ["doc_id", "key"])
    fields = "h1 long, h2 long, doc_id long, key long, start int, place int"
    windows = stage(texts.mapInArrow(_windows, fields), "rlz-windows")
    least = windows.groupBy("h1", "h2").agg(
        F.min("doc_id").alias("ref_doc"), F.max("doc_id").alias("_last"),
        F.min_by("place", "doc_id").alias("ref_start"),
    )
    # Stored, so that the join is one that splits the windows of a hot passage.
    least = stage(least.filter(F.col("ref_doc") < F.col("_last")).drop("_last"), "rlz-least")
    return windows.join(least, ["h1", "h2"]).filter(F.col("ref_doc") < F.col("doc_id")).select(
        "doc_id", "key", "start", "ref_doc", "ref_start"
    )


def _factors(found: pa.StructArray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Start, length, ref_doc and ref_start of the greedy factors of a text's
    looked-up windows."""
    starts, docs, places = (
        found.field(name).to_numpy(zero_copy_only=False).astype(np.int64) for name in ("start", "ref_doc", "ref_start")
    )
    starts, order = np.unique(starts, return_index=True)
    docs, places = docs[order], places[order]
    new = np.ones(len(starts), bool)
    new[1:] = (np.diff(starts) != 1) | (np.diff(places) != 1) | (docs[1:] != docs[:-1])
    heads = np.flatnonzero(new)
    lasts = np.append(heads[1:], len(starts))[: len(heads)] - 1
    return starts[heads], starts[lasts] - starts[heads] + SPAN, docs[heads], places[heads]


def _cut(batches):
    """Texts with their factors: what these leave of them."""
    names = ("start", "length", "ref_doc", "ref_start")
    kind = pa.list_(pa.struct([(name, pa.int64()) for name in names]))
    for batch in batches:
        found = batch.column("found")
        data, offsets = flat(batch.column("text"))
        kept, removed, factors, digests = [], [], [], []
        for i in range(batch.num_rows):
            words = data[offsets[i] : offsets[i + 1]].tobytes().split()
            digests.append(hashlib.sha256(b" ".join(words)).hexdigest())
            own = _factors(found.slice(i, 1).flatten())
            edges = np.zeros(len(words) + 1, np.int64)
            np.add.at(edges, own[0], 1)
            np.add.at(edges, own[0] + own[1], -1)
            gone = np.cumsum(edges[:-1]) > 0
            kept.append(b" ".join([w for w, x in zip(words, gone.tolist()) if not x]).decode("utf-8", "replace"))
            removed.append(int(gone.sum()))
            factors.append([dict(zip(names, f)) for f in zip(*(part.tolist() for part in own))])
        yield pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), pa.array(digests, pa.string()), pa.array(kept, pa.string()),
             pa.array(removed, pa.int64()), pa.array(factors, kind)],
            names=["doc_id", "sha256", "kept", "n_removed", "factors"],
        )


def factored(docs: DataFrame, known: DataFrame) -> DataFrame:
    """(doc_id, sha256, kept, n_removed, factors) of the texts that have
    factors and aren't later copies of whole texts."""
    found = (
        lookups(docs, known)
        .groupBy("doc_id", "key")
        # A set: repeated rows look up the same windows.
        .agg(F.collect_set(F.struct("start", "ref_doc", "ref_start")).alias("found"))
    )
    found = stage(found, "rlz-found")
    texts = likely(_texts(docs), "doc_id", found).join(found, ["doc_id", "key"])
    return texts.mapInArrow(
        _cut,
        "doc_id long, sha256 string, kept string, n_removed long, "
        "factors array<struct<start:long,length:long,ref_doc:long,ref_start:long>>",
    )


def remove_repeats(docs: DataFrame) -> DataFrame:
    """(doc_id, n_words, n_removed, kept_sha256, factors) for each row of docs
    (doc_id, text). A later copy of a whole text is one factor."""
    known = stage(read(docs), "rlz-read")
    several = known.groupBy("sha256").agg(F.min("doc_id").alias("_first"), F.max("doc_id").alias("_last"))
    several = several.filter(F.col("_first") < F.col("_last")).drop("_last")
    dealt = several.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    salted = known.drop("anchors").withColumn("_salt", F.pmod(F.xxhash64("doc_id"), F.lit(SALTS)).cast("int"))
    cut = factored(docs, known).select(
        "doc_id", "sha256", F.sha2("kept", 256).alias("_kept"), F.col("n_removed").alias("_removed"), "factors"
    )
    cut = cut.dropDuplicates(["doc_id", "sha256"])
    copy = (F.col("_first") < F.col("doc_id")) & (F.col("n_words") >= SPAN)
    whole = F.array(
        F.struct(
            F.lit(0).cast("long").alias("start"), F.col("n_words").alias("length"),
            F.col("_first").alias("ref_doc"), F.lit(0).cast("long").alias("ref_start"),
        )
    )
    rows = salted.join(dealt, ["sha256", "_salt"], "left").join(cut, ["doc_id", "sha256"], "left")
    return rows.select(
        "doc_id",
        "n_words",
        F.when(copy, F.col("n_words")).otherwise(F.coalesce("_removed", F.lit(0))).alias("n_removed"),
        F.when(copy, F.sha2(F.lit(""), 256)).otherwise(F.coalesce("_kept", "sha256")).alias("kept_sha256"),
        F.when(copy, whole).otherwise(F.coalesce("factors", F.slice(whole, 1, 0))).alias("factors"),
    )

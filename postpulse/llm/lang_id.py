"""Language identification of words and spans.

A language is learned as the frequencies of its letter trigrams (word edges
included, hashed into ``BUCKETS``) and the scripts it is written in. A word's
script narrows the languages to those that use it; each of these scores the
word by its trigrams. A Viterbi pass over the words of a text, with a penalty
for each switch of language, labels spans of mixed text. The prediction for a
text is the language of most of its letters, its score their share.

Defined results: null and empty texts, and texts without a letter, are ``und``
with score 0, as are all texts where nothing was learned. A word in a script
that no language uses says nothing. Ties go to the first language by code
point. Repeated rows are predicted each for itself, and learned as often. Of
more than ``MAX_LANGUAGES`` languages those with the fewest rows aren't learned.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .words import add_columns, flat, spans_of

BUCKET_BITS = 16
BUCKETS = 1 << BUCKET_BITS
#: Log-probability lost by a switch, and by a word outside its languages.
SWITCH = 9.0
OUTSIDE = 60.0
SMOOTHING = 0.5
#: A language uses a script that has at least this share of its letters.
SCRIPT_SHARE = 0.001
MAX_LANGUAGES = 500
UNKNOWN = "und"
#: Letters per step, over all languages.
LETTERS = 1 << 22

#: First and last code point of scripts; all others are one more.
SCRIPTS = (
    (0x0041, 0x024F), (0x1E00, 0x1EFF),  # Latin
    (0x0370, 0x03FF), (0x1F00, 0x1FFF),  # Greek
    (0x0400, 0x052F),  # Cyrillic
    (0x0530, 0x058F),  # Armenian
    (0x0590, 0x05FF),  # Hebrew
    (0x0600, 0x077F), (0x08A0, 0x08FF),  # Arabic
    (0x0900, 0x097F),  # Devanagari
    (0x0980, 0x09FF),  # Bengali
    (0x0A00, 0x0A7F),  # Gurmukhi
    (0x0A80, 0x0AFF),  # Gujarati
    (0x0B80, 0x0BFF),  # Tamil
    (0x0C00, 0x0C7F),  # Telugu
    (0x0C80, 0x0CFF),  # Kannada
    (0x0D00, 0x0D7F),  # Malayalam
    (0x0E00, 0x0E7F),  # Thai
    (0x10A0, 0x10FF),  # Georgian
    (0x1100, 0x11FF), (0xAC00, 0xD7AF),  # Hangul
    (0x3040, 0x30FF),  # Kana
    (0x3400, 0x4DBF), (0x4E00, 0x9FFF), (0x20000, 0x2FA1F),  # Han
)
#: Later ranges of a script belong to its first one.
_SAME = {1: 0, 3: 2, 8: 7, 20: 19, 23: 22, 24: 22}
OTHER_SCRIPT = len(SCRIPTS)

_tables: list[np.ndarray] = []


def letter_tables() -> tuple[np.ndarray, np.ndarray]:
    """By code point: the small letter (0 for what is no letter) and the script;
    made once per worker."""
    if not _tables:
        small = np.zeros(0x110000, np.uint32)
        for code in range(0x110000):
            letter = chr(code)
            if letter.isalpha():
                lower = letter.lower()
                small[code] = ord(lower) if len(lower) == 1 else code
        script = np.full(0x110000, OTHER_SCRIPT, np.uint8)
        for i, (first, last) in enumerate(SCRIPTS):
            script[first : last + 1] = _SAME.get(i, i)
        _tables.extend([small, script])
    return _tables[0], _tables[1]


@dataclass
class Letters:
    """The words (runs of letters) of some texts.

    bounds: first code point of each text, and the end; starts, ends: of each
    word; word_bounds: the first word of each text; at: where the letters are."""

    bounds: np.ndarray
    starts: np.ndarray
    ends: np.ndarray
    word_bounds: np.ndarray
    at: np.ndarray
    grams: np.ndarray
    scripts: np.ndarray


def letters_of(data: np.ndarray, offsets: np.ndarray) -> Letters:
    raw = data.tobytes()
    texts = [raw[a:b].decode("utf-8", "replace") for a, b in zip(offsets[:-1], offsets[1:])]
    bounds = np.zeros(len(texts) + 1, np.int64)
    np.cumsum([len(t) for t in texts], out=bounds[1:])
    codes = np.frombuffer("".join(texts).encode("utf-32-le", "surrogatepass"), np.uint32)
    small, script = letter_tables()
    # One blank before and after, so that every letter has neighbours.
    padded = np.zeros(len(codes) + 2, np.uint32)
    padded[1:-1] = small[codes]
    at = np.flatnonzero(padded[1:-1])
    here, before, after = padded[at + 1], padded[at], padded[at + 2]
    first = np.zeros(len(codes) + 1, bool)
    first[bounds] = True
    opens = (before == 0) | first[at]
    closes = (after == 0) | first[at + 1]
    left = np.where(opens, 0, before).astype(np.uint64)
    right = np.where(closes, 0, after).astype(np.uint64)
    mixed = (left * np.uint64(0x9E3779B97F4A7C15)) ^ (here.astype(np.uint64) * np.uint64(0xC2B2AE3D27D4EB4F))
    mixed = (mixed ^ (right * np.uint64(0x165667B19E3779F9))) * np.uint64(0xD6E8FEB86659FD93)
    grams = (mixed >> np.uint64(64 - BUCKET_BITS)).astype(np.int32)
    starts, ends = at[opens], at[closes] + 1
    return Letters(
        bounds, starts, ends, np.searchsorted(starts, bounds), at, grams, script[codes[at]]
    )


@dataclass(frozen=True)
class Model:
    languages: tuple[str, ...]
    #: buckets x languages, and scripts x languages
    log_probability: np.ndarray
    uses: np.ndarray


def common_languages(rows: DataFrame, most: int) -> DataFrame:
    """The rows whose lang is one of the ``most`` that have the most rows (ties:
    the first by code point), counted before any text is read. A column with
    more values than that holds other things than languages."""
    rows = rows.filter(F.col("lang").isNotNull())
    counts = rows.groupBy("lang").agg(F.count("*").alias("n"))
    known = counts.orderBy(F.desc("n"), "lang").limit(most + 1).collect()
    if len(known) <= most:
        return rows
    return rows.filter(F.col("lang").isin([row["lang"] for row in known[:most]]))


def learn(rows: DataFrame) -> Model:
    """The model of the rows (text, lang) whose lang isn't null. All rows count;
    a task sums what it reads, so few rows leave it. What comes to the driver
    is bounded by ``MAX_LANGUAGES`` times the buckets: of more languages, those
    of the most rows are learned (``common_languages``)."""

    def count(batches):
        grams: dict[str, np.ndarray] = {}
        scripts: dict[str, np.ndarray] = {}
        for batch in batches:
            langs = np.array(batch.column("lang").to_pylist(), object)
            data, offsets = flat(batch.column("text"))
            for lo, hi in spans_of(offsets):
                begin = offsets[lo]
                found = letters_of(data[begin : offsets[hi]], offsets[lo : hi + 1] - begin)
                own = langs[lo:hi]
                of = np.searchsorted(found.bounds, found.at, "right") - 1
                for lang in set(own):
                    mine = (own == lang)[of]
                    grams[lang] = grams.get(lang, 0) + np.bincount(found.grams[mine], minlength=BUCKETS)
                    scripts[lang] = scripts.get(lang, 0) + np.bincount(
                        found.scripts[mine], minlength=OTHER_SCRIPT + 1
                    )
        for kind, counted in (("gram", grams), ("script", scripts)):
            for lang, counts in counted.items():
                at = np.flatnonzero(counts)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([lang] * len(at), pa.string()), pa.array([kind] * len(at), pa.string()),
                     pa.array(at.astype(np.int32)), pa.array(counts[at].astype(np.int64))],
                    names=["lang", "kind", "bucket", "n"],
                )

    rows = common_languages(rows.select("text", "lang"), MAX_LANGUAGES)
    counted = rows.mapInArrow(count, "lang string, kind string, bucket int, n long")
    counts = counted.groupBy("lang", "kind", "bucket").agg(F.sum("n").alias("n")).toPandas()
    languages = tuple(sorted(counts["lang"].unique()))
    grams = np.zeros((BUCKETS, len(languages)))
    scripts = np.zeros((OTHER_SCRIPT + 1, len(languages)))
    for kind, target in (("gram", grams), ("script", scripts)):
        part = counts[counts["kind"] == kind]
        target[part["bucket"], [languages.index(x) for x in part["lang"]]] = part["n"]
    total = grams.sum(axis=0)
    # Unseen trigrams share what smoothing leaves them among the ones seen anywhere.
    seen = max(1, int((grams.sum(axis=1) > 0).sum()))
    log_probability = np.log((grams + SMOOTHING) / (total + SMOOTHING * 2 * seen))
    uses = scripts >= np.maximum(SCRIPT_SHARE * scripts.sum(axis=0), 1)
    return Model(languages, log_probability.astype(np.float32), uses)


def word_scores(found: Letters, model: Model) -> np.ndarray:
    """Words x languages: log-probabilities, lowered outside a word's languages."""
    n_words, n_langs = len(found.starts), len(model.languages)
    scores = np.zeros((n_words, n_langs), np.float32)
    first = np.searchsorted(found.at, found.starts)
    bounds = np.append(first, len(found.at))
    lo, step = 0, max(1, LETTERS // n_langs)
    while lo < n_words:
        hi = max(lo + 1, int(np.searchsorted(bounds, bounds[lo] + step, "right")) - 1)
        part = model.log_probability[found.grams[bounds[lo] : bounds[hi]]]
        scores[lo:hi] = np.add.reduceat(part, bounds[lo:hi] - bounds[lo], axis=0)
        lo = hi
    script = found.scripts[first]
    fits = model.uses[script]
    some = fits.any(axis=1)
    scores[~some] = 0
    scores -= np.where(fits | ~some[:, None], np.float32(0), np.float32(OUTSIDE))
    return scores


def viterbi(scores: np.ndarray, bounds: np.ndarray, switch: float = SWITCH) -> np.ndarray:
    """The best label of every word, for all texts at once: step t takes the
    t-th word of each text that has one."""
    sizes = np.diff(bounds)
    order = np.argsort(-sizes, kind="stable")
    begins, sizes = bounds[:-1][order], sizes[order]
    longest = int(sizes.max(initial=0))
    active = np.searchsorted(-sizes, -np.arange(longest), "left")
    n_words, n_langs = scores.shape
    moved = np.zeros((n_words, n_langs), bool)
    origin = np.zeros(n_words, np.int16)
    value = np.zeros((len(sizes), n_langs))
    for t, n in enumerate(active):
        at = begins[:n] + t
        now = value[:n]
        if t:
            best = now.argmax(axis=1)
            other = now[np.arange(n), best][:, None] - switch
            moved[at] = other > now
            origin[at] = best
            now = np.maximum(now, other)
        value[:n] = now + scores[at]
    labels = np.zeros(n_words, np.int16)
    label = value.argmax(axis=1)
    for t in range(longest - 1, -1, -1):
        n = active[t]
        at = begins[:n] + t
        own = label[:n]
        labels[at] = own
        if t:
            label[:n] = np.where(moved[at, own], origin[at], own)
    return labels


_SPAN = pa.struct([("start", pa.int64()), ("end", pa.int64()), ("lang", pa.string())])


def _labelled(data: np.ndarray, offsets: np.ndarray, model: Model, switch: float):
    """Per text: language, score and spans."""
    found = letters_of(data, offsets)
    n, n_langs = len(offsets) - 1, len(model.languages)
    labels = viterbi(word_scores(found, model), found.word_bounds, switch)
    docs = np.repeat(np.arange(n), np.diff(found.word_bounds))
    size = found.ends - found.starts
    letters = np.bincount(docs * n_langs + labels, weights=size, minlength=n * n_langs).reshape(n, n_langs)
    total = letters.sum(axis=1)
    best = letters.argmax(axis=1)
    names = np.array([*model.languages, UNKNOWN], object)
    score = letters[np.arange(n), best] / np.maximum(total, 1)
    # Neighbouring words of one text and label are a span.
    head = np.ones(len(labels), bool)
    head[1:] = (labels[1:] != labels[:-1]) | (docs[1:] != docs[:-1])
    at = np.flatnonzero(head)
    last = np.append(at[1:], len(labels)) - 1
    begin = found.bounds[docs[at]] if len(at) else np.zeros(0, np.int64)
    spans = pa.StructArray.from_arrays(
        [pa.array((found.starts[at] - begin).astype(np.int64)), pa.array((found.ends[last] - begin).astype(np.int64)),
         pa.array(names[labels[at]].tolist(), pa.string())],
        fields=list(_SPAN),
    )
    counts = np.zeros(n + 1, np.int32)
    np.cumsum(np.bincount(docs[at], minlength=n), out=counts[1:])
    return names[np.where(total > 0, best, n_langs)].tolist(), score, pa.ListArray.from_arrays(pa.array(counts), spans)


def predict(rows: DataFrame, model: Model, switch: float = SWITCH) -> DataFrame:
    """Rows (text and any others) with lang_pred, score and spans: the code
    points from start to end in a language. Columns of these names are replaced."""
    if not model.languages:
        return rows.withColumns(
            {"lang_pred": F.lit(UNKNOWN), "score": F.lit(0.0),
             "spans": F.array().cast("array<struct<start:long,end:long,lang:string>>")}
        )

    def compute(batch: pa.RecordBatch) -> dict[str, object]:
        data, offsets = flat(batch.column("text"))
        names, scores, spans = [], [], []
        # Scores are words times languages.
        for lo, hi in spans_of(offsets, max(1 << 16, (8 << 20) * 16 // max(16, len(model.languages)))):
            begin = offsets[lo]
            own = _labelled(data[begin : offsets[hi]], offsets[lo : hi + 1] - begin, model, switch)
            names += own[0]
            scores.append(own[1])
            spans.append(own[2])
        return {
            "lang_pred": pa.array(names, pa.string()),
            "score": np.concatenate(scores),
            "spans": pa.concat_arrays(spans),
        }

    return add_columns(
        rows, "lang_pred string, score double, spans array<struct<start:long,end:long,lang:string>>", compute
    )

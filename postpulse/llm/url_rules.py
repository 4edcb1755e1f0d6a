"""URL filter: one bit-parallel automaton for all glob rules.

Rules are globs over the canonical URL (host, then path): ``*`` stands for any
bytes but ``/``, ``**`` for any bytes, ``?`` for one character but ``/``. All
are packed into one multiword Shift-And automaton: a state per literal and one
more per rule, its masks by byte. A step moves every state of every rule over
one byte of every URL of a batch:

    S = ((S << 1) & match[byte]) | (S & stay[byte])

URLs go from longest to shortest, so that a step touches only those which
still have a byte there.

Defined results: a null URL, or one without ``://``, has an empty host and
path, which only an empty or ``**`` rule fits. Repeated rows are judged each
for itself. Columns of the added names are replaced.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .words import add_columns, flat, free, spans_of


@dataclass(frozen=True)
class HostRule:
    """Fits a host and its subdomains where the path starts as given."""

    verdict: str
    host: str
    path: str

    @property
    def name(self) -> str:
        return self.host + self.path

    def globs(self) -> list[str]:
        return [f"{self.name}**", f"*.{self.name}**"]


#: The base rules.
BASE_RULES = (
    HostRule("allow", "org", "/"),
    HostRule("block", "example.org", "/es/"),
    HostRule("block", "example.org", "/en/1"),
    HostRule("allow", "com", "/fr/"),
    HostRule("block", "com", "/de/"),
)
#: Hosts whose labels name unwanted pages, and paths of pages without prose.
BLOCKED_GLOBS = (
    "*cheap-pills*/**", "*free-bets*/**", "*adult-x*/**", "*spam-farm*/**", "*ads-track*/**",
    "*casino*/**", "*/login", "*/login/**", "*/cart", "*/cart/**", "**.zip", "**.exe",
)


class Automaton:
    """match, stay: masks by byte (256 x words); start, accept: masks."""

    def __init__(self, globs: list[str]) -> None:
        parsed = [self._parse(glob.encode()) for glob in globs]
        states = sum(len(items) + 1 for items, _ in parsed)
        n_words = max(1, -(-states // 64))
        match = np.zeros((256, n_words * 64), bool)
        stay = np.zeros((256, n_words * 64), bool)
        start = np.zeros(n_words * 64, bool)
        self.accepts = []
        at = 0
        for items, loops in parsed:
            start[at] = True
            for k, allowed in enumerate(items):
                match[:, at + k + 1] = allowed
            for k, allowed in loops.items():
                stay[:, at + k] |= allowed
            self.accepts.append(at + len(items))
            at += len(items) + 1
        self.match, self.stay, self.start = map(self._packed, (match, stay, start))

    @staticmethod
    def _parse(glob: bytes):
        """Allowed bytes of each step, and of the loop at each state."""
        any_byte = np.ones(256, bool)
        no_slash = any_byte.copy()
        no_slash[ord("/")] = False
        rest = np.zeros(256, bool)
        rest[0x80:0xC0] = True  # the bytes after a character's first
        items, loops, at = [], {}, 0
        while at < len(glob):
            if glob[at : at + 2] == b"**":
                loops[len(items)] = any_byte
                at += 2
                continue
            if glob[at] == ord("*"):
                loops[len(items)] = loops.get(len(items), no_slash) | no_slash
            elif glob[at] == ord("?"):
                items.append(no_slash & ~rest)
                loops[len(items)] = rest
            else:
                items.append(np.arange(256) == glob[at])
            at += 1
        return items, loops

    @staticmethod
    def _packed(bits: np.ndarray) -> np.ndarray:
        shape = (*bits.shape[:-1], bits.shape[-1] // 64, 64)
        return (bits.reshape(shape).astype(np.uint64) << np.arange(64, dtype=np.uint64)).sum(
            axis=-1, dtype=np.uint64
        )

    def run(self, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        """For each string and glob: does the glob fit the whole string?"""
        lengths = np.diff(offsets)
        order = np.argsort(-lengths, kind="stable")
        begins, sizes = offsets[:-1][order], lengths[order]
        state = np.tile(self.start, (len(sizes), 1))
        alive = np.searchsorted(-sizes, -np.arange(int(sizes.max(initial=0))), "left")
        for step, n in enumerate(alive):
            now, byte = state[:n], data[begins[:n] + step]
            moved = now << np.uint64(1)
            moved[:, 1:] |= now[:, :-1] >> np.uint64(63)
            state[:n] = (moved & self.match[byte]) | (now & self.stay[byte])
        fits = np.zeros((len(sizes), len(self.accepts)), bool)
        for k, bit in enumerate(self.accepts):
            fits[order, k] = (state[:, bit // 64] >> np.uint64(bit % 64)) & np.uint64(1) == 1
        return fits


@lru_cache(maxsize=4)
def automaton_of(globs: tuple[str, ...]) -> Automaton:
    """Built once in a worker, not for every batch."""
    return Automaton(list(globs))


def canonical(url):
    """Host and path columns of a URL column (see the module's text)."""
    at = F.instr(url, "://")
    after = F.coalesce(F.when(at > 0, url.substr(at + 3, F.length(url))), F.lit(""))
    host = F.regexp_extract(after, r"^([^/?#]*)", 1)
    path = F.regexp_extract(after, r"^[^/?#]*([^?#]*)", 1)
    lower = "abcdefghijklmnopqrstuvwxyz"
    return F.translate(host, lower.upper(), lower), path


def url_filter(
    rows: DataFrame,
    rules: tuple[HostRule, ...] = BASE_RULES,
    blocked: tuple[str, ...] = BLOCKED_GLOBS,
    url: str = "url",
) -> DataFrame:
    """Rows with host, path, rule (the longest base rule that fits, or null),
    blocked_by (the first blocking glob that fits, or null) and verdict."""
    ranked = sorted(rules, key=lambda r: (-len(r.name), r.name))
    globs = (*(glob for rule in ranked for glob in rule.globs()), *blocked)
    host, path = canonical(F.col(url))
    split = rows.withColumns({"host": host, "path": path})
    whole = free("_url", split)
    split = split.withColumn(whole, F.concat("host", "path"))

    def compute(batch: pa.RecordBatch) -> dict[str, object]:
        automaton = automaton_of(globs)
        data, offsets = flat(batch.column(whole))
        names, bans, verdicts = [], [], []
        for lo, hi in spans_of(offsets):
            own = offsets[lo : hi + 1] - offsets[lo]
            fits = automaton.run(data[offsets[lo] : offsets[hi]], own)
            n = 2 * len(ranked)
            by_rule = fits[:, 0:n:2] | fits[:, 1:n:2]
            for base, ban in zip(by_rule, fits[:, n:]):
                rule = ranked[int(base.argmax())] if base.any() else None
                glob = blocked[int(ban.argmax())] if ban.any() else None
                names.append(rule.name if rule else None)
                bans.append(glob)
                verdicts.append(rule.verdict if rule else "block" if glob else "allow")
        return {
            "rule": pa.array(names, pa.string()),
            "blocked_by": pa.array(bans, pa.string()),
            "verdict": pa.array(verdicts, pa.string()),
        }

    return add_columns(split, "rule string, blocked_by string, verdict string", compute).drop(whole)

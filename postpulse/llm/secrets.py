"""Secret scan with structural confirmation.

Three plain patterns (``assign``, ``access``, ``hex``) are reported as they
stand. Base64 and hex runs beside them are candidates only: each is decoded,
and reported when what comes out has the structure of a secret:

* ``der``: nested ASN.1 lengths that fill the value exactly and hold the fields
  of a private key;
* ``jwt``: three dotted parts, the first a JSON header that names an algorithm,
  the second a JSON object, the third a signature (or none for "none");
* ``pem``: an armoured private key whose body is such a structure, or an
  OpenSSH key; line breaks may be escaped, as in JSON;
* ``ssh``: length-prefixed fields that begin with a key type, or the OpenSSH
  private key magic.

A structure may start anywhere in its run, behind a path or a glued word, and
where one start fails the next is tried; it ends where a run ends, in either
base64 alphabet, and may be wrapped over lines. A ``der`` or ``ssh`` value
inside another one or an armour is part of that. Runs are found once and
split, and of a run that only looks like fields no more than their lengths are
decoded, so the work is linear in a text without structures.

Spans count code points, end exclusive. Defined results: null and empty texts
have no spans; repeated rows are scanned each for itself; a text of any length
is scanned whole. Columns of the added names are replaced.
"""

from __future__ import annotations

import base64
import binascii
import json
import re

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .words import add_columns, flat, give_back, spans_of

#: The plain patterns. Letters of the names in either case.
ASSIGN = (
    r"((?ai:password|passwd|secret|token|api_?key))[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)"
)
ACCESS = r"AKIA[A-Z0-9]+"
HEX = r"[0-9a-f]+"
KINDS = ("assign", "access", "hex", "der", "jwt", "pem", "ssh")
BASE = KINDS[:3]

_ASSIGN = re.compile(ASSIGN.encode().replace(b"(?ai:", b"(?i:"))
_ACCESS = re.compile(ACCESS.encode())
_HEX = re.compile(rb"[0-9a-f]{24,}")
#: Base64 with both alphabets, and with each.
_RUNS = tuple(re.compile(x) for x in (rb"[A-Za-z0-9+/_-]+", rb"[A-Za-z0-9+/]+", rb"[A-Za-z0-9_-]+"))
_HEX_RUN = re.compile(rb"[0-9a-fA-F]+")
#: Where a structure may start: ASN.1 sequences of a long length, or a short one
#: and the first field of a key; lengths and beginnings of key types; the magic.
_STARTS = re.compile(
    rb"(?=MI[E-T]|M[A-H][AEIMQUYcgkosw048](?:CAQ|w)|AAAA(?:B3Nz|C3Nz|E2Vj)|b3BlbnNzaC1rZXk)"
)
_HEX_STARTS = re.compile(
    rb"(?=30(?:8[1-4]|[0-7][0-9a-f](?:0201|30))|000000(?:077373|0b7373|136563)|6f70656e737368)", re.I
)
#: A line that begins so is a key of its own, not the next of a key before it.
_TYPED = re.compile(rb"AAAA(?:B3Nz|C3Nz|E2Vj)|000000(?:077373|0[bB]7373|136563)")
#: A line break within a value, as it is or escaped.
_BREAK = re.compile(rb"[ \t]*\r?\n[ \t]*|(?:\\+r)?\\+n")
_PADDING = re.compile(rb"={0,2}")
_DOTTED = re.compile(rb"[A-Za-z0-9_.-]{20,}")
_OBJECT = re.compile(rb'\{(?=[\s"}])')
_ARMOUR = re.compile(rb"-----(BEGIN|END) ([A-Z0-9 ]*PRIVATE KEY)-----")
_ARMOURED = re.compile(rb"[A-Za-z0-9+/=\s:,\\-]*")
#: Key types of length-prefixed keys.
SSH_TYPES = (
    b"ssh-rsa", b"ssh-dss", b"ssh-ed25519",
    b"ecdsa-sha2-nistp256", b"ecdsa-sha2-nistp384", b"ecdsa-sha2-nistp521",
)
SSH_MAGIC = b"openssh-key-v1\0"
#: No key of these types has more fields; lines aren't joined beyond them.
SSH_FIELDS = 8
#: Any reported span holds one of the names or a run of this length.
_LONG_RUN = 20
_RUN_BYTE = np.isin(np.arange(256), list(b"ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_-.="))
_NAMES = (b"passw", b"secret", b"token", b"api_key", b"apikey", b"private key-----")
#: Fewest characters of a decoded value, and of the part of it in its first line.
_LEAST, _HEX_LEAST, _FIRST = 32, 48, 20


def _length(data: bytes, at: int) -> tuple[int, int] | None:
    """The content's start and end of the ASN.1 element at ``at``."""
    if at + 2 > len(data):
        return None
    n, at = data[at + 1], at + 2
    if n & 0x80:
        size = n & 0x7F
        if not 1 <= size <= 4 or at + size > len(data):
            return None
        n, at = int.from_bytes(data[at : at + size], "big"), at + size
        if n < 0x80:
            return None
    return (at, at + n) if at + n <= len(data) else None


def _elements(data: bytes, start: int, end: int) -> list[tuple[int, int, int]] | None:
    """Tag, content start and end of elements that fill start to end exactly."""
    found = []
    while start < end:
        inside = _length(data, start)
        if inside is None or inside[1] > end:
            return None
        found.append((data[start], *inside))
        start = inside[1]
    return found


def is_key_der(data: bytes) -> bool:
    """Is it a DER private key: PKCS#1, PKCS#8 or SEC1, or an encrypted PKCS#8?"""
    if len(data) < 16 or data[0] != 0x30:
        return False
    whole = _length(data, 0)
    if whole is None or whole[1] != len(data):
        return False
    parts = _elements(data, *whole)
    if not parts:
        return False
    tags = [tag for tag, _, _ in parts]
    if tags[:2] == [0x30, 0x04] and len(parts) == 2:  # encrypted PKCS#8
        inner = _elements(data, *parts[0][1:])
        return bool(inner) and inner[0][0] == 0x06
    if tags[0] != 0x02 or parts[0][2] - parts[0][1] != 1 or data[parts[0][1]] > 3:
        return False
    if len(tags) >= 6 and set(tags) == {0x02}:  # PKCS#1, DSA: a version and integers
        return True
    if tags[1:3] == [0x30, 0x04]:  # PKCS#8: an algorithm and the key
        inner = _elements(data, *parts[1][1:])
        return bool(inner) and inner[0][0] == 0x06
    return tags[1] == 0x04 and all(tag in (0xA0, 0xA1) for tag in tags[2:])  # SEC1


def is_ssh(data: bytes) -> bool:
    """Is it an OpenSSH private key, or fields after a key type, all of whose
    lengths fill it exactly?"""
    if data.startswith(SSH_MAGIC):
        return len(data) > len(SSH_MAGIC) + 16
    fields, at = [], 0
    while at + 4 <= len(data):
        n = int.from_bytes(data[at : at + 4], "big")
        if at + 4 + n > len(data):
            return False
        fields.append(data[at + 4 : at + 4 + n])
        at += 4 + n
    return at == len(data) and len(fields) >= 2 and fields[0] in SSH_TYPES


def decoded(run: bytes) -> bytes | None:
    """The bytes behind a base64 run, of either alphabet, or None."""
    run = run.rstrip(b"=")
    if len(run) % 4 == 1:
        return None
    try:
        return base64.b64decode(run.translate(_URL) + b"=" * (-len(run) % 4), validate=True)
    except binascii.Error:
        return None


_URL = bytes.maketrans(b"-_", b"+/")


def _json_object(data: bytes | None) -> dict | None:
    try:
        value = json.loads(data or b"")
    except (ValueError, RecursionError):
        return None
    return value if isinstance(value, dict) else None


def _header(part: bytes) -> tuple[int, str] | None:
    """Where the widest JSON object with an algorithm starts that ends a dotted
    part, and the algorithm."""
    found = []
    for skip in range(4):
        data = decoded(part[skip:])
        if not data or not data.rstrip().endswith(b"}"):
            continue
        for at in (0, *(m.start() for m in _OBJECT.finditer(data, 1))):
            if at % 3 == 0:
                algorithm = (_json_object(data[at:]) or {}).get("alg")
                if isinstance(algorithm, str):
                    found.append((skip + at // 3 * 4, algorithm))
                    break
    return min(found, default=None)


def _jwts(text: bytes) -> list[tuple[str, int, int]]:
    found = []
    for m in _DOTTED.finditer(text):
        parts = m[0].split(b".")
        at = m.start()
        for header, payload, signature in zip(parts, parts[1:], parts[2:]):
            own, at = at, at + len(header) + 1
            if len(header) < 8 or _json_object(decoded(payload)) is None:
                continue
            head = _header(header)
            # Characters of 16 bytes.
            if head and (head[1].lower() == "none" or len(signature) >= 22):
                found.append(("jwt", own + head[0], at + len(payload) + 1 + len(signature)))
    return found


def _pems(text: bytes) -> list[tuple[str, int, int]]:
    found, armours = [], list(_ARMOUR.finditer(text))
    for a, b in zip(armours, armours[1:]):
        inside = text[a.end() : b.start()]
        if a[1] != b"BEGIN" or b[1] != b"END" or a[2] != b[2] or not _ARMOURED.fullmatch(inside):
            continue
        inside = re.sub(rb"\\+/", b"/", re.sub(rb"\\+[rnt]", b"\n", inside))
        data = decoded(b"".join(x for x in inside.split() if b":" not in x and b"," not in x))
        sealed = b"ENCRYPTED" in inside  # its lengths are encrypted too
        if data and (sealed or is_key_der(data) or data.startswith(SSH_MAGIC)):
            found.append(("pem", a.start(), b.end()))
    return found


def _der_size(head: bytes) -> int | None:
    """Length of the ASN.1 value that begins so, if it may be a private key."""
    if head[0] != 0x30:
        return None
    n, at = head[1], 2
    if n & 0x80:
        size = n & 0x7F
        if not 1 <= size <= 4:
            return None
        n, at = int.from_bytes(head[2 : 2 + size], "big"), 2 + size
    version = head[at] == 0x02 and head[at + 1] == 1 and head[at + 2] <= 3
    return at + n if version or head[at] == 0x30 else None


def _ssh_type(head: bytes) -> bool:
    name = head[4 : 4 + head[3]]
    return SSH_MAGIC.startswith(head[:9]) or (
        head[:3] == b"\0\0\0" and any(len(x) == head[3] and x.startswith(name) for x in SSH_TYPES)
    )


def _ssh_sizes(data: bytes) -> tuple[set[int], int | None]:
    """Lengths after which the fields that the data begin with make a key, and
    how much the next field needs, if there may be one."""
    magic = data.startswith(SSH_MAGIC)
    at, fields, all_fields, sizes = len(SSH_MAGIC) if magic else 0, 0, None, set()
    while at + 4 <= len(data):
        n = int.from_bytes(data[at : at + 4], "big")
        if magic and fields == 3 and all_fields is None:
            # Behind cipher, kdf and its options: a number of public keys.
            all_fields, at = 3 + n + 1, at + 4
            continue
        if at + 4 + n > len(data):
            return sizes, at + 4 + n
        at, fields = at + 4 + n, fields + 1
        if fields == all_fields or (not magic and fields >= 2):
            sizes.add(at)
        if fields == all_fields or (not magic and fields == SSH_FIELDS):
            return sizes, None
    return sizes, at + 4


def _lines(text: bytes, at: int, run: re.Pattern, need: int, typed: bool = False) -> tuple[bytes, dict[int, int]]:
    """A value from ``at`` over line breaks until it has as many characters as
    needed, and by number of characters where its lines end in the text."""
    parts, ends, size = [], {}, 0
    while True:
        # No more than asked for, and what tells whether the line ends there.
        most = need - size + 2
        line = run.match(text, at, at + most)
        if not line:
            break
        parts.append(line[0])
        size += len(line[0])
        if len(line[0]) < most:
            ends[size] = line.end()
        broken = _BREAK.match(text, line.end()) if size < need else None
        if not broken or (typed and _TYPED.match(text, broken.end())):
            break
        at = broken.end()
    return b"".join(parts), ends


def _fills(text: bytes, at: int, stop: int, read, hexed: bool) -> bool:
    """Do fields after a key type fill the run from ``at`` exactly? Only the
    fields' lengths are decoded, so a start costs the same in any run."""
    size = (stop - at) // 2 if hexed else (stop - at) * 3 // 4
    byte, fields = 0, 0
    while byte + 4 <= size and fields < SSH_FIELDS:
        first = at + 2 * byte if hexed else at + byte // 3 * 4
        part = read(text[first : min(stop, first + 8)])
        if part is None:
            return False
        skip = 0 if hexed else byte % 3
        byte += 4 + int.from_bytes(part[skip : skip + 4], "big")
        fields += 1
    return byte == size and fields >= 2 and is_ssh(read(text[at:stop]) or b"")


def _unhex(run: bytes) -> bytes:
    return bytes.fromhex(run[: len(run) // 2 * 2].decode())


def _keys(text: bytes, run: re.Pattern) -> list[tuple[str, int, int]]:
    """DER and SSH values in runs of base64 or hex digits."""
    hexed = run is _HEX_RUN
    read, starts, least = (_unhex, _HEX_STARTS, _HEX_LEAST) if hexed else (decoded, _STARTS, _LEAST)
    found = []

    def chars(size: int) -> int:
        return 2 * size if hexed else -(-4 * size // 3)

    def end_of(at: int, stop: int) -> tuple[str, int] | None:
        head = read(text[at : at + (2 * _FIRST if hexed else _FIRST)])
        size = _der_size(head)
        if size is not None:
            need = chars(size)
            if need > len(text) - at or need < least or (need < stop - at - hexed):
                return None
            value, ends = _lines(text, at, run, need)
            # A last half of a byte is no part of it.
            end = ends.get(need) or (ends[need + 1] - 1 if hexed and need + 1 in ends else None)
            return ("der", end) if end and is_key_der(read(value[:need])) else None
        if not _ssh_type(head):
            return None
        magic = SSH_MAGIC.startswith(head[:9])
        whole = stop - at >= least and (hexed or (stop - at) % 4 != 1)
        if whole and not magic and _fills(text, at, stop, read, hexed):
            return "ssh", stop
        need = chars(64)
        while True:
            value, ends = _lines(text, at, run, need, not magic)
            own = len(value) - (not hexed and len(value) % 4 == 1)
            sizes, more = _ssh_sizes(read(value[:own]))
            key = min((n for n in map(chars, sizes) if n in ends and n >= least), default=None)
            if key and is_ssh(read(value[:key])):
                return "ssh", ends[key]
            if len(value) < need or more is None or chars(more) > len(text) - at:
                break
            need = max(2 * need, chars(more))
        # The magic tells enough where the fields don't end with a line.
        size = (stop - at) // 2 if hexed else (stop - at) * 3 // 4
        enough = head.startswith(SSH_MAGIC) and size > len(SSH_MAGIC) + 16
        return ("ssh", stop) if whole and enough else None

    for m in run.finditer(text):
        begin, stop = m.span()
        done = begin
        first = 2 * _FIRST if hexed else _FIRST
        if stop - begin < first:
            continue
        for start in starts.finditer(m[0]):
            at = begin + start.start()
            if at >= done and stop - at >= first:
                end = end_of(at, stop)
                if end:
                    done = end[1]
                    padded = done if hexed else _PADDING.match(text, done).end()
                    found.append((end[0], at, padded))
    return found


def _confirmed(text: bytes) -> list[tuple[str, int, int]]:
    found = _jwts(text)
    armoured = _pems(text) if b"PRIVATE KEY-----" in text else []
    keys = {key for run in (*_RUNS, _HEX_RUN) for key in _keys(text, run)}
    reach = -1
    # By start, longer ones first: what ends within an earlier one lies in it.
    for kind, start, end in sorted([*armoured, *keys], key=lambda s: (s[1], -s[2])):
        if kind == "pem" or end > reach:
            found.append((kind, start, end))
        reach = max(reach, end)
    return found


def _found(text: bytes) -> list[tuple[str, int, int]]:
    """(kind, start, end) in bytes."""
    found = [("assign", *m.span()) for m in _ASSIGN.finditer(text) if len(m[2]) >= 6]
    found += [("access", *m.span()) for m in _ACCESS.finditer(text) if len(m[0]) >= 20]
    found += [("hex", *m.span()) for m in _HEX.finditer(text)]
    return found + _confirmed(text)


def find_secrets(text: bytes) -> list[tuple[str, int, int]]:
    """(kind, start, end) in code points, by start, then kind, then end."""
    found = _found(text)
    if found and not text.isascii():
        # Code points before each byte, counted once.
        before = np.zeros(len(text) + 1, np.int64)
        np.cumsum((np.frombuffer(text, np.uint8) & 0xC0) != 0x80, out=before[1:])
        found = [(k, int(before[a]), int(before[b])) for k, a, b in found]
    return sorted(found, key=lambda s: (s[1], KINDS.index(s[0]), s[2]))


def _may_hold(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Rows with a run long enough for any kind but an assignment."""
    edges = np.zeros(len(data) + 2, np.int8)
    edges[1:-1] = _RUN_BYTE[data]
    change = np.diff(edges)
    starts, ends = np.flatnonzero(change == 1), np.flatnonzero(change == -1)
    hits = starts[ends - starts >= _LONG_RUN]
    stops = ends[ends - starts >= _LONG_RUN]
    held = np.zeros(len(offsets) - 1, bool)
    # A run may go on over the seam of two texts: both count as hit.
    for at in (hits, stops - 1):
        held[np.searchsorted(offsets, at, "right") - 1] = True
    return held


def _suspects(column: pa.Array):
    """Texts by pieces: (first row, row after the last, bytes of each text that
    may hold a secret, None for the others)."""
    data, offsets = flat(column)
    for lo, hi in spans_of(offsets):
        piece = data[offsets[lo] : offsets[hi]]
        own = offsets[lo : hi + 1] - offsets[lo]
        held = _may_hold(piece, own) if len(piece) else np.zeros(hi - lo, bool)
        raw = piece.tobytes()
        lower = raw.lower()
        texts: list[bytes | None] = []
        for i, long_run in enumerate(held):
            begin, end = int(own[i]), int(own[i + 1])
            named = long_run or any(lower.find(name, begin, end) >= 0 for name in _NAMES)
            texts.append(raw[begin:end] if named else None)
        yield lo, hi, texts


def scan(rows: DataFrame, text: str = "text") -> DataFrame:
    """Rows with ``spans``: an array of (kind, start, end)."""
    kind = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())]))

    def compute(batch: pa.RecordBatch) -> dict[str, object]:
        result = []
        for _, _, texts in _suspects(batch.column(text)):
            for own in texts:
                spans = find_secrets(own) if own is not None else []
                result.append([{"kind": k, "start": s, "end": e} for k, s, e in spans])
        return {"spans": pa.array(result, kind)}

    return add_columns(rows, "spans array<struct<kind:string,start:long,end:long>>", compute)


def joined(spans):
    """An array of spans as ``kind:start:end``, comma-joined."""
    return F.array_join(
        F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ","
    )


def _redacted(text: bytes, mark: bytes) -> bytes | None:
    """The text with its secrets, overlapping ones joined, replaced by a mark;
    None if it has none."""
    spans = sorted((a, b) for _, a, b in _found(text))
    if not spans:
        return None
    out, at = [], 0
    for start, end in spans:
        if start >= at:
            out += [text[at:start], mark]
        at = max(at, end)
    return b"".join([*out, text[at:]])


def redact(rows: DataFrame, mark: str = "[secret]") -> DataFrame:
    """Rows whose texts have every secret replaced by a mark; ``n_chars``, where
    there is one, follows the new text. All other columns, of whatever names,
    stay as they are. Found and replaced in one pass, by pieces."""
    names = rows.columns
    counted = "n_chars" in names

    def run(batches):
        for batch in batches:
            for lo, hi, texts in _suspects(batch.column("text")):
                made = [_redacted(own, mark.encode()) if own is not None else None for own in texts]
                part = batch.slice(lo, hi - lo)
                if any(own is not None for own in made):
                    columns = {name: part.column(k) for k, name in enumerate(names)}
                    new = pa.array([None if own is None else own.decode() for own in made], columns["text"].type)
                    columns["text"] = pc.if_else(new.is_valid(), new, columns["text"])
                    if counted:
                        size = pc.utf8_length(new).cast(columns["n_chars"].type)
                        columns["n_chars"] = pc.if_else(new.is_valid(), size, columns["n_chars"])
                    part = pa.RecordBatch.from_arrays(list(columns.values()), names=names)
                yield part
        give_back()

    return rows.mapInArrow(run, rows.schema)

"""Secret scan with structural confirmation.

Three plain patterns give the base spans: assigned values, access key ids and long hex runs.  Longer base64
and hex candidates are then decoded, and reported only if their content has the structure of a secret:

* ``der``: ASN.1 whose nested lengths fit exactly and which has the integers of a private key (RSA, EC,
  PKCS#8), also inside PEM armour, after ``KEY=`` and with line breaks written as backslash and n;
* ``ssh``: the length-prefixed fields of an OpenSSH private key;
* ``jwt``: three base64url parts, of which the first is a JSON object with an ``alg`` and the second JSON.

A base64 candidate may run on into the text after the key; its own outer length says where the key ends, which
must be the end of a line or of the candidate.

Base spans stay whatever the confirmation says.  Null and empty texts give no spans.  Rows keep their number
and order of columns: repeated rows are scanned again, a null doc_id passes through.
"""

from __future__ import annotations

import base64
import binascii
import bisect
import hashlib
import itertools
import json
import re

import pyarrow as pa
from pyspark.sql import DataFrame

from fleetlens.llm.tables import map_chunks

ASSIGN = re.compile(
    r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
    re.ASCII | re.IGNORECASE)
ACCESS = re.compile(r"AKIA[A-Z0-9]{12,}")
HEX = re.compile(r"(?<![0-9a-f])[0-9a-f]{32,}")
TOKEN = re.compile(r"(?<![\w-])eyJ[A-Za-z0-9_-]{6,}\.[A-Za-z0-9_-]+\.[A-Za-z0-9_-]*", re.ASCII)
_LETTERS = "A-Za-z0-9+/_-"
_BREAK = r"(?:\r?\n|(?:\\+r)?\\+n)(?!-----)"
#: ASN.1 sequences and the OpenSSH magic fix the first base64 letters.
BASE64 = re.compile(
    rf"(?:(?<![{_LETTERS}])|(?<=\\[nrt]))(?=M[A-P]|b3BlbnNz)[{_LETTERS}]{{16,}}(?:{_BREAK}[{_LETTERS}]{{16,}})*"
    rf"(?:{_BREAK}[{_LETTERS}]{{1,15}})?={{0,2}}")
PEM = re.compile(rf"-----BEGIN [^-\r\n]{{0,60}}-----((?:(?!-----)[=\s\\{_LETTERS}])*)", re.ASCII)
_ESCAPED = re.compile(r"\\+[nrt]")
_LINE = re.compile(f"[{_LETTERS}]+")
_PADDING = re.compile(r"(?:(?:\s|\\+[rnt])*=){0,2}")
ANY_HEX = re.compile(r"(?<![0-9A-Fa-f])(?:[0-9A-Fa-f]{2}){16,}(?![0-9A-Fa-f])")
SSH_MAGIC = b"openssh-key-v1\0"
KINDS = ("assign", "access", "hex", "der", "ssh", "jwt")
SCHEMA = ("doc_id long, n_assign long, n_access long, n_hex long, base_sha256 string, spans string, "
          "n_confirmed long")


def _der_item(data: bytes, at: int, end: int) -> tuple[int, int, int] | None:
    """Tag, content start and content end of the ASN.1 item at ``at``, if its length fits below ``end``."""
    if at + 2 > end:
        return None
    tag, first = data[at], data[at + 1]
    start = at + 2
    size = first
    if first & 0x80:
        count = first & 0x7F
        if not 1 <= count <= 4 or start + count > end:
            return None
        size = int.from_bytes(data[start:start + count], "big")
        start += count
    return (tag, start, start + size) if start + size <= end else None


def _der_children(data: bytes, start: int, end: int) -> list[tuple[int, int, int]] | None:
    """The items that fill a constructed item without a gap; None if they do not."""
    items = []
    while start < end:
        item = _der_item(data, start, end)
        if item is None:
            return None
        items.append(item)
        start = item[2]
    return items


def is_private_key(data: bytes) -> bool:
    """Whether the bytes are wholly one ASN.1 private key (PKCS#1, SEC1 or PKCS#8, plain or encrypted)."""
    top = _der_item(data, 0, len(data))
    if top is None or top[0] != 0x30 or top[2] != len(data):
        return False
    items = _der_children(data, top[1], top[2])
    if not items or len(items) < 2:
        return False
    tags = [tag for tag, _, _ in items]
    if tags[0] == 0x02 and items[0][2] - items[0][1] == 1:
        version = data[items[0][1]]
        if len(items) >= 9 and all(tag == 0x02 for tag in tags[:9]):  # PKCS#1: nine integers
            return version in (0, 1)
        if len(items) >= 6 and all(tag == 0x02 for tag in tags[:6]):  # DSA: six integers
            return version == 0
        if version == 1 and tags[1] == 0x04:  # SEC1
            return items[1][2] - items[1][1] >= 16
        if version in (0, 1) and len(items) >= 3 and tags[1] == 0x30 and tags[2] == 0x04:  # PKCS#8
            named = _der_children(data, items[1][1], items[1][2])
            return bool(named) and named[0][0] == 0x06
    if len(items) == 2 and tags == [0x30, 0x04]:  # encrypted PKCS#8
        named = _der_children(data, items[0][1], items[0][2])
        return bool(named) and len(named) == 2 and named[0][0] == 0x06 and named[1][0] == 0x30
    return False


def _der_length(head: bytes) -> int | None:
    """Bytes of the outer sequence, by its first bytes; None where no private key starts like that."""
    if len(head) < 8 or head[0] != 0x30:
        return None
    count = head[1] & 0x7F if head[1] & 0x80 else 0
    if head[1] & 0x80 and not 1 <= count <= 4 or head[2 + count] not in (0x02, 0x30):
        return None
    return 2 + count + (int.from_bytes(head[2:2 + count], "big") if count else head[1])


def _ssh_length(data: bytes) -> int | None:
    """Bytes of what ``is_ssh_key`` accepts, by its fields; None if it goes on after ``data``."""
    at = len(SSH_MAGIC)
    for _ in range(3):  # cipher, derivation, its options
        at += 4 + int.from_bytes(data[at:at + 4], "big")
    count, at = int.from_bytes(data[at:at + 4], "big"), at + 4
    for _ in range(count + 1):  # public keys and the private part
        if at + 4 > len(data):
            return None
        at += 4 + int.from_bytes(data[at:at + 4], "big")
    return at if at <= len(data) else None


def is_ssh_key(data: bytes) -> bool:
    """Whether the bytes are an OpenSSH private key with fitting field lengths."""
    if not data.startswith(SSH_MAGIC):
        return False
    at = len(SSH_MAGIC)
    for _ in range(3):  # cipher, derivation, its options
        if at + 4 > len(data):
            return False
        at += 4 + int.from_bytes(data[at:at + 4], "big")
    return at + 4 <= len(data) and 1 <= int.from_bytes(data[at:at + 4], "big") <= 64


def _decoded(text: str) -> bytes | None:
    plain = re.sub(r"[\r\n=]", "", text).replace("-", "+").replace("_", "/")
    if len(plain) % 4 == 1:
        return None
    try:
        return base64.b64decode(plain + "=" * (-len(plain) % 4), validate=True)
    except (binascii.Error, ValueError):
        return None


def _json_object(part: str) -> dict | None:
    data = _decoded(part)
    try:
        value = json.loads(data) if data else None
    except (ValueError, RecursionError):
        return None
    return value if isinstance(value, dict) else None


def key_kind(data: bytes | None) -> str | None:
    if not data:
        return None
    return "der" if is_private_key(data) else "ssh" if is_ssh_key(data) else None


def base_spans(text: str) -> list[tuple[int, int, str]]:
    found = [(*m.span(), "assign") for m in ASSIGN.finditer(text) if m.end(2) - m.start(2) >= 8]
    found += [(*m.span(), "access") for m in ACCESS.finditer(text)]
    found += [(*m.span(), "hex") for m in HEX.finditer(text)]
    return sorted(found, key=lambda x: (x[0], KINDS.index(x[2])))


def _keys_between(text: str, start: int, end: int) -> list[tuple[int, int, str]]:
    """Spans of the keys whose base64 starts one of the lines between both places."""
    shown = _ESCAPED.sub(lambda m: " " * len(m[0]), text[start:end])
    lines = [m.span() for m in _LINE.finditer(shown)]
    plain = "".join(shown[a:b] for a, b in lines)
    ends = list(itertools.accumulate(b - a for a, b in lines))
    found, done = [], 0
    for (first, last), stop in zip(lines, ends):
        at = stop - (last - first)
        if at < done or plain[at:at + 1] not in ("M", "b"):
            continue
        kind, size = None, None
        if plain[at] == "M":
            size = _der_length(_decoded(plain[at:at + 16]) or b"")
            need = 0 if size is None else (4 * size + 2) // 3
            if need and at + need <= len(plain) and is_private_key(_decoded(plain[at:at + need])):
                kind = "der"
        elif plain.startswith("b3BlbnNz", at):
            data = _decoded(plain[at:len(plain) - (len(plain) - at) % 4]) or b""
            data += _decoded(plain[len(plain) - (len(plain) - at) % 4:]) or b""
            if is_ssh_key(data):
                kind, size = "ssh", _ssh_length(data)
        if kind is None:
            continue
        cut = len(plain) if size is None else at + (4 * size + 2) // 3
        line = bisect.bisect_left(ends, cut)
        if cut != ends[line]:
            if kind == "der":
                continue
            cut, line = len(plain), len(lines) - 1
        found.append((start + first, _PADDING.match(text, start + lines[line][1], end).end(), kind))
        done = cut
    return found


def confirmed_spans(text: str) -> list[tuple[int, int, str]]:
    """Spans of candidates whose decoded content has the structure of a key or a signed token."""
    found = []
    for m in TOKEN.finditer(text):
        head, body, _ = m[0].split(".")
        if (header := _json_object(head)) and isinstance(header.get("alg"), str) and _json_object(body) is not None:
            found.append((*m.span(), "jwt"))
    keys = set()
    for m in PEM.finditer(text):
        keys.update(_keys_between(text, *m.span(1)))
    for m in BASE64.finditer(text):
        keys.update(_keys_between(text, *m.span()))
    for start, end, kind in sorted(keys, key=lambda x: (x[0], -x[1])):  # what lies inside another is the same key
        if not found or found[-1][2] == "jwt" or start >= found[-1][1]:
            found.append((start, end, kind))
    for m in ANY_HEX.finditer(text):
        if m[0][:2] == "30" or m[0][:8].lower() == SSH_MAGIC[:4].hex():
            kind = key_kind(bytes.fromhex(m[0]))
            if kind:
                found.append((*m.span(), kind))
    return sorted(found, key=lambda x: (x[0], KINDS.index(x[2])))


def joined(spans: list[tuple[int, int, str]]) -> str:
    return ",".join(f"{kind}:{start}:{end}" for start, end, kind in spans)


def all_spans(text: str) -> list[tuple[int, int, str]]:
    return sorted(base_spans(text) + confirmed_spans(text), key=lambda x: (x[0], KINDS.index(x[2])))


def _scan(batch: pa.RecordBatch) -> pa.RecordBatch:
    out: dict[str, list] = {name.split()[0]: [] for name in SCHEMA.split(", ")}
    for doc_id, text in zip(batch.column("doc_id").to_pylist(), batch.column("text").to_pylist()):
        base = base_spans(text or "")
        more = confirmed_spans(text or "")
        out["doc_id"].append(doc_id)
        for kind in KINDS[:3]:
            out[f"n_{kind}"].append(sum(x[2] == kind for x in base))
        out["base_sha256"].append(hashlib.sha256(joined(base).encode()).hexdigest())
        out["spans"].append(joined(sorted(base + more, key=lambda x: (x[0], KINDS.index(x[2])))))
        out["n_confirmed"].append(len(more))
    counts = {"n_assign", "n_access", "n_hex", "n_confirmed", "doc_id"}
    return pa.RecordBatch.from_pydict(
        {k: pa.array(v, pa.int64() if k in counts else pa.string()) for k, v in out.items()})


def find_secrets(docs: DataFrame) -> DataFrame:
    """One row per document row with its base counts, digest and all spans.  No shuffle."""
    return map_chunks(docs.select("doc_id", "text"), "text", _scan, SCHEMA)


def redact(text: str, mark: str = "[SECRET]") -> str:
    """The text with every span, overlapping ones together, replaced by ``mark``."""
    parts, at = [], 0
    for start, end, _ in all_spans(text):
        if start >= at:
            parts += [text[at:start], mark]
        at = max(at, end)
    return "".join([*parts, text[at:]])


def redact_secrets(docs: DataFrame) -> DataFrame:
    """``docs`` with secrets in ``text`` replaced and ``n_chars``, where there is one, counted anew."""
    names = docs.columns
    schema = docs.schema

    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        texts = batch.column("text").to_pylist()
        kept = [None if x is None else redact(x) for x in texts]
        columns = list(batch.columns)
        columns[names.index("text")] = pa.array(kept, pa.string())
        if "n_chars" in names:
            at = names.index("n_chars")
            counts = [old if old is None or new is None or new == before else len(new)
                      for old, new, before in zip(batch.column(at).to_pylist(), kept, texts)]
            columns[at] = pa.array(counts, batch.column(at).type)
        return pa.RecordBatch.from_arrays(columns, names=names)

    return map_chunks(docs, "text", work, schema)

"""Secrets in whole texts: keyword prefilter, anchored expressions, checksums.

One Aho-Corasick pass over a text finds all keywords; an expression is tried
only at the places it could start.  Hexadecimal runs have no keyword: they are
found by their shortest length.  Tokens that carry a checksum or a
self-describing structure count only if it holds.  Runs as an Arrow map: one
pass, no shuffle, memory bounded by one Arrow batch.
"""

from __future__ import annotations

import base64
import binascii
import json
import re
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from spillway.llm.common import ship

# Kinds in the order in which spans of one start are listed.
BASE_KINDS = ("assign", "access", "hex")
KINDS = (*BASE_KINDS, "github", "npm", "jwt", "pem")

SPANS = T.ArrayType(T.StructType([T.StructField("kind", T.StringType()), T.StructField("start", T.LongType()),
                                  T.StructField("end", T.LongType())]))

# ---- fixed values: keywords and formats --------------------------------------
ASSIGN_WORDS = ("password", "passwd", "secret", "token", "api_key", "apikey")
ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
                    re.IGNORECASE | re.ASCII)
ASSIGN_LEAST = 12
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
ACCESS_LEAST = 18
HEX = re.compile(r"[0-9a-f]{16,}")
GITHUB = re.compile(r"gh[pousr]_([A-Za-z0-9]{30})([A-Za-z0-9]{6})(?![A-Za-z0-9])")
NPM = re.compile(r"npm_([A-Za-z0-9]{30})([A-Za-z0-9]{6})(?![A-Za-z0-9])")
JWT = re.compile(r"(eyJ[A-Za-z0-9_-]++)\.(eyJ[A-Za-z0-9_-]++)\.[A-Za-z0-9_-]+")
JWT_HEAD = re.compile(r"eyJ[A-Za-z0-9_-]*+")
PEM = re.compile(r"-----BEGIN ((?:[A-Z]+ )*PRIVATE KEY)-----([A-Za-z0-9+/=\s]+)-----END \1-----")
BASE62 = "0123456789ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz"
# -------------------------------------------------------------------------------


def base62_crc32(body: str) -> str:
    """CRC-32 of the body in six base-62 digits, as token issuers append it."""
    n, out = zlib.crc32(body.encode()), ""
    for _ in range(6):
        n, r = divmod(n, 62)
        out = BASE62[r] + out
    return out


def _crc_holds(m: re.Match) -> bool:
    return base62_crc32(m[1]) == m[2]


def _jwt_holds(m: re.Match) -> bool:
    try:
        head, body = (json.loads(base64.urlsafe_b64decode(p + "=" * (-len(p) % 4))) for p in (m[1], m[2]))
    except (ValueError, binascii.Error):
        return False
    return isinstance(head, dict) and "alg" in head and isinstance(body, dict)


def _pem_holds(m: re.Match) -> bool:
    """The body is base64 of one DER sequence whose length field matches."""
    try:
        der = base64.b64decode("".join(m[2].split()), validate=True)
    except (ValueError, binascii.Error):
        return False
    if len(der) < 2 or der[0] != 0x30:
        return False
    if der[1] < 0x80:
        return len(der) == 2 + der[1]
    width = der[1] & 0x7F
    return 1 <= width <= 4 and len(der) == 2 + width + int.from_bytes(der[2:2 + width], "big")


#: kind -> (expression, keep), tried where one of the kind's keywords stands
ANCHORED = {
    "assign": (ASSIGN, lambda m: len(m[2]) >= ASSIGN_LEAST),
    "access": (ACCESS, lambda m: m.end() - m.start() >= ACCESS_LEAST),
    "github": (GITHUB, _crc_holds),
    "npm": (NPM, _crc_holds),
    "jwt": (JWT, _jwt_holds),
    "pem": (PEM, _pem_holds),
}
#: what a failed expression rules out: it fails at every later place of this stretch too
RULED_OUT = {"jwt": JWT_HEAD}
KEYWORDS = {**{w: "assign" for w in ASSIGN_WORDS}, "akia": "access", **{f"gh{c}_": "github" for c in "pousr"},
            "npm_": "npm", "eyj": "jwt", "-----begin ": "pem"}


def automaton():
    import ahocorasick
    a = ahocorasick.Automaton()
    for word, kind in KEYWORDS.items():
        a.add_word(word, (kind, len(word)))
    a.make_automaton()
    return a


def scan_text(text: str, keywords) -> list[tuple[int, int, str]]:
    """(start, end, kind) in code points, leftmost and non-overlapping per kind, by start and kind order.

    A match that fails its length or checksum still uses up its characters.
    """
    low = text.lower() if text.isascii() else text.encode("utf-8", "surrogatepass").lower().decode("utf-8", "surrogatepass")
    starts: dict[str, list[int]] = {}
    for last, (kind, size) in keywords.iter(low):
        starts.setdefault(kind, []).append(last - size + 1)
    found = [(m.start(), m.end(), "hex") for m in HEX.finditer(text)]
    for kind, places in starts.items():
        expression, keep = ANCHORED[kind]
        free = 0
        for at in sorted(places):
            if at < free:
                continue
            if m := expression.match(text, at):
                free = m.end()
                if keep(m):
                    found.append((at, free, kind))
            elif kind in RULED_OUT and (m := RULED_OUT[kind].match(text, at)):
                free = m.end()
    found.sort(key=lambda s: (s[0], KINDS.index(s[2])))
    return found


def _scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    keywords = automaton()
    item = pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())])
    for batch in batches:
        at, kinds, starts, ends = [0], [], [], []
        for text in batch.column(batch.num_columns - 1):
            for s, e, k in scan_text(text.as_py() or "", keywords):
                kinds.append(k), starts.append(s), ends.append(e)
            at.append(len(kinds))
        spans = pa.ListArray.from_arrays(pa.array(at, pa.int32()), pa.StructArray.from_arrays(
            [pa.array(kinds, pa.string()), pa.array(starts, pa.int64()), pa.array(ends, pa.int64())], fields=list(item)))
        yield pa.RecordBatch.from_arrays([*batch.columns[:-1], spans], names=[*batch.schema.names[:-1], "spans"])


def find_secrets(docs: DataFrame) -> DataFrame:
    """doc_id, spans: an array of (kind, start, end) per document, by start and then kind.

    Offsets are code points, the end is exclusive.  Null and empty texts have
    an empty array; texts are scanned whole whatever their length; repeated
    rows stay rows; an empty table gives no rows; other columns are not read.
    """
    ship(docs.sparkSession)
    slim = docs.select("doc_id", F.col("text").cast("string").alias("text"))
    return slim.mapInArrow(_scan, T.StructType([slim.schema["doc_id"], T.StructField("spans", SPANS)]))


def redact(text: str, spans) -> str:
    """The text with every span replaced by [kind]; overlapping spans become one."""
    out, at = [], 0
    for kind, start, end in sorted(((s["kind"], s["start"], s["end"]) for s in spans), key=lambda s: s[1]):
        if start >= at:
            out += [text[at:start], f"[{kind}]"]
        at = max(at, end)
    return "".join([*out, text[at:]])


def joined(spans: Column) -> Column:
    """kind:start:end of the spans, comma-joined."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"),
                                                                 s["end"].cast("string"))), ",")

"""Secret scan with structural confirmation.

Pattern matches alone (``assign``, ``access``, ``hex``) are reported as they
stand.  In addition, encoded candidates are decoded, and reported only if what
they decode to has the structure of a secret:

* ``jwt``: a signed token whose first part decodes to a JSON object that names
  an algorithm and whose second part decodes to a JSON object;
* ``derkey``: base64 or hex (bare or in a PEM block) of a DER private key: a
  SEQUENCE whose nested lengths fill it exactly and whose fields are those of a
  PKCS#1, DSA, PKCS#8 (plain or encrypted) or SEC1 key; also a PEM block whose
  DEK-Info header says that its whole cipher blocks are an encrypted key;
* ``openssh``: base64 of the OpenSSH private key container, whose
  length-prefixed fields must nest and whose key count must be at least one;
* ``encoded``: base64 or hex of printable text that itself holds an ``assign``
  or ``access`` match.

Keys may be wrapped over lines (real or escaped line ends, in PEM with header
lines) and start behind a sign such as ``/``, ``_`` or ``-``; the lengths in the
key itself tell where it ends.  ``encoded`` runs may start behind such a sign.

Places are code points, end exclusive.  A null text counts as empty and has no
spans (``redact`` leaves it null); repeated rows get the same spans; an empty
table gives no rows; other columns are not read, and ``redact`` hands them on.
Texts are scanned whole, one row at a time: nothing is shuffled.
"""
from __future__ import annotations

import base64
import binascii
import json
import re

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import documents, keyed_texts

# The base patterns and their least lengths.
ASSIGN = re.compile(rb"(password|passwd|secret|token|api_?key)[\"']?\x20*[:=]\x20*[\"']?([a-z0-9+/_.=-]+)")  # on lower-cased ASCII
ACCESS = re.compile(rb"AKIA[A-Z0-9]+")
HEX = re.compile(rb"[0-9a-f]{16,}")
MIN_ASSIGN, MIN_ACCESS = 12, 18
KINDS = ("assign", "access", "hex", "jwt", "derkey", "openssh", "encoded")

JWT = re.compile(rb"(?<![\w-])ey[\w-]+\.[\w-]+(?:\.[\w-]*)?", re.ASCII)
PEM = re.compile(rb"-----BEGIN ([A-Z0-9 ]*PRIVATE KEY)-----")
LINE_END = re.compile(rb"\\+[nrt]|\r")
HEADER = re.compile(rb"^[\x20\t]*[A-Za-z][A-Za-z0-9-]*:[^\n]*$", re.M)
CIPHER = re.compile(rb"DEK-Info:\s*[A-Za-z0-9-]+,\s*[0-9A-Fa-f]{16,}")
KEY_START = re.compile(rb"M(?:(?<![A-Za-z0-9]M)|(?<=\\[nrt]M))[A-P][A-Za-z0-9+/_-]{2}")  # the first bytes of a SEQUENCE
OPENSSH_START = re.compile(rb"b3BlbnNzaC1rZXktdjEA")
RUN = re.compile(rb"[A-Za-z0-9+/_-]*")
BREAK = re.compile(rb"\\+(?=/)|[\"',]*(?:\\+[nrt]|[\r\n])(?:\\+[nrt]|[\s\"'>])*")
BASE64 = re.compile(rb"[A-Za-z0-9+/_-]{24,}={0,2}")
HEX_RUN = re.compile(rb"[0-9A-Fa-f]{32,}")
PRINTABLE = re.compile(rb"[\x09\x0a\x0d\x20-\x7e]+")
PRINTABLE_BYTES = b"\t\n\r" + bytes(range(0x20, 0x7F))


def _base_spans(raw: bytes) -> list[tuple[str, int, int]]:
    out = [("assign", m.start(), m.end()) for m in ASSIGN.finditer(raw.lower()) if m.end(2) - m.start(2) >= MIN_ASSIGN]
    out += [("access", m.start(), m.end()) for m in ACCESS.finditer(raw) if m.end() - m.start() >= MIN_ACCESS]
    return out + [("hex", m.start(), m.end()) for m in HEX.finditer(raw)]


def _base64(part: bytes) -> bytes | None:
    body = part.rstrip(b"=").translate(bytes.maketrans(b"-_", b"+/"))
    if len(body) % 4 == 1:
        return None
    try:
        return base64.b64decode(body + b"=" * (-len(body) % 4), validate=True)
    except (binascii.Error, ValueError):
        return None


def _json(part: bytes) -> dict | None:
    try:
        value = json.loads(_base64(part) or b"")
    except (ValueError, RecursionError):
        return None
    return value if isinstance(value, dict) else None


def _is_jwt(token: bytes) -> bool:
    head, _, rest = token.partition(b".")
    header = _json(head)
    return bool(header) and isinstance(header.get("alg"), str) and _json(rest.partition(b".")[0]) is not None


def _tlv(data: bytes) -> list[tuple[int, bytes]] | None:
    """The (tag, value) elements that fill ``data`` exactly, or None."""
    out, at = [], 0
    while at < len(data):
        if at + 2 > len(data):
            return None
        tag, size = data[at], data[at + 1]
        at += 2
        if size & 0x80:
            width = size & 0x7F
            if not 1 <= width <= 4 or at + width > len(data):
                return None
            size = int.from_bytes(data[at:at + width], "big")
            at += width
        if at + size > len(data):
            return None
        out.append((tag, data[at:at + size]))
        at += size
    return out


def _is_der_key(data: bytes) -> bool:
    outer = _tlv(data) if data[:1] == b"\x30" else None
    if not outer or len(outer) != 1:
        return False
    fields = _tlv(outer[0][1]) or []
    tags = [t for t, _ in fields]
    if tags == [0x30, 0x04]:  # algorithm with its parameters, encrypted key
        return [t for t, _ in _tlv(fields[0][1]) or []] == [0x06, 0x30] and len(fields[1][1]) >= 16
    if tags[:1] != [0x02] or fields[0][1] not in (b"\x00", b"\x01"):
        return False
    if len(tags) >= 9 and all(t == 0x02 for t in tags[:9]):  # version, modulus, exponents, primes, coefficients
        return True
    if tags == [0x02] * 6:  # version, primes and generator, public and private number
        return fields[0][1] == b"\x00" and all(len(x) >= 16 for _, x in fields[1:2] + fields[4:])
    if tags[1:3] == [0x30, 0x04]:  # version, algorithm, key
        algorithm = _tlv(fields[1][1])
        return bool(algorithm) and algorithm[0][0] == 0x06 and len(fields[2][1]) >= 16
    return fields[0][1] == b"\x01" and tags[1:2] == [0x04] and len(fields[1][1]) >= 16  # version, key


def _is_openssh(data: bytes) -> bool:
    magic = b"openssh-key-v1\0"
    if not data.startswith(magic):
        return False
    at, fields = len(magic), 0
    keys = None
    while at + 4 <= len(data):
        size = int.from_bytes(data[at:at + 4], "big")
        at += 4
        if fields == 3 and keys is None:  # cipher, key derivation and its options are followed by the number of keys
            keys = size
            continue
        if at + size > len(data):
            return False
        at, fields = at + size, fields + 1
    return bool(keys) and fields >= 3 + keys and at == len(data)


def _confirmed(data: bytes | None) -> str | None:
    if not data or len(data) < 12:
        return None
    if _is_der_key(data):
        return "derkey"
    if _is_openssh(data):
        return "openssh"
    if PRINTABLE.fullmatch(data) and any(k != "hex" for k, _, _ in _base_spans(data)):
        return "encoded"
    return None


def _pem_kind(part: bytes) -> str | None:
    """What the text between the BEGIN and END lines of a PEM block is."""
    lines = LINE_END.sub(b"\n", part)
    body = HEADER.sub(b"", lines).translate(None, b"\\\"',")
    data = _base64(b"".join(body.split()))
    if data and CIPHER.search(lines) and len(data) >= 16 and len(data) % 8 == 0:
        return "derkey"
    return kind if (kind := _confirmed(data)) in ("derkey", "openssh") else None


def _pem_spans(raw: bytes) -> list[tuple[str, int, int]]:
    out, begins = [], list(PEM.finditer(raw))
    for m, after in zip(begins, [*[n.start() for n in begins[1:]], len(raw)]):
        close = b"-----END " + m.group(1) + b"-----"
        end = raw.find(close, m.end(), after)
        if end >= 0 and (kind := _pem_kind(raw[m.end():end])):
            out.append((kind, m.start(), end + len(close)))
    return out


def _gathered(raw: bytes, at: int, need: int | None) -> tuple[bytes, int] | None:
    """The next ``need`` base64 characters, across line ends, and where they end
    (None: all there are; no result if there are fewer)."""
    out, have = [], 0
    while True:
        stop = RUN.match(raw, at).end()
        if need is not None:
            stop = min(stop, at + need - have)
        out.append(raw[at:stop])
        have += stop - at
        more = None if have == need else BREAK.match(raw, stop)
        if not more:
            return (b"".join(out), stop) if need in (None, have) else None
        at = more.end()


def _der_size(head: bytes) -> int | None:
    """Bytes of the SEQUENCE that starts with ``head``, if it may be a private key."""
    width = head[1] & 0x7F if head[1] & 0x80 else 0
    if width > 4 or head[1] == 0x80:
        return None
    inner = head[2 + width:5 + width]
    if inner not in (b"\x02\x01\x00", b"\x02\x01\x01") and inner[:1] != b"\x30":
        return None
    return 2 + width + (int.from_bytes(head[2:2 + width], "big") if width else head[1])


def _openssh_size(data: bytes) -> int | None:
    """Bytes of the container at the start of ``data``, if all of it is there."""
    at, left, first = len(b"openssh-key-v1\0"), 3, True
    while left and at + 4 <= len(data):
        at, left = at + 4 + int.from_bytes(data[at:at + 4], "big"), left - 1
        if first and not left:  # the number of keys; each, and then all private ones
            left, first, at = int.from_bytes(data[at:at + 4], "big") + 1, False, at + 4
    return at if not left and not first and at <= len(data) else None


def _key_spans(raw: bytes) -> list[tuple[str, int, int]]:
    """Keys by the lengths they hold: wrapped, or with other text before or behind."""
    out, last = [], 0
    for starts, kind in ((KEY_START, "derkey"), (OPENSSH_START, "openssh")):
        for m in starts.finditer(raw):
            at = m.start()
            if at < last and kind == "derkey":
                continue
            if kind == "derkey":
                head = _gathered(raw, at, 16)
                size = _der_size(_base64(head[0]) or b"\0\0") if head else None
            else:
                text = _gathered(raw, at, None)[0]
                size = _openssh_size(_base64(text[:len(text) - (len(text) % 4 == 1)]) or b"")
            if size and (part := _gathered(raw, at, -(-size * 8 // 6))) and _confirmed(_base64(part[0])) == kind:
                last = part[1] + len(raw[part[1]:part[1] + 2]) - len(raw[part[1]:part[1] + 2].lstrip(b"="))
                out.append((kind, at, last))
    return out


def _tail_start(run: bytes) -> int | None:
    """Where text that holds a secret starts in a base64 run, behind a sign."""
    body = run.rstrip(b"=")
    for phase in range(4):
        at = [k + 1 for k, c in enumerate(body) if c in b"/_-+" and (k + 1) % 4 == phase]
        data = _base64(body[at[0]:]) if at else None
        if data:
            odd = len(data.rstrip(PRINTABLE_BYTES))
            first = next((k for k in at if (k - at[0]) // 4 * 3 >= odd), None)
            if first is not None and _confirmed(data[(first - at[0]) // 4 * 3:]) == "encoded":
                return first
    return None


def _more_spans(raw: bytes) -> list[tuple[str, int, int]]:
    out = []
    for m in JWT.finditer(raw):
        if _is_jwt(m.group()):
            out.append(("jwt", m.start(), m.end()))
    if b"-----BEGIN" in raw:
        out += _pem_spans(raw)
    out += _key_spans(raw)
    for m in HEX_RUN.finditer(raw):
        run = m.group()
        if len(run) % 2 == 0 and (kind := _confirmed(bytes.fromhex(run.decode()))):
            out.append((kind, m.start(), m.end()))
    for m in BASE64.finditer(raw):
        if HEX_RUN.fullmatch(m.group()):
            continue
        if kind := _confirmed(_base64(m.group())):
            out.append((kind, m.start(), m.end()))
        elif (start := _tail_start(m.group())) is not None:
            out.append(("encoded", m.start() + start, m.end()))
    pem = [s for s in out if raw.startswith(b"-----BEGIN", s[1])]
    return [s for s in out if s in pem or not any(p[1] <= s[1] and s[2] <= p[2] for p in pem)]


def spans_of(text: str | None) -> list[tuple[str, int, int]]:
    """(kind, start, end) in code points, by start and then by kind as listed."""
    raw = (text or "").encode("utf-8", "surrogatepass")
    found = _base_spans(raw) + _more_spans(raw)
    if found and len(raw) != len(text):
        at = sorted({p for _, a, b in found for p in (a, b)})
        points, last, total = {}, 0, 0
        for p in at:
            total += len(raw[last:p].decode("utf-8", "surrogatepass"))
            points[p], last = total, p
        found = [(k, points[a], points[b]) for k, a, b in found]
    return sorted(set(found), key=lambda s: (s[1], KINDS.index(s[0]), s[2]))


def scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``id, spans`` for each row; ``spans`` is an array of (kind, start, end)."""
    kind = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32())]))

    def run(batches):
        for batch in batches:
            rows = [[{"kind": k, "start": a, "end": b} for k, a, b in spans_of(t.as_py())] for t in batch.column(1)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(rows, kind)], ["id", "spans"])

    own = keyed_texts(docs, id_col, text_col)
    spans = "spans array<struct<kind:string,start:int,end:int>>"
    return own.mapInArrow(run, f"id {own.schema['id'].dataType.simpleString()}, {spans}")


def _masked(text: str) -> str:
    out, last = [], 0
    for kind, a, b in spans_of(text):
        if b > last:
            if a >= last:
                out += [text[last:a], f"[{kind}]"]
            last = max(last, b)
    return "".join([*out, text[last:]]) if out else text


def redact(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` with every span of the text replaced by its kind in
    brackets; overlapping spans become one mask, named after the first."""
    at = docs.columns.index(text_col)

    def run(batches):
        for batch in batches:
            texts = [None if (t := x.as_py()) is None else _masked(t) for x in batch.column(at)]
            yield batch.set_column(at, batch.schema.field(at), pa.array(texts, batch.schema.field(at).type))

    return docs.mapInArrow(run, docs.schema)


def _joined(spans):
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")


def q_secrets(spark, sf_dir: str) -> DataFrame:
    base = F.filter("spans", lambda s: s["kind"].isin("assign", "access", "hex"))
    count = lambda kind: F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")
    return scan(documents(spark, sf_dir)).select(
        F.col("id").alias("doc_id"), count("assign"), count("access"), count("hex"),
        F.sha2(_joined(base), 256).alias("base_sha256"), _joined(F.col("spans")).alias("spans"))

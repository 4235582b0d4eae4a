r"""Secret scans with structural confirmation.

Patterns only name candidates. A base64 or hex candidate is reported if it
decodes to a private key: a DER sequence whose nested lengths add up to its size and which has the fields of
PKCS #1, PKCS #8 (plain or encrypted), SEC 1 or DSA; an OpenSSH key with its length-prefixed fields; or a signed token whose
header and payload are JSON with an algorithm. Certificates and public keys are none. Base64 may be wrapped over lines, hex may have
colons. A key file may be in a string with escaped
line ends, encrypted under Proc-Type and DEK-Info headers, or a PGP block of secret key packets. Plain assignments, access key ids and
long hex strings are the base findings; they are reported as they are found.

Every text is scanned whole, in the task that read it; nothing is shuffled.
"""

from __future__ import annotations

import base64
import binascii
import json
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from framestore.llm.batches import id_and_text, id_type, slices
from framestore.llm.registry import query, table

#: In the order in which findings at one place are listed.
KINDS = ("assign", "access", "hex", "token", "pem", "base64_key", "hex_key")
BASE_KINDS = KINDS[:3]

_ASSIGN = re.compile(
    r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.IGNORECASE | re.ASCII
)
_ACCESS = re.compile(r"AKIA[A-Z0-9]+")
_HEX = re.compile(r"(?<![0-9a-f])[0-9a-f]{24,}")
_TOKEN = re.compile(r"(?<![A-Za-z0-9_-])eyJ[A-Za-z0-9_-]*\.[A-Za-z0-9_-]+\.[A-Za-z0-9_-]*")
#: A body goes on to the next five hyphens; headers have single ones.
_PEM = re.compile(r"-----BEGIN ([A-Z0-9 ]*PRIVATE KEY(?: BLOCK)?)-----([^-]*+(?:-(?!----)[^-]*+)*+)-----END \1-----")
_ESCAPE = re.compile(r"\\+(?:[nrt]|u([0-9A-Fa-f]{4}))")
#: Lines of quotes and what joins strings, an opening quote with what joins it to the string before, a closing one with what follows it.
_QUOTED = re.compile(r"""^[\s+.&,;()\\]*["'`][\s+.&,;()\\"'`]*$|^[\s+.&,;()\\]*["'`]|["'`][\s+.&,;()\\]*$""")
_CIPHER = re.compile(r"[A-Z0-9-]+,\s*(?:[0-9A-F]{2})+", re.IGNORECASE | re.ASCII)
#: One line, and any number of further ones behind it. A DER sequence begins with M, the OpenSSH container with b3Blbn.
_BASE64 = re.compile(r"(?<![A-Za-z0-9+/_-])(?:M|b3Blbn)[A-Za-z0-9+/_-]{15,}(?:\r?\n[\x20\t]*[A-Za-z0-9+/_-]{16,})*+(?:\r?\n[\x20\t]*[A-Za-z0-9+/_-]+(?==|\r?\n|$))?={0,2}")
_HEX_KEY = re.compile(r"(?<![0-9A-Fa-f:])30(?::?\s{0,9}[0-9A-Fa-f]{2}){31,}+(?![0-9A-Fa-f])")
_LINE = re.compile(r"\r?\n[\x20\t]*")
_DER_TAGS = {0x01, 0x02, 0x03, 0x04, 0x05, 0x06, 0x0A, 0x0C, 0x13, 0x16, 0x17, 0x18, 0x30, 0x31}


def _unpad(text: str) -> bytes | None:
    """Base64 of either alphabet, with or without padding."""
    text = text.translate(str.maketrans("-_", "+/", " \t\r\n\\")).rstrip("=")
    try:
        return base64.b64decode(text + "=" * (-len(text) % 4), validate=True)
    except (binascii.Error, ValueError):
        return None


def _elements(data: bytes, start: int, stop: int) -> list[tuple[int, int, int]] | None:
    """(tag, start, stop) of DER elements that fill data[start:stop] exactly, else None."""
    found = []
    while start < stop:
        if stop - start < 2:
            return None
        tag, n = data[start], data[start + 1]
        start += 2
        if n == 0x80 or n > 0x84:
            return None
        if n > 0x80:
            size = n - 0x80
            if stop - start < size:
                return None
            n = int.from_bytes(data[start : start + size])
            start += size
        if start + n > stop or (tag not in _DER_TAGS and not 0xA0 <= tag <= 0xA3 and not 0x80 <= tag <= 0x83):
            return None
        found.append((tag, start, start + n))
        start += n
    return found


def der_key(data: bytes | None) -> bool:
    """A private key: a sequence that spans all bytes, whose nested lengths fit, with the fields of one of the forms.

    The fields are, by their tags: version and eight numbers (PKCS #1), version and five numbers (DSA), version, algorithm and octets
    (PKCS #8), version 1 and octets (SEC 1), or algorithm and octets (encrypted PKCS #8). An algorithm begins with an object id.
    """
    if not data or len(data) < 16 or data[0] != 0x30:
        return False
    todo, top, fields = [(0, len(data), 0)], None, []
    while todo:
        start, stop, depth = todo.pop()
        inner = _elements(data, start, stop)
        if inner is None or not depth and len(inner) != 1:
            return False
        if depth == 1:
            top, fields = [tag for tag, _, _ in inner], inner
        for tag, a, b in inner:
            if tag in (0x30, 0x31) or 0xA0 <= tag <= 0xA3:
                todo.append((a, b, depth + 1))

    def algorithm(k: int) -> bool:
        inner = _elements(data, *fields[k][1:]) if len(fields) > k and fields[k][0] == 0x30 else None
        return bool(inner) and inner[0][0] == 0x06

    if not top:
        return False
    if top[:2] == [0x30, 0x04]:
        return len(top) == 2 and algorithm(0)
    version = data[fields[0][1] : fields[0][2]] if top[0] == 0x02 else b""
    if version not in (b"\0", b"\1"):
        return False
    if top[1:3] == [0x30, 0x04]:
        return algorithm(1)
    numbers = len(top) == top.count(0x02)
    return numbers and len(top) in (6, 9) or top[:9] == [0x02] * 9 and top[9:] == [0x30] or version == b"\1" and top[1:2] == [0x04]


def ssh_key(data: bytes | None) -> bool:
    """The private container of OpenSSH: three length-prefixed fields, the number of keys and the keys."""
    magic = b"openssh-key-v1\0"
    if not data or not data.startswith(magic):
        return False
    at = len(magic)
    for _ in range(3):
        at += 4 + int.from_bytes(data[at : at + 4])
        if at > len(data):
            return False
    return len(data) - at >= 12


def pgp_key(data: bytes | None) -> bool:
    """A packet of a secret key or subkey (tags 5 and 7), in the old or the new form."""
    if not data or len(data) < 12 or not data[0] & 0x80:
        return False
    return (data[0] & 0x3F if data[0] & 0x40 else data[0] >> 2 & 0x0F) in (5, 7)


def pem_key(body: str, block: bool = False) -> bool:
    """A key between BEGIN and END (of a PGP `block` or not), also with the escapes and quotes of a JSON, YAML or source string, or encrypted
    as its Proc-Type and DEK-Info headers say."""
    text = _ESCAPE.sub(lambda m: chr(int(m[1], 16)) if m[1] else "\n", body)
    lines = [_QUOTED.sub("", line) for line in text.splitlines()]
    fields = {name.strip().lower(): value.strip() for name, colon, value in (line.partition(":") for line in lines) if colon}
    if block:
        # A line with an equals sign first is the checksum.
        return pgp_key(_unpad("".join(line for line in lines if ":" not in line and not line.strip().startswith("="))))
    data = _unpad("".join(line for line in lines if ":" not in line))
    if re.fullmatch(r"4,\s*ENCRYPTED", fields.get("proc-type", "")) and _CIPHER.fullmatch(fields.get("dek-info", "")):
        return bool(data)
    return der_key(data) or ssh_key(data)


def signed_token(text: str) -> bool:
    head, payload, signature = text.split(".")
    try:
        header, body = (json.loads(_unpad(x) or b"") for x in (head, payload))
    except (ValueError, RecursionError):
        return False
    named = isinstance(header, dict) and isinstance(header.get("alg"), str) and isinstance(body, dict)
    return named and (bool(signature) or header["alg"].lower() == "none")


def base_spans(text: str) -> list[tuple[int, int, str]]:
    found = [(m.start(), m.end(), "assign") for m in _ASSIGN.finditer(text) if m.end(2) - m.start(2) >= 6]
    found += [(m.start(), m.end(), "access") for m in _ACCESS.finditer(text) if m.end() - m.start() >= 20]
    return found + [(m.start(), m.end(), "hex") for m in _HEX.finditer(text)]


def confirmed_spans(text: str) -> list[tuple[int, int, str]]:
    found = [(m.start(), m.end(), "token") for m in _TOKEN.finditer(text) if signed_token(m[0])]
    found += [(m.start(), m.end(), "pem") for m in _PEM.finditer(text) if pem_key(m[2], m[1].endswith("BLOCK"))]
    m = _BASE64.search(text)
    while m:
        end = private_end(m[0])
        if end:
            found.append((m.start(), m.start() + end, "base64_key"))
        # Other lines of what is no key, or come behind one, may begin a key.
        line = _LINE.search(m[0])
        m = _BASE64.search(text, m.start() + (end or (line.start() if line else len(m[0]))))
    for m in _HEX_KEY.finditer(text):
        if der_key(bytes.fromhex(re.sub(r"[:\s]", "", m[0]))):
            found.append((m.start(), m.end(), "hex_key"))
    return found


def private_end(text: str) -> int:
    """How far a private key goes in base64 text of one or more lines, 0 without one.

    Its own lengths tell: the lines behind it may be other text.
    """
    whole = _LINE.sub("", text)
    head = _unpad(whole[:16])
    if head is None or not head:
        return 0
    size = None
    if head[0] == 0x30 and len(head) > 5 and head[1] != 0x80 and head[1] <= 0x84:
        n = head[1] & 0x7F if head[1] > 0x80 else 0
        size = 2 + n + (int.from_bytes(head[2 : 2 + n]) if n else head[1])
        letters = -(-4 * size // 3)
        if letters > len(whole) or not der_key(_unpad(whole[:letters])):
            return 0
    elif ssh_key(_unpad(whole)):
        return len(text)
    else:
        return 0
    at = seen = 0
    while seen < letters:
        gap = _LINE.match(text, at)
        at = gap.end() if gap else at + 1
        seen += not gap
    while text[at : at + 1] == "=":
        at += 1
    return at


def secret_spans(text: str) -> list[tuple[int, int, str]]:
    """(start, end, kind) in code points, in order of start, then of kind as listed."""
    return sorted(base_spans(text) + confirmed_spans(text), key=lambda s: (s[0], KINDS.index(s[2])))


def redacted(text: str, spans: list[tuple[int, int, str]], mark: str) -> str:
    """`text` with every run of overlapping spans replaced by `mark`."""
    parts, at = [], 0
    for start, end, _ in spans:
        if start >= at:
            parts += [text[at:start], mark]
        at = max(at, end)
    return "".join([*parts, text[at:]])


_SPANS = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())]))


def find_secrets(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", mark: str = "[SECRET]") -> DataFrame:
    """Per row of `docs`: id, `spans` (kind, start, end in code points), and the `text` with them replaced.

    Null texts count as empty and have no spans. Repeated rows are scanned one by
    one. An empty table gives no rows. Other columns are ignored.
    """

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text"):
                texts = part.column("text").to_pylist()
                spans = [secret_spans(t) for t in texts]
                lists = [[{"kind": k, "start": a, "end": b} for a, b, k in s] for s in spans]
                clean = [redacted(t, s, mark) if s else t for t, s in zip(texts, spans)]
                yield pa.RecordBatch.from_arrays(
                    [part.column("id"), pa.array(lists, _SPANS), pa.array(clean, pa.string())], ["id", "spans", "text"]
                )

    schema = f"id {id_type(docs, id_col)}, spans array<struct<kind string, start bigint, end bigint>>, text string"
    rows = id_and_text(docs, id_col, text_col).drop("row").mapInArrow(scan, schema)
    return rows.select(F.col("id").alias(id_col), "spans", "text")


def redact(docs: DataFrame, text_col: str = "text", mark: str = "[SECRET]") -> DataFrame:
    """`docs` with every secret in `text_col` replaced by `mark`; null texts stay null, other columns as they are."""

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = batch.schema.get_field_index("text")
            for part in slices(batch, "text"):
                texts = [t and redacted(t, secret_spans(t), mark) for t in part.column("text").to_pylist()]
                columns = [*part.columns[:at], pa.array(texts, part.schema.field(at).type), *part.columns[at + 1 :]]
                yield pa.RecordBatch.from_arrays(columns, schema=part.schema)

    # Names that occur once, whatever the columns of `docs` are called.
    inner = docs.toDF(*["text" if c == text_col else f"c{i}" for i, c in enumerate(docs.columns)])
    return inner.mapInArrow(scan, inner.schema).toDF(*docs.columns)


@query()
def op7_secrets(spark, sf_dir):
    found = find_secrets(table(spark, sf_dir, "documents"))
    base = F.filter("spans", lambda s: s["kind"].isin(*BASE_KINDS))
    written = lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))
    counts = [F.size(F.filter("spans", lambda s: s["kind"] == k)).cast("long").alias(f"n_{k}") for k in BASE_KINDS]  # noqa: B023
    return found.select(
        "doc_id",
        *counts,
        F.sha2(F.array_join(F.transform(base, written), ","), 256).alias("base_sha256"),
        F.array_join(F.transform("spans", written), ",").alias("spans"),
    )

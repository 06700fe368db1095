"""Secrets in whole texts: three patterns, and encoded keys confirmed by their structure.

Base kinds are `assign` (a named value), `access` (access key ids) and `hex`
(long hexadecimal runs). Runs of base64, base64url or hexadecimal digits are
decoded besides; they are reported only if the bytes are what they seem to be:

* `jwt`: three dot-separated parts, the first a JSON object with an `alg`, the
  second a JSON object (or ciphertext where the header names an `enc`);
* `der`: an ASN.1 sequence whose nested lengths fill their parents exactly and
  which starts like a private key (a version number, then integers, an algorithm
  or an octet string);
* `ssh`: an OpenSSH private key container whose length fields add up.

A PEM frame needs no pattern of its own: its body is a run with line ends. Line ends
may be written as escapes, as in JSON, and lines may be indented, as in YAML. Where a key
ends is what its own lengths say, whatever the lines before and behind it look like.
"""

import binascii
import hashlib
import json
import re
from base64 import b64decode

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gaugeflow.llm.blocks import blocks
from gaugeflow.llm.scale import mapped

# The base patterns, in the order that breaks ties.
ASSIGN = re.compile(
    r"""((?ai:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]+")
LONG_HEX = re.compile(r"[0-9a-f]{24,}")
KINDS = ("assign", "access", "hex", "jwt", "der", "ssh")
KEY_HINT = re.compile(r"(?ai:password|passwd|secret|token|api_?key)")

# Dotted runs, and where a header may begin: an opening brace, then a quote, a blank or a line end.
DOTTED = re.compile(r"[A-Za-z0-9_-]+(?:\.[A-Za-z0-9_-]*){2,}")
HEADER = re.compile(r"e(?:y[A-DI-L]|w[k-r0-3])")
# Encoded lines, and what may stand between two of them.
LINE = re.compile(r"[A-Za-z0-9+/_-]+")
# What a JSON object begins with.
OBJECT = re.compile(r'\{[ \t\r\n]*(?:"(?:[^"\\]|\\.)*"[ \t\r\n]*:|\})', re.DOTALL)
_ESCAPED = r"(?:\\+r)?\\+n"
ESCAPED, BREAK = re.compile(_ESCAPED), re.compile(rf"(?:\r?\n|{_ESCAPED})[ \t]*")
# A DER sequence starts with byte 30, an OpenSSH container with "openssh-key-v1".
_FIRST = r"(?:(?<![A-Za-z0-9+/_-])|(?<=\\n))"
DER_START = re.compile(_FIRST + "M[A-P][A-Za-z0-9+/_-]")
OPENSSH_START = "b3BlbnNzaC1rZXktdjE"
HEX_KEY = re.compile(r"(?<![0-9A-Fa-f])30[0-9A-Fa-f]{30,}")


def unbase64(run):
    """Bytes of a base64 or base64url run with line ends, padded or not; None if it is neither."""
    if "\\" in run:
        run = ESCAPED.sub("", run)
    body = "".join(run.split()).rstrip("=").replace("-", "+").replace("_", "/")
    if len(body) % 4 == 1:
        return None
    try:
        return b64decode(body + "=" * (-len(body) % 4), validate=True)
    except (binascii.Error, ValueError):
        return None


def _element(data, at, end):
    """Tag, first and last position of the content of the ASN.1 element at `at`; None if cut."""
    if at + 2 > end:
        return None
    tag, size, at = data[at], data[at + 1], at + 2
    if size & 0x80:
        count = size & 0x7F
        if not 1 <= count <= 4 or at + count > end:
            return None
        size, at = int.from_bytes(data[at : at + count], "big"), at + count
    return (tag, at, at + size) if at + size <= end else None


def _fills(data, at, end, depth):
    """Whether elements fill [at, end) exactly, sequences and sets inside them likewise."""
    while at < end:
        part = _element(data, at, end)
        if part is None or part[0] & 0x1F == 0x1F:
            return False
        if part[0] in (0x30, 0x31) and (depth == 0 or not _fills(data, part[1], part[2], depth - 1)):
            return False
        at = part[2]
    return True


def is_private_key(data):
    """A sequence of a small version number and a key body, whose lengths nest exactly."""
    outer = _element(data, 0, len(data))
    if outer is None or outer[0] != 0x30 or outer[2] != len(data) or not _fills(data, *outer[1:], 8):
        return False
    version = _element(data, outer[1], outer[2])
    if version is None or version[0] != 0x02 or version[2] - version[1] != 1 or data[version[1]] > 1:
        return False
    body = _element(data, version[2], outer[2])
    if body is not None and body[0] == 0x30:
        # An algorithm, which may be as short as its identifier, and the key in an octet string.
        name, key = _element(data, body[1], body[2]), _element(data, body[2], outer[2])
        if name is None or name[0] != 0x06 or key is None or key[0] != 0x04:
            return False
        body = key
    return body is not None and body[0] in (0x02, 0x04) and body[2] - body[1] >= 8


def openssh_size(data):
    """Bytes of the container that `data` starts with, or None if it starts with none.

    Its cipher, derivation, options, key count and keys have lengths that add up. Where
    `data` ends too early, the bytes that are needed at least, as a negative number.
    """
    magic = b"openssh-key-v1\0"
    at, texts, count = len(magic), 0, None
    if not data.startswith(magic[: len(data)]):
        return None
    # Three texts, the number of keys, that many public keys and the private part.
    while count is None or texts < 4 + count:
        if at + 4 > len(data):
            return -(at + 4)
        size, at = int.from_bytes(data[at : at + 4], "big"), at + 4
        if texts == 3 and count is None:
            count = size
            if not 1 <= count <= 16:
                return None
            continue
        at, texts = at + size, texts + 1
        if at > len(data):
            return -at
    return at


def der_size(head):
    """Bytes of the sequence whose first bytes are `head`, if it begins with a version number."""
    if len(head) < 9 or head[0] != 0x30:
        return None
    size, at = head[1], 2
    if size & 0x80:
        count = size & 0x7F
        if not 1 <= count <= 4:
            return None
        size, at = int.from_bytes(head[2 : 2 + count], "big"), 2 + count
    return at + size if head[at : at + 2] == b"\x02\x01" else None


def encoded_run(text, start, size):
    """The end of the first `size` encoded characters from `start` on, line breaks between them
    not counted, and how many there are; fewer where the run ends."""
    at, found = start, 0
    while line := LINE.match(text, at, at + size - found):
        found, at = found + line.end() - at, line.end()
        if found == size:
            break
        between = BREAK.match(text, at)
        if not between or not _encoded(text, between.end()):
            break
        at = between.end()
    return at, found


def _encoded(text, at):
    """Whether an encoded character stands at a position."""
    return LINE.match(text, at, at + 1) is not None


def _encoded_chars(size):
    return -(-size * 4 // 3)


def _key_end(text, start, size):
    """The end of a key of `size` bytes that is encoded from `start` on, and its bytes; or None."""
    chars = _encoded_chars(size)
    if chars > len(text) - start:
        return None
    end, found = encoded_run(text, start, chars)
    if found < chars or _encoded(text, end):
        return None
    data = unbase64(text[start:end])
    padding = -chars % 4
    while padding and text.startswith("=", end):
        end, padding = end + 1, padding - 1
    return (end, data) if data is not None else None


def der_spans(text):
    """Spans of encoded private keys. A key's own length says where it ends, so text behind
    it, or a word before it that looks like a beginning, does not matter."""
    at = 0
    while m := DER_START.search(text, at):
        start, at = m.start(), m.start() + 1
        head_end, found = encoded_run(text, start, 12)
        head = unbase64(text[start:head_end]) if found == 12 else None
        size = der_size(head) if head else None
        key = _key_end(text, start, size) if size else None
        if key and is_private_key(key[1]):
            at = key[0]
            yield "der", start, at


def openssh_spans(text):
    """Spans of encoded OpenSSH containers, whose lengths say where they end."""
    at = 0
    while (start := text.find(OPENSSH_START, at)) >= 0:
        at, size = start + 1, 255
        while size:
            end, found = encoded_run(text, start, _encoded_chars(size))
            # A single character more than whole groups holds no byte.
            data = unbase64(text[start : end - (found % 4 == 1)])
            needed = openssh_size(data) if data else None
            key = _key_end(text, start, needed) if needed and needed > 0 else None
            if key:
                at = key[0]
                yield "ssh", start, at
            more = needed is not None and needed < 0 and found == _encoded_chars(size)
            # What needs more than there is left ends here.
            more = more and _encoded_chars(-needed) <= len(text) - start
            size = max(-needed, 2 * size) if more else 0


def _json_object(data):
    try:
        found = json.loads(data) if data else None
    except (ValueError, RecursionError):
        return None
    return found if isinstance(found, dict) else None


_SCAN = json.JSONDecoder()


def headers_in(part):
    """(start, object) of every JSON object that is encoded from `start` to the end of `part`.

    Starts four characters apart share one decoding, and each is read only as far as it is
    JSON, so a long run of beginnings costs no more than its length.
    """
    decoded = {}
    for m in HEADER.finditer(part):
        start, kind = m.start(), (len(part) - m.start()) % 4
        if kind not in decoded:
            data = unbase64(part[start:])
            good = data is not None and data.rstrip(b" \t\r\n").endswith(b"}")
            decoded[kind] = (start, data, data.decode("latin-1")) if good else None
        if decoded[kind] is None:
            continue
        first, data, letters = decoded[kind]
        at = (start - first) // 4 * 3
        if not OBJECT.match(letters, at):
            continue
        try:
            _, end = _SCAN.raw_decode(letters, at)
        except (ValueError, RecursionError):
            continue
        header = _json_object(data[at:]) if not letters[end:].strip(" \t\r\n") else None
        if header is not None:
            yield start, header


def token_parts(header, parts):
    """How many of `parts`, the first of which is the header's, make a signed token; 0 if none do."""
    if not isinstance(header.get("alg"), str):
        return 0
    count = 5 if "enc" in header else 3
    if len(parts) < count:
        return 0
    if "enc" in header:
        return count if all(unbase64(p) is not None for p in parts[1:count]) else 0
    signed = header["alg"].lower() == "none" or bool(parts[2] and unbase64(parts[2]))
    return count if signed and _json_object(unbase64(parts[1])) is not None else 0


def token_spans(text):
    """Spans of signed tokens: three parts with dots between them, or five.

    Parts beyond the token's own, such as the empty one after a full stop, do not belong to it.
    """
    for run in DOTTED.finditer(text):
        parts, at, k = run[0].split("."), run.start(), 0
        while k < len(parts) - 2:
            count = 0
            for start, header in headers_in(parts[k]):
                if count := token_parts(header, parts[k : k + 5]):
                    yield "jwt", at + start, at + len(".".join(parts[k : k + count]))
                    break
            for _ in range(max(1, count)):
                at, k = at + len(parts[k]) + 1, k + 1


def base_spans(text):
    """(kind, start, end) of the three patterns, by start, then in the order of KINDS."""
    found = []
    if KEY_HINT.search(text):
        found += [
            ("assign", m.start(), m.end())
            for m in ASSIGN.finditer(text)
            if m.end(2) - m.start(2) >= 6
        ]
    if "AKIA" in text:
        found += [
            ("access", m.start(), m.end()) for m in ACCESS.finditer(text) if m.end() - m.start() >= 20
        ]
    # A run of 24 digits or more is found from its first digit on, as by HEX.
    found += [("hex", m.start(), m.end()) for m in LONG_HEX.finditer(text)]
    return sorted(found, key=_order)


def confirmed_spans(text):
    """Spans whose decoded bytes parse as a token or a private key."""
    found = list(token_spans(text)) if "." in text else []
    found += der_spans(text)
    found += openssh_spans(text)
    for m in HEX_KEY.finditer(text):
        if len(m[0]) % 2 == 0 and is_private_key(bytes.fromhex(m[0])):
            found.append(("der", m.start(), m.end()))
    return found


def _order(span):
    return span[1], KINDS.index(span[0]), span[2]


def written(spans):
    return ",".join(f"{kind}:{start}:{end}" for kind, start, end in spans)


def masked(text, spans, mark="[SECRET]"):
    """`text` with every stretch covered by spans replaced by one mark."""
    parts, at = [], 0
    for _, start, end in sorted(spans, key=lambda s: (s[1], s[2])):
        if end <= at:
            continue
        if start >= at:
            parts += [text[at:start], mark]
        at = end
    return "".join([*parts, text[at:]])


def find_secrets(docs: DataFrame, id_col="doc_id", text_col="text") -> DataFrame:
    """id, text with secrets masked, `found` (kind, start, end) and the base kinds' spans as text.

    Positions are code points, ends exclusive. Null and empty texts hold nothing and
    stay as they are; a null id stays null; repeated rows give repeated results;
    other columns are ignored. Base spans are reported whatever the decoded bytes
    say; two spans may overlap.
    """
    kind = docs.schema[id_col].dataType.simpleString()
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    span = pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())])

    def scan(batches):
        for block in blocks(batches, "text"):
            found, texts, base = [], [], []
            for text in block.column("text").to_pylist():
                own = base_spans(text) if text else []
                every = sorted(own + confirmed_spans(text), key=_order) if text else []
                base.append(written(own))
                found.append([dict(zip(("kind", "start", "end"), s)) for s in every])
                texts.append(masked(text, every) if every else text)
            yield pa.RecordBatch.from_arrays(
                [
                    block.column("id"),
                    pa.array(texts, pa.string()),
                    pa.array(found, pa.list_(span)),
                    pa.array(base, pa.string()),
                ],
                names=["id", "masked", "found", "base"],
            )

    schema = (
        f"id {kind}, masked string, "
        "found array<struct<kind:string,start:bigint,end:bigint>>, base string"
    )
    return mapped(rows, scan, schema).withColumnRenamed("id", id_col)


def mask_secrets(docs: DataFrame, text_col="text", length_col="n_chars") -> DataFrame:
    """All columns of `docs`, with the secrets in the text masked and its length renewed.

    `length_col` is renewed only where the text changes, and only if there is such a column.
    """
    at = docs.columns.index(text_col)

    def mask(batches):
        for block in blocks(batches, text_col):
            texts = block.column(at).to_pylist()
            for number, text in enumerate(texts):
                spans = (base_spans(text) + confirmed_spans(text)) if text else []
                if spans:
                    texts[number] = masked(text, spans)
            yield block.set_column(at, block.schema.field(at), pa.array(texts, block.schema.field(at).type))

    if length_col not in docs.columns:
        return mapped(docs, mask, docs.schema)
    before = docs.withColumn("_length_before", F.length(text_col))
    out = mapped(before, mask, before.schema)
    now = F.length(text_col)
    kind = docs.schema[length_col].dataType
    length = F.when(now != F.col("_length_before"), now.cast(kind)).otherwise(F.col(length_col))
    return out.withColumn(length_col, length).drop("_length_before")


def secret_digest(docs: DataFrame, id_col="doc_id", text_col="text") -> DataFrame:
    """Counts and span texts of `find_secrets`, one row per row."""
    found = find_secrets(docs, id_col, text_col)

    def count(kind):
        return F.size(F.filter("found", lambda s: s.kind == kind)).cast("long").alias(f"n_{kind}")

    line = F.transform("found", lambda s: F.concat_ws(":", s.kind, s.start, s.end))
    return found.select(
        id_col,
        *[count(kind) for kind in KINDS[:3]],
        F.sha2("base", 256).alias("base_sha256"),
        F.array_join(line, ",").alias("spans"),
        *[count(kind) for kind in KINDS[3:]],
    )


def base_digest(text):
    """What `base_sha256` is for one text."""
    return hashlib.sha256(written(base_spans(text or "")).encode()).hexdigest()

"""Secrets in whole texts: fixed patterns, and strings a compressor cannot predict.

The base kinds are leftmost non-overlapping matches of a pattern each: ``assign``
(a keyword, a sign and a value of 12 or more), ``access`` (an access key of 18 or
more) and ``hex`` (16 or more). The method adds ``novel``: a candidate of
``LEAST_CANDIDATE`` or more characters with a sensitive word in the ``REACH`` code
points before it. In ``NAME=value`` the value is a candidate too, and the name stands
before it. What base spans cover in part is measured whole, and its span overlaps
theirs; what they cover wholly is not measured. A zstandard compressor primed with a
dictionary of common identifiers compresses the text around it without and with
the candidate; what it adds, in bytes for each character, is its novelty, and one
of ``NOVELTY`` or more is reported. Words, paths and names that the text or the
dictionary holds already add little.

Offsets are code points, ends exclusive. Null and empty texts have no spans.
"""

from __future__ import annotations

import hashlib
import re

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from textgraph.llm.hashing import as_bytes, code_points, runs
from textgraph.llm.tables import keeps_columns, map_blocks, strings, table

KINDS = ("assign", "access", "hex", "novel")
ASSIGN = r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = r"AKIA[A-Z0-9]+"
LEAST_VALUE, LEAST_ACCESS, LEAST_HEX = 12, 18, 16

CANDIDATE = r"[A-Za-z0-9+/_.=-]{20,}"
LEAST_CANDIDATE = 20
REACH = 64
CONTEXT = 256
NOVELTY = 0.75
SENSITIVE = r"key|secret|token|passw|credential|auth|bearer|private|signature|session|cookie"
# Identifiers common in code and settings.
IDENTIFIERS = (
    "access_key secret_key api_key client_id client_secret private_key public_key auth_token refresh_token "
    "session_id password username user_name hostname database connection configuration environment production "
    "development application authorization authentication certificate credentials Content-Type application/json "
    "https://www. http://localhost: /usr/local/bin/ /home/user/ index.html README.md package.json "
    "getElementById addEventListener toString hashCode StringBuilder ArrayList HashMap IllegalArgumentException "
    "import_module __init__ self.assertEqual numpy pandas DataFrame function return const static public class "
    "abcdefghijklmnopqrstuvwxyz ABCDEFGHIJKLMNOPQRSTUVWXYZ 0123456789 example placeholder changeme xxxxxxxxxxxxxxxx "
    "----------------------------------------------------------------"
)


def base_matches(text: str, assign: re.Pattern, access: re.Pattern) -> list[tuple[int, int, int]]:
    """``(start, kind, end)`` of the matches of ``assign`` and ``access``."""
    found = [(m.start(), 0, m.end()) for m in assign.finditer(text) if m.end(2) - m.start(2) >= LEAST_VALUE]
    if "AKIA" in text:
        found += [(m.start(), 1, m.end()) for m in access.finditer(text) if m.end() - m.start() >= LEAST_ACCESS]
    return found


def hex_runs(texts: pa.Array) -> list[list[tuple[int, int, int]]]:
    """``(start, kind, end)`` of the runs of lower-case hexadecimal digits in each text."""
    data, starts = as_bytes(texts)
    digit = np.zeros(256, bool)
    digit[48:58] = digit[97:103] = True
    start, end, _ = runs(digit[data], starts)
    long = end - start >= LEAST_HEX
    start, end = start[long], end[long]
    row = np.searchsorted(starts, start, side="right") - 1
    out: list[list[tuple[int, int, int]]] = [[] for _ in range(len(texts))]
    if len(start):
        points = code_points(data)
        before = points[start] - points[starts[row]]
        for i, a, size in zip(row.tolist(), before.tolist(), (end - start).tolist(), strict=True):
            out[i].append((a, 2, a + size))
    return out


def novelty(text: str, start: int, end: int, compressor: zstandard.ZstdCompressor) -> float:
    """Bytes that the span adds to the compressed text around it, for each of its characters."""
    around = text[max(0, start - CONTEXT) : start] + text[end : end + CONTEXT]
    known = around.encode("utf-8", "replace")
    added = len(compressor.compress(known + text[start:end].encode())) - len(compressor.compress(known))
    return added / (end - start)


def value_starts(part: str, sensitive: re.Pattern) -> list[int]:
    """Where a value can begin in a candidate: at its own start, behind its first and last
    sign, and behind the first sign after each sensitive word; padding at the end is no sign."""
    body = part.rstrip("=")
    if "=" not in body:
        return [0]
    signs = {body.find("="), body.rfind("=")}
    signs.update(body.find("=", m.end()) for m in sensitive.finditer(body))
    return sorted({0, *(len(body) - len(body[i:].lstrip("=")) for i in signs if i >= 0)})


def novel_span(text: str, start: int, end: int, near: list[tuple[int, int]], sensitive: re.Pattern, compressor: zstandard.ZstdCompressor) -> tuple[int, int] | None:
    """The longest novel value of a candidate that base spans, of which ``near`` has those that meet it, do not cover."""
    for at in value_starts(text[start:end], sensitive):
        at += start
        if end - at < LEAST_CANDIDATE:
            break
        covered = at
        for a, b in near:
            if a <= covered:
                covered = max(covered, b)
        if covered < end and sensitive.search(text, max(0, at - REACH), at) and novelty(text, at, end, compressor) >= NOVELTY:
            return at, end
    return None


def scan(texts: pa.Array, values: list[str]) -> list[list[tuple[int, int, int]]]:
    """All spans ``(start, kind, end)`` of each text, by start and kind."""
    assign, access = re.compile(ASSIGN, re.A | re.I), re.compile(ACCESS)
    candidate, sensitive = re.compile(CANDIDATE), re.compile(SENSITIVE, re.A | re.I)
    primed = zstandard.ZstdCompressionDict(IDENTIFIERS.encode(), dict_type=zstandard.DICT_TYPE_RAWCONTENT)
    compressor = zstandard.ZstdCompressor(level=3, dict_data=primed)
    out = []
    for text, found in zip(values, hex_runs(texts), strict=True):
        found += base_matches(text, assign, access)
        base = sorted((a, b) for a, _, b in found)
        near: list[tuple[int, int]] = []
        read = 0
        # Candidates rise and do not overlap, so one sweep over the base spans meets them all.
        for m in candidate.finditer(text):
            while read < len(base) and base[read][0] < m.end():
                near.append(base[read])
                read += 1
            near = [x for x in near if x[1] > m.start()]
            span = novel_span(text, *m.span(), near, sensitive, compressor)
            if span is not None:
                found.append((span[0], 3, span[1]))
        out.append(sorted(found))
    return out


def joined(spans: list[tuple[int, int, int]]) -> str:
    return ",".join(f"{KINDS[kind]}:{a}:{b}" for a, kind, b in spans)


def find_secrets(docs: DataFrame) -> DataFrame:
    """``(doc_id, n_assign, n_access, n_hex, base_sha256, spans, found)``; ``found`` has the
    spans as an array of ``(kind, start, end)``."""
    span = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())]))

    def work(block: pa.RecordBatch) -> pa.RecordBatch:
        spans = scan(block.column("text"), strings(block))
        counts = [[sum(k == kind for _, k, _ in x) for x in spans] for kind in range(3)]
        digests = [hashlib.sha256(joined([s for s in x if s[1] < 3]).encode()).hexdigest() for x in spans]
        found = [[{"kind": KINDS[k], "start": a, "end": b} for a, k, b in x] for x in spans]
        return pa.record_batch(
            [block.column("doc_id"), *(pa.array(c, pa.int64()) for c in counts), pa.array(digests), pa.array([joined(x) for x in spans]), pa.array(found, span)],
            ["doc_id", "n_assign", "n_access", "n_hex", "base_sha256", "spans", "found"],
        )

    id_type = docs.schema["doc_id"].dataType.simpleString()
    return map_blocks(
        docs.select("doc_id", "text"),
        work,
        f"doc_id {id_type}, n_assign bigint, n_access bigint, n_hex bigint, base_sha256 string, spans string, "
        "found array<struct<kind:string,start:bigint,end:bigint>>",
    )


def redact(docs: DataFrame, mark: str = "[secret]") -> DataFrame:
    """``docs`` with every span of its texts replaced by ``mark``; ``n_chars`` follows, where there is one.

    Spans that overlap are replaced by one mark. A null text stays null.
    """

    def work(block: pa.RecordBatch) -> pa.RecordBatch:
        values = strings(block)
        clean = []
        for text, spans in zip(values, scan(block.column("text"), values), strict=True):
            parts, at = [], 0
            for a, _, b in spans:
                if a >= at:
                    parts += [text[at:a], mark]
                at = max(at, b)
            clean.append("".join([*parts, text[at:]]) if spans else None)
        texts = [new if new is not None else old for new, old in zip(clean, block.column("text").to_pylist(), strict=True)]
        cols = {name: block.column(name) for name in block.schema.names}
        cols["text"] = pa.array(texts, pa.string())
        if "n_chars" in cols:
            sizes = pa.array([None if new is None else len(new) for new in clean], pa.int64())
            cols["n_chars"] = pc.coalesce(sizes.cast(cols["n_chars"].type), cols["n_chars"])
        return pa.record_batch(list(cols.values()), list(cols))

    return map_blocks(docs, work, docs.schema)


def op10_secrets(spark, sf_dir: str) -> DataFrame:
    """The spans of secrets in all documents."""
    return find_secrets(table(spark, sf_dir, "documents")).drop("found")


@keeps_columns
def redact_secrets(spark, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, secrets in their texts replaced."""
    return redact(docs)

"""Operator 3: secrets by form, and by how little a dictionary of code helps to compress them.

Strings of a known form are found by pattern. Other long strings near a word that
hints at a secret are measured: the bytes that the string adds to a zstandard frame whose
dictionary holds common identifiers and the text around it. Names, paths and words found
elsewhere nearby cost little; what stays as large as random text is reported.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from demandflow.llm.common import text_of
from demandflow.session import ship_package

KINDS = ("assign", "access", "hex", "novel")  # at the same place in this order
MIN_VALUE, MIN_ACCESS, MIN_HEX = 8, 16, 32  # characters
SURROUNDING = 512  # characters on both sides that prime the dictionary
HINT_REACH = 40  # characters before a string in which a hint counts
MIN_CANDIDATE = 20  # characters of a string that is measured
MIN_NOVELTY = 0.62  # marginal bytes per character; random hexadecimal digits come to about 0.6, base 64 to 0.8

FINDINGS = "array<struct<kind:string,start:bigint,end:bigint,novelty:double>>"

# Names that often stand near secrets in code and settings; what they spell is not novel.
IDENTIFIERS = (
    "access account address admin api application argument array async authorization await aws azure base64 bearer "
    "branch bucket build cache callback certificate character class client cluster commit component config connection "
    "console const container content context cookie credential database debug decode default define delete deploy "
    "description development directory disable document domain download email enable encode endpoint environment error "
    "example exception export extends false file filter float folder format function gateway github google handler hash "
    "header hostname https identifier implementation import include index initialize input instance integer interface "
    "internal javascript json key kubernetes language length library license listener local localhost location logger "
    "login message method middleware model module namespace network notification null number object option output package "
    "parameter parent password path payload permission pipeline plugin policy port prefix private process production "
    "profile project property protocol provider proxy public python query queue random reference region registry release "
    "repository request require resource response result return router runtime schema script secret security select server "
    "service session setting signature source status storage stream string subscription suffix switch system table target "
    "template terminal test thread timeout timestamp token transaction transform true undefined update upload username "
    "validate value variable version warning webhook website window worker workspace 0123456789 abcdefghijklmnopqrstuvwxyz "
    "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
)

ASSIGN = re.compile(
    r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.ASCII | re.IGNORECASE
)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{%d,}" % MIN_HEX)
CANDIDATE = re.compile(r"[A-Za-z0-9+/_=-]{%d,}" % MIN_CANDIDATE)
HINT = re.compile(r"key|auth|bearer|private|credential|pwd|passphrase|signature|secret|token|passw", re.IGNORECASE)


class Novelty:
    """Marginal compressed bytes of a string, given the text around it."""

    def __init__(self, identifiers: str = IDENTIFIERS, level: int = 6) -> None:
        self.identifiers = identifiers.encode()
        self.level = level

    def size(self, primer: bytes, data: bytes) -> int:
        words = zstandard.ZstdCompressionDict(primer, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
        compressor = zstandard.ZstdCompressor(level=self.level, dict_data=words, write_content_size=False)
        return len(compressor.compress(data))

    def of(self, text: str, start: int, end: int) -> float:
        """Bytes per character that text[start:end] adds behind its surroundings."""
        before, after = text[max(0, start - SURROUNDING) : start], text[end : end + SURROUNDING]
        primer = self.identifiers + after.encode("utf-8", "replace") + before.encode("utf-8", "replace")
        candidate = text[start:end].encode("utf-8", "replace")
        lead = before[-HINT_REACH:].encode("utf-8", "replace")
        return (self.size(primer, lead + candidate) - self.size(primer, lead)) / len(candidate)


def base_spans(text: str) -> list[tuple[int, int, int, int, int]]:
    """(start, kind number, end, start and end of the value) of all strings of a known form, per kind."""
    found = []
    lower = text.lower()
    if any(word in lower for word in ("passw", "secret", "token", "api")):
        for m in ASSIGN.finditer(text):
            if len(m[2]) >= MIN_VALUE:
                found.append((m.start(), 0, m.end(), m.start(2), m.end(2)))
    if "AKIA" in text:
        found += [(m.start(), 1, m.end(), *m.span()) for m in ACCESS.finditer(text) if len(m[0]) >= MIN_ACCESS]
    found += [(m.start(), 2, m.end(), *m.span()) for m in HEX.finditer(text)]
    return sorted(found)


def scan(text: str, novelty: Novelty, min_novelty: float = MIN_NOVELTY) -> list[dict]:
    """Findings of one text, by start, then kind."""
    base = base_spans(text)
    spans = [(start, kind, end, novelty.of(text, a, b)) for start, kind, end, a, b in base]
    if HINT.search(text):
        covered, last = iter([*[(s, e) for s, _, e, _, _ in base], (len(text) + 1, len(text) + 1)]), (0, 0)
        for m in CANDIDATE.finditer(text):
            while last[1] <= m.start():
                last = next(covered)
            if last[0] < m.end() or not HINT.search(text, max(0, m.start() - HINT_REACH), m.start()):
                continue
            value = novelty.of(text, *m.span())
            # A long word is not a secret: random strings mix digits with letters.
            if value >= min_novelty and re.search("[0-9]", m[0]) and re.search("[A-Za-z]", m[0]):
                spans.append((m.start(), 3, m.end(), value))
    return [{"kind": KINDS[k], "start": s, "end": e, "novelty": v} for s, k, e, v in sorted(spans)]


def secrets(docs: DataFrame, min_novelty: float = MIN_NOVELTY) -> DataFrame:
    """doc_id and ``findings`` of every row: kind, start, end (code points, end exclusive) and novelty.

    Findings are ordered by start, then kind. Those of the kinds assign, access and
    hex are reported whatever their novelty. A null or empty text has none, the array is then empty; equal
    rows have equal findings; an empty table gives no rows; columns other than
    doc_id and text are not looked at. Rows are not shuffled.
    """
    ship_package(docs.sparkSession)
    texts = docs.select(docs["doc_id"].alias("doc_id"), text_of(docs).alias("text"))
    span = pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64()), ("novelty", pa.float64())])

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        novelty = Novelty()
        for batch in batches:
            findings = pa.array([scan(t.as_py(), novelty, min_novelty) for t in batch.column(1)], pa.list_(span))
            yield pa.RecordBatch.from_arrays([batch.column(0), findings], ["doc_id", "findings"])

    kind = texts.schema["doc_id"].dataType.simpleString()
    return texts.mapInArrow(find, f"doc_id {kind}, findings {FINDINGS}")


def joined_spans(findings: Column) -> Column:
    """kind:start:end of all ``findings``, joined by commas."""
    return F.array_join(
        F.transform(findings, lambda f: F.concat_ws(":", f["kind"], f["start"].cast("string"), f["end"].cast("string"))),
        ",",
    )

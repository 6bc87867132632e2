"""Secret scans: three fixed patterns, and strings that a primed compressor finds new in a sensitive context.

Candidates are long runs of token characters that are not all digits, near a word that announces a credential. A run is
split at "=" into name and value, padding aside, and what a pattern covers of it is left out. A candidate's novelty is what it adds to the compressed size of its surroundings, per character, under zstandard primed
with a dictionary of identifiers: names that code or the surroundings already use cost little, random strings cost about
a byte per character. Candidates above the threshold are reported beside the matches of the patterns, which always stay.

Defined results: a null text is empty and has no span; spans count code points, their end is exclusive; repeated rows are
scanned alike; texts of any length are scanned whole; other columns pass through, those named like a result are replaced.
"""

from __future__ import annotations

import re
from bisect import bisect_left
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import accumulate

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Kinds in the order in which spans with equal starts are listed.
BASE_KINDS = ["assign", "access", "hex"]
NOVEL = "novel"

# The base patterns, with the part and length that a match must have.
ASSIGN = re.compile(
    rb"((?i:password|passwd|secret|token|api_?key))[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)"
)
ACCESS = re.compile(rb"AKIA[A-Z0-9]+")
HEX = re.compile(rb"[0-9a-f]{16,}")
ASSIGN_SIZE, ACCESS_SIZE, HEX_SIZE = 12, 18, 16

# Words that announce a credential, in lower case.
SENSITIVE = [
    b"auth", b"bearer", b"cert", b"credential", b"key", b"login", b"passw", b"private", b"pwd",
    b"secret", b"session", b"signature", b"token",
]

# Names that code uses often, which prime the compressor.
IDENTIFIERS = (
    "access account address algorithm api application argument array assert async attribute auth "
    "authorization await base64 begin boolean buffer bytes cache callback certificate char class client "
    "config connection const constructor container content context controller cookie count create "
    "credential database datetime debug decode default delete describe encode encrypt endpoint "
    "environment error event exception execute export expires extends false field filename final float "
    "format function generate getElementById handler hash header hostname identifier implements import "
    "index initialize instance integer interface iterator json key length level license list localhost "
    "logger login manager message method module namespace number object offset option output override "
    "package parameter password path payload permission port private process production property protected "
    "protocol provider public query queue random reader receive record redirect register release remote "
    "request response result return schema secret select sequence server service session signature "
    "socket source static status string struct subscribe system table template thread timeout timestamp "
    "token transaction true undefined update upload url user username utf-8 uuid validate value variable "
    "version virtual void webhook writer 0123456789 abcdefghijklmnopqrstuvwxyz ABCDEFGHIJKLMNOPQRSTUVWXYZ"
)

CANDIDATE = re.compile(rb"[A-Za-z0-9+/_=-]{16,}")
PART = re.compile(rb"[^=]+(?:=+$)?")
PART_SIZE = 12
ANNOUNCED = re.compile(b"(?=(" + b"|".join(SENSITIVE) + b"))")


@dataclass(frozen=True)
class Limits:
    """Bytes looked at on both sides of a candidate, and the novelty from which it is reported."""

    context: int = 256
    announced_within: int = 48
    novelty: float = 0.75


SPAN = "array<struct<kind: string, start: bigint, end: bigint, novelty: double>>"


class Scanner:
    def __init__(self, limits: Limits):
        import zstandard

        self.limits = limits
        primed = zstandard.ZstdCompressionDict(
            IDENTIFIERS.encode(), dict_type=zstandard.DICT_TYPE_RAWCONTENT
        )
        self.compressor = zstandard.ZstdCompressor(
            level=9, dict_data=primed, write_content_size=False, write_checksum=False
        )
        self.is_hex = bytes(49 if chr(i) in "0123456789abcdef" else 48 for i in range(256))

    def _base(self, data: bytes) -> list[tuple[int, int, str]]:
        found = []
        low = data.lower()
        if any(w in low for w in (b"passw", b"secret", b"token", b"api")):
            found += [
                (m.start(), m.end(), "assign")
                for m in ASSIGN.finditer(data)
                if m.end(2) - m.start(2) >= ASSIGN_SIZE
            ]
        if b"AKIA" in data:
            found += [
                (m.start(), m.end(), "access")
                for m in ACCESS.finditer(data)
                if m.end() - m.start() >= ACCESS_SIZE
            ]
        # Maximal runs of hex digits: a run that is long enough is found from its first digit.
        if b"1" * HEX_SIZE in data.translate(self.is_hex):
            found += [(m.start(), m.end(), "hex") for m in HEX.finditer(data)]
        return found

    def novelty(self, before: bytes, candidate: bytes, after: bytes) -> float:
        """Compressed bytes that the candidate adds to its surroundings, per byte of it."""
        without = len(self.compressor.compress(before + after))
        return (len(self.compressor.compress(before + candidate + after)) - without) / len(candidate)

    def _parts(self, data: bytes, taken: list[tuple[int, int, str]]) -> Iterator[tuple[int, int, int]]:
        """Start and end of what the patterns leave of the parts of all runs, and where the name before it starts."""
        covered: list[list[int]] = []
        for s, e, _ in sorted(taken):
            if covered and s <= covered[-1][1]:
                covered[-1][1] = max(covered[-1][1], e)
            else:
                covered.append([s, e])
        covered.append([len(data), len(data)])
        # Parts follow each other, so what ends before one of them is never looked at again.
        first = 0
        for run in CANDIDATE.finditer(data):
            name = run.start()
            for m in PART.finditer(run.group()):
                at, end = run.start() + m.start(), run.start() + m.end()
                while covered[first][1] <= at and first < len(covered) - 1:
                    first += 1
                j = first
                while covered[j][0] < end:
                    if covered[j][0] - at >= PART_SIZE:
                        yield at, covered[j][0], name
                    at = max(at, covered[j][1])
                    j += 1
                if end - at >= PART_SIZE:
                    yield at, end, name
                name = run.start() + m.start()

    def _novel(self, data: bytes, taken: list[tuple[int, int, str]]) -> list[tuple[int, int, float]]:
        found, lim = [], self.limits
        starts = ends = None
        for start, end, name in self._parts(data, taken):
            part = data[start:end]
            if part.isdigit():
                continue
            if starts is None:
                # All sensitive words, and the first end of those that start at or after each of them.
                words = [m.span(1) for m in ANNOUNCED.finditer(data.lower())]
                starts = [s for s, _ in words]
                ends = [*accumulate((e for _, e in reversed(words)), min)][::-1]
            word = bisect_left(starts, max(0, min(name, start - lim.announced_within)))
            if word == len(starts) or ends[word] > start:
                continue
            before, after = data[max(0, start - lim.context) : start], data[end : end + lim.context]
            value = self.novelty(before, part, after)
            if value >= lim.novelty:
                found.append((start, end, value))
        return found

    def scan(self, text: str | None) -> list[tuple[str, int, int, float | None]]:
        """Kind, start, end and novelty of all spans, in code points, by start and then kind."""
        data = (text or "").encode()
        base = self._base(data)
        found = [(s, e, k, None) for s, e, k in base]
        found += [(s, e, NOVEL, v) for s, e, v in self._novel(data, base)]
        if not found:
            return []
        places, at, points = {}, 0, 0
        for place in sorted({x for s, e, _, _ in found for x in (s, e)}):
            points += len(data[at:place].decode())
            at = place
            places[place] = points
        order = [*BASE_KINDS, NOVEL]
        found.sort(key=lambda x: (x[0], order.index(x[2])))
        return [(k, places[s], places[e], v) for s, e, k, v in found]


def scan(docs: DataFrame, limits: Limits = Limits()) -> DataFrame:
    """``docs`` with ``spans``: kind, start, end and novelty (null for the patterns)."""

    @F.pandas_udf(SPAN)
    def spans(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        scanner = Scanner(limits)
        names = ("kind", "start", "end", "novelty")
        for texts in batches:
            yield pd.Series([[dict(zip(names, s, strict=True)) for s in scanner.scan(t)] for t in texts])

    return docs.withColumn("spans", spans(F.col("text")))


def listed(spans: Column) -> Column:
    """``kind:start:end`` of all spans, joined by commas."""
    return F.array_join(
        F.transform(
            spans,
            lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string")),
        ),
        ",",
    )


def redacted(text: str | None, spans, mask: str) -> str | None:
    """The text with every span replaced by the mask; spans that overlap are replaced together."""
    if text is None or not spans:
        return text
    out, at = [], 0
    last = 0
    for start, end in sorted(spans):
        if start >= last:
            out += [text[at:start], mask]
        at = last = max(last, end)
    return "".join([*out, text[at:]])


def redact(docs: DataFrame, mask: str = "[secret]", limits: Limits = Limits()) -> DataFrame:
    """``docs`` with all spans masked in ``text``, and ``n_chars`` of the new text where that column exists."""

    @F.pandas_udf("string")
    def cleaned(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        scanner = Scanner(limits)
        for texts in batches:
            yield pd.Series(
                [redacted(t, [s[1:3] for s in scanner.scan(t)], mask) for t in texts], dtype=object
            )

    rows = docs.withColumn("text", cleaned(F.col("text")))
    if "n_chars" in docs.columns:
        rows = rows.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))
    return rows

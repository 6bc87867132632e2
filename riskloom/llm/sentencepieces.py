"""SentencePiece encoding that keeps offsets, and decoding.

A text is normalised by longest prefixes through the character map compiled into the model file (a double-array trie over
UTF-8 bytes). For every normalised byte the source byte is kept, so the borders of all pieces project to byte spans of
the original text. Pieces come from the sentencepiece library, run on the normalised text with its own normaliser off.

The library is asked once per distinct segment of a task. A text is cut only where no piece of the vocabulary reaches
across, so merges on both sides cannot meet and the ids are those of the whole text.

Defined results: a null text is empty and has the begin and end ids alone; repeated rows are encoded alike; texts of any
length are encoded whole; other columns pass through, those named like a result are replaced.
"""

from __future__ import annotations

import hashlib
import re
import struct
from array import array
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import islice

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

SPACE = "▁"

#: Bytes, about, of each half of the segments that a task remembers, and what one takes beside its characters.
REMEMBERED = 16 << 20
ENTRY = 200

#: Rows whose ids a task holds at once.
PART_ROWS = 200

CONTROL = 3  # piece type in the model file
BYTE = 6


def _fields(data: bytes) -> Iterator[tuple[int, int, object]]:
    """Fields of a protocol buffer message: number, wire type, value."""
    at = 0

    def varint() -> int:
        nonlocal at
        value = shift = 0
        while True:
            byte = data[at]
            at += 1
            value |= (byte & 127) << shift
            shift += 7
            if byte < 128:
                return value

    while at < len(data):
        key = varint()
        kind = key & 7
        if kind == 0:
            value = varint()
        else:
            size = {1: 8, 5: 4}.get(kind) or varint()
            value = data[at : at + size]
            at += size
        yield key >> 3, kind, value


def _field(number: int, kind: int, value) -> bytes:
    def varint(n: int) -> bytes:
        out = bytearray()
        while n > 127:
            out.append(n & 127 | 128)
            n >>= 7
        return bytes([*out, n])

    head = varint(number << 3 | kind)
    if kind == 0:
        return head + varint(value)
    return head + (varint(len(value)) if kind == 2 else b"") + value


class CharMap:
    """The compiled character map: longest prefix of UTF-8 bytes to its replacement."""

    def __init__(self, blob: bytes):
        self.units: tuple[int, ...] = ()
        self.strings = b""
        if blob:
            (size,) = struct.unpack("<I", blob[:4])
            self.units = struct.unpack(f"<{size // 4}I", blob[4 : 4 + size])
            self.strings = blob[4 + size :]
        self.starts = frozenset(b for b in range(256) if self.units and self._starts(b))

    @staticmethod
    def _offset(unit: int) -> int:
        return (unit >> 10) << ((unit & 512) >> 6)

    def _starts(self, byte: int) -> bool:
        at = self._offset(self.units[0]) ^ byte
        return at < len(self.units) and self.units[at] & 0x800000FF == byte

    def longest(self, data: bytes, start: int) -> tuple[bytes, int] | None:
        """Replacement and length of the longest key that ``data`` has at ``start``."""
        units, found = self.units, None
        at = self._offset(units[0])
        for i in range(start, len(data)):
            at ^= data[i]
            unit = units[at]
            if unit & 0x800000FF != data[i]:
                break
            at ^= self._offset(unit)
            if unit >> 8 & 1:
                found = (units[at] & 0x7FFFFFFF, i + 1 - start)
        if found is None:
            return None
        return self.strings[found[0] : self.strings.index(b"\0", found[0])], found[1]


@dataclass
class Encoding:
    """Ids with begin and end, and for each the first and last byte (exclusive) of the original text."""

    ids: np.ndarray
    starts: np.ndarray
    ends: np.ndarray


class _Segments(dict):
    """Ids of segments as bytes, with ``lead`` put before them; the library is asked once for all new ones of a text.

    When full, the segments become the older half, from which those that are used again come back.
    """

    def __init__(self, library, lead: str = ""):
        self.library, self.lead, self.older, self.bytes = library, lead, {}, 0

    def ids(self, segments: list[str]) -> list[bytes]:
        """Ids of each segment; the library is asked for distinct ones."""
        distinct = set(segments)
        fresh = [s for s in distinct if s not in self]
        if fresh:
            if self.bytes > REMEMBERED:
                self.older, self.bytes = dict(self), 0
                self.clear()
                fresh = distinct
            known = {s: self.older[s] for s in fresh if s in self.older}
            new = [s for s in fresh if s not in known]
            if new:
                known.update(zip(new, self._asked(new), strict=True))
            self.update(known)
            # An id has four bytes, a character up to four.
            self.bytes += ENTRY * len(known) + 4 * sum(map(len, known)) + sum(map(len, known.values()))
        return list(map(self.__getitem__, segments))

    def _asked(self, segments: list[str]) -> list[bytes]:
        """Ids from the library: of all segments in one line each, where a line feed is one id that no segment has."""
        feed = self.library.encode("\n")
        lines = "\n".join([self.lead + s for s in segments])
        if len(feed) > 1 or lines.count("\n") >= len(segments):
            return [array("I", self.library.encode(self.lead + s)).tobytes() for s in segments]
        ids = np.array(self.library.encode(lines + "\n"), dtype="<u4")
        ends = (4 * np.flatnonzero(ids == feed[0])).tolist()
        data, starts = ids.tobytes(), [0, *[end + 4 for end in ends]]
        return [data[start:end] for start, end in zip(starts[:-1], ends, strict=True)]


class Encoder:
    def __init__(self, path: str):
        import sentencepiece

        with open(path, "rb") as file:
            model = file.read()
        pieces, spec, trainer, rest = [], {}, {}, []
        for number, kind, value in _fields(model):
            if number == 1:
                pieces.append({n: v for n, _, v in _fields(value)})
            elif number == 2:
                trainer = {n: v for n, _, v in _fields(value)}
            if number == 3:
                spec = {n: v for n, _, v in _fields(value)}
            else:
                rest.append(_field(number, kind, value))
        self.map = CharMap(spec.get(2, b""))
        self.dummy, self.strip, self.escape = (bool(spec.get(n, 1)) for n in (3, 4, 5))
        self.suffix = bool(trainer.get(24, 0))
        if any(p.get(3, 1) == 4 for p in pieces):
            raise ValueError("models with user-defined pieces are not supported")
        off = b"".join([_field(1, 2, b"identity"), *[_field(n, 0, 0) for n in (3, 4, 5)]])
        self.library = sentencepiece.SentencePieceProcessor(model_proto=model)
        plain = sentencepiece.SentencePieceProcessor(
            model_proto=b"".join([*rest, _field(3, 2, off)])
        )
        self.segments, self.words = _Segments(plain), _Segments(plain, SPACE)
        self.begin, self.end = self.library.bos_id(), self.library.eos_id()
        texts = [p[1].decode() for p in pieces]
        kinds = [p.get(3, 1) for p in pieces]
        self.sizes = np.array(
            [
                1 if k == BYTE else 0 if k == CONTROL else len(t.encode())
                for t, k in zip(texts, kinds, strict=True)
            ]
        )
        plain_texts = [t for t, k in zip(texts, kinds, strict=True) if k not in (BYTE, CONTROL)]
        # Cuts that no piece reaches across: before a space mark after other characters, and around line feeds.
        self.cut_spaces = not any(SPACE in t.lstrip(SPACE) for t in plain_texts)
        self.cut_lines = not any("\n" in t and len(t) > 1 for t in plain_texts)
        self.cutter = re.compile(
            "|".join(
                ([r"\n"] if self.cut_lines else [])
                + [r"%s+[^%s%s]*|[^%s%s]+" % ((SPACE,) + (SPACE, r"\n" if self.cut_lines else "") * 2)]
                if self.cut_spaces
                else ([r"\n", r"[^\n]+"] if self.cut_lines else [r"[\s\S]+"])
            )
        )
        self.unknown = self.library.unk_id()

    def normalise(self, text: str) -> tuple[str, np.ndarray]:
        """The normalised text, and for each of its UTF-8 bytes and its end the byte of ``text`` it comes from."""
        data = text.encode()
        if not data:
            return "", np.zeros(1, dtype=np.int64)
        mark = SPACE.encode() if self.escape else b" "
        if not self.map.units and not self.strip and not self.suffix:
            out = (mark if self.dummy else b"") + data.replace(b" ", mark)
            # A space becomes as many bytes as the mark has, each of them from the one byte of the space.
            sizes = np.where(np.frombuffer(data, dtype=np.uint8) == 32, len(mark), 1)
            lead = np.zeros(len(mark) if self.dummy else 0, dtype=np.int32)
            sources = np.repeat(np.arange(len(data), dtype=np.int32), sizes)
            return out.decode(), np.concatenate([lead, sources, np.array([len(data)], dtype=np.int32)])
        return self._normalise_by_map(data, mark)

    def _normalised(self, text: str) -> str:
        """The normalised text alone."""
        if not text or self.map.units or self.strip or self.suffix:
            return self.normalise(text)[0]
        mark = SPACE if self.escape else " "
        return (mark if self.dummy else "") + text.replace(" ", mark)

    def _chunks(self, data: bytes) -> Iterator[tuple[bytes, int, int]]:
        """Replacement, source place and source length, by longest prefixes; a character without a key stays."""
        at = 0
        while at < len(data):
            hit = self.map.longest(data, at) if data[at] in self.map.starts else None
            if hit is None:
                lead = data[at]
                size = 1 if lead < 0x80 else 2 if lead < 0xE0 else 3 if lead < 0xF0 else 4
                hit = data[at : at + size], size
            yield hit[0], at, hit[1]
            at += hit[1]

    def _normalise_by_map(self, data: bytes, mark: bytes) -> tuple[str, np.ndarray]:
        out, sources, consumed = bytearray(), [], 0
        chunks = list(self._chunks(data))
        if self.strip:
            while chunks and chunks[0][0] == b" ":
                consumed = chunks[0][1] + chunks[0][2]
                chunks.pop(0)
        if not chunks:
            return "", np.zeros(1, dtype=np.int64)

        def put(piece: bytes, source: int) -> None:
            out.extend(piece)
            sources.extend([source] * len(piece))

        if self.dummy and not self.suffix:
            put(mark, consumed)
        after_space = self.strip
        for piece, at, size in chunks:
            while after_space and piece.startswith(b" "):
                piece = piece[1:]
            if piece:
                for i in range(len(piece)):
                    put(mark if piece[i] == 32 else piece[i : i + 1], at)
                after_space = piece.endswith(b" ")
            consumed = at + size
            if not self.strip:
                after_space = False
        if self.strip:
            while out.endswith(mark):
                consumed = sources[len(out) - len(mark)]
                del out[-len(mark) :], sources[-len(mark) :]
        if self.dummy and self.suffix:
            put(mark, consumed)
        return out.decode(), np.array([*sources, consumed])

    def _ids(self, normalised: str) -> bytes:
        if not (self.cut_spaces and self.cut_lines) or SPACE * 2 in normalised or normalised.endswith(SPACE):
            return b"".join(self.segments.ids(self.cutter.findall(normalised)))
        lines = [line.split(SPACE) for line in normalised.split("\n")]
        words = iter(self.words.ids([w for first, *own in lines for w in own]))
        feed, *starts = self.segments.ids(["\n", *[own[0] for own in lines if own[0]]])
        starts, out = iter(starts), []
        for own in lines:
            out += [next(starts) if own[0] else b"", *islice(words, len(own) - 1), feed]
        return b"".join(out[:-1])

    def ids(self, text: str | None) -> np.ndarray:
        """Ids with begin and end, without spans."""
        inner = np.frombuffer(self._ids(self._normalised(text or "")), dtype="<u4")
        return np.concatenate([[self.begin], inner, [self.end]]).astype("<u4")

    def encode(self, text: str | None) -> Encoding:
        normalised, sources = self.normalise(text or "")
        inner = np.frombuffer(self._ids(normalised), dtype="<u4")
        sizes = self.sizes[inner]
        if (inner == self.unknown).any():
            sizes = self._with_unknown(normalised, inner, sizes)
        borders = np.concatenate([[0], np.cumsum(sizes)])
        if borders[-1] != len(sources) - 1:
            raise ValueError("the pieces do not add up to the normalised text")
        at = sources[borders]
        first, last = at[:1], at[-1:]
        return Encoding(
            np.concatenate([[self.begin], inner, [self.end]]).astype("<u4"),
            np.concatenate([first, at[:-1], last]),
            np.concatenate([first, at[1:], last]),
        )

    def _with_unknown(self, normalised: str, ids: np.ndarray, sizes: np.ndarray) -> np.ndarray:
        """Unknown pieces have the size of what they stand for; the library tells it."""
        surfaces = []
        for part in self.cutter.findall(normalised):
            found = self.segments.library.encode_as_pieces(part)
            surfaces += [len(p.encode()) for p in found]
        return np.where(ids == self.unknown, np.array(surfaces), sizes)

    def decode(self, ids: np.ndarray) -> str:
        return self.library.decode(ids.tolist())


def encode(docs: DataFrame, model_path: str) -> DataFrame:
    """``docs`` with ``ids``, ``starts`` and ``ends`` of all pieces, in bytes of the original text."""

    @F.pandas_udf("struct<ids: array<int>, starts: array<int>, ends: array<int>>")
    def pieces(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        encoder = Encoder(model_path)
        for texts in batches:
            done = [encoder.encode(t) for t in texts]
            yield pd.DataFrame(
                {
                    "ids": [d.ids.astype(np.int32) for d in done],
                    "starts": [d.starts.astype(np.int32) for d in done],
                    "ends": [d.ends.astype(np.int32) for d in done],
                }
            )

    rows = docs.withColumn("_pieces", pieces(F.col("text")))
    return rows.withColumns({c: F.col("_pieces")[c] for c in ("ids", "starts", "ends")}).drop("_pieces")


def training_ids(docs: DataFrame, model_path: str) -> DataFrame:
    """``docs`` with ``ids``, begin and end included, ``n_tokens``, and ``round_trip``, whether decoding gives the text
    back, in place of ``text``. A task holds the ids of some hundred rows at a time.
    """
    others = [c for c in docs.columns if c not in ("text", "ids", "n_tokens", "round_trip")]
    fields = ["ids array<int>", "n_tokens bigint", "round_trip boolean"]
    schema = StructType(docs.select(*others).schema.fields + StructType.fromDDL(", ".join(fields)).fields)

    def both(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = Encoder(model_path)
        for batch in batches:
            for start in range(0, batch.num_rows, PART_ROWS):
                part = batch.slice(start, PART_ROWS)
                texts = [t or "" for t in part.column("text").to_pylist()]
                ids = [encoder.ids(t) for t in texts]
                same = [encoder.decode(x) == t for x, t in zip(ids, texts, strict=True)]
                sizes = [len(x) for x in ids]
                ends = pa.array(np.cumsum([0, *sizes]), type=pa.int32())
                lists = pa.ListArray.from_arrays(ends, pa.array(np.concatenate(ids).view(np.int32)))
                columns = [part.column(c) for c in others]
                yield pa.RecordBatch.from_arrays(
                    [*columns, lists, pa.array(sizes, type=pa.int64()), pa.array(same)],
                    names=[*others, "ids", "n_tokens", "round_trip"],
                )

    return docs.select(*others, "text").mapInArrow(both, schema)


def _hex(data: bytes) -> str:
    return hashlib.sha256(data).hexdigest()


DIGESTS = (
    "struct<n_tokens: bigint, ids_sha256: string, spans_sha256: string, decoded_sha256: string, "
    "round_trip: boolean>"
)


def digests(docs: DataFrame, model_path: str) -> DataFrame:
    """``docs`` with digests of the ids, of the spans (starts, then ends, as 32-bit integers) and of the decoded text."""

    @F.pandas_udf(DIGESTS)
    def digest(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        encoder = Encoder(model_path)
        for texts in batches:
            out = []
            for text in texts:
                done = encoder.encode(text)
                decoded = encoder.decode(done.ids)
                spans = done.starts.astype("<u4").tobytes() + done.ends.astype("<u4").tobytes()
                out.append(
                    (len(done.ids), _hex(done.ids.tobytes()), _hex(spans), _hex(decoded.encode()), decoded == (text or ""))
                )
            names = ["n_tokens", "ids_sha256", "spans_sha256", "decoded_sha256", "round_trip"]
            yield pd.DataFrame(out, columns=names)

    names = ("n_tokens", "ids_sha256", "spans_sha256", "decoded_sha256", "round_trip")
    rows = docs.withColumn("_digest", digest(F.col("text")))
    return rows.withColumns({c: F.col("_digest")[c] for c in names}).drop("_digest")

"""N-gram Jaccard join by chosen paths.

Documents are sets of five-word shingles. A set is represented by the minima of hash functions over it; two sets agree in
each with a probability equal to their Jaccard similarity. From the root, and again in every bucket that is too large,
each set descends into the buckets of those of its minima that a hash of the bucket chooses, 1 / threshold of them on
average, so a pair above the threshold is expected to stay together in one bucket per level. Small buckets are compared
by brute force. Runs are repeated until a pair at the threshold is missed with at most the accepted probability.

Comparisons use a byte of each minimum and a lower limit; what passes is grouped, and within the groups every pair is
checked exactly on its whole shingle sets, by matrix products over blocks of documents. Links are counted there, so no
list of pairs is ever written.

Words are lower-cased (A-Z). A text with fewer words than a shingle is one shingle.

Defined results: a null text is empty; texts without words are copies of each other and link to nothing else; copies and
texts with equal shingle sets are one set, found once; rows without id take part, their class is named by the smallest
id in it, or null; repeated rows are copies; other columns are ignored. Cost grows with the square of the number of
different texts in one group of near copies, as does the number of links that is asked for.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskloom.llm.common import lookup_join, stored
from riskloom.llm.components import components


@dataclass(frozen=True)
class Settings:
    threshold: float = 0.8
    words: int = 5
    #: Hash functions, and the share of equal bytes from which a pair is checked exactly.
    minima: int = 64
    sketch_share: float = 0.6
    #: Buckets up to this size are compared, larger ones split, at most this many times.
    small: int = 1000
    depth: int = 3
    recall: float = 0.999
    #: Documents, and shingles, of one block of an exact comparison.
    block_rows: int = 512
    block_shingles: int = 2_000_000

    @property
    def runs(self) -> int:
        """Runs after which a pair at the threshold that is split to the full depth is still found."""
        stays = 1.0
        for _ in range(self.depth):
            stays = 1 - math.exp(-stays)
        return math.ceil(math.log(1 - self.recall) / math.log(1 - stays))


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


#: Bytes, about, of the word hashes that a task remembers, and what one takes beside its word.
REMEMBERED = 24 << 20
ENTRY = 180


class Shingler:
    """Sorted 64-bit shingle hashes of texts. Word hashes are remembered within a task."""

    def __init__(self, words: int):
        self.words, self.known, self.bytes = words, {}, 0

    def _word(self, word: bytes) -> int:
        import xxhash

        if self.bytes > REMEMBERED:
            self.known.clear()
            self.bytes = 0
        self.bytes += ENTRY + len(word)
        value = self.known[word] = xxhash.xxh64_intdigest(word)
        return value

    def shingles(self, text: str | None) -> np.ndarray:
        words = (text or "").encode().lower().split()
        if not words:
            return np.zeros(0, dtype=np.uint64)
        known = self.known
        hashes = np.array([known.get(w) or self._word(w) for w in words], dtype=np.uint64)
        n = max(1, len(words) - self.words + 1)
        out = np.zeros(n, dtype=np.uint64)
        for i in range(min(self.words, len(words))):
            out = _mix(out * np.uint64(31) + hashes[i : i + n])
        return np.unique(out)


def _functions(n: int) -> tuple[np.ndarray, np.ndarray]:
    seeds = _mix(np.arange(1, 2 * n + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))
    return seeds[:n].astype(np.uint32) | np.uint32(1), seeds[n:].astype(np.uint32)


def _minima(sets: list[np.ndarray], n: int) -> np.ndarray:
    """One row of ``n`` minima per set; sets without elements have zeros."""
    sizes = np.array([len(s) for s in sets])
    out = np.zeros((len(sets), n), dtype=np.uint32)
    full = np.flatnonzero(sizes)
    if len(full):
        every = np.concatenate([sets[i] for i in full])
        every = (every ^ (every >> np.uint64(32))).astype(np.uint32)
        starts = np.concatenate([[0], np.cumsum(sizes[full])[:-1]])
        for j, (a, b) in enumerate(zip(*_functions(n), strict=True)):
            out[full, j] = np.minimum.reduceat(every * a + b, starts)
    return out


FEATURES = "struct<d1: bigint, d2: bigint, n: int, minima: binary>"


def features(docs: DataFrame, settings: Settings) -> DataFrame:
    """Stored per row: ``doc_id``, hashes of the text, digest and size of its shingle set, and its minima."""

    @F.pandas_udf(FEATURES)
    def describe(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        shingler = Shingler(settings.words)
        with np.errstate(over="ignore"):
            for texts in batches:
                sets = [shingler.shingles(t) for t in texts]
                yield pd.DataFrame(
                    {
                        "d1": [int(_mix(s).sum().view(np.int64)) if len(s) else 0 for s in sets],
                        "d2": [
                            int(np.bitwise_xor.reduce(_mix(s + np.uint64(77))).view(np.int64)) if len(s) else 0
                            for s in sets
                        ],
                        "n": [len(s) for s in sets],
                        "minima": [m.tobytes() for m in _minima(sets, settings.minima)],
                    }
                )

    text = F.coalesce(F.col("text"), F.lit(""))
    rows = docs.select("doc_id", text.alias("text"))
    rows = rows.select(
        "doc_id",
        F.xxhash64("text").alias("h1"),
        F.xxhash64(F.lit("second"), F.col("text")).alias("h2"),
        describe("text").alias("f"),
    )
    return stored(rows.select("doc_id", "h1", "h2", "f.*"), "join-features")


def distinct_sets(rows: DataFrame) -> DataFrame:
    """Stored, one row per shingle set: a number ``uid``, copies, smallest id, and one text (by its hashes) that has it."""
    sets = rows.groupBy("d1", "d2", "n").agg(
        F.min("doc_id").alias("first_id"),
        F.count(F.lit(1)).alias("copies"),
        F.min(F.struct("h1", "h2")).alias("h"),
        F.first("minima").alias("minima"),
    )
    sets = sets.select("d1", "d2", "n", "first_id", "copies", "h.h1", "h.h2", "minima")
    return stored(sets.withColumn("uid", F.monotonically_increasing_id()), "join-sets")


def _descend(minima: np.ndarray, nodes: np.ndarray, share: float) -> tuple[np.ndarray, np.ndarray]:
    """Row numbers and buckets that the rows go to from their nodes."""
    with np.errstate(over="ignore"):
        place = np.arange(1, minima.shape[1] + 1, dtype=np.uint64) << np.uint64(32)
        tokens = _mix(minima.astype(np.uint64) + place)
        drawn = _mix(tokens ^ _mix(nodes + np.uint64(1))[:, None])
        row, col = np.nonzero(drawn < np.uint64(int(share * 2**64)))
        return row, _mix(tokens[row, col] + _mix(nodes[row] ^ np.uint64(0xA5A5)))


def _matrix(values: pd.Series, kind, width: int) -> np.ndarray:
    return np.frombuffer(b"".join(values), dtype=kind).reshape(-1, width)


def _split(rows: DataFrame, settings: Settings, runs: int | None) -> DataFrame:
    """``bucket`` and ``uid`` one level down: from the root in every run, else from each row's ``bucket``."""
    share = 1 / (settings.threshold * settings.minima)

    def go(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            minima = _matrix(batch.minima, np.uint32, settings.minima)
            uids = batch.uid.to_numpy()
            if runs is None:
                starts = [batch.bucket.to_numpy().view(np.uint64)]
            else:
                starts = [np.full(len(uids), r + 1, dtype=np.uint64) for r in range(runs)]
            for nodes in starts:
                row, bucket = _descend(minima, nodes, share)
                yield pd.DataFrame({"bucket": bucket.view(np.int64), "uid": uids[row]})

    return rows.mapInPandas(go, "bucket long, uid long")


def _groups(batches: Iterator[pd.DataFrame], keys: list[str]) -> Iterator[pd.DataFrame]:
    """Runs of whole groups from batches that are sorted by the keys."""
    rest = None
    for batch in batches:
        if rest is not None:
            batch = pd.concat([rest, batch], ignore_index=True)
        if not len(batch):
            continue
        last = (batch[keys] == batch[keys].iloc[-1]).all(axis=1).to_numpy()
        cut = int(np.argmax(last))
        if cut:
            yield batch.iloc[:cut].reset_index(drop=True)
        rest = batch.iloc[cut:]
    if rest is not None and len(rest):
        yield rest.reset_index(drop=True)


def _lowest(n: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The lowest row that each of ``n`` rows is connected to by the links a-b."""
    label = np.arange(n)
    while len(a):
        low = np.minimum(label[a], label[b])
        before = label.copy()
        np.minimum.at(label, a, low)
        np.minimum.at(label, b, low)
        label = label[label]
        if (label == before).all():
            break
    return label


def _similar(sketches: np.ndarray, group: np.ndarray, side: np.ndarray | None, least: int):
    """Pairs of rows of one group with enough equal bytes; with sides, only pairs of different ones."""
    left, right = [], []
    starts = np.flatnonzero(np.concatenate([[True], group[1:] != group[:-1]]))
    sizes = np.diff(np.concatenate([starts, [len(group)]]))
    for gap in range(1, min(64, int(sizes.max()))):
        i = np.flatnonzero(group[:-gap] == group[gap:])
        # Groups of 64 rows and more are compared below.
        i = i[sizes[np.searchsorted(starts, i, side="right") - 1] < 64]
        if not len(i):
            continue
        hit = i[(sketches[i] == sketches[i + gap]).sum(axis=1) >= least]
        left.append(hit)
        right.append(hit + gap)
    for start, size in zip(starts[sizes >= 64], sizes[sizes >= 64], strict=True):
        own = sketches[start : start + size]
        for i in range(0, size, 64):
            equal = (own[i : i + 64, None, :] == own[None, i:, :]).sum(axis=2) >= least
            x, y = np.nonzero(equal)
            keep = x < y
            left.append(start + i + x[keep])
            right.append(start + i + y[keep])
    a = np.concatenate(left) if left else np.zeros(0, dtype=np.int64)
    b = np.concatenate(right) if right else np.zeros(0, dtype=np.int64)
    if side is not None:
        differ = (side[a] != side[b]) | (side[a] < 0)
        a, b = a[differ], b[differ]
    return a, b


def _compare(rows: DataFrame, sets: DataFrame, settings: Settings) -> DataFrame:
    """Edges ``a``, ``b`` that connect what looks similar within the small buckets of ``rows``."""
    least = math.ceil(settings.sketch_share * settings.minima)

    def look(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for part in _groups(batches, ["bucket"]):
            sketches = (_matrix(part.minima, np.uint32, settings.minima) & 255).astype(np.uint8)
            a, b = _similar(sketches, part.bucket.to_numpy(), None, least)
            label, uids = _lowest(len(part), a, b), part.uid.to_numpy()
            moved = np.flatnonzero(label != np.arange(len(part)))
            yield pd.DataFrame({"a": uids[moved], "b": uids[label[moved]]})

    full = rows.join(sets.select("uid", "minima"), "uid").select("bucket", "uid", "minima")
    dealt = full.repartition("bucket").sortWithinPartitions("bucket")
    return dealt.mapInPandas(look, "a long, b long").distinct()


def _compare_blocks(rows: DataFrame, sizes: DataFrame, sets: DataFrame, settings: Settings) -> DataFrame:
    """As ``_compare`` for buckets that stayed large: every block of a bucket meets every other."""
    least = math.ceil(settings.sketch_share * settings.minima)

    def look(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for part in _groups(batches, ["bucket", "lo", "hi"]):
            sketches = (_matrix(part.minima, np.uint32, settings.minima) & 255).astype(np.uint8)
            key = part[["bucket", "lo", "hi"]]
            group = (key != key.shift()).any(axis=1).cumsum().to_numpy()
            side = np.where(part.lo == part.hi, -1, part.block).astype(np.int64)
            a, b = _similar(sketches, group, side, least)
            label, uids = _lowest(len(part), a, b), part.uid.to_numpy()
            moved = np.flatnonzero(label != np.arange(len(part)))
            yield pd.DataFrame({"a": uids[moved], "b": uids[label[moved]]})

    blocks = F.ceil(F.col("size") / settings.small).cast("int")
    rows = rows.join(sizes, "bucket").withColumn("blocks", blocks)
    rows = rows.withColumn("block", F.pmod(F.xxhash64("uid"), "blocks").cast("int"))
    full = _met(rows.join(sets.select("uid", "minima"), "uid"))
    keys = ["bucket", "lo", "hi"]
    dealt = full.select(*keys, "block", "uid", "minima").repartition(*keys).sortWithinPartitions(*keys)
    return dealt.mapInPandas(look, "a long, b long").distinct()


def _met(rows: DataFrame) -> DataFrame:
    """Each row once per pair ``lo``, ``hi`` of blocks that its ``block`` is in."""
    rows = rows.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    return rows.withColumns({"lo": F.least("block", "other"), "hi": F.greatest("block", "other")}).drop("other")


def candidate_edges(sets: DataFrame, settings: Settings) -> DataFrame:
    """Edges that connect all sets whose sketches met in a small bucket and looked similar; stored."""
    found, level = None, 1
    rows = _split(sets.filter("n > 0").select("uid", "minima"), settings, settings.runs)
    while True:
        if level > 1:
            rows = stored(rows, "join-level")
        sizes = rows.groupBy("bucket").agg(F.count(F.lit(1)).alias("size")).filter("size > 1")
        sizes = stored(sizes, "join-sizes")
        shared = stored(rows.join(sizes, "bucket"), "join-shared")
        small = shared.filter(F.col("size") <= settings.small).drop("size")
        edges = stored(_compare(small, sets, settings), "join-edges")
        found = edges if found is None else found.unionByName(edges)
        large = shared.filter(F.col("size") > settings.small).drop("size")
        if large.isEmpty():
            return found
        if level == settings.depth:
            rest = stored(_compare_blocks(large, sizes, sets, settings), "join-edges")
            return found.unionByName(rest)
        rows = _split(large.join(sets.select("uid", "minima"), "uid"), settings, None)
        level += 1


def _exact(batches: Iterator[pd.DataFrame], threshold: float) -> Iterator[pd.DataFrame]:
    """Of each meeting of two blocks: linked copies per set, and the lowest set it is connected to."""
    keys = ["label", "lo", "hi"]
    for part in _groups(batches, keys):
        for _, group in part.groupby(keys, sort=False):
            sets = [np.frombuffer(s, dtype=np.uint64) for s in group.shingles]
            sizes = np.array([len(s) for s in sets])
            every, at = np.unique(np.concatenate(sets), return_inverse=True)
            row = np.repeat(np.arange(len(sets)), sizes)
            # Shingles that only one set has cannot count; the others become columns, some at a time.
            shared = np.bincount(at, minlength=len(every)) > 1
            column = np.cumsum(shared) - 1
            row, column = row[shared[at]], column[at[shared[at]]]
            order = np.argsort(column, kind="stable")
            row, column = row[order], column[order]
            common = np.zeros((len(sets), len(sets)), dtype=np.float32)
            width = max(1, 4_000_000 // len(sets))
            for start in range(0, int(shared.sum()), width):
                lo, hi = np.searchsorted(column, [start, start + width])
                cells = np.zeros((len(sets), width), dtype=np.float32)
                cells[row[lo:hi], column[lo:hi] - start] = 1
                common += cells @ cells.T
            linked = common >= threshold * (sizes[:, None] + sizes[None, :] - common) - 1e-6
            np.fill_diagonal(linked, False)
            if group.lo.iloc[0] != group.hi.iloc[0]:
                block = group.block.to_numpy()
                linked &= block[:, None] != block[None, :]
            a, b = np.nonzero(linked)
            label, uids = _lowest(len(sets), a, b), group.uid.to_numpy()
            links = linked @ group.copies.to_numpy()
            some = np.flatnonzero(links)
            yield pd.DataFrame({"a": uids[some], "b": uids[label[some]], "links": links[some]})


def exact_links(docs: DataFrame, sets: DataFrame, groups: DataFrame, settings: Settings) -> DataFrame:
    """Stored ``a``, ``b``, ``links``: within each group of candidates, checked on whole sets."""

    @F.pandas_udf("binary")
    def shingles(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        shingler = Shingler(settings.words)
        with np.errstate(over="ignore"):
            for texts in batches:
                yield pd.Series([shingler.shingles(t).tobytes() for t in texts])

    members = sets.select("uid", "n", "copies", "h1", "h2").join(
        groups.select(F.col("node").alias("uid"), "label"), "uid"
    )
    members = stored(members, "join-members")
    totals = members.groupBy("label").agg(F.count(F.lit(1)).alias("rows"), F.sum("n").alias("shingles"))
    blocks = F.greatest(
        F.ceil(F.col("rows") / settings.block_rows), F.ceil(F.col("shingles") / settings.block_shingles)
    )
    totals = stored(totals.select("label", blocks.cast("int").alias("blocks")), "join-blocks")
    text = F.coalesce(F.col("text"), F.lit(""))
    texts = docs.select(
        text.alias("text"),
        F.xxhash64(text).alias("t1"),
        F.xxhash64(F.lit("second"), text).alias("t2"),
    )
    same = (F.col("t1") == F.col("h1")) & (F.col("t2") == F.col("h2"))
    found = lookup_join(texts, members.select("uid", "h1", "h2"), same, "inner")
    # Copies of the same text: one is enough.
    found = found.select("uid", shingles("text").alias("shingles")).groupBy("uid")
    found = found.agg(F.first("shingles").alias("shingles"))
    rows = members.join(totals, "label").join(found, "uid")
    rows = rows.withColumn("block", F.pmod(F.xxhash64("uid"), "blocks").cast("int"))
    keys = ["label", "lo", "hi"]
    rows = _met(rows).select(*keys, "block", "uid", "copies", "shingles")
    dealt = rows.repartition(*keys).sortWithinPartitions(*keys)
    check = lambda batches: _exact(batches, settings.threshold)
    return stored(dealt.mapInPandas(check, "a long, b long, links long"), "join-links")


def _classified(docs: DataFrame, settings: Settings) -> DataFrame:
    """Per row: ids, hashes of the text, its set's size, class (as a set number and as an id), copies and links."""
    rows = features(docs, settings)
    sets = distinct_sets(rows)
    groups = components(candidate_edges(sets, settings))
    links = exact_links(docs, sets, groups, settings)
    counts = links.groupBy(F.col("a").alias("uid")).agg(F.sum("links").alias("links"))
    classes = components(links.select("a", "b")).select(F.col("node").alias("uid"), "label")
    named = sets.select("uid", "first_id").join(classes, "uid")
    names = named.groupBy("label").agg(F.min("first_id").alias("class_id"))
    named = named.join(names, "label").select("uid", "label", "class_id")
    known = sets.select("d1", "d2", "n", "uid", F.col("first_id").alias("copy_id"), "copies")
    known = known.join(named, "uid", "left").join(counts, "uid", "left")
    known = known.select(
        "d1", "d2", "n", "copy_id",
        F.coalesce("label", "uid").alias("class"),
        F.coalesce("class_id", "copy_id").alias("class_id"),
        (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links"),
    )
    return rows.drop("minima").join(stored(known, "join-known"), ["d1", "d2", "n"])


def jaccard_join(docs: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """One row per document: ``doc_id``, ``class_id`` (smallest id of its connected near copies), ``copy_id`` (of the
    documents with its own shingle set), ``n_shingles`` and ``n_links``, the other documents at or above the threshold.
    """
    return _classified(docs, settings).select(
        "doc_id", "class_id", "copy_id", F.col("n").cast("long").alias("n_shingles"), "n_links"
    )


def keep_one(docs: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """The rows of ``docs`` without near copies: of each class the row with the smallest id stays, one if it is repeated."""
    row = ["doc_id", "h1", "h2"]
    order = F.struct(F.col("doc_id").isNull().alias("unnamed"), *row)
    rows = _classified(docs, settings).groupBy("class", *row).agg(F.count(F.lit(1)).alias("times"))
    chosen = rows.groupBy("class").agg(F.min(order).alias("o"), F.min_by("times", order).alias("times"))
    names = {"doc_id": "_kept_id", "h1": "_kept_h1", "h2": "_kept_h2"}
    chosen = stored(chosen.select(*[F.col(f"o.{c}").alias(n) for c, n in names.items()], "times"), "join-kept")
    text = F.coalesce(F.col("text"), F.lit(""))
    same = (
        F.col("doc_id").eqNullSafe(F.col("_kept_id"))
        & (F.xxhash64(text) == F.col("_kept_h1"))
        & (F.xxhash64(F.lit("second"), text) == F.col("_kept_h2"))
    )
    kept = lookup_join(docs, chosen.drop("times"), same, "left_semi")
    # Only where a kept row is repeated does the whole row have to be dealt again.
    return kept if chosen.filter("times > 1").isEmpty() else kept.dropDuplicates(["doc_id", "text"])

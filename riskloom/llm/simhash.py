"""SimHash near-duplicates, linked by BK-trees.

A fingerprint has 64 bits: each tells whether most of the text's shingle hashes (XXH64) have it set. Fingerprints that
differ in at most ``radius`` bits agree whole in one of ``radius + 1`` blocks of bits, so those with an equal block are
one shard and all links lie within shards. In a shard the distinct fingerprints form a BK-tree: children are keyed by
their Hamming distance to the parent, and a search at distance d from a node follows only the edges d - radius to
d + radius. Large shards have several trees of bounded size, and each tree is sent to the tasks that hold the shard's
queries, a part of them each; no tree goes to every executor, so nothing that is sent grows with the corpus. Many trees
are built and searched at once, level by level.

A task returns a spanning set of the links that it finds, never all pairs. Connected fingerprints are one component.

Words are lower-cased (A-Z) and lie between spaces and the ASCII controls tab to carriage return. Shingles keep their
repeats. A text with fewer words than a shingle is one shingle; without words the fingerprint is zero, linked like any
other.

Defined results: a null text is empty; texts with equal fingerprints are one component; rows without id take part, a
component is named by the smallest id in it, or null; repeated rows stay rows; texts of any length are read whole; other
columns are ignored; an empty table gives none.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import partial

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskloom.llm.common import stored
from riskloom.llm.components import components
from riskloom.llm.neardup import _groups as whole_groups
from riskloom.llm.neardup import _lowest as lowest_linked
from riskloom.llm.spread import join_counted

BITS = 64


@dataclass(frozen=True)
class Settings:
    words: int = 3
    radius: int = 2
    seed: int = 42
    #: Fingerprints of one tree, and queries that go through the trees at once.
    tree: int = 1024
    queries: int = 1024

    @property
    def blocks(self) -> list[tuple[int, int]]:
        """First bit and width of the blocks, of which links leave one unchanged."""
        edges = [BITS * i // (self.radius + 1) for i in range(self.radius + 2)]
        return [(lo, hi - lo) for lo, hi in zip(edges, edges[1:], strict=False)]


def fingerprint(text: str, settings: Settings = Settings()) -> int:
    """The unsigned fingerprint of a text."""
    import xxhash

    words = text.encode().lower().split()
    if not words:
        return 0
    n = max(1, len(words) - settings.words + 1)
    shingles = zip(*(words[i:] for i in range(settings.words)), strict=False) if len(words) >= settings.words else [words]
    digests = map(partial(xxhash.xxh64_intdigest, seed=settings.seed), map(b" ".join, shingles))
    hashes = np.fromiter(digests, dtype="<u8", count=n)
    ones = np.zeros(BITS, dtype=np.int64)
    for i in range(0, n, 65_536):
        part = hashes[i : i + 65_536]
        ones += np.unpackbits(part.view(np.uint8), bitorder="little").reshape(-1, BITS).sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > n, bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """Stored ``doc_id`` and ``fingerprint`` (the 64 bits as a long)."""

    @F.pandas_udf("long")
    def read(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for texts in batches:
            found = np.fromiter((fingerprint(t, settings) for t in texts), dtype=np.uint64, count=len(texts))
            yield pd.Series(found.view(np.int64))

    rows = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    return stored(rows.select("doc_id", read("text").alias("fingerprint")), "simhash")


class Forest:
    """BK-trees over runs of equal ``group``: the first member is the root, each other member hangs below it."""

    def __init__(self, bits: np.ndarray, group: np.ndarray):
        self.bits = bits
        starts = np.concatenate([[True], group[1:] != group[:-1]]) if len(group) else np.zeros(0, dtype=bool)
        self.groups, self.roots = group[starts], np.flatnonzero(starts)
        rest = np.flatnonzero(~starts)
        parent = self.roots[np.searchsorted(self.roots, rest, side="right") - 1]
        keys, children = [], []
        while len(rest):
            # The first of those at one distance from a node becomes its child, the others go on below it.
            edge, first, which = np.unique(self._edges(parent, self._apart(rest, parent)), return_index=True, return_inverse=True)
            keys.append(edge)
            children.append(rest[first])
            below = np.ones(len(rest), dtype=bool)
            below[first] = False
            parent, rest = rest[first][which][below], rest[below]
        self.keys = np.concatenate(keys) if keys else np.zeros(0, dtype=np.int64)
        order = np.argsort(self.keys)
        self.keys = self.keys[order]
        self.children = np.concatenate(children)[order] if children else np.zeros(0, dtype=np.int64)

    @staticmethod
    def _edges(node: np.ndarray, distance: np.ndarray) -> np.ndarray:
        return node * (BITS + 1) + distance

    def _apart(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        return np.bitwise_count(self.bits[a] ^ self.bits[b]).astype(np.int64)

    def near(self, bits: np.ndarray, group: np.ndarray, radius: int) -> tuple[np.ndarray, np.ndarray]:
        """Numbers of queries and of the members of their group's tree within the radius."""
        at = np.searchsorted(self.groups, group)
        known = at < len(self.groups)
        known[known] = self.groups[at[known]] == group[known]
        query = np.flatnonzero(known)
        node = self.roots[at[query]]
        left, right = [], []
        while len(query):
            distance = np.bitwise_count(bits[query] ^ self.bits[node]).astype(np.int64)
            hit = distance <= radius
            left.append(query[hit])
            right.append(node[hit])
            lo = np.searchsorted(self.keys, self._edges(node, np.maximum(distance - radius, 0)))
            hi = np.searchsorted(self.keys, self._edges(node, np.minimum(distance + radius, BITS)), side="right")
            counts = hi - lo
            query = np.repeat(query, counts)
            within = np.arange(len(query)) - np.repeat(np.cumsum(counts) - counts, counts)
            node = self.children[np.repeat(lo, counts) + within]
        if not left:
            return np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.int64)
        return np.concatenate(left), np.concatenate(right)


def _linked(part: pd.DataFrame, settings: Settings) -> pd.DataFrame:
    """Spanning links of whole meetings of trees and queries: rows sorted by ``shard``, ``lo``, ``hi``."""
    keys = part[["shard", "lo", "hi"]]
    group = (keys != keys.shift()).any(axis=1).cumsum().to_numpy()
    bits = part.fingerprint.to_numpy().view(np.uint64)
    piece, lo, hi = part.piece.to_numpy(), part.lo.to_numpy(), part.hi.to_numpy()
    members, asking = np.flatnonzero(piece == lo), np.flatnonzero(piece == hi)
    forest = Forest(bits[members], group[members])
    a = b = np.zeros(0, dtype=np.int64)
    for i in range(0, len(asking), settings.queries):
        own = asking[i : i + settings.queries]
        query, member = forest.near(bits[own], group[own], settings.radius)
        # What is linked so far is kept as one link per member, so lists stay short.
        label = lowest_linked(len(part), np.concatenate([a, own[query]]), np.concatenate([b, members[member]]))
        a = np.flatnonzero(label != np.arange(len(part)))
        b = label[a]
    return pd.DataFrame({"a": bits[a].view(np.int64), "b": bits[b].view(np.int64)})


def links(distinct: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """Stored ``a``, ``b``: links between distinct fingerprints that connect all that lie within the radius."""
    blocks = [
        (F.shiftrightunsigned("fingerprint", lo).bitwiseAND(F.lit((1 << width) - 1)) * len(settings.blocks) + i)
        for i, (lo, width) in enumerate(settings.blocks)
    ]
    sharded = distinct.select("fingerprint", F.explode(F.array(*blocks)).alias("shard"))
    sizes = sharded.groupBy("shard").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    met = join_counted(sharded, stored(sizes, "simhash-shards"), "shard")
    pieces = F.ceil(F.col("n") / settings.tree).cast("int")
    met = met.select("shard", "fingerprint", pieces.alias("pieces"))
    met = met.withColumn("piece", F.pmod(F.xxhash64("fingerprint"), "pieces").cast("int"))
    met = met.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("pieces") - 1)))
    met = met.select("shard", F.least("piece", "other").alias("lo"), F.greatest("piece", "other").alias("hi"), "piece", "fingerprint")
    keys = ["shard", "lo", "hi"]

    def search(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for part in whole_groups(batches, keys):
            yield _linked(part, settings)

    dealt = met.repartition(*keys).sortWithinPartitions(*keys)
    return stored(dealt.mapInPandas(search, "a long, b long").distinct(), "simhash-links")


def near_duplicates(docs: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """One row per document: ``doc_id``, ``fingerprint`` (16 hex digits), ``component_id`` (smallest id connected)."""
    rows = fingerprints(docs, settings)
    distinct = rows.groupBy("fingerprint").agg(F.min("doc_id").alias("first_id"), F.count(F.lit(1)).alias("n"))
    distinct = stored(distinct, "simhash-distinct")
    found = components(links(distinct, settings)).select(F.col("node").alias("fingerprint"), "label")
    named = distinct.join(found, "fingerprint", "left")
    named = stored(named.withColumn("label", F.coalesce("label", "fingerprint")).withColumnRenamed("n", "copies"), "simhash-labels")
    names = named.groupBy("label").agg(F.min("first_id").alias("component_id"), F.count(F.lit(1)).alias("n"))
    named = join_counted(named, stored(names, "simhash-names"), "label")
    named = named.select("fingerprint", "component_id", F.col("copies").alias("n"))
    joined = join_counted(rows, stored(named, "simhash-components"), "fingerprint")
    bits = F.lpad(F.lower(F.hex("fingerprint")), 16, "0")
    return joined.select("doc_id", bits.alias("fingerprint"), "component_id")

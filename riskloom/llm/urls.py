"""URL filters: prefix rules, and a cascade of Bloom filters over the domains of the corpus.

The cascade holds a set of listed keys exactly, given all keys that will ever be asked (the universe). Level 0 encodes the
listed keys; each further level encodes the keys of the other side that pass the level before by mistake, until none is
left. A key is listed if the first level that rejects it has an odd number. Keys are dealt by hash to shards of a
bounded size, each with a cascade of its own, so building needs one shuffle of distinct keys and no join.

Defined results: a null url, or one without ``://``, has an empty host and path and no listed domain; repeated rows are
judged alike; other columns pass through, those named like a result are replaced.
"""

from __future__ import annotations

import math
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskloom.llm.common import lookup_join, stored

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

#: Keys of one shard, on average: what one task holds in memory while it builds.
SHARD_KEYS = 200_000

#: The whole cascade is sent to every task up to this size; beyond it keys go to the shards instead.
BROADCAST_BYTES = 32 << 20

MAX_LEVELS = 200
CASCADE = "shard int, level int, n_bits long, n_hashes int, bits binary"


@dataclass(frozen=True)
class Rule:
    verdict: str
    host: str
    path: str

    @property
    def text(self) -> str:
        return self.host + self.path


def host_of(url: Column) -> Column:
    host = F.translate(F.regexp_extract(url, r"://([^/?#]*)", 1), UPPER, LOWER)
    return F.coalesce(host, F.lit(""))


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, r"://[^/?#]*([^?#]*)", 1), F.lit(""))


def longest_rule(rules: Sequence[Rule], host: Column, path: Column) -> tuple[Column, Column]:
    """Text and verdict of the longest rule that fits; null where none does."""
    text = verdict = F.lit(None).cast("string")
    for rule in sorted(rules, key=lambda r: len(r.text)):
        fits = ((host == rule.host) | host.endswith("." + rule.host)) & path.startswith(rule.path)
        text = F.when(fits, F.lit(rule.text)).otherwise(text)
        verdict = F.when(fits, F.lit(rule.verdict)).otherwise(verdict)
    return text, verdict


def domains_of(host: Column) -> Column:
    """The host and all its parent domains, longest first; none for an empty host."""
    labels = F.split(host, r"\.")
    n = F.size(labels)
    parents = F.transform(
        F.sequence(F.lit(1), n), lambda i: F.array_join(F.slice(labels, i, n), ".")
    )
    return F.when(host != "", parents).otherwise(F.array().cast("array<string>"))


def _hashes(key: Column) -> tuple[Column, Column]:
    return F.xxhash64(key), F.xxhash64(F.lit("second"), key)


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _places(h1: np.ndarray, h2: np.ndarray, level: int, n_hashes: int, n_bits: int) -> np.ndarray:
    with np.errstate(over="ignore"):
        turn = _mixed(np.array([level + 1], dtype=np.uint64))[0]
        start, step = _mixed(h1 ^ turn), _mixed(h2 + turn) | np.uint64(1)
        i = np.arange(n_hashes, dtype=np.uint64)
        return (start[:, None] + i * step[:, None]) % np.uint64(n_bits)


def _passes(h1, h2, level: int, n_hashes: int, n_bits: int, bits: np.ndarray) -> np.ndarray:
    at = _places(h1, h2, level, n_hashes, n_bits)
    return ((bits[at >> np.uint64(3)] >> (at & np.uint64(7)).astype(np.uint8)) & 1).all(axis=1)


def _filter_of(h1, h2, level: int, rate: float) -> tuple[int, int, np.ndarray]:
    n_bits = max(64, math.ceil(-max(1, len(h1)) * math.log(rate) / math.log(2) ** 2))
    n_hashes = max(1, round(-math.log2(rate)))
    bits = np.zeros(n_bits // 8 + 1, dtype=np.uint8)
    at = _places(h1, h2, level, n_hashes, n_bits).ravel()
    np.bitwise_or.at(bits, at >> np.uint64(3), np.left_shift(1, (at & np.uint64(7))).astype(np.uint8))
    return n_hashes, n_bits, bits


def _unsigned(values) -> np.ndarray:
    return np.asarray(values, dtype=np.int64).view(np.uint64)


def _build_shard(keys: pd.DataFrame) -> pd.DataFrame:
    h1, h2, listed = _unsigned(keys.h1), _unsigned(keys.h2), keys.listed.to_numpy(dtype=bool)
    inside, outside = np.flatnonzero(listed), np.flatnonzero(~listed)
    # The first level is sharper the rarer listed keys are; all later ones halve what is left.
    rate = min(0.5, max(1e-6, math.sqrt(0.5) * len(inside) / max(1, len(outside))))
    rows = []
    while True:
        level = len(rows)
        if level == MAX_LEVELS:
            raise ValueError("two keys share both hashes: they cannot be told apart")
        n_hashes, n_bits, bits = _filter_of(h1[inside], h2[inside], level, rate)
        rows.append((int(keys.shard.iloc[0]), level, n_bits, n_hashes, bits.tobytes()))
        wrong = outside[_passes(h1[outside], h2[outside], level, n_hashes, n_bits, bits)]
        if not len(wrong):
            return pd.DataFrame(rows, columns=["shard", "level", "n_bits", "n_hashes", "bits"])
        inside, outside, rate = wrong, inside, 0.5


def build_cascade(universe: DataFrame, listed: DataFrame) -> tuple[DataFrame, int]:
    """Cascade rows and the number of shards. Both inputs have a ``key``; listed keys belong to the universe anyway."""
    every = universe.select("key", F.lit(False).alias("listed")).unionByName(
        listed.select("key", F.lit(True).alias("listed"))
    )
    h1, h2 = _hashes(F.col("key"))
    keys = every.filter("key is not null").groupBy("key").agg(F.max("listed").alias("listed"))
    keys = stored(keys.select(h1.alias("h1"), h2.alias("h2"), "listed"), "cascade-keys")
    n_shards = max(1, math.ceil(keys.count() / SHARD_KEYS))
    dealt = keys.withColumn("shard", F.pmod("h1", F.lit(n_shards)).cast("int"))
    return stored(dealt.groupBy("shard").applyInPandas(_build_shard, CASCADE), "cascade"), n_shards


def _levels(rows: pd.DataFrame) -> list[tuple]:
    return [
        (int(r.level), int(r.n_hashes), int(r.n_bits), np.frombuffer(r.bits, dtype=np.uint8))
        for r in rows.sort_values("level").itertuples()
    ]


def _in_shard(levels: list[tuple], h1: np.ndarray, h2: np.ndarray) -> np.ndarray:
    """Exact membership of keys of the universe."""
    rejected_at = np.full(len(h1), len(levels))
    alive = np.arange(len(h1))
    for level, n_hashes, n_bits, bits in levels:
        passed = _passes(h1[alive], h2[alive], level, n_hashes, n_bits, bits)
        rejected_at[alive[~passed]] = level
        alive = alive[passed]
    return rejected_at % 2 == 1


def _listed_by_broadcast(rows: DataFrame, cascade: DataFrame, n_shards: int) -> DataFrame:
    sent = rows.sparkSession.sparkContext.broadcast(
        {int(shard): _levels(g) for shard, g in cascade.toPandas().groupby("shard")}
    )

    @F.pandas_udf("boolean")
    def any_listed(batches: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.Series]:
        for first, second in batches:
            sizes = first.map(len).to_numpy(dtype=np.int64)
            out = np.zeros(len(first), dtype=bool)
            if sizes.sum():
                h1 = _unsigned(np.concatenate(first.to_list()))
                h2 = _unsigned(np.concatenate(second.to_list()))
                row = np.repeat(np.arange(len(first)), sizes)
                shard = h1.view(np.int64) % n_shards
                for s in np.unique(shard):
                    if int(s) in sent.value:
                        mine = np.flatnonzero(shard == s)
                        found = mine[_in_shard(sent.value[int(s)], h1[mine], h2[mine])]
                        out[row[found]] = True
            yield pd.Series(out)

    return rows.withColumn("listed", any_listed("_h1", "_h2")).drop("_h1", "_h2")


def _listed_by_shard(rows: DataFrame, cascade: DataFrame, n_shards: int) -> DataFrame:
    """For a cascade too large to send: distinct keys go to their shard, verdicts of hosts come back as a lookup."""

    def probe(keys: pd.DataFrame, shard: pd.DataFrame) -> pd.DataFrame:
        hit = np.zeros(len(keys), dtype=bool)
        if len(keys) and len(shard):
            hit = _in_shard(_levels(shard), _unsigned(keys.h1), _unsigned(keys.h2))
        return pd.DataFrame({"h1": keys.h1, "h2": keys.h2, "hit": hit})

    hosts = rows.select("host", "_h1", "_h2").dropDuplicates(["host"])
    pairs = hosts.select("host", F.explode(F.arrays_zip("_h1", "_h2")).alias("k")).select(
        "host", F.col("k._h1").alias("h1"), F.col("k._h2").alias("h2")
    )
    keys = pairs.select("h1", "h2").distinct()
    keys = keys.withColumn("shard", F.pmod("h1", F.lit(n_shards)).cast("int"))
    hits = (
        keys.groupBy("shard")
        .cogroup(cascade.groupBy("shard"))
        .applyInPandas(probe, "h1 long, h2 long, hit boolean")
        .filter("hit")
        .drop("hit")
    )
    bad = pairs.join(hits, ["h1", "h2"]).select(F.col("host").alias("_bad_host")).distinct()
    bad = stored(bad, "cascade-hosts")
    rows = lookup_join(rows.drop("_h1", "_h2"), bad, F.col("host") == F.col("_bad_host"))
    return rows.withColumn("listed", F.col("_bad_host").isNotNull()).drop("_bad_host")


def with_listed(
    rows: DataFrame, cascade: DataFrame, n_shards: int, broadcast_bytes: int = BROADCAST_BYTES
) -> DataFrame:
    """``rows`` with ``listed``: whether the ``host`` or a parent domain of it is listed."""
    domains = domains_of(F.col("host"))
    for i, name in enumerate(("_h1", "_h2")):
        rows = rows.withColumn(name, F.transform(domains, lambda d: _hashes(d)[i]))  # noqa: B023
    size = cascade.agg(F.sum(F.length("bits"))).first()[0] or 0
    way = _listed_by_broadcast if size <= broadcast_bytes else _listed_by_shard
    return way(rows, cascade, n_shards)


def judge(
    pages: DataFrame, rules: Sequence[Rule], cascade: DataFrame, n_shards: int, **options
) -> DataFrame:
    """``pages`` with ``host``, ``path``, ``rule``, ``listed`` and ``verdict``: the rule's, else by the cascade."""
    rows = pages.withColumns({"host": host_of(F.col("url")), "path": path_of(F.col("url"))})
    text, verdict = longest_rule(rules, F.col("host"), F.col("path"))
    rows = with_listed(rows, cascade, n_shards, **options)
    by_list = F.when(F.col("listed"), F.lit("block")).otherwise(F.lit("allow"))
    return rows.withColumns({"rule": text, "verdict": F.coalesce(verdict, by_list)})


def corpus_domains(pages: DataFrame) -> DataFrame:
    """The universe: all hosts of the corpus and their parent domains, as ``key``."""
    hosts = pages.select(host_of(F.col("url")).alias("host")).distinct()
    return hosts.select(F.explode(domains_of(F.col("host"))).alias("key")).distinct()


def domains_named(domains: DataFrame, words: Sequence[str]) -> DataFrame:
    """The domains whose own label has one of the words between hyphens: the block list of the registered query."""
    parts = F.split(F.substring_index("key", ".", 1), "-")
    return domains.filter(F.arrays_overlap(parts, F.array(*[F.lit(w) for w in words])))

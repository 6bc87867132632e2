"""Periodic runs, whitening and SimHash against brute force, and on the cases that each of them defines."""

import hashlib
import math
import random
import re
import time
import zlib
from fractions import Fraction

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from riskloom.llm import periods, queries, simhash, whitening
from riskloom.llm.spread import join_counted
from tests.llm.test_documents import MESSY, SCHEMA, words


@pytest.fixture(scope="module")
def docs(spark, sf):
    return spark.read.parquet(f"{sf}/documents.parquet")


@pytest.fixture(scope="module")
def messy(spark):
    clashing = ["runs", "collapsed", "_found", "_words", "_a", "fingerprint", "n", "label", "shard", "component_id", "key"]
    return spark.createDataFrame(MESSY, SCHEMA).withColumns({c: F.lit("x") for c in clashing})


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


# --- periodic runs ---


def lyndon_by_suffixes(s):
    n = len(s)
    return [next((j for j in range(i + 1, n) if s[j:] < s[i:]), n) - i for i in range(n)]


def runs_by_period(w, least):
    """Every maximal stretch of every period, without those that have a smaller one."""
    found, ids = [], np.unique(w, return_inverse=True)[1] if len(w) else np.zeros(0, dtype=int)
    for p in range(1, len(w) // least.exponent + 1):
        same = np.concatenate([[False], ids[:-p] == ids[p:], [False]])
        edges = np.flatnonzero(same[1:] != same[:-1])
        for start, end in zip(edges[::2].tolist(), edges[1::2].tolist(), strict=True):
            length = end + p - start
            if length >= max(least.words, least.exponent * p):
                stretch = ids[start : end + p]
                if not any((stretch[q:] == stretch[:-q]).all() for q in range(1, p)):
                    found.append((start, length, p))
    return sorted(found, key=lambda r: (r[0], r[2]))


def random_words(draw):
    w = [draw.randrange(draw.choice([1, 2, 3, 5])) for _ in range(draw.randint(0, 45))]
    if w and draw.random() < 0.6:
        a = draw.randrange(len(w))
        p = draw.randint(1, max(1, (len(w) - a) // 3))
        w = [w[a + (i - a) % p] if i >= a else w[i] for i in range(len(w))]
    return w


def test_grouping_gives_lyndon_lengths():
    draw = random.Random(3)
    for _ in range(1500):
        w = random_words(draw)
        assert periods.lyndon_lengths(w) == lyndon_by_suffixes(w)


def test_runs_equal_those_of_every_period():
    draw = random.Random(4)
    for _ in range(1500):
        w = [b"%d" % x for x in random_words(draw)]
        for least in (periods.Least(), periods.Least(4, 2), periods.Least(5, 3), periods.Least(9, 5)):
            assert periods.word_runs(w, least) == runs_by_period(w, least)


def fibonacci(n):
    a, b = [b"a"], [b"a", b"b"]
    while len(b) < n:
        a, b = b, b + a
    return b[:n]


@pytest.mark.parametrize(
    "w, want",
    [
        ([b"a"] * 100_000, [(0, 100_000, 1)]),
        ([b"%d" % (i % 7) for i in range(100_000)], [(0, 100_000, 7)]),
        ([b"%d" % (i % 20_001) for i in range(100_000)], [(0, 100_000, 20_001)]),
        ([b"%d" % i for i in range(100_000)], []),
        (fibonacci(100_000), []),
    ],
    ids=["one word", "short period", "long period", "all different", "fibonacci"],
)
def test_long_texts_take_seconds(w, want):
    start = time.perf_counter()
    # The third repeats itself 4.99 times.
    assert periods.word_runs(w) == want
    assert time.perf_counter() - start < 20


def periodic(doc_id, text):
    w = words(text)
    h = zlib.crc32(str(doc_id).encode())
    g, n = h // 10, len(w)
    if h % 10 == 0 and n:
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        w = [w[a + (i - a) % p] if i >= a else w[i] for i in range(n)]
    return w


def contract_row(w):
    runs = runs_by_period(w, periods.Least())
    best = min(runs, key=lambda r: (-Fraction(r[1], r[2]), r[0], r[2]), default=(None, None, None))
    dropped = {i for s, n, p in runs for i in range(s + p, s + n)}
    return (
        len(runs), *best, best[2] and 1000 * best[1] // best[2],
        sha("".join(f"{s},{n},{p}\n" for s, n, p in runs)),
        sha(" ".join(x for i, x in enumerate(w) if i not in dropped)),
    )


def test_op11_equals_brute_force(spark, sf, docs):
    texts = {r.doc_id: r.text or "" for r in docs.collect()}
    got = queries.QUERIES["op11_periodic_runs"].run(spark, sf).collect()
    assert len(got) == len(texts) and sum(r.n_runs for r in got) > 10
    for r in got:
        row = (r.n_runs, r.start, r.length, r.period, r.exponent_milli, r.runs_sha256, r.collapsed_sha256)
        assert row == contract_row(periodic(r.doc_id, texts[r.doc_id])), r.doc_id


def test_repeated_tails(spark):
    ids = [i for i in range(2000) if zlib.crc32(str(i).encode()) % 10 == 0][:40]
    rows = [(i, " ".join(f"w{k}" for k in range(j))) for j, i in enumerate(ids)] + [(ids[0], None), (None, "a  b"), (1, "c  d")]
    for r in queries.repeated_tails(spark.createDataFrame(rows, "doc_id long, text string")).collect():
        if r.doc_id is None or r.doc_id == 1:
            assert r.text in ("a  b", "c  d")
        elif r.text is not None and words(r.text):
            assert words(r.text) == periodic(r.doc_id, " ".join(f"w{k}" for k in range(ids.index(r.doc_id))))


def test_runs_of_messy_rows(messy):
    found = periods.find_runs(messy)
    assert set(found.columns) == {*messy.columns, "n_words"}
    rows = found.collect()
    assert len(rows) == len(MESSY)
    for r in rows:
        assert [tuple(x) for x in r.runs] == runs_by_period(words(r.text or ""), periods.Least())
        assert r.n_words == len(words(r.text or ""))
    empty = [r for r in rows if not words(r.text or "")]
    assert len(empty) == 3 and all(r.runs == [] and r.collapsed == "" for r in empty)
    assert periods.find_runs(messy.limit(0)).count() == 0


def test_strongest_run_ties(spark):
    runs = [[(5, 8, 2), (9, 12, 3), (20, 9, 2)], [(5, 8, 2), (9, 12, 3)], [(9, 8, 1), (9, 16, 2)], []]
    table = spark.createDataFrame([(i, r) for i, r in enumerate(runs)], "i int, runs array<struct<start: long, length: long, period: long>>")
    got = {r.i: r.b and tuple(r.b) for r in table.select("i", periods.strongest(F.col("runs")).alias("b")).collect()}
    assert got == {0: (20, 9, 2), 1: (5, 8, 2), 2: (9, 8, 1), 3: None}


# --- whitening ---


def whitened_by_hand(vectors, components=4, counts=False):
    """Of rows (id, list): the contract's columns by id."""
    kept = [(i, v) for i, v in vectors if v is not None and all(c is not None and math.isfinite(c) for c in v)]
    dims = max((len(v) for _, v in kept), default=0)
    if not dims:
        return {}
    key = lambda v: tuple(math.floor(256 * float(c)) for c in v)
    fit = [key(v) for _, v in kept] if counts else list({key(v) for _, v in kept})
    pad = lambda x: [*x, *[0] * (dims - len(x))]
    x = np.array([pad(k) for k in fit], dtype=np.int64)
    n, s = len(x), x.sum(axis=0)
    centred = x - s / n
    values, columns = np.linalg.eigh(centred.T @ centred / n)
    trace, values, columns = values.sum(), values[::-1][:components], columns[:, ::-1][:, :components]
    out = {}
    for i, v in kept:
        own = np.array(pad(key(v)), dtype=np.int64)
        out[i] = (n, int(((n * own - s) ** 2).sum()), (own - s / n) @ columns, values, trace)
    return out


def check_whitened(df, vectors, counts=False):
    want, seen, signs = whitened_by_hand(vectors, counts=counts), 0, {}
    for r in df.collect():
        n, deviation, projection, values, trace = want[r.vec_id]
        seen += 1
        assert (r.n, r.deviation) == (n, deviation)
        value = values[r.component - 1]
        if value <= 1e-9 * max(values[0], 1e-300):
            assert (r.whitened, r.explained) == (0.0, 0.0)
            continue
        assert r.explained == pytest.approx(value / trace, rel=1e-6)
        assert abs(r.identity_error) < 1e-6
        expected = projection[r.component - 1] / math.sqrt(value)
        assert abs(r.whitened) == pytest.approx(abs(expected), rel=1e-6, abs=1e-9)
        if abs(expected) > 1e-6:
            signs.setdefault(r.component, set()).add(np.sign(expected) == np.sign(r.whitened))
    assert all(len(s) == 1 for s in signs.values())
    return seen


def test_op12_equals_brute_force(spark, sf):
    rows = spark.read.parquet(f"{sf}/embeddings.parquet").collect()
    got = queries.QUERIES["op12_embedding_whitening"].run(spark, sf)
    assert check_whitened(got, [(r.vec_id, r.embedding) for r in rows]) == 4 * len(rows)


TABLE = "vec_id long, embedding array<float>, n string, key string, component string, _salts string"


def vector_rows(spark, vectors):
    return spark.createDataFrame([(i, v, "n", "k", "c", "s") for i, v in vectors], TABLE)


def test_whitening_of_messy_vectors(spark):
    draw = np.random.default_rng(5)
    vectors = [(i, draw.normal(size=6).round(2).tolist()) for i in range(60)]
    vectors += [(100 + i, vectors[0][1]) for i in range(50)] + [(200, [-0.0] * 6), (201, [0.001] * 6)]
    vectors += [(300, [1.5, -2.0]), (301, []), (302, [1e3] * 6), (None, vectors[1][1])]
    bad = [(400, None), (401, [1.0, None, 2.0, 3.0, 4.0, 5.0]), (402, [float("nan")] * 6), (403, [float("inf")] + [0.0] * 5)]
    df = vector_rows(spark, vectors + bad)
    for weights in ("one", "counts"):
        got = whitening.whiten(df, weights=weights)
        assert set(got.columns) == {"vec_id", "_salts", *(c.split()[0] for c in whitening.RESULTS.split(", "))}
        assert check_whitened(got, vectors + bad, weights == "counts") == 4 * len(vectors)


@pytest.mark.parametrize("vectors", [[], [(1, None)], [(1, [])], [(1, []), (2, None)]])
def test_whitening_without_vectors(spark, vectors):
    assert whitening.whiten(vector_rows(spark, vectors)).count() == 0


def test_whitening_without_variance(spark):
    same = whitening.whiten(vector_rows(spark, [(i, [1.0, 2.0, 3.0]) for i in range(5)])).collect()
    assert len(same) == 15
    assert {(r.n, r.deviation, r.whitened, r.explained, r.identity_error) for r in same} == {(1, 0, 0.0, 0.0, 0.0)}
    # A line has one component with variance.
    line = [(i, [float(i), 2.0 * i, 0.0]) for i in range(9)]
    assert check_whitened(whitening.whiten(vector_rows(spark, line)), line) == 27


def test_whitening_beyond_a_long(spark):
    rows = whitening.whiten(vector_rows(spark, [(1, [3e38, 0.0]), (2, [-3e38, 1.0]), (3, [1.0, 2.0])])).collect()
    assert len(rows) == 6 and all(math.isfinite(r.whitened) for r in rows)
    # Near the mean the distance still fits.
    assert {r.vec_id for r in rows if r.deviation is None} == {1, 2}


# --- SimHash ---


def fingerprint_by_bits(text):
    w = words(re.sub("[A-Z]", lambda m: m.group().lower(), text))
    shingles = [" ".join(w[i : i + 3]) for i in range(len(w) - 2)] or ([" ".join(w)] if w else [])
    hashes = [xxhash.xxh64(s.encode(), seed=42).intdigest() for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def components_by_pairs(bits, ids):
    """Smallest id per row over all pairs of rows."""
    label = list(range(len(bits)))
    values = np.array(bits, dtype=np.uint64)
    for _ in range(len(bits)):
        before = list(label)
        for i in range(len(bits)):
            near = np.flatnonzero(np.bitwise_count(values ^ values[i]) <= 2)
            low = min(label[j] for j in near)
            for j in near:
                label[j] = low
        if label == before:
            break
    return [min((ids[j] for j in range(len(ids)) if label[j] == label[i] and ids[j] is not None), default=None) for i in range(len(ids))]


def test_op13_equals_brute_force(spark, sf, docs):
    texts = docs.select("doc_id", "text").collect()
    bits = [fingerprint_by_bits(r.text or "") for r in texts]
    want = components_by_pairs(bits, [r.doc_id for r in texts])
    got = {r.doc_id: (r.fingerprint, r.component_id) for r in queries.QUERIES["op13_simhash_trees"].run(spark, sf).collect()}
    assert got == {r.doc_id: (f"{b:016x}", c) for r, b, c in zip(texts, bits, want, strict=True)}
    assert len({c for _, c in got.values()}) < len(got)


def test_simhash_of_messy_rows(messy):
    got = simhash.near_duplicates(messy).collect()
    bits = [fingerprint_by_bits(r[1] or "") for r in MESSY]
    want = components_by_pairs(bits, [r[0] for r in MESSY])
    assert sorted(map(repr, map(tuple, got))) == sorted(repr((r[0], f"{b:016x}", c)) for r, b, c in zip(MESSY, bits, want, strict=True))
    assert simhash.near_duplicates(messy.limit(0)).count() == 0


@pytest.mark.parametrize("tree", [8, 1024])
def test_trees_connect_all_that_lies_within_the_radius(spark, tree):
    draw = random.Random(9)
    # Chains of flips, a dense group around one value, one common block, and the extremes.
    values = {0, 2**64 - 1, 1, 2**63}
    for _ in range(60):
        v = draw.getrandbits(64)
        for _ in range(draw.randint(1, 6)):
            values.add(v)
            for b in draw.sample(range(64), draw.choice([1, 2, 2, 3])):
                v ^= 1 << b
    centre = draw.getrandbits(64)
    values |= {centre ^ 1 << a ^ 1 << b for a in range(0, 64, 3) for b in range(0, 64, 7)}
    values |= {(centre & ~(2**42 - 1)) | draw.getrandbits(42) for _ in range(300)}
    values = sorted(values)
    signed = [(int(np.uint64(v).view(np.int64)),) for v in values]
    settings = simhash.Settings(tree=tree, queries=100)
    found = simhash.links(spark.createDataFrame(signed, "fingerprint long"), settings).collect()
    # A spanning set: far fewer links than pairs.
    assert len(found) < 3 * len(values) * (1 if tree > 8 else 20)
    at = {s: i for i, (s,) in enumerate(signed)}
    label = list(range(len(values)))
    for _ in range(len(values)):
        before = list(label)
        for r in found:
            low = min(label[at[r.a]], label[at[r.b]])
            label[at[r.a]] = label[at[r.b]] = low
        if label == before:
            break
    assert label == components_by_pairs(values, list(range(len(values))))


def test_counted_join_spreads_frequent_keys(spark):
    rows = spark.range(20_000).select("id", F.when(F.col("id") % 3 == 0, 7).otherwise(F.col("id") % 500).alias("k"))
    table = rows.groupBy("k").agg(F.count("*").alias("n"), (F.first("k") * 2).alias("twice"))
    joined = join_counted(rows, table, "k", key_rows=100)
    assert joined.columns == ["k", "id", "n", "twice"]
    assert joined.count() == 20_000 and joined.where("twice <> 2 * k").isEmpty()
    assert joined.select("id").distinct().count() == 20_000

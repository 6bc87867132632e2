"""Embedding whitening by a covariance over distinct vectors.

Entries become whole numbers, floor(scale * entry). Equal vectors are grouped once, with their number of rows; the fit
weighs each distinct vector by one, or by that number. Sums are exact whole numbers. The covariance is summed task by
task as a weighted product of centred vectors; its eigenvectors are taken on the driver, where it has as many rows and
columns as a vector has entries. Each distinct vector is whitened once and joined back to its rows.

Defined results: a row is left out if its vector is null or has a null or non-finite entry; a vector shorter than the
longest counts as zero in the entries it lacks, and is a vector of its own; entries beyond a long become the nearest one;
rows without id, and repeated rows, stay rows; a component without variance has ``whitened`` and ``explained`` zero and is
left out of ``identity_error``; there are as many components as entries at most; ``deviation`` is null where it does not
fit a long; other columns pass through, those named like a result are replaced, the vector is dropped; a table without
vectors gives none.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from decimal import Decimal
from fractions import Fraction

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskloom.llm.common import stored
from riskloom.llm.spread import join_counted

SCALE = 256
COMPONENTS = 4
# Entries of the vectors that a task holds as a matrix at once.
PART_ENTRIES = 1_000_000
LONG = 2**63
# Share of the greatest eigenvalue below which rounding leaves no variance.
NO_VARIANCE = 1e-12


def _pack(vectors: pa.Array, scale: int) -> list[bytes | None]:
    """Vectors of whole numbers as bytes: a width, then every entry; None where a row is left out."""
    ends = np.cumsum(np.array([0 if n is None else n for n in vectors.value_lengths().to_pylist()], dtype=np.int64))
    entries = vectors.flatten().cast(pa.float64()).to_numpy(zero_copy_only=False)
    with np.errstate(over="ignore", invalid="ignore"):
        numbers = np.floor(scale * entries)
    inside = np.abs(numbers) < LONG
    whole = np.where(inside, numbers, 0).astype(np.int64)
    whole[~inside] = np.where(numbers[~inside] > 0, LONG - 1, -LONG)
    bad = np.concatenate([[0], np.cumsum(~np.isfinite(entries))])
    wide = np.concatenate([[0], np.cumsum((whole < -(2**15)) | (whole >= 2**15))])
    narrow = whole.astype("<i2")
    out, start = [], 0
    for end, absent in zip(ends.tolist(), vectors.is_null().to_pylist(), strict=True):
        if absent or bad[end] > bad[start]:
            out.append(None)
        elif wide[end] > wide[start]:
            out.append(b"\x08" + whole[start:end].astype("<i8").tobytes())
        else:
            out.append(b"\x02" + narrow[start:end].tobytes())
        start = end
    return out


def _unpack(keys: pd.Series, dims: int) -> np.ndarray:
    out = np.zeros((len(keys), dims), dtype=np.int64)
    shapes: dict[tuple[int, int], list[int]] = {}
    for i, key in enumerate(keys):
        shapes.setdefault((key[0], len(key)), []).append(i)
    for (width, size), rows in shapes.items():
        data = b"".join(bytes(keys.iloc[i][1:]) for i in rows)
        out[rows, : (size - 1) // width] = np.frombuffer(data, dtype=f"<i{width}").reshape(len(rows), -1)
    return out


def _parts(batches: Iterator[pd.DataFrame], dims: int) -> Iterator[tuple[pd.DataFrame, np.ndarray]]:
    """Rows and their vectors, some at a time."""
    step = max(1, PART_ENTRIES // dims)
    for batch in batches:
        for i in range(0, len(batch), step):
            part = batch.iloc[i : i + step].reset_index(drop=True)
            yield part, _unpack(part.key, dims)


def keyed(rows: DataFrame, column: str, scale: int = SCALE) -> DataFrame:
    """The rows that have a vector, with ``key``, its whole numbers as bytes, in place of the vector."""

    @F.arrow_udf("binary")
    def pack(vectors: pa.Array) -> pa.Array:
        return pa.array(_pack(vectors, scale), type=pa.binary())

    named = rows.drop("key") if column != "key" else rows
    others = [c for c in named.columns if c != column]
    return named.select(*others, pack(F.col(column)).alias("key")).where(F.col("key").isNotNull())


def distinct_vectors(rows: DataFrame) -> DataFrame:
    """Stored: each ``key`` once, with its ``n`` rows."""
    return stored(rows.groupBy("key").agg(F.count(F.lit(1)).alias("n")), "whitening-vectors")


@dataclass(frozen=True)
class Fit:
    """Weight of all vectors, exact sums, mean, and the leading components (columns) with their variance."""

    total: int
    sums: list[int]
    mean: np.ndarray
    components: np.ndarray
    variance: np.ndarray
    explained: np.ndarray

    @property
    def axes(self) -> np.ndarray:
        """What centred vectors are multiplied with; zero where there is no variance."""
        some = self.variance > 0
        return self.components * np.where(some, 1 / np.sqrt(np.where(some, self.variance, 1)), 0)


def _weights(part: pd.DataFrame, counts: bool) -> np.ndarray:
    return part.n.to_numpy() if counts else np.ones(len(part), dtype=np.int64)


def _sums(vectors: DataFrame, dims: int, counts: bool) -> tuple[int, list[int]]:
    """Total weight and exact weighted sums."""

    def add(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total = np.zeros(dims + 1, dtype=object)
        for part, x in _parts(batches, dims):
            w = _weights(part, counts)
            bound = int(w.sum()) * max(abs(int(x.min())), abs(int(x.max())))
            exact = x if bound < LONG else x.astype(object)
            total[:dims] += w @ exact if exact is x else (exact * w.astype(object)[:, None]).sum(axis=0)
            total[dims] += int(w.sum())
        yield pd.DataFrame({"dim": np.arange(dims + 1), "total": [Decimal(int(t)) for t in total]})

    parts = vectors.mapInPandas(add, "dim int, total decimal(38,0)")
    found = {r.dim: int(r.total) for r in parts.groupBy("dim").agg(F.sum("total").alias("total")).collect()}
    return found[dims], [found[i] for i in range(dims)]


def _covariance(vectors: DataFrame, mean: np.ndarray, total: int, counts: bool) -> np.ndarray:
    dims = len(mean)

    def multiply(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        products = np.zeros((dims, dims))
        for part, x in _parts(batches, dims):
            centred = x - mean
            products += (centred * _weights(part, counts)[:, None]).T @ centred
        i, j = np.triu_indices(dims)
        yield pd.DataFrame({"i": i, "j": j, "product": products[i, j]})

    cells = vectors.mapInPandas(multiply, "i int, j int, product double").groupBy("i", "j")
    out = np.zeros((dims, dims))
    for r in cells.agg(F.sum("product").alias("product")).collect():
        out[r.i, r.j] = out[r.j, r.i] = r["product"] / total
    return out


def fit(vectors: DataFrame, components: int = COMPONENTS, weights: str = "one") -> Fit | None:
    """Fit to distinct vectors, each weighing one or its ``counts`` of rows; None without vectors or entries."""
    if weights not in ("one", "counts"):
        raise ValueError("weights must be 'one' or 'counts'")
    size = (F.octet_length("key") - 1) / F.conv(F.hex(F.substring("key", 1, 1)), 16, 10).cast("int")
    dims = int(vectors.agg(F.max(size)).first()[0] or 0)
    if not dims:
        return None
    total, sums = _sums(vectors, dims, weights == "counts")
    mean = np.array([float(Fraction(s, total)) for s in sums])
    values, columns = np.linalg.eigh(_covariance(vectors, mean, total, weights == "counts"))
    values, columns = values[::-1], columns[:, ::-1]
    trace = float(values.sum())
    values, columns = values[:components], columns[:, :components]
    values = np.where(values > NO_VARIANCE * max(values[0], 0.0), values, 0.0)
    # The entry that is greatest in size is positive.
    greatest = np.abs(columns).argmax(axis=0)
    columns = columns * np.sign(columns[greatest, np.arange(columns.shape[1])])
    explained = values / trace if values[0] > 0 else np.zeros(len(values))
    return Fit(total, sums, mean, columns, values, explained)


def _deviation(x: np.ndarray, fitted: Fit) -> list[int | None]:
    """Sum over entries of (total * x - sum)^2, exactly."""
    largest = max(abs(int(x.min())), abs(int(x.max()))) * fitted.total + max(map(abs, fitted.sums))
    kind = np.int64 if largest**2 * x.shape[1] < LONG else object
    apart = x.astype(kind) * fitted.total - np.array(fitted.sums, dtype=kind)
    return [int(v) if v < LONG else None for v in (apart * apart).sum(axis=1)]


def projected(vectors: DataFrame, fitted: Fit) -> DataFrame:
    """Each distinct vector with its ``deviation`` and its ``whitened`` coordinates."""
    axes, dims = fitted.axes, len(fitted.mean)

    def project(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for part, x in _parts(batches, dims):
            deviation = pd.Series(_deviation(x, fitted), dtype="Int64")
            yield part.assign(deviation=deviation, whitened=list((x - fitted.mean) @ axes))

    return vectors.mapInPandas(project, "key binary, n long, deviation long, whitened array<double>")


def identity_error(projected_rows: DataFrame, fitted: Fit, weights: str = "one") -> float:
    """Largest absolute entry of the covariance of the whitened vectors minus the identity."""
    k = int((fitted.variance > 0).sum())
    if not k:
        return 0.0
    w = F.col("n") if weights == "counts" else F.lit(1)
    at = [F.get("whitened", i) for i in range(k)]
    sums = [F.sum(w * a).alias(f"s{i}") for i, a in enumerate(at)]
    products = [F.sum(w * at[i] * at[j]).alias(f"p{i}_{j}") for i in range(k) for j in range(i, k)]
    row = projected_rows.agg(*sums, *products).first()
    mean = [row[f"s{i}"] / fitted.total for i in range(k)]
    cells = [(i, j) for i in range(k) for j in range(i, k)]
    return max(abs(row[f"p{i}_{j}"] / fitted.total - mean[i] * mean[j] - (i == j)) for i, j in cells)


RESULTS = "component int, n long, deviation long, whitened double, explained double, identity_error double"


def whiten(
    rows: DataFrame, column: str = "embedding", components: int = COMPONENTS, weights: str = "one", scale: int = SCALE
) -> DataFrame:
    """One row per row with a vector and component: ``component`` (from 1), ``n`` (weight of the fit), ``deviation``
    (squared distance from the mean, times n^2), ``whitened``, ``explained`` (share of the variance), ``identity_error``.
    """
    names = ["component", "n", "deviation", "whitened", "explained", "identity_error"]
    kept = keyed(rows.drop(*(c for c in names if c != column)), column, scale)
    others = [c for c in kept.columns if c != "key"]
    vectors = distinct_vectors(kept)
    fitted = fit(vectors, components, weights)
    if fitted is None:
        empty = [F.lit(None).cast(t.split()[1]).alias(t.split()[0]) for t in RESULTS.split(", ")]
        return kept.select(*others, *empty).where(F.lit(False))
    white = projected(vectors, fitted)
    error = identity_error(white, fitted, weights)
    joined = join_counted(kept, white, "key")
    each = joined.select(*others, "deviation", F.posexplode("whitened").alias("_at", "whitened"))
    shares = F.lit([float(e) for e in fitted.explained])
    return each.select(
        *others,
        (F.col("_at") + 1).alias("component"),
        F.lit(fitted.total).cast("long").alias("n"),
        "deviation",
        "whitened",
        F.get(shares, F.col("_at")).alias("explained"),
        F.lit(float(error)).alias("identity_error"),
    )

"""Document fingerprints: invertible Bloom lookup sketches of a text's paragraphs, with DataFrame functions only.

A paragraph is a line, cut further after the ends of sentences. Its 64-bit digest goes into one cell of each of three
tables; a cell holds a count, the XOR of its digests and the XOR of check hashes of them. Subtracting the sketch of one
version from that of another leaves the digests in which they differ. A cell that holds one digest gives it away, and taking
it out of its two other cells frees more: rows of cells are peeled table by table, so no digest is taken out twice. Sketches
have room for all paragraphs of both versions; a pair that cannot be peeled is tried again with larger tables.

The likeness of two texts is the Jaccard similarity of their sets of paragraphs, from their sizes and what was recovered.

Texts are dealt once, to ranges of ids in which their neighbours are; everything after that, cells included, stays in
those partitions.

Defined results: a null text is empty; two texts without paragraphs have likeness 1, one of them 0; repeated paragraphs
count once; rows without id come last; rows that share an id follow each other by text; a table with one row is its own
neighbour, an empty one gives no rows; other columns are left out.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from riskloom.llm.common import lookup_join, stored

TABLES = 3

#: Cells of each table of the fingerprint that is shown.
SHOWN = 8

#: Rows of one range of ids, and the most ranges.
RANGE_ROWS, MAX_RANGES = 1000, 50_000

#: Times every table is peeled.
TURNS = 6

LOWEST = -(2**63)


def paragraphs(text: Column) -> Column:
    return F.filter(F.split(text, r"\n|(?<=[.!?]) +"), lambda p: p != "")


def digests(text: Column) -> Column:
    return F.array_distinct(F.transform(paragraphs(text), lambda p: F.xxhash64(p)))


def _check(digest: Column) -> Column:
    return F.xxhash64(digest, F.lit("check"))


def shown(digest_array: Column) -> Column:
    """The sketch with three tables of ``SHOWN`` cells as text: count, digests and checks in hex."""

    def cell(table: int, j: int) -> Column:
        own = F.filter(
            digest_array,
            lambda d: F.shiftright(d, 8 * table + 3).bitwiseAND(F.lit(SHOWN - 1).cast("long")) == j,
        )
        return F.aggregate(
            own,
            F.struct(F.lit(0).alias("n"), F.lit(0).cast("long").alias("k"), F.lit(0).cast("long").alias("c")),
            lambda s, d: F.struct(
                (s["n"] + 1).alias("n"),
                s["k"].bitwiseXOR(d).alias("k"),
                s["c"].bitwiseXOR(_check(d)).alias("c"),
            ),
            lambda s: F.concat_ws(":", F.hex(s["n"]), F.hex(s["k"]), F.hex(s["c"])),
        )

    return F.concat_ws(",", *[cell(t, j) for t in range(TABLES) for j in range(SHOWN)])


def with_ranges(docs: DataFrame) -> DataFrame:
    """``doc_id``, ``text``, ``order`` and ``range``; ``guest`` rows show the last of a range its neighbour.

    The first row of each range is repeated in the range above it, that of the highest in the lowest.
    """
    rows = docs.select(
        "doc_id",
        F.coalesce(F.col("text"), F.lit("")).alias("text"),
        F.coalesce(F.col("doc_id").cast("long"), F.lit(LOWEST)).alias("order"),
    )
    n = rows.count()
    ranges = max(1, min(MAX_RANGES, math.ceil(n / RANGE_ROWS)))
    inner = [i / ranges for i in range(1, ranges)] or [0.5]
    bounds = rows.agg(F.percentile_approx("order", inner, max(10_000, 20 * ranges)).alias("b")).first()[0]
    steps = math.ceil(math.log2(len(inner) + 1))
    listed = F.split(F.lit(",".join(map(str, sorted(set(bounds or [0]))))), ",").cast("array<bigint>")
    size = len(set(bounds or [0]))

    # Number of bounds at or below the id, by halving.
    def halve(s: Column, _: Column) -> Column:
        middle = F.floor((s["lo"] + s["hi"]) / 2).cast("int")
        above = F.coalesce(F.get(listed, middle) <= F.col("order"), F.lit(False))
        done = s["lo"] >= s["hi"]
        return F.struct(
            F.when(~done & above, middle + 1).otherwise(s["lo"]).alias("lo"),
            F.when(~done & ~above, middle).otherwise(s["hi"]).alias("hi"),
        )

    start = F.struct(F.lit(0).alias("lo"), F.lit(size).alias("hi"))
    place = F.aggregate(F.sequence(F.lit(1), F.lit(steps + 1)), start, halve, lambda s: s["lo"])
    rows = rows.withColumn("range", place)
    heads = stored(rows.groupBy("range").agg(F.max("order").alias("head")), "print-heads")
    # One row per range: a window over all of them holds at most MAX_RANGES small rows.
    by_range = Window.orderBy("range")
    lowest = F.first("range").over(by_range)
    heads = heads.select(
        F.col("range").alias("_range"), "head", F.coalesce(F.lead("range").over(by_range), lowest).alias("above")
    )
    heads = stored(heads, "print-guests")
    rows = lookup_join(rows, heads, F.col("range") == F.col("_range"))
    at = lambda r, guest: F.struct(r.alias("range"), F.lit(guest).alias("guest"))
    own, guest = at(F.col("range"), False), at(F.col("above"), True)
    places = F.when(F.col("order") == F.col("head"), F.array(own, guest)).otherwise(F.array(own))
    return rows.select("doc_id", "text", "order", F.explode(places).alias("p")).select(
        "doc_id", "text", "order", "p.range", "p.guest"
    )


def neighbours(docs: DataFrame) -> DataFrame:
    """Every document with ``next_id`` and ``next_text`` of the following one, by descending id, and a key: ``range``, ``nr``."""
    by = Window.partitionBy("range").orderBy("guest", F.desc("order"), "text")
    rows = with_ranges(docs).select(
        "doc_id",
        "text",
        "range",
        "guest",
        F.row_number().over(by).alias("nr"),
        F.lead("text").over(by).alias("next_text"),
    )
    return rows.filter(~F.col("guest")).drop("guest")


def edited(text: Column, next_text: Column) -> Column:
    """The last third of the text replaced by the start of the next one."""
    cut = F.floor(F.length(text) / 3).cast("int")
    return F.concat(F.substr(text, F.lit(1), F.length(text) - cut), F.substr(next_text, F.lit(1), cut))


def compared(pairs: DataFrame, room: float) -> DataFrame:
    """Digests that only ``left`` (``gone``) or only ``right`` (``new``) has, per ``range``, ``nr`` and ``pair``.

    ``stuck`` counts the cells that were left over; pairs without any difference have no row. Rows must be dealt by
    ``range``: all aggregations then stay in their partition. A cell's ``slot`` is its table and its place in it; two more
    tables of one cell count what was taken out.
    """
    total = F.size("left") + F.size("right")
    signed = lambda side, n: F.transform(side, lambda d: F.struct(F.lit(n).cast("long").alias("n"), d.alias("k")))
    rows = pairs.select(
        "range",
        (F.col("nr").cast("long") * 2 + F.col("pair")).alias("key"),
        F.ceil(total * room / TABLES + 16).cast("int").alias("cells"),
        F.explode(F.concat(signed("left", 1), signed("right", -1))).alias("e"),
    ).select("range", "key", "cells", "e.n", "e.k", _check(F.col("e.k")).alias("c"))
    size = 1 << 40
    slot = lambda t: F.pmod(F.xxhash64("k", F.lit(t)), F.col("cells")) + F.lit(t * size)
    rows = rows.withColumn("slot", F.explode(F.array(*[slot(t) for t in range(TABLES)])))
    group = ["range", "key", "cells", "slot"]

    def summed(df: DataFrame) -> DataFrame:
        sums = df.groupBy(group).agg(F.sum("n").alias("n"), F.bit_xor("k").alias("k"), F.bit_xor("c").alias("c"))
        return sums.filter("n <> 0 or k <> 0 or c <> 0")

    gone, new, nothing = TABLES * size, (TABLES + 1) * size, F.lit(0).cast("long")
    rows = summed(rows)
    for turn in range(TURNS * TABLES):
        table = turn % TABLES
        within = F.col("slot").between(table * size, (table + 1) * size - 1)
        alone = within & (F.abs("n") == 1) & (F.col("c") == _check(F.col("k")))
        as_is = F.struct("slot", "n", "k", "c")
        tally = F.struct(
            F.when(F.col("n") > 0, F.lit(gone)).otherwise(F.lit(new)).alias("slot"),
            F.lit(1).cast("long").alias("n"), nothing.alias("k"), nothing.alias("c"),
        )
        out = [
            F.struct(slot(t).alias("slot"), (-F.col("n")).alias("n"), "k", "c") for t in range(TABLES) if t != table
        ]
        moves = F.explode(F.when(alone, F.array(tally, *out)).otherwise(F.array(as_is)))
        rows = summed(rows.select("range", "key", "cells", moves.alias("m")).select("range", "key", "cells", "m.*"))
    sums = rows.groupBy("range", "key").agg(
        F.sum(F.when(F.col("slot") == gone, F.col("n")).otherwise(0)).alias("gone"),
        F.sum(F.when(F.col("slot") == new, F.col("n")).otherwise(0)).alias("new"),
        F.count_if(F.col("slot") < gone).alias("stuck"),
    )
    nr, pair = F.shiftright("key", 1).cast("int"), F.col("key").bitwiseAND(F.lit(1).cast("long")).cast("int")
    return sums.select("range", nr.alias("nr"), pair.alias("pair"), "gone", "new", "stuck")


def _pairs(rows: DataFrame) -> DataFrame:
    """Both comparisons of each row: 0 with its edited text, 1 with the next one."""
    rows = rows.withColumns(
        {
            "a": digests(F.col("text")),
            "e": digests(edited(F.col("text"), F.col("next_text"))),
            "x": digests(F.col("next_text")),
        }
    )
    both = F.array(
        F.struct(F.lit(0).alias("pair"), F.col("a").alias("left"), F.col("e").alias("right")),
        F.struct(F.lit(1).alias("pair"), F.col("a").alias("left"), F.col("x").alias("right")),
    )
    return rows.select("range", "nr", F.explode(both).alias("b")).select("range", "nr", "b.*")


def differences(rows: DataFrame, room: float = 1.7) -> DataFrame:
    """Stored differences of all pairs that differ somewhere; those that fail are tried again with twice the room."""
    done = stored(compared(_pairs(rows), room), "print-differences")
    failed = done.filter("stuck > 0")
    while not failed.isEmpty():
        room *= 2
        keys = failed.select("range", "nr", "pair")
        again = rows.join(F.broadcast(keys) if keys.count() < 10_000 else keys, ["range", "nr"], "left_semi")
        again = _pairs(again).join(keys, ["range", "nr", "pair"], "left_semi").repartition("range")
        more = stored(compared(again, room), "print-differences")
        done = done.filter("stuck = 0").unionByName(more)
        failed = more.filter("stuck > 0")
    return done


def fingerprints(docs: DataFrame) -> DataFrame:
    """``doc_id``, ``n_chars``, ``edited_sha256``, both fingerprints, ``near_edited`` and ``near_next`` of every row."""
    rows = neighbours(docs)
    sides = ("near_edited", "near_next")
    found = differences(rows).groupBy("range", "nr").agg(
        *[
            F.max(F.when(F.col("pair") == i, F.struct("gone", "new"))).alias(side)
            for i, side in enumerate(sides)
        ]
    )
    changed = edited(F.col("text"), F.col("next_text"))
    # The digests are columns of their own: each is read by every cell of the sketch.
    rows = rows.withColumns({"_a": digests(F.col("text")), "_e": digests(changed)})
    shapes = rows.select(
        "range",
        "nr",
        "doc_id",
        F.length("text").cast("long").alias("n_chars"),
        F.sha2(changed.cast("binary"), 256).alias("edited_sha256"),
        F.size("_a").alias("_n"),
        shown(F.col("_a")).alias("fingerprint"),
        shown(F.col("_e")).alias("edited_fingerprint"),
    )

    def likeness(side: str) -> Column:
        """Paragraphs of both over those of either; pairs without any difference left nothing behind."""
        lost, more = (F.coalesce(F.col(side)[c], F.lit(0)) for c in ("gone", "new"))
        return F.coalesce(F.try_divide(F.col("_n") - lost, F.col("_n") + more), F.lit(1.0)).alias(side)

    return shapes.join(found, ["range", "nr"], "left").select(
        "doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", *[likeness(side) for side in sides]
    )

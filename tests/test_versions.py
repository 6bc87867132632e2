"""Versioned state: one writer wins, dead runs change nothing, repeated runs find their commit; decisions run by run."""

import threading

import pytest
from pyspark.sql import functions as F

from riskloom.operators import decide as G
from riskloom.operators import registry as R
from riskloom.plans import monitoring
from riskloom.sources import versions
from riskloom.streaming.monitoring import arrived_scores, take_batch, watch_scores


def numbers(spark, *values):
    return spark.createDataFrame([(v,) for v in values], "n int")


def content(df):
    return sorted(r["n"] for r in df.collect())


def test_an_empty_store_has_no_version(spark, scratch):
    root = scratch("state")
    assert versions.versions(spark, root) == [] and versions.version(spark, root) is None
    assert versions.read(spark, root) is None
    with pytest.raises(FileNotFoundError):
        R.read_registry(spark, root)
    assert R.read_activations(spark, root).count() == 0 and monitoring.read_decisions(spark, root).count() == 0


@pytest.mark.parametrize("scheme", ["file", "other"])
def test_one_of_two_writers_wins(spark, scratch, monkeypatch, scheme):
    root = scratch("state")
    if scheme == "other":
        monkeypatch.setattr(versions, "LOCAL", "none")  # the rename that other file systems get
    assert versions.commit(numbers(spark, 1), root, 0) == 1
    with pytest.raises(versions.CommitConflict):
        versions.commit(numbers(spark, 2), root, 0)
    assert versions.commit(numbers(spark, 3), root, 1) == 2
    assert content(versions.read(spark, root)) == [3] and content(versions.read(spark, root, 1)) == [1]


def test_writers_at_the_same_time_lose_nothing(spark, scratch):
    root, failed = scratch("state"), []

    def add(value):
        try:
            versions.update(
                spark, root,
                lambda known: numbers(spark, value) if known is None else known.unionByName(numbers(spark, value)),
            )
        except Exception as e:  # noqa: BLE001
            failed.append(e)

    threads = [threading.Thread(target=add, args=(i,)) for i in range(6)]
    [t.start() for t in threads]
    [t.join() for t in threads]
    assert not failed and content(versions.read(spark, root)) == list(range(6))
    assert versions.versions(spark, root) == [1, 2, 3, 4, 5, 6]


def test_a_run_that_dies_before_its_claim_changes_nothing(spark, scratch, monkeypatch):
    root = scratch("state")
    versions.commit(numbers(spark, 1), root, 0)

    def die(*_):
        raise OSError("lost")

    with monkeypatch.context() as m:
        m.setattr(versions, "_claim", die)
        with pytest.raises(OSError):
            versions.commit(numbers(spark, 2), root, 1)
    assert versions.versions(spark, root) == [1] and content(versions.read(spark, root)) == [1]
    assert versions.commit(numbers(spark, 3), root, 1) == 2 and content(versions.read(spark, root)) == [3]


def test_a_repeated_run_finds_its_commit(spark, scratch):
    root = scratch("state")
    add = lambda known: numbers(spark, 7) if known is None else known.unionByName(numbers(spark, 7))
    assert versions.update(spark, root, add, "run-1") == 1
    assert versions.update(spark, root, add, "run-2") == 2
    assert versions.update(spark, root, add, "run-1") == 1
    assert content(versions.read(spark, root)) == [7, 7]


def test_registry_and_activations_take_a_rerun(spark, scratch):
    path, events = scratch("registry"), scratch("events")
    row = spark.createDataFrame([("v1", 0.5)], "model_version string, auc_test double")
    R.append_registry(row, path)
    R.append_registry(row.withColumn("auc_test", F.lit(0.6)), path)
    R.append_registry(row.withColumn("model_version", F.lit("v2")), path)
    registry = R.read_registry(spark, path)
    assert sorted(tuple(r) for r in registry.collect()) == [("v1", 0.6), ("v2", 0.5)]
    assert [tuple(r) for r in R.read_registry(spark, path, 1).collect()] == [("v1", 0.5)]
    for version in ("v1", "v2", "v2", "absent"):
        R.record_activation(registry, events, version, "2024-05-01" if version == "v1" else "2024-06-01")
    known = R.read_activations(spark, events)
    assert known.count() == 2 and R.active_model(known, registry).first()[0] == "v2"


def wanted(spark, rows):
    schema = "model_name string, decided_on date, wants_retrain boolean"
    df = spark.createDataFrame(rows, schema.replace("date", "string")).withColumn("decided_on", F.col("decided_on").cast("date"))
    return df.withColumns({
        "month": F.date_format("decided_on", "yyyy-MM"), "overall": F.lit(0.5), "psi": F.create_map(F.lit("a"), F.lit(0.5)),
        "status": F.lit("OK"), "key_columns_high": F.lit(1),
    })


def branches(df):
    return sorted((r["model_name"], str(r["decided_on"]), r["branch"]) for r in df.collect())


def test_decisions_run_by_run_equal_one_run(spark, scratch):
    rows = [(m, f"2024-{i:02d}-01", (i * k) % 3 != 1) for m, k in (("a", 1), ("b", 2)) for i in range(1, 9)]
    whole = branches(G.cooldown(wanted(spark, rows), days=70))
    root = scratch("decisions")
    late = [rows[i] for i in (12, 3, 0, 9, 5)]
    for part in (rows[1:6], rows[8:], late, rows[:1], rows[6:8]):
        monitoring.store_decisions(wanted(spark, part), root, days=70)
    assert branches(monitoring.read_decisions(spark, root)) == whole
    held = {r["model_name"]: r["cooldown_until"] for r in monitoring.stored_cooldown(spark, root, 70).collect()}
    assert set(held) == {m for m, _, b in whole if b == "retrain_model"}


def scores(spark, rows, lo, hi):
    """Scores of months lo to hi - 1 that drift away from the first month."""
    n = F.col("id")
    month = F.add_months(F.lit("2024-01-01").cast("date"), (lo + n % (hi - lo)).cast("int"))
    return spark.range(rows).select(
        ((n * 37 % 101) / 100 + F.month(month) * 0.15).alias("prediction"), month.alias("snapshot_date")
    )


def test_scores_that_arrive_in_parts_are_decided_like_all_at_once(spark, scratch):
    source, root, progress = scratch("source"), scratch("watched"), scratch("progress")
    base = scores(spark, 400, 0, 1).select("prediction")
    full = scores(spark, 3000, 0, 6)
    full.withColumn("h", F.hash("prediction") % 3).where("h < 1").drop("h").coalesce(1).write.parquet(f"{source}/one")
    full.withColumn("h", F.hash("prediction") % 3).where("h >= 1").drop("h").coalesce(1).write.parquet(f"{source}/two")

    def arrivals():
        return spark.readStream.schema(full.schema).option("maxFilesPerTrigger", 1).parquet(f"{source}/*")

    watch_scores(arrivals(), base, root, progress, "m")
    spine = full.select("snapshot_date").distinct()
    whole = monitoring.decide_months(base, full, spine, "m")
    cols = ["decided_on", "overall", "status", "wants_retrain", "branch"]
    plain = lambda df: sorted(tuple(str(v) for v in r) for r in df.select(*cols).collect())
    mine = monitoring.read_decisions(spark, f"{root}/decisions")
    assert plain(mine) == plain(whole) and mine.count() == 6
    before = versions.versions(spark, f"{root}/decisions")
    assert len(before) == 2 and arrived_scores(spark, f"{root}/scores").count() == 3000
    # Nothing new; then the last batch once more, as after a run that died before it noted the batch.
    watch_scores(arrivals(), base, root, progress, "m")
    take_batch(spark.read.parquet(f"{source}/{_second(spark, root, source)}"), 1, base, root, "m")
    assert versions.versions(spark, f"{root}/decisions") == before
    assert arrived_scores(spark, f"{root}/scores").count() == 3000
    take_batch(full.limit(0), 9, base, root, "m")
    assert versions.versions(spark, f"{root}/decisions") == before


def _second(spark, root, source):
    """Which of the two files came as batch 1."""
    n = spark.read.parquet(f"{root}/scores").where("arrival_batch = 1").count()
    return "one" if spark.read.parquet(f"{source}/one").count() == n else "two"

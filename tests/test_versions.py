"""Versions told by manifests, and keys that stay."""

import time
from datetime import datetime, timezone

import pytest

from panelkit.operators import relational as rel, text_search
from panelkit.session import scratch_path
from panelkit.sources import versions


def panel(spark, rows):
    return spark.createDataFrame(rows, "code string, year int, v double")


ROWS = [("A", 2000, 1.0), ("B", 2000, None), ("A", 2001, 3.0), ("C", None, 4.0)]


def rows_of(df):
    return sorted(map(tuple, df.select("code", "year", "v").collect()), key=str)


def test_unchanged_partitions_are_referenced(spark):
    target = scratch_path(spark, "v")
    versions.write_version(spark, {"fact": panel(spark, ROWS)}, target, "one", {"fact": "year"})
    changed = ROWS[:2] + [("A", 2001, 9.0), ROWS[3], ("D", 2002, 5.0)]
    second = versions.write_version(spark, {"fact": panel(spark, changed)}, target, "two", {"fact": "year"})
    where = {r.partition: r.path.rsplit("=", 1)[1] for r in second.collect()}
    assert where == {"2000": "one", "": "one", "2001": "two", "2002": "two"}
    assert rows_of(versions.read_version(spark, target, "fact", "one")) == sorted(ROWS, key=str)
    assert rows_of(versions.read_version(spark, target, "fact")) == sorted(changed, key=str)
    assert versions.read_version(spark, target, "fact").schema == panel(spark, ROWS).schema
    assert versions.verify_version(spark, target, "one").count() == versions.verify_version(spark, target).count() == 0


def test_an_interrupted_write_is_not_seen(spark, monkeypatch):
    target = scratch_path(spark, "v")
    versions.write_version(spark, {"fact": panel(spark, ROWS)}, target, "one", {"fact": "year"})

    def stopped(*_):
        raise OSError("stopped before the manifest")

    with monkeypatch.context() as m, pytest.raises(OSError):
        m.setattr(versions, "_manifest", stopped)
        versions.write_version(spark, {"fact": panel(spark, ROWS[:1])}, target, "two", {"fact": "year"})
    # A manifest without its end mark counts as none.
    spark.range(1).write.option("mapreduce.fileoutputcommitter.marksuccessfuljobs", "false").parquet(f"{target}/manifests/version=three")
    assert [v for v, _ in versions.versions(spark, target)] == ["one"]
    assert rows_of(versions.read_version(spark, target, "fact")) == sorted(ROWS, key=str)
    versions.write_version(spark, {"fact": panel(spark, ROWS[:1])}, target, "two", {"fact": "year"})
    assert rows_of(versions.read_version(spark, target, "fact")) == [ROWS[0]]


def test_as_of_and_unknown_versions(spark):
    target = scratch_path(spark, "v")
    before = datetime.now(timezone.utc)
    versions.write_version(spark, {"t": panel(spark, ROWS)}, target, "one")
    time.sleep(0.05)
    between = datetime.now(timezone.utc)
    time.sleep(0.05)
    versions.write_version(spark, {"t": panel(spark, ROWS[:1])}, target, "two")
    assert versions.read_version(spark, target, "t", as_of=between).count() == 4
    assert versions.read_version(spark, target, "t", as_of=datetime.now(timezone.utc)).count() == 1
    for wrong in ({"as_of": before}, {"version": "three"}):
        with pytest.raises(ValueError):
            versions.read_version(spark, target, "t", **wrong)
    with pytest.raises(ValueError):
        versions.write_version(spark, {"t": panel(spark, ROWS)}, target, "two")


def test_lost_files_are_found(spark):
    target = scratch_path(spark, "v")
    versions.write_version(spark, {"t": panel(spark, ROWS)}, target, "one", {"t": "code"})
    path = spark._jvm.org.apache.hadoop.fs.Path(f"{target}/data/t/version=one/_partition=A")
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)
    assert [r.partition for r in versions.verify_version(spark, target).collect()] == ["A"]


def test_empty_table(spark):
    target = scratch_path(spark, "v")
    versions.write_version(spark, {"t": panel(spark, [])}, target, "one", {"t": "code"})
    assert versions.read_version(spark, target, "t").collect() == [] and versions.verify_version(spark, target).count() == 0


def test_keys_stay(spark):
    target = scratch_path(spark, "k")
    frame = lambda names: spark.createDataFrame([(n,) for n in names], "name string")
    key = lambda df: {r.name: r.id for r in df.collect()}
    assert key(versions.assign_keys(spark, frame(["m", "b", "b", None]), "name", target, "1")) == {"b": 1, "m": 2}
    assert key(versions.assign_keys(spark, frame(["a", "z", "m"]), "name", target, "2")) == {"b": 1, "m": 2, "a": 3, "z": 4}
    assert key(versions.assign_keys(spark, frame(["b"]), "name", target, "3")) == {"b": 1, "m": 2, "a": 3, "z": 4}
    assert key(versions.read_keys(spark, target, "1")) == {"b": 1, "m": 2}
    batches = {r.partition: r.path.rsplit("=", 1)[1] for r in versions.read_manifest(spark, target).collect()}
    assert batches == {"1": "1", "2": "2"}  # a version writes its own batch only


def test_search_in_the_index_equals_the_scan(spark):
    names = ["Côte d'Ivoire", "Costa Rica", "cost", "OSTA", "a", "Ab", "abab", "", None, "tacos"]
    df = spark.createDataFrame([(f"K{i}", n, f"code{i % 3}") for i, n in enumerate(names)], "iso_code string, country string, code string")
    index = text_search.build_index(df, ["country", "code"], parts=3)
    for text in ["cost", "osta", "a", "ab", "aba", "baba", "CODE1", "ô", "d'i", "  ", "none", "st", "code12"]:
        got = text_search.search_index(index, df, text, ["country", "code"], k=4).collect()
        assert got == rel.search(df, text, ["country", "code"], k=4).collect(), text
    plan = text_search.search_index(index, df, "cost", ["country"])._jdf.queryExecution().executedPlan().toString()
    assert "In(piece" in plan

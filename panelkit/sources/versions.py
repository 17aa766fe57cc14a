"""Versions of tables, told by manifests, and keys that never change.

A version's data is written first, its manifest last. The manifest lists for every table and partition where
the files are, how many rows they hold and their checksum. Readers follow manifests only, so a
write that was interrupted leaves files nobody looks at. A partition that is as the version
before has it is referenced there and not written again.
"""

from __future__ import annotations

import json
from collections.abc import Mapping
from datetime import datetime, timezone
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.types import StringType, StructField, StructType

from panelkit.operators.relational import dense_key
from panelkit.session import store
from panelkit.sources.readers import path_exists

WHOLE = "all"  # the partition of a table that is not split
ENTRY = "table_name string, partition string, path string, rows long, checksum string, split_by string, schema string"


def _manifest(target: str, version: str) -> str:
    return f"{target}/manifests/version={version}"


def versions(spark: SparkSession, target: str) -> list[tuple[str, datetime]]:
    """Finished versions, oldest first: those whose manifest was written to its end."""
    if not path_exists(spark, f"{target}/manifests"):
        return []
    root = spark._jvm.org.apache.hadoop.fs.Path(f"{target}/manifests")
    found = [s.getPath() for s in root.getFileSystem(spark._jsc.hadoopConfiguration()).listStatus(root)]
    names = [p.getName().removeprefix("version=") for p in found if path_exists(spark, f"{p}/_SUCCESS")]
    out = []
    for name in names:
        created = spark.read.schema(f"{ENTRY}, created_at timestamp").parquet(_manifest(target, name)).agg(F.max("created_at")).first()[0]
        out.append((name, created))
    return sorted(out, key=lambda v: (v[1], v[0]))


def read_manifest(spark: SparkSession, target: str, version: str | None = None, as_of: datetime | None = None) -> DataFrame:
    """The entries of a version; without one the last, or the last that was there at ``as_of``."""
    known = versions(spark, target)
    if version is None:
        known = [v for v, created in known if as_of is None or created.astimezone(timezone.utc) <= as_of.astimezone(timezone.utc)]
        if not known:
            raise ValueError(f"no version in {target}" + (f" as of {as_of}" if as_of else ""))
        version = known[-1]
    elif version not in [v for v, _ in known]:
        raise ValueError(f"no version {version} in {target}")
    return spark.read.schema(f"{ENTRY}, created_at timestamp").parquet(_manifest(target, version))


def _checksum(df: DataFrame) -> Column:
    """Of all rows in any order: the sum and the exclusive or of their hashes."""
    row = F.xxhash64(*[F.col(f"`{c}`") for c in sorted(df.columns)])
    return F.concat_ws(":", F.sum(row.cast("decimal(38,0)")).cast("string"), F.bit_xor(row).cast("string"))


def _schema(df: DataFrame) -> str:
    """As files give it back: every column may be missing."""
    return StructType([StructField(f.name, f.dataType) for f in df.schema.fields]).json()


def write_version(spark: SparkSession, tables: Mapping[str, DataFrame], target: str, version: str, split_by: Mapping[str, str] | None = None) -> DataFrame:
    """Write the tables as a version and return its manifest. ``split_by`` names a table's partition column.

    Only partitions whose rows or checksum differ from the last version's are written. A version that
    exists is not written again.
    """
    split_by = dict(split_by or {})
    known = [v for v, _ in versions(spark, target)]
    if version in known:
        raise ValueError(f"version {version} exists")
    before = read_manifest(spark, target).drop("created_at") if known else spark.createDataFrame([], ENTRY)
    entries = []
    for name, df in tables.items():
        split = split_by.get(name)
        part = F.coalesce(F.col(f"`{split}`").cast("string"), F.lit("")) if split else F.lit(WHOLE)
        own = df.groupBy(part.alias("partition")).agg(F.count(F.lit(1)).alias("rows"), _checksum(df).alias("checksum"))
        own = own.withColumns({"table_name": F.lit(name), "split_by": F.lit(split or ""), "schema": F.lit(_schema(df))})
        old = before.select("table_name", "partition", "rows", "checksum", "split_by", "schema", F.col("path").alias("old"))
        path = f"{target}/data/{name}/version={version}"
        own = store(own.join(old, ["table_name", "partition", "rows", "checksum", "split_by", "schema"], "left"), "entries")
        changed = own.filter("old IS NULL").select("partition")
        rows = df.withColumn("_partition", part).join(changed.withColumnRenamed("partition", "_partition"), "_partition", "left_semi")
        if split:
            rows = rows.hint("rebalance", F.col("_partition"))
        if not changed.isEmpty():
            rows.write.mode("overwrite").partitionBy("_partition").parquet(path)
        own = own.withColumn("path", F.coalesce("old", F.lit(path)))
        if df.isEmpty():  # a table without rows has one entry that says so
            own = spark.createDataFrame([(WHOLE, 0, "", name, split or "", _schema(df), "")], "partition string, rows long, checksum string, table_name string, split_by string, schema string, path string")
        entries.append(own.select(*[f.split()[0] for f in ENTRY.split(", ")]))
    manifest = reduce(DataFrame.unionByName, entries).withColumn("created_at", F.lit(datetime.now(timezone.utc)))
    manifest.coalesce(1).write.mode("overwrite").parquet(_manifest(target, version))  # last: from here on the version is there
    return read_manifest(spark, target, version)


def read_version(spark: SparkSession, target: str, table: str, version: str | None = None, as_of: datetime | None = None) -> DataFrame:
    """A table as a version has it."""
    entries = [r.asDict() for r in read_manifest(spark, target, version, as_of).filter(F.col("table_name") == table).collect()]
    if not entries:
        raise ValueError(f"no table {table} in the version")
    schema = StructType.fromJson(json.loads(entries[0]["schema"]))
    stored = StructType([*schema.fields, StructField("_partition", StringType())])
    empty = spark.createDataFrame([], schema)
    roots: dict[str, list[str]] = {}
    for e in entries:
        if e["rows"]:
            roots.setdefault(e["path"], []).append(e["partition"])
    parts = []
    for root, names in sorted(roots.items()):
        own = F.col("_partition").isin(names) | (F.col("_partition").isNull() if "" in names else F.lit(False))
        parts.append(spark.read.schema(stored).parquet(root).filter(own).drop("_partition"))
    return reduce(DataFrame.unionByName, parts, empty) if parts else empty


def verify_version(spark: SparkSession, target: str, version: str | None = None) -> DataFrame:
    """Partitions whose files do not hold the rows the manifest says: none, unless files were lost or changed."""
    manifest = read_manifest(spark, target, version)
    bad = []
    for r in manifest.select("table_name").distinct().collect():
        df = read_version(spark, target, r["table_name"], version)
        own = manifest.filter((F.col("table_name") == r["table_name"]) & (F.col("rows") > 0))
        split = own.select("split_by").first()
        part = F.coalesce(F.col(f"`{split[0]}`").cast("string"), F.lit("")) if split and split[0] else F.lit(WHOLE)
        now = df.groupBy(part.alias("partition")).agg(F.count(F.lit(1)).alias("rows"), _checksum(df).alias("checksum"))
        bad.append(own.select("table_name", "partition", "rows", "checksum").join(now, ["partition", "rows", "checksum"], "left_anti").select("table_name", "partition", "rows"))
    return reduce(DataFrame.unionByName, bad)


# Keys

def assign_keys(spark: SparkSession, entities: DataFrame, key: str, target: str, version: str, out: str = "id") -> DataFrame:
    """(key, id) of every key seen in this or an earlier version; ids of earlier ones stay as they are.

    New keys get the next ids in key order. They are found by an anti-join, numbered range by range, and
    stored as one more batch, so a version writes only what is new. A version that was interrupted
    left no manifest and is not seen; run again it gives the same ids.
    """
    names = entities.select(F.col(f"`{key}`").alias(key)).filter(F.col(f"`{key}`").isNotNull()).distinct()
    known = read_keys(spark, target) if versions(spark, target) else None
    fresh = names if known is None else names.join(known.select(key), key, "left_anti")
    last = 0 if known is None else known.agg(F.max(out)).first()[0] or 0
    numbered = dense_key(store(fresh, "keys"), key, out).withColumn(out, F.col(out) + F.lit(last).cast("long"))
    batch = numbered.withColumn("batch", F.lit(version))
    old = [] if known is None else [read_version(spark, target, "keys")]
    write_version(spark, {"keys": reduce(DataFrame.unionByName, [*old, batch])}, target, version, {"keys": "batch"})
    return read_keys(spark, target)


def read_keys(spark: SparkSession, target: str, version: str | None = None) -> DataFrame:
    """(key, id) as of a version; the last without one."""
    return read_version(spark, target, "keys", version).drop("batch")

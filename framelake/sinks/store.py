"""Sinks and table maintenance (SNK-1..SNK-9, AGG-9 as the upsert's guard).

Keyed upsert has these forms:

* a catalog table whose format supports row-level operations (Delta, Iceberg):
  ``DataFrame.mergeInto`` - update all on match, insert all otherwise;
* a catalog table that this module creates: bucketed by the key inside partitions that are a hash of the key. The increment is
  written with the same layout, so increment and target meet bucket by bucket and neither is shuffled. New keys are inserted; otherwise the
  partitions that hold increment keys are written anew elsewhere and each is switched over by one catalog operation;
* any other catalog table: the merged result is staged, then swapped in by renames;
* a storage path: a Parquet folder without a catalog. New keys are appended; otherwise the merged folder is written
  beside it and swapped in by renames.

Every form leaves complete content wherever a run is cut short, and running the same upsert again finishes it. One
writer at a time.
"""

from __future__ import annotations

import re
import uuid
import warnings
from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from framelake.operators.contracts import check_keys
from framelake.session import checkpoint_path, staged


def table_exists(spark: SparkSession, name: str) -> bool:
    """SNK-1."""
    return spark.catalog.tableExists(name)


def merge_result(target: DataFrame, source: DataFrame, keys: Sequence[str], evolve: bool = False) -> DataFrame:
    """JOI-2 / SNK-3 as a pure plan: rows of ``target`` not matched by key, plus all of ``source``.

    Equal to MERGE ... WHEN MATCHED UPDATE * WHEN NOT MATCHED INSERT * for a source
    with unique, non-null keys. The anti join shuffles both sides on the key (or
    broadcasts the source when AQE measures it small).

    The column sets must be equal unless ``evolve`` is set. Then columns only in ``source`` are added (NULL in
    rows that are not matched), and columns only in ``target`` keep their value in matched rows.
    """
    keys = list(keys)
    extra = [c for c in source.columns if c not in target.columns]
    missing = [c for c in target.columns if c not in source.columns]
    if (extra or missing) and not evolve:
        raise ValueError(f"columns differ: only in the source {extra}, only in the target {missing}; pass evolve=True to merge them")
    kept = target.join(source.select(*keys), keys, "left_anti")
    if missing:
        source = source.join(target.select(*keys, *missing), keys, "left")
    return kept.unionByName(source, allowMissingColumns=True).select(*target.columns, *extra)


# ---------------------------------------------------------------- path tables


def _fs(spark: SparkSession, path: str):
    jpath = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return jpath.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), jpath


def _beside(path: str, what: str) -> str:
    return f"{path.rstrip('/')}__{what}"


def read_path(spark: SparkSession, path: str, fmt: str = "parquet") -> DataFrame | None:
    """SRC-6 for the path form: the table's rows, or None if there is no table.

    A folder that is missing because a swap was cut short is put back first.
    """
    fs, root = _fs(spark, path)
    if not fs.exists(root):
        _, old = _fs(spark, _beside(path, "old"))
        if not fs.exists(old):
            return None
        fs.rename(old, root)
    if not any(st.isDirectory() or not st.getPath().getName().startswith(("_", ".")) for st in fs.listStatus(root)):
        return None
    return spark.read.option("mergeSchema", "true").format(fmt).load(path)


def _swap_path(spark: SparkSession, df: DataFrame, path: str, fmt: str) -> None:
    """Replace a folder: the new one is complete before the present one is moved aside, which goes last."""
    new, old = _beside(path, "new"), _beside(path, "old")
    read_path(spark, path, fmt)  # puts back what an earlier swap moved aside
    fs, root = _fs(spark, path)
    for leftover in (new, old):
        fs.delete(_fs(spark, leftover)[1], True)
    df.write.format(fmt).save(new)
    if fs.exists(root):
        fs.rename(root, _fs(spark, old)[1])
    fs.rename(_fs(spark, new)[1], root)
    fs.delete(_fs(spark, old)[1], True)


def _upsert_path(spark: SparkSession, path: str, source: DataFrame, keys: list[str], fmt: str, check: bool, evolve: bool) -> str:
    """Path form of the upsert. The increment is staged once: the key check, the overlap test and the
    merge read it instead of running its plan again (a scoring UDF runs once)."""
    inc = staged(source, "increment")
    if check:
        check_keys(inc, keys)
    current = read_path(spark, path, fmt)
    if current is None:
        inc.write.format(fmt).mode("append").save(path)
        return "created"
    same = set(current.columns) == set(inc.columns)
    if not same and not evolve:
        merge_result(current, inc, keys)  # raises and names the columns
    if same and inc.select(*keys).join(current.select(*keys), keys, "left_semi").isEmpty():
        inc.write.format(fmt).mode("append").save(path)
        return "appended"
    _swap_path(spark, merge_result(current, inc, keys, evolve), path, fmt)
    return "merged"


# ---------------------------------------------------------------- keyed catalog tables
PARTS = 16


def _quoted(name: str) -> str:
    return ".".join(f"`{p}`" for p in name.split("."))


def _part_column(columns: Sequence[str]) -> str | None:
    """The partition column of the keyed layout; its name tells the number of partitions."""
    return next((c for c in columns if re.fullmatch(r"key_part_of_[0-9]+", c)), None)


def _described(spark: SparkSession, table: str, partition: str = "") -> dict[str, str]:
    """What the catalog says; a partition's own entries stand before those of its table."""
    out: dict[str, str] = {}
    for r in spark.sql(f"DESCRIBE TABLE EXTENDED {_quoted(table)} {partition}").collect():
        out.setdefault(r["col_name"], r["data_type"])
    return out


@dataclass(frozen=True)
class Layout:
    """How a keyed table is laid out; all of it is told by the table itself."""

    keys: tuple[str, ...]
    part: str
    buckets: int

    @staticmethod
    def of(spark: SparkSession, table: str) -> Layout | None:
        part = _part_column(spark.table(table).columns)
        if part is None:
            return None
        said = _described(spark, table)
        return Layout(tuple(k.strip(" `") for k in said["Bucket Columns"].strip("[]").split(",")), part, int(said["Num Buckets"]))

    def save(self, df: DataFrame, table: str, fmt: str, location: str | None = None) -> None:
        """Write a table of this layout, a file per partition and bucket. Rows that come dealt by the key are not shuffled."""
        if self.part not in df.columns:
            parts = int(self.part.rsplit("_", 1)[1])
            df = df.withColumn(self.part, F.pmod(F.xxhash64(*self.keys), F.lit(parts)).cast("int")).repartition(self.buckets, *self.keys)
        writer = df.write.format(fmt).partitionBy(self.part).bucketBy(self.buckets, *self.keys).sortBy(*self.keys)
        (writer.option("path", location) if location else writer).saveAsTable(table)


def create_keyed(spark: SparkSession, table: str, df: DataFrame, keys: Sequence[str], parts: int = PARTS, buckets: int | None = None,
                 fmt: str = "parquet") -> None:
    """SNK-2: a catalog table bucketed by its key, inside ``parts`` partitions that are a hash of the key.

    ``buckets`` is by default ``spark.sql.shuffle.partitions``, which the session sizes for the data: a merge has as many tasks.
    """
    buckets = buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))
    Layout(tuple(keys), f"key_part_of_{parts}", buckets).save(df, table, fmt)


def read_table(spark: SparkSession, table: str) -> DataFrame:
    """A catalog table without the partition column of the keyed layout."""
    df = spark.table(table)
    return df.drop(_part_column(df.columns) or "")


def keyed_merge(target: DataFrame, inc: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Update all on match, insert all otherwise, for two tables of one keyed layout: one join, bucket by bucket.

    Columns missing in ``inc`` keep their value in matched rows and are NULL in new ones.
    """
    keys = list(keys)
    t, s = target.withColumn("_old", F.lit(True)).alias("t"), inc.withColumn("_new", F.lit(True)).alias("s")

    def pick(c: str) -> Column:
        if c in keys:
            return F.col(c)
        return (F.when(F.col("_new"), F.col(f"s.`{c}`")).otherwise(F.col(f"t.`{c}`")) if c in inc.columns else F.col(f"t.`{c}`")).alias(c)

    return t.join(s, keys, "full_outer").select(*[pick(c) for c in target.columns])


def _switch(spark: SparkSession, table: str, layout: Layout, folder: str, parts: Sequence[int]) -> None:
    """Point each partition at its new folder, one catalog operation each, and remove what it held before.

    Cut short, some partitions are new and some are old, and all are whole; the same upsert again finishes the rest.
    """
    have = {r[0] for r in spark.sql(f"SHOW PARTITIONS {_quoted(table)}").collect()}
    for p in parts:
        one, new = f"PARTITION ({layout.part}={p})", f"{folder}/{layout.part}={p}"
        if f"{layout.part}={p}" in have:
            fs, before = _fs(spark, _described(spark, table, one)["Location"])
            spark.sql(f"ALTER TABLE {_quoted(table)} {one} SET LOCATION '{new}'")
            if before.getName() == f"{layout.part}={p}":
                fs.delete(before, True)
        else:
            spark.sql(f"ALTER TABLE {_quoted(table)} ADD {one} LOCATION '{new}'")
    spark.catalog.refreshTable(table)


def drop_keyed(spark: SparkSession, table: str) -> None:
    """Drop a keyed table with the folders that merges put beside it."""
    parts = [r[0] for r in spark.sql(f"SHOW PARTITIONS {_quoted(table)}").collect()]
    folders = {_described(spark, table, f"PARTITION ({p})")["Location"].rsplit("/", 1)[0] for p in parts}
    root = _described(spark, table)["Location"].rstrip("/")
    spark.sql(f"DROP TABLE {_quoted(table)}")
    for folder in folders:
        if folder.startswith(f"{root}__"):
            fs, path = _fs(spark, folder)
            fs.delete(path, True)


def _upsert_keyed(spark: SparkSession, table: str, source: DataFrame, keys: list[str], fmt: str, check: bool, evolve: bool, layout: Layout) -> str:
    if list(layout.keys) != keys:
        raise ValueError(f"{table} is keyed by {list(layout.keys)}, not {keys}")
    part, inc_name, merged_name = layout.part, f"{table}__inc", f"{table}__merged"
    for leftover in (inc_name, merged_name):
        spark.sql(f"DROP TABLE IF EXISTS {_quoted(leftover)}")
    # The only shuffle: the increment, dealt to buckets as it is written. Its plan (a scoring UDF, above all) runs once.
    layout.save(source, inc_name, fmt, checkpoint_path(spark, f"increment-{uuid.uuid4().hex}"))
    inc = spark.table(inc_name)
    if check:
        check_keys(inc.drop(part), keys)
    target = spark.table(table)
    extra = [c for c in inc.columns if c not in target.columns]
    missing = [c for c in target.columns if c not in inc.columns]
    if (extra or missing) and not evolve:
        merge_result(target.drop(part), inc.drop(part), keys)  # raises and names the columns
    if extra:
        added = ", ".join(f"`{c}` {inc.schema[c].dataType.simpleString()}" for c in extra)
        spark.sql(f"ALTER TABLE {_quoted(table)} ADD COLUMNS ({added})")
        target = spark.table(table)
    touched = [r[0] for r in inc.select(part).distinct().collect()]  # as many numbers as there are partitions at most
    held = target.filter(F.col(part).isin(touched))
    if not missing and inc.select(*keys).join(held.select(*keys), keys, "left_semi").isEmpty():
        inc.select(*target.columns).write.insertInto(table)
        done = "appended"
    else:
        # Merged partitions stay in a folder of their own beside the table's.
        folder = f"{_described(spark, table)['Location'].rstrip('/')}__{uuid.uuid4().hex}"
        layout.save(keyed_merge(held, inc, keys).select(*target.columns), merged_name, fmt, folder)
        _switch(spark, table, layout, folder, touched)
        spark.sql(f"DROP TABLE {_quoted(merged_name)}")  # the files stay: this table only named them
        done = "merged"
    spark.sql(f"DROP TABLE {_quoted(inc_name)}")
    return done


ROW_LEVEL_FORMATS = frozenset(("delta", "iceberg"))


def _supports_merge(spark: SparkSession, table: str) -> bool:
    return _described(spark, table).get("Provider", "").lower() in ROW_LEVEL_FORMATS


def upsert(
    spark: SparkSession,
    target: str,
    source: DataFrame,
    keys: Sequence[str],
    fmt: str = "parquet",
    check: bool = True,
    evolve: bool = False,
    parts: int = PARTS,
    buckets: int | None = None,
) -> str:
    """SNK-2 / SNK-3 / SNK-4: create on first write, else idempotent keyed upsert.

    ``target`` is a catalog table name or a storage path (contains '/').
    Returns what was done: 'created', 'appended' (only new keys), 'merged' or 'swapped'.
    ``parts`` and ``buckets`` lay out a new catalog table (see :func:`create_keyed`). ``evolve`` allows the source to have
    more or fewer columns (see :func:`merge_result`); otherwise a difference raises.
    """
    keys = list(keys)
    if "/" in target:
        return _upsert_path(spark, target, source, keys, fmt, check, evolve)
    recover_table(spark, target)
    exists = table_exists(spark, target)
    layout = Layout.of(spark, target) if exists else None
    if layout:
        return _upsert_keyed(spark, target, source, keys, fmt, check, evolve, layout)
    # The increment is read several times (key check, merge): written once, so that upstream work (a
    # scoring UDF, above all) runs exactly once and survives executor loss.
    source = staged(source, "increment")
    if check:
        check_keys(source, keys)
    if not exists:
        if fmt in ROW_LEVEL_FORMATS:
            source.write.format(fmt).saveAsTable(target)
        else:
            create_keyed(spark, target, source, keys, parts, buckets, fmt)
        return "created"
    if _supports_merge(spark, target):
        cond = " AND ".join(f"t.{k} = s.{k}" for k in keys)
        (
            source.alias("s")
            .mergeInto(target, F.expr(cond))
            .whenMatched()
            .updateAll()
            .whenNotMatched()
            .insertAll()
            .merge()
        )
        return "merged"
    # A table of another layout: stage the merged result as its own table, move the
    # present one aside, move the staged one in, and only then drop the old one. A crash at any
    # point leaves a complete table that recover_table() puts back.
    new, old = f"{target}__staged", f"{target}__old"
    spark.sql(f"DROP TABLE IF EXISTS {new}")
    merge_result(spark.table(target), source, keys, evolve).write.format(fmt).saveAsTable(new)
    spark.sql(f"ALTER TABLE {target} RENAME TO {old}")
    spark.sql(f"ALTER TABLE {new} RENAME TO {target}")
    spark.sql(f"DROP TABLE {old}")
    return "swapped"


def recover_table(spark: SparkSession, target: str) -> None:
    """Undo a swap that a crash cut short: without ``target``, the table moved aside is put back; with it, that one is dropped."""
    old = f"{target}__old"
    if table_exists(spark, old):
        spark.sql(f"DROP TABLE {old}" if table_exists(spark, target) else f"ALTER TABLE {old} RENAME TO {target}")


def overwrite(df: DataFrame, target: str, fmt: str = "parquet", change_feed: bool = False) -> None:
    """SNK-7: snapshot overwrite with schema replacement; ``change_feed`` turns the change feed on where the format has one
    and warns where it has none (:func:`write_snapshot` and :func:`changes_between` give one for any).

    A path's new content is written beside it, so a derived snapshot may read what it replaces; a
    table name is replaced through ``saveAsTable`` (Spark refuses to overwrite a table that the job reads).
    """
    feeds = "/" not in target and fmt in ROW_LEVEL_FORMATS
    if change_feed and not feeds:
        warnings.warn(f"{target} has no change feed of its own; compare written snapshots instead", stacklevel=2)
    if "/" in target:
        _swap_path(df.sparkSession, df, target, fmt)
        return
    df.write.format(fmt).mode("overwrite").option("overwriteSchema", "true").saveAsTable(target)
    if change_feed and feeds:
        set_table_properties(df.sparkSession, target, {"delta.enableChangeDataFeed": "true"})


def snapshot_changes(old: DataFrame, new: DataFrame, keys: Sequence[str]) -> DataFrame:
    """SNK-8: row-level change feed between two snapshots: the keys, ``_old``, ``_new`` and ``change_type``.

    Full outer join on the key; ``change_type`` is insert / delete / update (any
    column differs, NULL-safe). Unchanged rows are dropped. NULL is a key value like others. A column that only
    one snapshot has counts as NULL in the other.
    """
    keys = list(keys)
    types = {f.name: f.dataType for s in (old, new) for f in s.schema if f.name not in keys}

    def side(df: DataFrame, name: str) -> DataFrame:
        cols = [(F.col(c) if c in df.columns else F.lit(None)).cast(t).alias(c) for c, t in types.items()]
        return df.select(*[F.col(k).alias(f"{name}_{k}") for k in keys], F.struct(F.lit(True).alias("_here"), *cols).alias(name))

    same = reduce(lambda a, k: a & F.col(f"_old_{k}").eqNullSafe(F.col(f"_new_{k}")), keys, F.lit(True))
    j = side(old, "_old").join(side(new, "_new"), same, "full_outer")
    change = (
        F.when(F.col("_old").isNull(), "insert")
        .when(F.col("_new").isNull(), "delete")
        .when(~F.col("_old").eqNullSafe(F.col("_new")), "update")
    )
    shown = [F.when(F.col(s).isNotNull(), F.struct(*[F.col(s)[c].alias(c) for c in types])).alias(s) for s in ("_old", "_new")] if types else ["_old", "_new"]
    key = [F.when(F.col("_new").isNull(), F.col(f"_old_{k}")).otherwise(F.col(f"_new_{k}")).alias(k) for k in keys]
    return j.withColumn("change_type", change).filter(F.col("change_type").isNotNull()).select(*key, *shown, "change_type")


# ---------------------------------------------------------------- snapshots with digests
SNAPSHOT_PARTS = 256


def write_snapshot(df: DataFrame, path: str, keys: Sequence[str], parts: int = SNAPSHOT_PARTS) -> None:
    """SNK-8: a snapshot, partitioned by a hash of the key, with a digest of each partition beside it (``<path>__digests``).

    A digest is the partition's number of rows and the sum of its rows' hashes: it does not depend on their order. The rows are
    written once; the digests are taken from what was written.
    """
    part = f"key_part_of_{parts}"
    dealt = df.withColumn(part, F.pmod(F.xxhash64(*keys), F.lit(parts)).cast("int"))
    dealt.repartition(F.col(part)).write.partitionBy(part).parquet(path)
    stored = df.sparkSession.read.schema(dealt.schema).parquet(path)
    digests(stored, part).coalesce(1).write.parquet(_beside(path, "digests"))  # a row per partition


def digests(df: DataFrame, part: str) -> DataFrame:
    """``(part, n, digest)``: rows and the sum of row hashes of each partition, over all columns by name."""
    cols = sorted(c for c in df.columns if c != part)
    return df.groupBy(F.col(part).alias("part")).agg(
        F.count(F.lit(1)).alias("n"), F.sum(F.xxhash64(F.lit(",".join(cols)), *cols).cast("decimal(20,0)")).alias("digest"))


def changes_between(spark: SparkSession, old_path: str, new_path: str, keys: Sequence[str]) -> DataFrame:
    """SNK-8: :func:`snapshot_changes` of two written snapshots, reading only partitions whose digests differ.

    Equal partitions with equal sums of 64-bit hashes count as equal. Snapshots of another number of partitions, or with other columns, are
    compared whole.
    """
    old, new = spark.read.parquet(old_path), spark.read.parquet(new_path)
    part, other = _part_column(old.columns), _part_column(new.columns)
    if part == other:
        a, b = (spark.read.parquet(_beside(p, "digests")) for p in (old_path, new_path))
        equal = a.join(b, ["part", "n", "digest"]).select("part")
        # As many numbers as there are partitions at most, so that both scans are pruned before they start.
        differ = [r[0] for r in a.select("part").union(b.select("part")).distinct().join(equal, "part", "left_anti").collect()]
        old, new = (df.filter(F.col(part).isin(differ)) for df in (old, new))
    return snapshot_changes(old.drop(part), new.drop(other), keys)


def set_table_properties(spark: SparkSession, table: str, props: dict[str, str]) -> None:
    """SNK-6: idempotent table tags; single quotes in values are doubled."""
    def q(s: str) -> str:
        return "'" + str(s).replace("'", "''") + "'"

    clause = ", ".join(f"{q(k)} = {q(v)}" for k, v in props.items())
    spark.sql(f"ALTER TABLE {table} SET TBLPROPERTIES ({clause})")


def create_feature_table(
    spark: SparkSession, name: str, df: DataFrame, primary_key: str, description: str, fmt: str = "parquet"
) -> None:
    """SNK-5: unique non-null key check, create, description and primary-key property."""
    check_keys(df, [primary_key])
    df.write.format(fmt).saveAsTable(name)
    spark.sql(f"COMMENT ON TABLE {name} IS '" + description.replace("'", "''") + "'")
    set_table_properties(spark, name, {"primary_key": primary_key})


def write_manifest(df: DataFrame, path: str) -> None:
    """SNK-9: manifest as Parquet and as CSV with a header."""
    df.write.mode("overwrite").parquet(f"{path.rstrip('/')}/manifest.parquet")
    df.write.mode("overwrite").option("header", True).csv(f"{path.rstrip('/')}/manifest.csv")

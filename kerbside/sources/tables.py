"""Layer tables: date-partitioned Parquet with append, create, replace and upsert.

Writes are Spark's own: appends, static overwrites of one date's folder and dynamic overwrites of the partitions that
hold rows. A write that replaces rows is staged in the shared folder first, so it never reads what it overwrites and a
failure up to then changes nothing. The overwrite itself is not atomic: until it ends, readers may miss rows of the
partitions it replaces, and one stopped half-way is repeated by its caller. Silver and gold are rebuilt
from bronze, which only grows, so a repeated trigger or backfill ends in the full table. One writer per table at a time.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field
from functools import reduce
from operator import and_, or_

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from kerbside.operators.filters import on_partitions_of
from kerbside.operators.windows import keep_first
from kerbside.session import pin, written

# --- fixed values: the folder that Spark's writers give a null partition value ---
NULL_PARTITION = "__HIVE_DEFAULT_PARTITION__"
# Rows up to which a folder's part of them is small enough for one task, whatever share of them it holds.
FEW_ROWS = 1_000_000
# --- end of fixed values ---


@dataclass(frozen=True)
class Layer:
    """A table's folder, its row key, the columns that partition it and, if fixed, its schema.

    With a schema, reads open no file footers to merge columns; a file from before a column
    was added yields nulls for it.
    """

    path: str
    keys: Sequence[str]
    partition_by: Sequence[str] = field(default=("date",))
    schema: T.StructType | None = None

    @property
    def changes(self) -> str:
        """Folder of changed keys, appended after each write, that the next layer streams."""
        return f"{self.path}.changes"


def exists(spark: SparkSession, layer: Layer) -> bool:
    """Whether the table was ever written to."""
    try:
        spark.read.schema("date date").parquet(layer.path)
    except AnalysisException as missing:
        if missing.getCondition() != "PATH_NOT_FOUND":
            raise
        return False
    return True


def read_layer(spark: SparkSession, layer: Layer, columns: Sequence[str] | None = None) -> DataFrame:
    """The table, or the named columns of it. Without a fixed schema, columns of differing
    files are merged by name."""
    reader = spark.read.option("mergeSchema", "true") if layer.schema is None else spark.read.schema(layer.schema)
    df = reader.parquet(layer.path)
    return df.select(*columns) if columns else df


def read_layer_stream(
    spark: SparkSession, layer: Layer, schema: T.StructType, max_files: int = 200, archive: str | None = None
) -> DataFrame:
    """Keys changed in a layer, as a stream.

    With ``archive``, files that a trigger has done with move there, so that the next trigger's
    listing stays short. Only one reader of a layer's changes may archive them.
    """
    reader = spark.readStream.schema(schema).option("maxFilesPerTrigger", str(max_files))
    if archive:
        reader = reader.option("cleanSource", "archive").option("sourceArchiveDir", archive)
    return reader.parquet(layer.changes)


def publish_changes(keys: DataFrame, layer: Layer) -> None:
    """Append changed keys; repeating an append is harmless, as readers recompute by key."""
    keys.distinct().write.mode("append").parquet(layer.changes)


def scan_union(spark: SparkSession, paths: Sequence[str]) -> DataFrame:
    """Files of several paths with their columns united by name."""
    return spark.read.option("mergeSchema", "true").parquet(*paths)


def scan_union_mixed(spark: SparkSession, paths: Sequence[str]) -> DataFrame:
    """As ``scan_union`` for paths whose column types differ: a differing column is read as text."""
    frames = [spark.read.parquet(p) for p in paths]
    kinds: dict[str, set[str]] = {}
    for frame in frames:
        for name, kind in frame.dtypes:
            kinds.setdefault(name, set()).add(kind)
    mixed = [name for name, found in kinds.items() if len(found) > 1]
    union = None
    for frame in frames:
        here = frame.withColumns({c: F.col(c).cast("string") for c in mixed if c in frame.columns})
        union = here if union is None else union.unionByName(here, allowMissingColumns=True)
    return union


def _by_partition(df: DataFrame, layer: Layer, few: bool = False) -> DataFrame:
    """Few files per partition: rows are shuffled to their partition. AQE's rebalance splits a
    partition that is too large for one task, so a hot date is written by many.

    It also merges small partitions into one task, which then writes their files one after another. ``few`` rows are
    dealt over tasks of a fixed number instead.
    """
    if few:
        return df.repartition(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), *layer.partition_by)
    return df.hint("rebalance", *[F.col(c) for c in layer.partition_by])


def _overwrite_partitions(rows: DataFrame, layer: Layer, few: bool = False) -> None:
    """Replace the partitions that hold rows; all others stay."""
    writer = _by_partition(rows, layer, few).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
    writer.partitionBy(*layer.partition_by).parquet(layer.path)


def _folder(layer: Layer, values: Sequence) -> str:
    parts = [f"{c}={NULL_PARTITION if v is None else v}" for c, v in zip(layer.partition_by, values)]
    return "/".join([layer.path, *parts])


def _empty_partitions(rows: DataFrame, layer: Layer, parts: DataFrame) -> None:
    """Leave each of ``parts`` without rows. A dynamic overwrite does not reach them; they are
    few, as a rebuilt group rarely was all of its partition."""
    blank = rows.drop(*layer.partition_by).limit(0)
    for part in parts.toLocalIterator():
        blank.write.mode("overwrite").option("partitionOverwriteMode", "static").parquet(_folder(layer, part))


def append(df: DataFrame, layer: Layer, few: bool = False) -> None:
    _by_partition(df, layer, few).write.mode("append").partitionBy(*layer.partition_by).parquet(layer.path)


def append_batch(rows: DataFrame, batch_id: int, layer: Layer) -> None:
    """Append a numbered batch under its own ``_batch`` partition: running it again replaces
    what it wrote before and nothing else."""
    _overwrite_partitions(rows.withColumn("_batch", F.lit(batch_id).cast("bigint")), layer)


def create(df: DataFrame, layer: Layer) -> None:
    """First write of a table; an error when it exists."""
    _by_partition(df, layer).write.mode("errorifexists").partitionBy(*layer.partition_by).parquet(layer.path)


def replace_date(df: DataFrame, layer: Layer, day: str) -> None:
    """Replace one date's rows by ``df``; all other dates stay.

    A row of another date fails the write before the table changes, and no rows at all is an
    error. The date's folder is overwritten as a whole, so its finer partitions without new rows go too.
    """
    outside = F.raise_error(F.lit(f"row outside {day}")).cast("boolean")
    inside = F.coalesce(F.col("date") == F.lit(day).cast("date"), F.lit(False))
    staged = pin(df.filter(F.when(inside, F.lit(True)).otherwise(outside)))
    if staged.isEmpty():
        raise ValueError(f"no rows to replace {day} with")
    finer = list(layer.partition_by[1:])
    rows = _by_partition(staged, layer).drop("date")
    writer = rows.write.mode("overwrite").option("partitionOverwriteMode", "static")
    (writer.partitionBy(*finer) if finer else writer).parquet(_folder(layer, [day]))


def upsert(
    df: DataFrame,
    layer: Layer,
    order: Sequence[Column] | None = None,
    groups: DataFrame | None = None,
    pinned: bool = False,
) -> None:
    """Update rows whose key exists, insert the others.

    Only partitions that receive rows are read and rewritten. The source must be unique on the key:
    with ``order`` the first row per key wins, without it a repeated key is an error. A null
    key equals nothing, so such rows are all inserted. New columns are added; rows from before
    hold nulls there. A key keeps its partition: ``partition_by`` must derive from the key.

    With ``groups``, rows of the table that agree with one of its rows go first, whatever their
    key, so a group that is rebuilt as a whole also loses the rows it no longer has. ``groups`` holds the
    partition columns. A ``pinned`` source is cheap to count, so few rows in many folders are written by many tasks.
    """
    spark = df.sparkSession
    parts = list(layer.partition_by)
    if order is None:
        _assert_unique(df, layer.keys)
        source = df
    else:
        source = keep_first(df, layer.keys, order, whole_keys=True)
    if not exists(spark, layer):
        append(source, layer, pinned and source.count() <= FEW_ROWS)
        return
    touched = source.select(*parts)
    if groups is not None:
        touched = touched.unionByName(groups.select(*parts))
    touched = written(touched.distinct(), "touched")
    stored = read_layer(spark, layer)
    kept = on_partitions_of(stored, touched, parts)
    broken = touched.filter(reduce(or_, [F.col(c).isNull() for c in parts]))
    if not broken.isEmpty():
        same = reduce(and_, [stored[c].eqNullSafe(broken[c]) for c in parts])
        kept = kept.unionByName(stored.join(broken, same, "left_semi"))
    kept = kept.join(source.select(*layer.keys), list(layer.keys), "left_anti")
    if groups is not None:
        kept = kept.join(groups, groups.columns, "left_anti")
    staged = pin(kept.unionByName(source, allowMissingColumns=True))
    _overwrite_partitions(staged, layer, pinned and staged.count() <= FEW_ROWS)
    if groups is not None:
        filled = staged.select(*parts).distinct()
        same = reduce(and_, [F.col(f"t.{c}").eqNullSafe(F.col(f"f.{c}")) for c in parts])
        _empty_partitions(staged, layer, touched.alias("t").join(filled.alias("f"), same, "left_anti"))


def _assert_unique(df: DataFrame, keys: Sequence[str]) -> None:
    whole = df.dropna(subset=list(keys))
    repeated = whole.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n")).filter("_n > 1").limit(1)
    if not repeated.isEmpty():
        raise ValueError(f"the source repeats a key of {list(keys)}")


def _files(spark: SparkSession, layer: Layer) -> DataFrame:
    """The table's files with their partition values, from the folder's listing: no file is opened."""
    return spark.read.format("binaryFile").option("pathGlobFilter", "*.parquet").load(layer.path).drop("content")


def layer_dates(spark: SparkSession, layer: Layer) -> DataFrame:
    """Dates of a layer that hold files, in order."""
    return _files(spark, layer).select("date").distinct().orderBy("date")


def with_file(df: DataFrame, name: str = "_file") -> DataFrame:
    """Path of the file each row comes from; apply right after the read."""
    return df.select("*", F.col("_metadata.file_path").alias(name))


def files_per_date(spark: SparkSession, layer: Layer) -> DataFrame:
    """Files of each date, by date and path."""
    return _files(spark, layer).select("date", "path").orderBy("date", "path")


def compact(spark: SparkSession, layer: Layer, days: Sequence[str]) -> None:
    """Rewrite the named dates into few files each."""
    _overwrite_partitions(pin(read_layer(spark, layer).filter(F.col("date").isin([*days]))), layer)


def latest_envelope(spark: SparkSession, layer: Layer) -> DataFrame:
    """One row about a layer's newest date: ``target_date``, its files, columns and rows.

    The date and the files come from the folder's listing, so a date whose files hold no rows counts. A layer
    without files gives a null date, no columns and zeros.
    """
    if not exists(spark, layer):
        return spark.createDataFrame([(None, 0, [], 0)], "target_date date, object_count long, columns array<string>, row_count long")
    files = _files(spark, layer)
    newest = files.agg(F.max("date").alias("newest")).scalar()
    rows = read_layer(spark, layer).filter(F.col("date") == newest)
    names = F.array(*[F.lit(c) for c in rows.columns]).cast("array<string>")
    listed = files.groupBy().agg(F.max("date").alias("target_date"), F.count_if(F.col("date") == newest).alias("object_count"))
    counted = rows.agg(F.count(F.lit(1)).alias("row_count")).scalar()
    return listed.select(
        "target_date", "object_count", F.when(F.col("target_date").isNotNull(), names).otherwise(F.array().cast("array<string>")).alias("columns"),
        F.coalesce(counted, F.lit(0)).alias("row_count"))

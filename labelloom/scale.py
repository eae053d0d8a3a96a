"""Building blocks that keep a plan whole when one key holds a large share of the rows."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as ST
from pyspark.sql.pandas.types import to_arrow_schema

# A side of a join is broadcast only when its counted rows and bytes stay within these bounds.
BROADCAST_ROWS = 200_000
BROADCAST_BYTES = 64 << 20
# A key is hot when it holds at least 1/HOT_KEYS of the rows; there can be no more such keys.
HOT_KEYS = 1_000
# Smaller groups than this are no burden for a task, whatever their share.
HOT_ROWS = 10_000
SALTS = 64

# Where an unset ``spark.checkpoint.dir`` points in a session on one machine, as in tests.
LOCAL_SHARED = "/tmp/checkpoints"


def shared_folder(spark: SparkSession) -> str:
    """The folder for written intermediate tables, as named by ``spark.checkpoint.dir``.

    Only a session whose driver and executors are one process may leave it unset.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if root:
        return root.rstrip("/")
    master = spark.conf.get("spark.master", "")
    if master != "local" and not master.startswith("local["):
        raise ValueError("spark.checkpoint.dir must name a folder that every executor can reach")
    spark.conf.set("spark.checkpoint.dir", LOCAL_SHARED)
    return LOCAL_SHARED


def stage(df: DataFrame, name: str = "table", options: dict | None = None) -> DataFrame:
    """Write ``df`` once to the shared folder and read it back.

    Cuts the lineage at a table that outlives lost executors, and lets later passes prune
    columns instead of repeating the work. ``options`` are the writer's.
    """
    spark = df.sparkSession
    path = f"{shared_folder(spark)}/labelloom/{name}-{uuid.uuid4().hex}"
    df.write.options(**{"compression": "zstd", **(options or {})}).parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def spread(source: DataFrame, key: str) -> DataFrame:
    """Spread a freshly read table over the cores when its files give fewer splits than cores.

    Large inputs have more splits than that and are left as they are.
    """
    cores = source.sparkSession.sparkContext.defaultParallelism
    return source if source.rdd.getNumPartitions() >= cores else source.repartition(cores, key)


def _width(field: ST.StructField) -> Column:
    if isinstance(field.dataType, (ST.StringType, ST.BinaryType)):
        return F.coalesce(F.octet_length(field.name), F.lit(0))
    if isinstance(field.dataType, (ST.ArrayType, ST.MapType, ST.StructType)):
        return F.coalesce(F.length(F.to_json(F.struct(field.name))), F.lit(0))
    return F.lit(8)


def fits(df: DataFrame, max_rows: int | None = None, max_bytes: int | None = None) -> bool:
    """True when a stored table is counted small enough to broadcast, in rows and in bytes.

    Rows are counted first (for columnar files from their footers); bytes only when these are few.
    """
    if df.count() > (BROADCAST_ROWS if max_rows is None else max_rows):
        return False
    width = sum((_width(f) for f in df.schema.fields), F.lit(0))
    size = df.agg(F.sum(width)).first()[0] or 0
    return size <= (BROADCAST_BYTES if max_bytes is None else max_bytes)


def hot_keys(df: DataFrame, on: Sequence[str], share: int = HOT_KEYS) -> DataFrame:
    """The keys that hold at least ``1 / share`` of the rows each, hence at most ``share`` keys."""
    counts = df.groupBy(*on).agg(F.count(F.lit(1)).alias("_rows"))
    limit = counts.agg(F.sum("_rows") / share).scalar()
    return counts.filter((F.col("_rows") >= HOT_ROWS) & (F.col("_rows") >= limit)).select(*on)


def skew_join(left: DataFrame, right: DataFrame, on: Sequence[str], how: str = "inner",
              hot: DataFrame | None = None, salts: int = SALTS) -> DataFrame:
    """Equi-join that spreads the hot keys of ``left`` over ``salts`` tasks each.

    Rows of ``right`` are repeated for hot keys only. ``left`` is read twice, so it should be a
    scan or a stored table. ``how`` is ``inner``, ``left``,
    ``left_semi`` or ``left_anti``: each left row meets every right row of its key exactly once.
    """
    on = list(on)
    hot = F.broadcast((hot if hot is not None else hot_keys(left, on)).select(*on)
                      .withColumn("_hot", F.lit(True)))
    spread = F.col("_hot")
    for key in on:
        spread = spread | F.col(key).isNull()
    # The salt depends on the row alone, so a task that is run again salts as before.
    rest = [f.name for f in left.schema.fields if f.name not in on
            and isinstance(f.dataType, (ST.AtomicType, ST.ArrayType))] or on
    salt = F.when(spread, F.pmod(F.xxhash64(*rest), F.lit(salts)).cast("int"))
    left = left.join(hot, on, "left").withColumn("_salt", F.coalesce(salt, F.lit(0))).drop("_hot")
    copies = F.when(F.col("_hot"), F.sequence(F.lit(0), F.lit(salts - 1)))
    right = (right.join(hot, on, "left")
             .withColumn("_salt", F.explode(F.coalesce(copies, F.array(F.lit(0))))).drop("_hot"))
    return left.join(right, [*on, "_salt"], how).drop("_salt")


def attach(big: DataFrame, small: DataFrame, on: Sequence[str], how: str = "left",
           max_rows: int | None = None) -> DataFrame:
    """Join a side that is expected to be small: broadcast when counted small, salted otherwise."""
    if fits(small, max_rows):
        return big.join(F.broadcast(small), list(on), how)
    return skew_join(big, small, on, how)


def local_table(spark: SparkSession, columns: dict[str, Sequence], schema: str) -> DataFrame:
    """A small table held in the plan itself."""
    return spark.createDataFrame(pa.table(dict(columns)), schema)


def pin(df: DataFrame, max_rows: int = 10_000) -> DataFrame:
    """Fix a small computed table: held in the plan when counted small, else written out."""
    rows = df.take(max_rows + 1)
    if len(rows) > max_rows:
        return stage(df, "pinned")
    table = pa.Table.from_pylist([r.asDict(recursive=True) for r in rows],
                                 schema=to_arrow_schema(df.schema))
    return df.sparkSession.createDataFrame(table, df.schema)


def running_totals(df: DataFrame, order: Sequence[Column | str], sums: Sequence[str],
                   parts: int | None = None) -> DataFrame:
    """Add ``running_<c>`` for each column of ``sums``: totals over the whole table in ``order``.

    The order must identify a row (pre-aggregate ties). The table is cut into ranges, written
    once so that the cut is fixed, and each range adds the total of the ranges before it. No task
    sees more than one range, and only one row per range is broadcast.
    """
    parts = parts or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    cut = stage(df.repartitionByRange(parts, *order)
                .withColumn("_part", F.spark_partition_id()), "ranges")
    totals = cut.groupBy("_part").agg(*[F.sum(c).alias(f"_total_{c}") for c in sums])
    earlier = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select("_part", *[F.coalesce(F.sum(f"_total_{c}").over(earlier), F.lit(0))
                                       .alias(f"_before_{c}") for c in sums])
    within = (Window.partitionBy("_part").orderBy(*order)
              .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    out = cut.join(F.broadcast(offsets), "_part")
    for c in sums:
        out = out.withColumn(f"running_{c}", F.col(f"_before_{c}") + F.sum(c).over(within))
    return out.drop("_part", *[f"_before_{c}" for c in sums])


def row_numbers(df: DataFrame, order: Sequence[Column], name: str = "rank", parts: int | None = None) -> DataFrame:
    """Add ``name``: the place (from 1) of a row in the whole table in ``order``, which must identify a row.

    The table is cut into sorted ranges and written once with the place inside the range; the sizes of the ranges
    before it, one row per range, are added. No row moves a second time.
    """
    parts = parts or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    cut = stage(df.repartitionByRange(parts, *order).sortWithinPartitions(*order)
                .withColumn("_at", F.monotonically_increasing_id()), "ranges")
    # The id holds the number of the partition above 33 bits of the row's place in it.
    part, place = F.shiftright("_at", 33), F.col("_at").bitwiseAND(F.lit((1 << 33) - 1))
    sizes = cut.groupBy(part.alias("_part")).agg(F.count(F.lit(1)).alias("_size"))
    earlier = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select("_part", F.coalesce(F.sum("_size").over(earlier), F.lit(0)).alias("_before"))
    return (cut.withColumn("_part", part).join(F.broadcast(offsets), "_part")
            .withColumn(name, F.col("_before") + place + 1).drop("_part", "_at", "_before"))


def order_cutoffs(keys: DataFrame, group: str, order: Sequence[str], bucket: Column,
                  ranks: Callable[[Column], Column]) -> DataFrame:
    """For each group, the ``order`` values found at exact ranks: ``(group, rank_no, cut)``.

    ``bucket`` must be monotone in ``order``; ``ranks`` maps the group size to an array of ranks.
    A histogram of buckets locates each rank, and only the buckets that hold one are ordered, so
    a group with most of the rows is never sorted in one task.
    """
    placed = keys.withColumn("_b", bucket)
    hist = placed.groupBy(group, "_b").agg(F.count(F.lit(1)).alias("_n"))
    by_bucket = Window.partitionBy(group).orderBy("_b")
    seen = (hist.withColumn("_upto", F.sum("_n").over(by_bucket))
            .withColumn("_size", F.sum("_n").over(Window.partitionBy(group))))
    numbered = F.transform(ranks(F.col("_size")), lambda r, i: F.struct(
        i.alias("rank_no"), r.cast("bigint").alias("_rank")))
    wanted = pin(seen.select(
        group, "_b", (F.col("_upto") - F.col("_n")).alias("_before"),
        F.inline(F.filter(numbered, lambda r: (r["_rank"] > F.col("_upto") - F.col("_n"))
                          & (r["_rank"] <= F.col("_upto"))))), 100_000)
    near = attach(placed, wanted.select(group, "_b").distinct(), [group, "_b"], "left_semi")
    near = near.groupBy(group, "_b", *order).agg(F.count(F.lit(1)).alias("_n"))
    ordered = near.withColumn("_at", F.sum("_n").over(
        Window.partitionBy(group, "_b").orderBy(*order)))
    return (attach(ordered, wanted, [group, "_b"], "inner")
            .filter(F.col("_before") + F.col("_at") >= F.col("_rank"))
            .groupBy(group, "rank_no").agg(F.min(F.struct(*order)).alias("cut")))

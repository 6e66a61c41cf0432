"""Shared pieces of the training-data operators: shared-folder tables, text access, numbering, joins over skewed keys."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F


def shared_folder(spark: SparkSession) -> str:
    """The folder all executors share: ``spark.checkpoint.dir``, or the checkpoint folder that was set.

    Where neither is named, a single-process session (``local[...]``, as in tests) gets a temporary
    folder; on a cluster that is an error, as its machines don't share temporary folders.
    """
    named = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if named is None:
        master = spark.sparkContext.master
        if master.startswith("local-cluster") or not master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="linkweave-"))
        named = spark.sparkContext.getCheckpointDir()
    return named


def written(df: DataFrame) -> DataFrame:
    """``df`` written once as Parquet to the shared folder and read again.

    This cuts lineage: a lost executor costs a reread, never a recomputation of what is above.
    """
    spark = df.sparkSession
    path = f"{shared_folder(spark)}/linkweave-{uuid.uuid4().hex}"
    df.write.parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out.written_to = path
    return out


def forget(*tables: DataFrame | None) -> None:
    """Deletes tables made by ``written`` that nothing reads any more."""
    for table in tables:
        path = getattr(table, "written_to", None)
        if path:
            spark = table.sparkSession
            place = spark._jvm.org.apache.hadoop.fs.Path(path)
            place.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()).delete(place, True)


def text_key(text: Column) -> Column:
    """128-bit identity of a text as hex; null and empty text share one key."""
    return F.md5(F.coalesce(text, F.lit("")).cast("binary"))


def utf8(batch, name: str) -> list[bytes]:
    """The texts of an Arrow batch as UTF-8 bytes; null gives empty bytes."""
    import pyarrow as pa

    column = batch.column(batch.schema.get_field_index(name))
    kind = pa.large_binary() if pa.types.is_large_string(column.type) else pa.binary()
    return [b or b"" for b in column.cast(kind).to_pylist()]


def buckets(spark: SparkSession, floor: int = 16) -> int:
    """Number of hash buckets used to split a hot group: follows the shuffle width, which follows the input."""
    return max(floor, int(spark.conf.get("spark.sql.shuffle.partitions")))


def skewed_join(many: DataFrame, one: DataFrame, key: str, how: str = "inner") -> DataFrame:
    """``many`` joined to ``one`` on ``key`` though a key may hold any part of the rows of ``many``.

    Both sides must be reads or narrow steps over reads (see ``written``): each is then one exchange of its own, and
    adaptive execution splits a partition that one key has blown up, repeating its few rows of ``one``. An aggregate
    by the key in the same stage would forbid that. Nothing is broadcast.
    """
    return many.join(one.hint("merge"), key, how)


def numbered(
    df: DataFrame, group: Sequence[str], order: Sequence[str], name: str, spread: Column, n: int, ranges: Column | None = None
) -> DataFrame:
    """Gapless 0-based number of each row in its ``group``, without bringing a whole group into one task.

    Rows are dealt by (group, bucket of ``spread``); bucket counts are summed up over the buckets of a
    group (at most ``n`` rows a group) and shift the numbers inside each bucket. With ``ranges``, its values are the
    buckets, so that numbers follow (ranges, order) through the whole group. Null group values form a group of their own.
    """
    dealt = df.withColumn("_b", F.pmod(F.xxhash64(spread), F.lit(n)).cast("int") if ranges is None else ranges)
    counts = dealt.groupBy(*group, "_b").agg(F.count(F.lit(1)).alias("_n"))
    ahead = Window.partitionBy(*group).orderBy("_b").rowsBetween(Window.unboundedPreceding, -1)
    starts = counts.select(
        *[F.col(g).alias(f"_g{i}") for i, g in enumerate(group)],
        F.col("_b").alias("_gb"),
        F.coalesce(F.sum("_n").over(ahead), F.lit(0)).alias("_start"),
    )
    inside = Window.partitionBy(*group, "_b").orderBy(*order)
    ranked = dealt.withColumn("_r", F.row_number().over(inside) - 1)
    same = F.col("_b") == F.col("_gb")
    for i, g in enumerate(group):
        same = same & F.col(g).eqNullSafe(F.col(f"_g{i}"))
    return (
        ranked.join(starts, same)
        .withColumn(name, (F.col("_start") + F.col("_r")).cast("long"))
        .drop("_b", "_gb", "_start", "_r", *[f"_g{i}" for i in range(len(group))])
    )

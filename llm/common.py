"""Helpers the operators of this package share."""

from __future__ import annotations

import os
import tempfile
import uuid
import zipfile

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from farezone.session import ensure_checkpoint_dir


_ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
_SHIPPED: set[str] = set()


def ship_code(spark: SparkSession) -> None:
    """Send this package to the executors' Python workers (``addPyFile``), once an application."""
    sc = spark.sparkContext
    if sc.applicationId in _SHIPPED:
        return
    path = os.path.join(tempfile.mkdtemp(prefix="llm-code-"), "llm_code.zip")  # read by the driver alone
    with zipfile.ZipFile(path, "w") as z:
        for package in ("llm", "farezone"):
            for folder, _, names in os.walk(os.path.join(_ROOT, package)):
                for name in sorted(names):
                    if name.endswith(".py"):
                        full = os.path.join(folder, name)
                        z.write(full, os.path.relpath(full, _ROOT))
    sc.addPyFile(path)
    _SHIPPED.add(sc.applicationId)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def materialize(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` to the shared folder (``spark.checkpoint.dir``) and read it back.

    Cuts lineage, fixes the rows for everything built on them, and survives lost
    executors, since the files are on shared storage.
    """
    spark = df.sparkSession
    path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/llm/{label}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def text_or_empty(col: str = "text") -> Column:
    return F.coalesce(F.col(col), F.lit(""))


def let(value: Column, body) -> Column:
    """Bind ``value`` once inside an expression: ``body`` gets it as a lambda variable."""
    return F.transform(F.array(value), body).getItem(0)


def ordered(df: DataFrame, order: list, sums: tuple = (), label: str = "ordered") -> DataFrame:
    """Global order of the (narrow) rows of ``df`` without a single-task sort.

    Rows are range-partitioned and sorted; per-partition totals, one row for each
    partition, give every partition its offset. Adds ``_row`` (from 0) and, for each
    column ``c`` in ``sums``, ``_before_c`` (sum over all earlier rows) and ``_all_c``
    (sum over all rows). Rows that tie in ``order`` are in any, but fixed, order.
    """
    t = materialize(
        df.repartitionByRange(*order).sortWithinPartitions(*order)
        .withColumn("_part", F.spark_partition_id())
        .withColumn("_seq", F.monotonically_increasing_id()), label)
    totals = t.groupBy("_part").agg(F.count(F.lit(1)).alias("_n"),
                                    *[F.sum(c).alias(f"_t_{c}") for c in sums])
    earlier = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    everything = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    zero = F.lit(0)
    offsets = totals.select(
        "_part", F.coalesce(F.sum("_n").over(earlier), zero).alias("_o_row"),
        *[F.coalesce(F.sum(f"_t_{c}").over(earlier), zero).alias(f"_o_{c}") for c in sums],
        *[F.sum(f"_t_{c}").over(everything).alias(f"_all_{c}") for c in sums])
    inside = Window.partitionBy("_part").orderBy("_seq")
    before = inside.rowsBetween(Window.unboundedPreceding, -1)
    t = t.select("*", (F.row_number().over(inside) - 1).alias("_i"),
                 *[F.coalesce(F.sum(c).over(before), zero).alias(f"_b_{c}") for c in sums])
    # offsets has one row for each shuffle partition: bounded by the partition count
    t = t.join(F.broadcast(offsets), "_part")
    return t.select(*df.columns, (F.col("_i") + F.col("_o_row")).alias("_row"),
                    *[(F.col(f"_b_{c}") + F.col(f"_o_{c}")).alias(f"_before_{c}") for c in sums],
                    *[F.col(f"_all_{c}") for c in sums])

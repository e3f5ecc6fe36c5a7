"""Sinks (S7-S10): interim tables, published CSV/Parquet, idempotent mart extension.

What is published changes in one step, after everything is written (:mod:`farezone.sources.published`).

Interim tables go to the shared folder named by ``spark.checkpoint.dir`` (never a
machine-local temp folder), so a lost executor or a restarted job re-reads them
instead of recomputing the lineage.
"""

from __future__ import annotations

import uuid
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from farezone.sources.published import NULL_FOLDER, Publication, published_folder


def shared_dir(spark: SparkSession) -> str:
    """The cluster's shared checkpoint folder (``spark.checkpoint.dir``); set a
    scratch one only where the session has none (local runs and tests)."""
    from farezone.session import ensure_checkpoint_dir

    return ensure_checkpoint_dir(spark).rstrip("/")


_SCOPE: ContextVar = ContextVar("interim_scope", default=None)


@contextmanager
def interim_scope(spark: SparkSession):
    """Interim tables written inside are deleted at the end, if it succeeds (after a failure they
    are left to look at): for jobs that write all they return before they leave the scope."""
    paths: list[str] = []
    token = _SCOPE.set(paths)
    try:
        yield
    finally:
        _SCOPE.reset(token)
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    for p in paths:
        path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(p)
        path.getFileSystem(conf).delete(path, True)


def write_interim(df: DataFrame, name: str, path: str | None = None, partition_by: tuple = ()) -> DataFrame:
    """Write ``df`` as Parquet (the cache of interim results) and read it back.

    The returned DataFrame has no lineage beyond the written files. ``path``
    defaults to a fresh folder under the shared checkpoint directory. ``partition_by``
    names the last columns of ``df``, by which readers can pass over whole folders.
    """
    spark = df.sparkSession
    out = path or f"{shared_dir(spark)}/interim/{name}-{uuid.uuid4().hex}"
    if path is None and _SCOPE.get() is not None:
        _SCOPE.get().append(out)
    df.write.mode("overwrite").partitionBy(*partition_by).parquet(out)
    return spark.read.schema(df.schema).parquet(out)


def write_csv(df: DataFrame, path: str, order_by: list | None = None) -> str:
    """Publish a tidy table as CSV with a header and no index column; the folder of its files.

    The table that was in ``path`` stays whole until this one is (see :mod:`farezone.sources.published`)."""
    if order_by:
        df = df.orderBy(*order_by)
    with Publication(df.sparkSession, path) as publication:
        publication.write("", df, fmt="csv")
    return published_folder(df.sparkSession, path)


def months_before(since, col: str = "year_month"):
    """What an incremental publication keeps: the partitions of months before ``since``."""
    return lambda values: values[col] != NULL_FOLDER and values[col] < since.isoformat()


def publish(df: DataFrame, path: str, partition_by, fmt: str = "parquet", sort_within=None,
            since=None, published: DataFrame | None = None, col: str = "year_month", spread: int | None = None) -> None:
    """Replace a published table so that no partition of an earlier run stays behind.

    A full run replaces the table. With ``since``, the published months before it are kept (S10)
    where they are, and all months from it on are those of ``df``, also if there are fewer than
    before. ``published`` gives them as rows instead, for a table that isn't published in versions yet.
    A failure at any point leaves the table as it was. ``spread`` lets a partition be several files."""
    with Publication(df.sparkSession, path) as publication:
        stage(publication, "", df, partition_by, fmt, sort_within, since, published, col, spread)


def stage(publication: Publication, name: str, df: DataFrame, partition_by, fmt: str = "parquet", sort_within=None,
          since=None, published: DataFrame | None = None, col: str = "year_month", spread: int | None = None) -> None:
    """:func:`publish` as one table of a publication."""
    keep = None
    if since is not None:
        df = df.filter(F.col(col) >= F.lit(since)) if published is None else splice_history(published, df, since, col)
        keep = months_before(since, col) if published is None else None
    publication.write(name, df, partition_by, fmt, sort_within, keep, spread)


def extend_mart(df: DataFrame, mart_path: str, partition_by=("metric", "year_month"),
                fmt: str = "parquet", sort_within=("id", "company", "Z")) -> None:
    """Add or replace the metrics (and months) in ``df`` inside the published mart.

    The mart is partitioned by ``metric`` and ``year_month``; only the partitions
    present in ``df`` are replaced, so running the extension twice gives the same
    table (the reference re-read and rewrote one CSV, appending the metrics again
    on every run), and an incremental run replaces only its months. The others are kept without
    being rewritten, and a failure leaves all as they were.
    """
    with Publication(df.sparkSession, mart_path) as publication:
        publication.write("", df, partition_by, fmt, sort_within, keep=lambda values: True)


def existing(read) -> DataFrame | None:
    """The table that ``read()`` opens, None if there is none yet."""
    try:
        return read()
    except AnalysisException as e:
        if e.getCondition() not in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            raise
        return None


def splice_history(hist: DataFrame, new: DataFrame, cutoff, col: str = "year_month") -> DataFrame:
    """Cached history before ``cutoff`` plus newly computed months from it on.

    Both sides are filtered, so no month is counted twice.
    """
    c = F.lit(cutoff)
    return hist.filter(F.col(col) < c).unionByName(new.filter(F.col(col) >= c),
                                                   allowMissingColumns=True)


def relayout_by_month(trips: DataFrame, path: str, max_records_per_file: int = 20_000_000) -> None:
    """One-off relayout of a trip table into ``year_month=YYYYMM`` folders.

    A filter on ``year_month`` then prunes whole folders (``PartitionFilters``),
    and row groups inside a month stay sorted by the hour key for min/max
    skipping. No shuffle: each task sorts its own rows by month and writes one
    file per month it holds (source files are monthly, so usually one).
    """
    from farezone.functions.timekeys import month_key

    (trips.withColumn("year_month", month_key("datetimeid"))
          .sortWithinPartitions("year_month", "datetimeid")
          .write.mode("overwrite")
          .option("maxRecordsPerFile", max_records_per_file)
          .partitionBy("year_month")
          .parquet(path))

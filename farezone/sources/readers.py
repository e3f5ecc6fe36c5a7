"""Readers (S1-S6): trip tables, base list, zone matrix and names, daily indicators.

Trip files keep their own physical types: ids and money are cast to the declared types
after the scan (a value that doesn't fit fails the read, it never becomes NULL), so the hour
key's filter and column pruning still reach Parquet. The other readers declare their schema.
"""

from __future__ import annotations

import re
from functools import reduce
from urllib.parse import unquote

from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from farezone.sources.published import read_published

_MONEY = T.DecimalType(12, 2)
_FEE = _MONEY


def _f(name, t, nullable=True):
    return T.StructField(name, t, nullable)


_COMMON = [_f("datetimeid", T.LongType()), _f("pulocationid", T.IntegerType()),
           _f("dolocationid", T.IntegerType())]

_METERED = _COMMON + [
    _f("trip_distance", T.DoubleType()), _f("trip_time_in_secs", T.IntegerType()),
    _f("total_amount", _MONEY), _f("fare_amount", _MONEY), _f("extra", _FEE),
    _f("tip_amount", _FEE), _f("tolls_amount", _FEE), _f("mta_tax", _FEE),
    _f("improvement_surcharge", _FEE), _f("congestion_surcharge", _FEE),
]

TRIP_SCHEMAS = {
    "yellow": T.StructType(_METERED + [_f("airport_fee", _FEE), _f("hack_number", T.StringType())]),
    "green": T.StructType(_METERED + [_f("hack_number", T.StringType())]),
    "fhv": T.StructType(_COMMON + [_f("dispatching_base_num", T.StringType())]),
    "hvfhv": T.StructType(_COMMON + [
        _f("hvfhs_license_num", T.StringType()), _f("route_id", T.LongType()),
        _f("trip_miles", T.DoubleType()), _f("trip_time", T.IntegerType()),
        _f("base_passenger_fare", _MONEY), _f("tolls", _FEE), _f("bcf", _FEE),
        _f("sales_tax", _FEE), _f("congestion_surcharge", _FEE), _f("airport_fee", _FEE),
        _f("tips", _FEE), _f("driver_pay", _MONEY), _f("tlc_driver_license_num", T.StringType()),
    ]),
}

BASES_SCHEMA = T.StructType([_f("lic_no", T.StringType()), _f("company", T.StringType())])
ZONE_NAMES_SCHEMA = T.StructType([_f("LocationID", T.IntegerType()), _f("Zone", T.StringType())])
DAILY_SCHEMA = T.StructType([_f("metric_day", T.DateType()), _f("count_trips", T.LongType()),
                             _f("industry", T.StringType()), _f("period_start", T.LongType())])
MART_SCHEMA = T.StructType([
    _f("year_month", T.DateType()), _f("id", T.IntegerType()), _f("company", T.StringType()),
    _f("Z", T.StringType()), _f("Zone", T.StringType()), _f("metric", T.StringType()),
    _f("count", T.DoubleType()),
])


def read_trips(spark: SparkSession, path: str, industry: str) -> DataFrame:
    """Every monthly Parquet file of one industry (``path`` may be a glob).

    ``industry`` is one of ``yellow``, ``green``, ``fhv``, ``hvfhv`` (the shared
    rides live in the hvfhv files). Each file's footer gives its physical types; a declared
    column is NULL only for the files that lack it, others are ignored. Money is rounded
    to cents.
    """
    fields = TRIP_SCHEMAS[industry].fields
    groups = [files.select(*[checked_cast(files, f) for f in fields]) for files in alike(spark, path, fields)]
    return reduce(DataFrame.unionByName, groups)


def alike(spark: SparkSession, path: str, fields: list) -> list[DataFrame]:
    """The files of ``path`` as one table if their schemas merge (one job reads all footers), else
    one for each set of physical types that agree on the declared ``fields``.

    Types that differ take one more job over all files, which reads their footers in tasks, and one
    for each set of types found: the number of jobs doesn't grow with the files."""
    try:
        return [spark.read.option("mergeSchema", True).parquet(path)]
    except (PySparkException, Py4JJavaError) as e:
        if "CANNOT_MERGE" not in str(e):
            raise
    # an inner folder names its partition columns from the root on; a glob has no root
    reader = lambda: spark.read if re.search(r"[*?{\[]", path) else spark.read.option("basePath", path)
    files = reader().schema(T.StructType(fields)).parquet(path).inputFiles()
    declared = {f.name.lower() for f in fields}
    by_types: dict = {}
    for file, types in footer_types(spark, files, declared):
        by_types.setdefault(types, []).append(file)
    unread = by_types.pop(None, [])
    groups = [(some[:1], some) for some in map(_spark_paths, by_types.values())]  # one file tells of all
    groups += [(some, some) for some in _that_merge(reader, _spark_paths(unread))]
    tables: list = []  # declared fields by name, files
    for telling, some in groups:
        own = reader().option("mergeSchema", True).parquet(*telling).schema
        own = {f.name.lower(): f for f in own.fields if f.name.lower() in declared}
        for known, same in tables:  # files that only lack columns of others go with them
            if all(f.dataType == known[n].dataType for n, f in own.items() if n in known):
                known.update({n: f for n, f in own.items() if n not in known})
                same += some
                break
        else:
            tables.append((own, list(some)))
    return [reader().schema(T.StructType(list(known.values()))).parquet(*some) for known, some in tables]


def _spark_paths(uris: list[str]) -> list[str]:
    """Paths that Spark's readers take for exactly these files."""
    return [re.sub(r"([*?{}\[\]\\])", r"\\\1", unquote(u)) for u in uris]


def footer_types(spark: SparkSession, files: list[str], names: set[str]) -> list[tuple[str, str | None]]:
    """Each file (a URI) with the physical types of its columns in ``names`` (lower case), from its
    footer. Footers are read in tasks; None where Python can't open the file's store."""

    def run(batches):
        import pyarrow as pa
        import pyarrow.fs
        import pyarrow.parquet as pq

        def types(uri):
            try:
                store, path = pa.fs.FileSystem.from_uri(uri)
                with store.open_input_file(path) as f:
                    columns = [(c.name.lower(), str(c.type)) for c in pq.read_schema(f)]
            except (OSError, ValueError, NotImplementedError, ImportError):
                return None
            return "; ".join(f"{n} {t}" for n, t in sorted(columns) if n in names)

        for batch in batches:
            uris = batch.column(0)
            yield pa.RecordBatch.from_arrays([uris, pa.array([types(u) for u in uris.to_pylist()], pa.string())], names=["file", "types"])

    slices = max(1, min(len(files), 4 * spark.sparkContext.defaultParallelism))
    listed = spark.createDataFrame([(f,) for f in files], "file string").repartition(slices)
    # names of files and types alone: as much as the driver's own listing of the folder
    return [tuple(r) for r in listed.mapInArrow(run, "file string, types string").collect()]


def _that_merge(reader, files: list[str]) -> list[list[str]]:
    """``files`` in parts whose schemas merge, for stores that only Spark opens: halves of what doesn't."""
    if not files:
        return []
    try:
        reader().option("mergeSchema", True).parquet(*files)
        return [files]
    except (PySparkException, Py4JJavaError) as e:
        if "CANNOT_MERGE" not in str(e) or len(files) == 1:
            raise
    half = len(files) // 2
    return _that_merge(reader, files[:half]) + _that_merge(reader, files[half:])


# integer types from narrow to wide: a cast to a wider one can't fail, and Spark
# unwraps it in a comparison, so that filters are still pushed down
_INTEGERS = [T.ByteType(), T.ShortType(), T.IntegerType(), T.LongType()]


def checked_cast(df: DataFrame, field: T.StructField):
    """``field`` of ``df`` in its declared type: NULL where ``df`` lacks it, an error for a
    value that the type can't hold (also where ANSI mode is off)."""
    found = [f for f in df.schema.fields if f.name.lower() == field.name.lower()]  # as Spark resolves names
    if not found:
        return F.lit(None).cast(field.dataType).alias(field.name)
    col, have = F.col(field.name), found[0].dataType
    if have == field.dataType:
        return col.alias(field.name)
    if have in _INTEGERS and field.dataType in _INTEGERS and _INTEGERS.index(have) < _INTEGERS.index(field.dataType):
        return col.cast(field.dataType).alias(field.name)
    cast = col.try_cast(field.dataType)
    lost = col.isNotNull() & cast.isNull()
    if isinstance(field.dataType, T.IntegralType):  # a fraction would be cut off
        lost = lost | (cast != col)
    message = F.concat(F.lit(f"{field.name} doesn't fit {field.dataType.simpleString()}: "), col.cast("string"))
    return F.when(lost, F.raise_error(message).cast(field.dataType)).otherwise(cast).alias(field.name)


def read_bases(spark: SparkSession, path: str) -> DataFrame:
    """The licensed-base list (``lic_no``, ``company``)."""
    return spark.read.schema(BASES_SCHEMA).parquet(path)


def read_zone_matrix(spark: SparkSession, path: str, zones: list[str] | None = None) -> DataFrame:
    """S3: the wide Yes/No zone matrix CSV (``ID`` + one column per service zone).

    ``zones`` names the zone columns in file order; when omitted the header is
    read for the names (a one-line read; the file has one row per taxi zone).
    """
    if zones is None:
        header = spark.read.option("header", True).csv(path).columns
        zones = [c for c in header if c != "ID"]
    schema = T.StructType([_f("ID", T.IntegerType())] + [_f(z, T.StringType()) for z in zones])
    return spark.read.option("header", True).schema(schema).csv(path)


def read_zone_names(spark: SparkSession, path: str) -> DataFrame:
    """The zone lookup (Parquet) with ``LocationID, Zone``."""
    return spark.read.schema(ZONE_NAMES_SCHEMA).parquet(path)


def read_daily_indicators(spark: SparkSession, url: str, table: str, end: int,
                          properties: dict | None = None) -> DataFrame:
    """The daily indicator table from a relational server over JDBC.

    The ``period_start < end`` bound (F13) and the sub-industry filter are pushed
    into the remote query; ``partitionColumn`` options in ``properties`` spread
    the read over executors. Untested here: no server is reachable.
    """
    from farezone import config as C

    inds = ", ".join(f"'{i}'" for i in C.FHV_SUBINDUSTRIES)
    query = (f"(select metric_day, count_trips, industry, period_start from {table} "
             f"where industry in ({inds}) and period_start < {int(end)}) t")
    reader = spark.read.format("jdbc").option("url", url).option("dbtable", query)
    for k, v in (properties or {}).items():
        reader = reader.option(k, v)
    return reader.load()


def read_mart(spark: SparkSession, path: str, fmt: str = "parquet") -> DataFrame:
    """Re-read the published mart with its declared schema: the version its manifest names,
    or plain files in ``path`` (in ``fmt``) where no manifest is."""
    df = read_published(spark, path, MART_SCHEMA)
    if df is None:
        df = spark.read.schema(MART_SCHEMA).option("header", True).format(fmt).load(path)
    # a mart written partitioned by metric returns that column last; restore the order
    return df.select(*MART_SCHEMA.fieldNames())


def zone_names(lookup: DataFrame) -> DataFrame:
    """S4 projection: ``LocationID, Zone`` -> ``id, zone``."""
    return lookup.select(F.col("LocationID").cast("int").alias("id"), F.col("Zone").alias("zone"))

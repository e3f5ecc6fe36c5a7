"""Trip-shaped views derived from the TPC-H-style tables in ``/root/testdata``.

The reference ships no trip data, so the test inputs are views over the given
tables (rules in FIXTURES.md). Everything here is lazy DataFrame code: each view
grows with the tables it reads, and Catalyst prunes the columns a query needs.

Joins here are left to the optimizer (no forced broadcast): customer and supplier
grow with the scale factor, so AQE picks broadcast only when the runtime size is
under ``spark.sql.adaptive.autoBroadcastJoinThreshold``. Only ``nation`` (25 rows
at every scale) backs the zone dimensions.
"""

from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import DataFrame, SparkSession

from farezone.functions.timekeys import HOUR_KEY

# Fixed fixture rules (FIXTURES.md): order priority -> industry view.
PRIORITY_YELLOW = ("1-URGENT",)
PRIORITY_GREEN = ("2-HIGH",)
PRIORITY_FHV = ("3-MEDIUM",)
PRIORITY_HVFHV = ("4-NOT SPECIFIED", "5-LOW")

MONEY = "decimal(12,2)"
FEE = "decimal(4,2)"


class Tables:
    """The given tables of one folder, each opened once (its schema is a job) whatever views read it."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self._dir, self._open = spark, sf_dir, {}

    def __getattr__(self, name: str) -> DataFrame:
        if name.startswith("_"):
            raise AttributeError(name)
        return self.opened(name)[0]

    def opened(self, *names: str) -> list[DataFrame]:
        """Several tables, opened side by side."""
        new = [n for n in names if n not in self._open]
        with ThreadPoolExecutor(max(1, len(new))) as pool:
            self._open.update(zip(new, pool.map(lambda n: self.spark.read.parquet(f"{self._dir}/{n}.parquet"), new)))
        return [self._open[n] for n in names]


# The views are written as SQL text: see farezone.functions.text. Orders meet their customers before they
# meet the lineitems, the largest table, which then is shuffled once (by order) and not once more by customer.
_BASE = f"""
    SELECT o_orderpriority, {HOUR_KEY.format("l_shipdate")} AS datetimeid,
           nullif(c_nationkey, 7) AS pulocationid, nullif(s_nationkey, 11) AS dolocationid,
           l_orderkey, l_suppkey, l_linenumber, l_quantity, l_extendedprice, l_discount, l_tax, l_returnflag, l_linestatus
    FROM {{li}} JOIN ({{o}} JOIN {{c}} ON o_custkey = c_custkey) ON l_orderkey = o_orderkey JOIN {{s}} ON l_suppkey = s_suppkey
    WHERE o_orderpriority IN (PRIORITIES)"""

_METERED = ["datetimeid", "pulocationid", "dolocationid", "l_quantity AS trip_distance",
            "CAST(l_quantity * 180 AS int) AS trip_time_in_secs",
            f"CAST(l_extendedprice AS {MONEY}) AS total_amount", f"CAST(l_extendedprice AS {MONEY}) AS fare_amount",
            f"nullif(CAST(l_tax AS {FEE}), CAST(0.08D AS {FEE})) AS extra", f"CAST(l_discount AS {FEE}) AS tip_amount",
            f"CAST(l_tax AS {FEE}) AS tolls_amount", f"CAST(0.5D AS {FEE}) AS mta_tax",
            f"CAST(0.3D AS {FEE}) AS improvement_surcharge",
            f"CAST(CASE WHEN l_returnflag = 'R' THEN 2.5D END AS {FEE}) AS congestion_surcharge"]
_AIRPORT_FEE = f"CAST(CASE WHEN l_linestatus = 'O' THEN 1.25D ELSE 0 END AS {FEE}) AS airport_fee"
_HACK = "CAST(l_suppkey AS string) AS hack_number"
_FHV = ["datetimeid", "pulocationid", "dolocationid", "concat('B', CAST(l_suppkey AS string)) AS dispatching_base_num"]
_HV = ["datetimeid", "pulocationid", "dolocationid",
       "concat('HV000', CAST(2 + pmod(l_linenumber, 5) AS string)) AS hvfhs_license_num",
       "CASE WHEN l_returnflag = 'R' THEN l_orderkey END AS route_id", "l_quantity AS trip_miles",
       "CAST(l_quantity * 180 AS int) AS trip_time", f"CAST(l_extendedprice AS {MONEY}) AS base_passenger_fare",
       f"CAST(l_tax AS {FEE}) AS tolls", f"CAST(l_discount AS {FEE}) AS bcf", f"CAST(l_tax AS {FEE}) AS sales_tax",
       f"CAST(CASE WHEN l_linestatus = 'O' THEN 2.75D END AS {FEE}) AS congestion_surcharge", f"CAST(0 AS {FEE}) AS airport_fee",
       f"CAST(l_discount AS {FEE}) AS tips", f"CAST(CASE WHEN l_linenumber != 3 THEN l_extendedprice END AS {MONEY}) AS driver_pay",
       "CAST(l_suppkey AS string) AS tlc_driver_license_num"]

# view -> (order priorities, its columns over the joined base)
VIEW_RULES = {
    "yellow": (PRIORITY_YELLOW, [*_METERED, _AIRPORT_FEE, _HACK]),
    "green": (PRIORITY_GREEN, [*_METERED, _HACK]),
    "fhv": (PRIORITY_FHV, _FHV),
    "hvfhv": (PRIORITY_HVFHV, _HV),
}


def _over_base(tables: Tables, columns: list, priorities) -> DataFrame:
    """``columns`` over lineitem ⋈ orders ⋈ customer ⋈ supplier of the given order priorities."""
    base = _BASE.replace("PRIORITIES", ", ".join(f"'{p}'" for p in priorities))
    li, o, c, s = tables.opened("lineitem", "orders", "customer", "supplier")
    return tables.spark.sql(f"SELECT {', '.join(columns)} FROM ({base})", li=li, o=o, c=c, s=s)


def trip_view(name: str, tables: Tables) -> DataFrame:
    priorities, columns = VIEW_RULES[name]
    return _over_base(tables, columns, priorities)


def yellow(spark: SparkSession, sf_dir: str) -> DataFrame:
    return trip_view("yellow", Tables(spark, sf_dir))


def green(spark: SparkSession, sf_dir: str) -> DataFrame:
    return trip_view("green", Tables(spark, sf_dir))


def fhv(spark: SparkSession, sf_dir: str) -> DataFrame:
    return trip_view("fhv", Tables(spark, sf_dir))


def hvfhv(spark: SparkSession, sf_dir: str) -> DataFrame:
    return trip_view("hvfhv", Tables(spark, sf_dir))


def bases(spark: SparkSession, sf_dir: str, tables: Tables | None = None) -> DataFrame:
    """Licensed bases: one per supplier, except ``s_suppkey % 10 = 9``."""
    return spark.sql("""
        SELECT concat('B', CAST(s_suppkey AS string)) AS lic_no,
               CASE pmod(s_suppkey, 7) WHEN 0 THEN 'UBER' WHEN 1 THEN 'LYFT' WHEN 2 THEN 'JUNO' WHEN 3 THEN 'VIA'
                                       WHEN 4 THEN NULL ELSE 'BASE CO' END AS company
        FROM {s} WHERE pmod(s_suppkey, 10) != 9""", s=(tables or Tables(spark, sf_dir)).supplier)


def zone_matrix(spark: SparkSession, sf_dir: str, tables: Tables | None = None) -> DataFrame:
    """Wide Yes/No membership matrix with the real file's shape (``ID`` + zones)."""
    return spark.sql("""
        SELECT CAST(n_nationkey AS int) AS ID, 'Yes' AS Citywide,
               if(n_regionkey IN (0, 1), 'Yes', 'No') AS Core,
               if(n_nationkey IN (0, 1, 5), 'Yes', 'No') AS Midtown,
               if(NOT n_regionkey IN (0, 1) AND n_nationkey != 2, 'Yes', 'No') AS Non_Core,
               if(n_nationkey IN (2, 3, 13), 'Yes', 'No') AS Airports
        FROM {n}""", n=(tables or Tables(spark, sf_dir)).nation)


def zone_lookup(spark: SparkSession, sf_dir: str, tables: Tables | None = None) -> DataFrame:
    """The taxi-zone lookup (``LocationID``, ``Zone``); nation 24 has no entry, 22 a NULL
    name, and 23 stands in it twice."""
    return spark.sql("""
        SELECT LocationID, Zone
        FROM (SELECT CAST(n_nationkey AS int) AS LocationID, CASE WHEN n_nationkey != 22 THEN n_name END AS Zone,
                     explode(if(n_nationkey = 23, array(1, 2), array(1))) AS time
              FROM {n} WHERE n_nationkey != 24)""", n=(tables or Tables(spark, sf_dir)).nation)


def daily_indicators(spark: SparkSession, sf_dir: str, tables: Tables | None = None) -> DataFrame:
    return spark.sql(f"""
        SELECT CAST(o_orderdate AS date) AS metric_day, CAST(pmod(o_custkey, 50) AS bigint) AS count_trips,
               CASE o_orderpriority WHEN '1-URGENT' THEN 'fhv_black_car' WHEN '2-HIGH' THEN 'fhv_livery'
                                    WHEN '3-MEDIUM' THEN 'fhv_lux_limo' ELSE 'other' END AS industry,
               {HOUR_KEY.format("o_orderdate")} AS period_start
        FROM {{o}}""", o=(tables or Tables(spark, sf_dir)).orders)


TRIP_VIEWS = {"yellow": yellow, "green": green, "fhv": fhv, "hvfhv": hvfhv}


def joined_base(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The join behind every trip view, once for all of them, tagged with its view."""
    cases = " ".join(f"WHEN o_orderpriority IN ({', '.join(repr(p) for p in ps)}) THEN '{name}'" for name, (ps, _) in VIEW_RULES.items())
    return _over_base(Tables(spark, sf_dir), ["*", f"CASE {cases} END AS view"], [p for ps, _ in VIEW_RULES.values() for p in ps])

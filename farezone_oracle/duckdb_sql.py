"""DuckDB oracle: each registered query as plain SQL over the base tables.

Written independently of the Spark code: the trip views are rebuilt here in SQL
(rules in FIXTURES.md), and zone volume follows the reference's own formulation
(pickups left-joined to inbound drop-offs, "pickup outside" as NOT EXISTS).

Rules that make the two engines agree exactly: ``//`` for integral division,
``sum(bigint)`` cast back to BIGINT (DuckDB returns HUGEINT), money summed as
decimal and divided as double, ``UNPIVOT INCLUDE NULLS``.
"""

from __future__ import annotations

# Fixture parameters (FIXTURES.md): period, ALL start, run date 2001-01-15.
START, END = 1996010100, 2001010100
OLD_HV_START, OLD_HV_END = 1998060100, 2001010100
RUN_END = 2000120100          # first day of the month before the run month, as an hour key
CUTOFF = "DATE '2000-12-01'"  # published months are strictly before this
ALL_SINCE = "DATE '1998-06-01'"
FARE_CAP, DIST_CAP, TIME_CAP = 100000, 45, 7200

ZONES = ("Citywide", "Core", "Midtown", "Non_Core", "Airports")

_BASE = """
  SELECT CAST(strftime(l.l_shipdate, '%Y%m%d%H') AS BIGINT) AS datetimeid,
         NULLIF(c.c_nationkey, 7) AS pulocationid,
         NULLIF(s.s_nationkey, 11) AS dolocationid,
         l.*
  FROM lineitem l
  JOIN orders o ON l.l_orderkey = o.o_orderkey
  JOIN customer c ON o.o_custkey = c.c_custkey
  JOIN supplier s ON l.l_suppkey = s.s_suppkey
  WHERE o.o_orderpriority IN ({prio})"""

_METERED = """
  SELECT datetimeid, pulocationid, dolocationid,
         l_quantity AS trip_distance,
         CAST(l_quantity * 180 AS INTEGER) AS trip_time_in_secs,
         CAST(l_extendedprice AS DECIMAL(12,2)) AS total_amount,
         CAST(l_extendedprice AS DECIMAL(12,2)) AS fare_amount,
         NULLIF(CAST(l_tax AS DECIMAL(4,2)), CAST(0.08 AS DECIMAL(4,2))) AS extra,
         CAST(l_discount AS DECIMAL(4,2)) AS tip_amount,
         CAST(l_tax AS DECIMAL(4,2)) AS tolls_amount,
         CAST(0.5 AS DECIMAL(4,2)) AS mta_tax,
         CAST(0.3 AS DECIMAL(4,2)) AS improvement_surcharge,
         CAST(CASE WHEN l_returnflag = 'R' THEN 2.5 END AS DECIMAL(4,2)) AS congestion_surcharge,
         {airport}
         CAST(l_suppkey AS VARCHAR) AS hack_number
  FROM ({base})"""

VIEWS = {
    "yellow": _METERED.format(
        airport="CAST(CASE WHEN l_linestatus = 'O' THEN 1.25 ELSE 0 END AS DECIMAL(4,2)) AS airport_fee,",
        base=_BASE.format(prio="'1-URGENT'")),
    "green": _METERED.format(airport="", base=_BASE.format(prio="'2-HIGH'")),
    "fhv": f"""
  SELECT datetimeid, pulocationid, dolocationid, 'B' || CAST(l_suppkey AS VARCHAR) AS dispatching_base_num
  FROM ({_BASE.format(prio="'3-MEDIUM'")})""",
    "hvfhv": f"""
  SELECT datetimeid, pulocationid, dolocationid,
         'HV000' || CAST(2 + l_linenumber % 5 AS VARCHAR) AS hvfhs_license_num,
         CASE WHEN l_returnflag = 'R' THEN l_orderkey END AS route_id,
         l_quantity AS trip_miles,
         CAST(l_quantity * 180 AS INTEGER) AS trip_time,
         CAST(l_extendedprice AS DECIMAL(12,2)) AS base_passenger_fare,
         CAST(l_tax AS DECIMAL(4,2)) AS tolls,
         CAST(l_discount AS DECIMAL(4,2)) AS bcf,
         CAST(l_tax AS DECIMAL(4,2)) AS sales_tax,
         CAST(CASE WHEN l_linestatus = 'O' THEN 2.75 END AS DECIMAL(4,2)) AS congestion_surcharge,
         CAST(0 AS DECIMAL(4,2)) AS airport_fee,
         CAST(l_discount AS DECIMAL(4,2)) AS tips,
         CAST(CASE WHEN l_linenumber <> 3 THEN l_extendedprice END AS DECIMAL(12,2)) AS driver_pay,
         CAST(l_suppkey AS VARCHAR) AS tlc_driver_license_num
  FROM ({_BASE.format(prio="'4-NOT SPECIFIED', '5-LOW'")})""",
    "bases": """
  SELECT 'B' || CAST(s_suppkey AS VARCHAR) AS lic_no,
         CASE s_suppkey % 7 WHEN 0 THEN 'UBER' WHEN 1 THEN 'LYFT' WHEN 2 THEN 'JUNO'
                            WHEN 3 THEN 'VIA' WHEN 4 THEN NULL ELSE 'BASE CO' END AS company
  FROM supplier WHERE s_suppkey % 10 <> 9""",
    "zone_matrix": """
  SELECT CAST(n_nationkey AS INTEGER) AS ID,
         'Yes' AS Citywide,
         CASE WHEN n_regionkey IN (0, 1) THEN 'Yes' ELSE 'No' END AS Core,
         CASE WHEN n_nationkey IN (0, 1, 5) THEN 'Yes' ELSE 'No' END AS Midtown,
         CASE WHEN n_regionkey NOT IN (0, 1) AND n_nationkey <> 2 THEN 'Yes' ELSE 'No' END AS Non_Core,
         CASE WHEN n_nationkey IN (2, 3, 13) THEN 'Yes' ELSE 'No' END AS Airports
  FROM nation""",
    "names": """
  SELECT CAST(n_nationkey AS INTEGER) AS id, CASE WHEN n_nationkey <> 22 THEN n_name END AS zone
  FROM nation WHERE n_nationkey <> 24
  UNION ALL SELECT CAST(n_nationkey AS INTEGER), n_name FROM nation WHERE n_nationkey = 23""",
    "daily": """
  SELECT CAST(o_orderdate AS DATE) AS metric_day,
         CAST(o_custkey % 50 AS BIGINT) AS count_trips,
         CASE o_orderpriority WHEN '1-URGENT' THEN 'fhv_black_car' WHEN '2-HIGH' THEN 'fhv_livery'
                              WHEN '3-MEDIUM' THEN 'fhv_lux_limo' ELSE 'other' END AS industry,
         CAST(strftime(o_orderdate, '%Y%m%d%H') AS BIGINT) AS period_start
  FROM orders""",
    "members": f"""
  SELECT ID AS id, zone FROM zone_matrix
  UNPIVOT (flag FOR zone IN ({", ".join(ZONES)})) WHERE flag = 'Yes'""",
    "members7": """
  SELECT id, zone FROM members WHERE zone <> 'Citywide'""",
}

_PERIOD = f"datetimeid >= {START} AND datetimeid < {END}"
_HV_MAP = ("COALESCE(CASE hvfhs_license_num WHEN 'HV0002' THEN 'JUNO' WHEN 'HV0003' THEN 'UBER' "
           "WHEN 'HV0004' THEN 'VIA' WHEN 'HV0005' THEN 'LYFT' END, hvfhs_license_num)")

VIEWS.update({
    "od_yellow": f"""
  SELECT datetimeid // 10000 AS year_month, pulocationid, dolocationid, COUNT(datetimeid) AS count
  FROM yellow WHERE {_PERIOD} AND trip_distance > 0 AND total_amount > 0
  GROUP BY datetimeid // 10000, pulocationid, dolocationid""",
    "od_green": f"""
  SELECT datetimeid // 10000 AS year_month, pulocationid, dolocationid, COUNT(datetimeid) AS count
  FROM green WHERE {_PERIOD} AND trip_distance > 0 AND total_amount > 0
  GROUP BY datetimeid // 10000, pulocationid, dolocationid""",
    "od_trad": f"""
  SELECT datetimeid // 10000 AS year_month, pulocationid, dolocationid, COUNT(datetimeid) AS count
  FROM fhv t JOIN bases b ON t.dispatching_base_num = b.lic_no
  WHERE b.company NOT IN ('UBER', 'LYFT', 'JUNO', 'VIA') AND {_PERIOD}
  GROUP BY datetimeid // 10000, pulocationid, dolocationid""",
    "od_license": f"""
  SELECT datetimeid // 10000 AS year_month, pulocationid, dolocationid, hvfhs_license_num,
         COUNT(datetimeid) AS count
  FROM hvfhv WHERE {_PERIOD} AND trip_miles > 0 AND base_passenger_fare > 0
  GROUP BY datetimeid // 10000, pulocationid, dolocationid, hvfhs_license_num""",
    "od_shared": f"""
  SELECT datetimeid // 10000 AS year_month, pulocationid, dolocationid, COUNT(datetimeid) AS count
  FROM hvfhv WHERE route_id IS NOT NULL AND {_PERIOD} AND trip_miles > 0 AND base_passenger_fare > 0
  GROUP BY datetimeid // 10000, pulocationid, dolocationid""",
    "od": f"""
  SELECT *, 'yellow' AS company FROM od_yellow
  UNION ALL SELECT *, 'green' AS company FROM od_green
  UNION ALL SELECT *, 'no_hv' AS company FROM od_trad
  UNION ALL SELECT year_month, pulocationid, dolocationid, count, {_HV_MAP} AS company FROM od_license
  UNION ALL SELECT *, 'shared' AS company FROM od_shared""",
    "pu": """
  SELECT year_month, pulocationid AS id, company, CAST(SUM(count) AS BIGINT) AS count
  FROM od WHERE pulocationid IS NOT NULL GROUP BY ALL""",
    "do_": """
  SELECT year_month, dolocationid AS id, company, CAST(SUM(count) AS BIGINT) AS count
  FROM od WHERE dolocationid IS NOT NULL GROUP BY ALL""",
    "inbound": """
  SELECT od.year_month, od.dolocationid AS id, od.company, m.zone, CAST(SUM(od.count) AS BIGINT) AS count1
  FROM od JOIN members7 m ON od.dolocationid = m.id
  WHERE NOT EXISTS (SELECT 1 FROM members7 m2 WHERE m2.zone = m.zone AND m2.id = od.pulocationid)
  GROUP BY ALL""",
    "volume": """
  SELECT e.year_month, e.id, e.company, e.zone, e.count,
         COALESCE(f.count1, 0) AS count1, e.count + COALESCE(f.count1, 0) AS volume
  FROM (SELECT pu.*, m.zone FROM pu JOIN members7 m ON pu.id = m.id) e
  LEFT JOIN inbound f USING (year_month, id, company, zone)""",
})


def _label(col: str = "company") -> str:
    return f"UPPER(CASE WHEN {col} = 'no_hv' THEN 'FHV' ELSE {col} END)"


def _ym(col: str = "year_month") -> str:
    return f"make_date(CAST({col} // 100 AS BIGINT), CAST({col} % 100 AS BIGINT), 1)"


VIEWS.update({
    "combined": f"""
  SELECT c.*, n.zone AS Zone FROM (
    SELECT {_ym()} AS year_month, id, {_label()} AS company, zone AS Z, volume AS count, 'Trips' AS metric
    FROM volume
    UNION ALL
    SELECT {_ym()}, id, {_label()}, 'Citywide', count, 'Trips'
    FROM pu WHERE id IN (SELECT id FROM members WHERE zone = 'Citywide')
    UNION ALL
    SELECT {_ym()}, pu.id, {_label()}, m.zone, count, 'PickUps' FROM pu JOIN members m ON pu.id = m.id
    UNION ALL
    SELECT {_ym()}, do_.id, {_label()}, m.zone, count, 'DropOffs' FROM do_ JOIN members m ON do_.id = m.id
  ) c LEFT JOIN names n ON c.id = n.id""",
    "all_rows": f"""
  SELECT year_month, id, Z, Zone, metric, CAST(SUM(count) AS BIGINT) AS count, 'ALL' AS company
  FROM combined
  WHERE COALESCE(company NOT IN ('SHARED', 'NOHV'), TRUE) AND year_month >= {ALL_SINCE}
    AND year_month IS NOT NULL AND id IS NOT NULL AND Z IS NOT NULL AND Zone IS NOT NULL AND metric IS NOT NULL
  GROUP BY year_month, id, Z, Zone, metric""",
    "mart": f"""
  SELECT year_month, id, company, Z, Zone, metric, CAST(SUM(count) AS BIGINT) AS count
  FROM (
    SELECT year_month, id,
           CASE WHEN REPLACE(company, ' ', '') IN ('UBER', 'LYFT', 'VIA', 'JUNO') THEN 'HVFHV'
                ELSE REPLACE(company, ' ', '') END AS company,
           Z, Zone, metric, count
    FROM (SELECT year_month, id, company, Z, Zone, metric, count FROM combined
          UNION ALL SELECT year_month, id, company, Z, Zone, metric, count FROM all_rows)
    WHERE year_month < {CUTOFF}
  )
  WHERE year_month IS NOT NULL AND id IS NOT NULL AND company IS NOT NULL AND Z IS NOT NULL
    AND Zone IS NOT NULL AND metric IS NOT NULL
  GROUP BY year_month, id, company, Z, Zone, metric
  HAVING company <> 'FHV'""",
})


def _avg(x: str) -> str:
    return f"(CAST(SUM({x}) AS DOUBLE) / NULLIF(COUNT({x}), 0))"


def _sum(x: str) -> str:
    return f"SUM(COALESCE({x}, 0))"


_HV_PARTS = ("base_passenger_fare", "tolls", "bcf", "sales_tax", "congestion_surcharge", "airport_fee", "tips")
_RIDER = " + ".join(f"COALESCE({p}, 0)" for p in _HV_PARTS)


def _financials(view: str, fare: str, dist: str, secs: str, shared: bool, company: str) -> str:
    extra = "route_id IS NOT NULL AND " if shared else ""
    fare_base = "base_passenger_fare" if view == "hvfhv" else fare
    return f"""
  SELECT datetimeid // 10000 AS year_month, pulocationid,
         {_avg(fare)} AS avg_total_fare,
         CAST(SUM(COALESCE({fare}, 0)) AS DOUBLE) AS sum_total_fare,
         {_avg(secs)} / 60.0 AS avg_trip_time,
         {_avg(dist)} AS avg_trip_distance{company}
  FROM {view}
  WHERE {extra}{_PERIOD} AND {dist} > 0 AND {fare_base} > 0 AND {fare_base} < {FARE_CAP}
    AND {dist} < {DIST_CAP} AND {secs} > 0 AND {secs} < {TIME_CAP}
  GROUP BY datetimeid // 10000, pulocationid"""


FIN = {
    "yellow": ("yellow", "total_amount", "trip_distance", "trip_time_in_secs", False),
    "green": ("green", "total_amount", "trip_distance", "trip_time_in_secs", False),
    "hvfhv": ("hvfhv", f"({_RIDER})", "trip_miles", "trip_time", False),
    "shared": ("hvfhv", f"({_RIDER})", "trip_miles", "trip_time", True),
}

VIEWS["fin_all"] = "\n  UNION ALL\n".join(
    _financials(*FIN[k], company=f", '{k}' AS company") for k in FIN)
VIEWS["fin_wide"] = f"""
  SELECT {_ym()} AS year_month, f.pulocationid AS id, UPPER(REPLACE(company, ' ', '')) AS company,
         m.zone AS Z, n.zone AS Zone,
         avg_total_fare AS "Average Fare", sum_total_fare AS "Total Fare",
         avg_trip_time AS "Average Trip Time", avg_trip_distance AS "Average Trip Distance"
  FROM fin_all f JOIN members m ON f.pulocationid = m.id
  LEFT JOIN names n ON f.pulocationid = n.id
  WHERE {_ym()} < {CUTOFF}"""


def _metered_fares(view: str, airport: bool, extra_payers_only: bool) -> str:
    drivers = "COUNT(DISTINCT hack_number)"
    avg_extra = _avg("NULLIF(extra, 0)") if extra_payers_only else _avg("COALESCE(extra, 0)")
    airport_cols = (f"{_avg('NULLIF(airport_fee, 0)')} AS avg_airport_fee, "
                    f"CAST({_sum('airport_fee')} AS DOUBLE) AS sum_airport_fee,") if airport else ""
    return f"""
  SELECT {_ym('datetimeid // 10000')} AS year_month,
         {_avg('total_amount')} AS avg_total_fare, CAST({_sum('total_amount')} AS DOUBLE) AS sum_total_fare,
         {_avg('fare_amount')} AS avg_fare_amount, CAST({_sum('fare_amount')} AS DOUBLE) AS sum_fare_amount,
         {avg_extra} AS avg_extra, CAST({_sum('extra')} AS DOUBLE) AS sum_extra,
         CAST(0.50 AS DOUBLE) AS mta_tax, CAST({_sum('mta_tax')} AS DOUBLE) AS total_mta_tax,
         {_avg('NULLIF(tip_amount, 0)')} AS avg_tip_amount, CAST({_sum('tip_amount')} AS DOUBLE) AS sum_tip_amount,
         {_avg('NULLIF(tolls_amount, 0)')} AS avg_tolls_amount,
         CAST({_sum('tolls_amount')} AS DOUBLE) AS sum_tolls_amount,
         CAST(0.30 AS DOUBLE) AS improvement_surcharge,
         CAST({_sum('improvement_surcharge')} AS DOUBLE) AS sum_improvement_surcharge,
         {_avg('NULLIF(congestion_surcharge, 0)')} AS avg_congestion_surcharge,
         CAST({_sum('congestion_surcharge')} AS DOUBLE) AS sum_congestion_surcharge,
         {airport_cols}
         {_avg('trip_distance')} AS avg_distance,
         {drivers} AS count_drivers,
         {_avg('fare_amount')} + {_avg('COALESCE(extra, 0)')} AS driver_pay,
         CAST({_sum('fare_amount')} + {_sum('extra')} AS DOUBLE) AS total_driver_pay,
         CAST({_sum('fare_amount')} + {_sum('extra')} AS DOUBLE) / NULLIF({drivers}, 0) AS pay_per_driver,
         CAST({_sum('tip_amount')} AS DOUBLE) / NULLIF({drivers}, 0) AS tips_per_driver,
         CAST({_sum('extra')} AS DOUBLE) / NULLIF({drivers}, 0) AS extra_per_driver,
         CAST({_sum('fare_amount')} AS DOUBLE) / NULLIF({drivers}, 0) AS fare_per_driver
  FROM {view}
  WHERE datetimeid >= {START} AND datetimeid < {RUN_END} AND trip_distance > 0 AND total_amount > 0
    AND total_amount < {FARE_CAP} AND trip_distance < {DIST_CAP}
  GROUP BY datetimeid // 10000"""


def _hv_fares(shared: bool) -> str:
    drivers = "COUNT(DISTINCT tlc_driver_license_num)"
    cols = []
    for p in ("base_passenger_fare", "tolls", "bcf", "sales_tax", "congestion_surcharge", "tips",
              "driver_pay", "airport_fee"):
        cols.append(f"{_avg(p)} AS avg_{p}, CAST({_sum(p)} AS DOUBLE) AS sum_{p}")
    extra = "route_id IS NOT NULL AND " if shared else ""
    return f"""
  SELECT {_ym('datetimeid // 10000')} AS year_month,
         {", ".join(cols)},
         {_avg('trip_miles')} AS avg_distance,
         {drivers} AS count_drivers,
         {_avg('driver_pay')} AS driver_pay,
         CAST(SUM(driver_pay) AS DOUBLE) AS total_driver_pay,
         CAST(SUM(driver_pay) AS DOUBLE) / NULLIF({drivers}, 0) AS pay_per_driver,
         CAST({_sum('tips')} AS DOUBLE) / NULLIF({drivers}, 0) AS tips_per_driver,
         CAST({" + ".join(_sum(p) for p in _HV_PARTS)} AS DOUBLE) AS sum_total_fare,
         {" + ".join(_avg(p) for p in _HV_PARTS)} AS avg_total_fare
  FROM hvfhv
  WHERE {extra}datetimeid >= {START} AND datetimeid < {RUN_END} AND trip_miles > 0
    AND base_passenger_fare > 0 AND base_passenger_fare < {FARE_CAP} AND trip_miles < {DIST_CAP}
  GROUP BY datetimeid // 10000"""


VIEWS["fares_yellow"] = _metered_fares("yellow", airport=True, extra_payers_only=False)
VIEWS["fares_green"] = _metered_fares("green", airport=False, extra_payers_only=True)
VIEWS["fares_hvfhv"] = _hv_fares(shared=False)
VIEWS["fares_shared"] = _hv_fares(shared=True)

# Dependencies between views, so each query defines only what it uses.
DEPS = {
    "yellow": [], "green": [], "fhv": [], "hvfhv": [], "bases": [], "zone_matrix": [], "names": [],
    "daily": [], "members": ["zone_matrix"], "members7": ["members"],
    "od_yellow": ["yellow"], "od_green": ["green"], "od_trad": ["fhv", "bases"],
    "od_license": ["hvfhv"], "od_shared": ["hvfhv"],
    "od": ["od_yellow", "od_green", "od_trad", "od_license", "od_shared"],
    "pu": ["od"], "do_": ["od"], "inbound": ["od", "members7"], "volume": ["pu", "inbound", "members7"],
    "combined": ["volume", "pu", "do_", "members", "names"], "all_rows": ["combined"],
    "mart": ["combined", "all_rows"],
    "fin_all": ["yellow", "green", "hvfhv"], "fin_wide": ["fin_all", "members", "names"],
    "fares_yellow": ["yellow"], "fares_green": ["green"], "fares_hvfhv": ["hvfhv"],
    "fares_shared": ["hvfhv"],
}


def _with(*needed: str) -> str:
    order: list[str] = []

    def visit(v):
        for d in DEPS[v]:
            visit(d)
        if v not in order:
            order.append(v)

    for v in needed:
        visit(v)
    return "WITH " + ",\n".join(f"{v} AS ({VIEWS[v]}\n)" for v in order) + "\n"


def _fares_long(view: str) -> str:
    # every measure column, melted with NULLs kept; values as double
    return _with(view) + f"""
  SELECT year_month, variable, CAST(value AS DOUBLE) AS value
  FROM (SELECT * FROM {view}) t
  UNPIVOT INCLUDE NULLS (value FOR variable IN (COLUMNS(* EXCLUDE (year_month))))"""


ORACLE = {
    "od_counts_yellow": _with("od_yellow") + "SELECT * FROM od_yellow",
    "od_counts_green": _with("od_green") + "SELECT * FROM od_green",
    "od_counts_traditional": _with("od_trad") + "SELECT * FROM od_trad",
    "od_counts_old_hv": _with("fhv", "bases") + f"""
  SELECT datetimeid // 10000 AS year_month, pulocationid, dolocationid, b.company AS company,
         COUNT(datetimeid) AS count
  FROM fhv t JOIN bases b ON t.dispatching_base_num = b.lic_no
  WHERE b.company IN ('UBER', 'LYFT', 'JUNO', 'VIA')
    AND datetimeid >= {OLD_HV_START} AND datetimeid < {OLD_HV_END}
  GROUP BY datetimeid // 10000, pulocationid, dolocationid, b.company""",
    "od_counts_by_license": _with("od_license") + "SELECT * FROM od_license",
    "od_counts_shared": _with("od_shared") + "SELECT * FROM od_shared",
    "fhv_with_base": _with("fhv", "bases") + f"""
  SELECT t.*, b.company FROM fhv t JOIN bases b ON t.dispatching_base_num = b.lic_no WHERE {_PERIOD}""",
    "od_all_industries": _with("od") + "SELECT * FROM od",
    "pickups_all": _with("pu") + "SELECT * FROM pu",
    "dropoffs_all": _with("do_") + "SELECT * FROM do_",
    "zone_members": _with("members") + "SELECT * FROM members",
    "inbound_all": _with("inbound") + "SELECT * FROM inbound",
    "zone_volume_all": _with("volume") + "SELECT * FROM volume",
    "pickups_by_zone": _with("pu", "members", "names") + f"""
  SELECT {_ym()} AS year_month, pu.id, {_label()} AS company, count, n.zone AS Zone, m.zone AS Z,
         'PickUps' AS metric
  FROM pu LEFT JOIN names n ON pu.id = n.id JOIN members m ON pu.id = m.id""",
    "dropoffs_by_zone": _with("do_", "members", "names") + f"""
  SELECT {_ym()} AS year_month, do_.id, {_label()} AS company, count, n.zone AS Zone, m.zone AS Z,
         'DropOffs' AS metric
  FROM do_ LEFT JOIN names n ON do_.id = n.id JOIN members m ON do_.id = m.id""",
    "citywide_trips": _with("pu", "members") + f"""
  SELECT {_ym()} AS year_month, id, {_label()} AS company, count, 'Citywide' AS Z, 'Trips' AS metric
  FROM pu WHERE id IN (SELECT id FROM members WHERE zone = 'Citywide')""",
    "all_companies": _with("all_rows") + "SELECT * FROM all_rows",
    "trips_mart": _with("mart") + "SELECT * FROM mart",
    "mart_slice": _with("mart") + """
  SELECT * FROM mart WHERE metric = 'Trips' AND Z IN ('Core', 'Midtown')
    AND company IN ('YELLOW', 'HVFHV', 'ALL')
    AND year_month >= DATE '1999-01-01' AND year_month < DATE '2000-07-01'""",
    "distinct_companies": _with("mart") + "SELECT DISTINCT company FROM mart",
    "zone_financials_yellow": _with("yellow") + _financials(*FIN["yellow"], company=""),
    "zone_financials_green": _with("green") + _financials(*FIN["green"], company=""),
    "zone_financials_hvfhv": _with("hvfhv") + _financials(*FIN["hvfhv"], company=""),
    "zone_financials_shared": _with("hvfhv") + _financials(*FIN["shared"], company=""),
    "zone_financials_mart": _with("fin_wide") + """
  SELECT year_month, id, company, Z, Zone, metric, count
  FROM fin_wide
  UNPIVOT INCLUDE NULLS (count FOR metric IN ("Average Fare", "Total Fare", "Average Trip Time",
                                              "Average Trip Distance"))""",
    "fares_yellow": _with("fares_yellow") + "SELECT * FROM fares_yellow",
    "fares_green": _with("fares_green") + "SELECT * FROM fares_green",
    "fares_hvfhv": _with("fares_hvfhv") + "SELECT * FROM fares_hvfhv",
    "fares_shared": _with("fares_shared") + "SELECT * FROM fares_shared",
    "fares_yellow_long": _fares_long("fares_yellow"),
    "fares_green_long": _fares_long("fares_green"),
    "fares_hvfhv_long": _fares_long("fares_hvfhv"),
    "fares_shared_long": _fares_long("fares_shared"),
    "fhv_totals": _with("daily") + f"""
  SELECT CAST(date_trunc('month', metric_day) AS DATE) AS year_month, 999 AS id,
         CAST(SUM(count_trips) AS BIGINT) AS count, industry
  FROM daily
  WHERE industry IN ('fhv_black_car', 'fhv_livery', 'fhv_lux_limo') AND period_start < {RUN_END}
  GROUP BY CAST(date_trunc('month', metric_day) AS DATE), industry
  UNION ALL
  SELECT CAST(date_trunc('month', metric_day) AS DATE) AS year_month, 999 AS id,
         CAST(SUM(count_trips) AS BIGINT) AS count, 'fhv' AS industry
  FROM daily
  WHERE industry IN ('fhv_black_car', 'fhv_livery', 'fhv_lux_limo') AND period_start < {RUN_END}
  GROUP BY CAST(date_trunc('month', metric_day) AS DATE)""",
    "read_trips": _with("yellow") + "SELECT * FROM yellow",
    "read_bases": _with("bases") + "SELECT * FROM bases",
    "read_zone_matrix": _with("zone_matrix") + "SELECT * FROM zone_matrix",
    "read_zone_names": _with("names") + "SELECT * FROM names",
}
for _q in ("read_mart", "mart_csv", "splice_history"):
    ORACLE[_q] = ORACLE["trips_mart"]
ORACLE["extend_mart"] = f"""
  SELECT year_month, id, company, Z, Zone, metric, CAST(count AS DOUBLE) AS count FROM ({ORACLE["trips_mart"]})
  UNION ALL
  SELECT year_month, id, company, Z, Zone, metric, CAST(count AS DOUBLE) AS count FROM ({ORACLE["zone_financials_mart"]})"""
for _q in ("yellow", "green", "hvfhv"):
    ORACLE[f"fares_{_q}_late"] = ORACLE[f"fares_{_q}"]

"""Service zones: membership (R3), expansion (J4), inbound drop-offs (A6), J2.

Service zones overlap (Midtown lies inside Core), so one taxi zone belongs to several. For
expansion, membership is a small ``(id, zone)`` table, one row per taxi zone and service zone it
belongs to. For counts it is one bit mask per taxi zone, a bit for each service zone: "the pickup is outside" is
``dropoff_mask & ~pickup_mask``, and zones become rows only after everything is summed. Spark
broadcasts either by its size, so every zone operator is a map-side join on the trip side.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from farezone.functions.text import literal, sql


def zone_members(matrix: DataFrame, exclude=(), id_col: str = "ID") -> DataFrame:
    """Wide Yes/No matrix -> ``(id, zone)`` rows where the flag is ``Yes``.

    ``exclude`` leaves zones out (the trips metric skips ``Citywide``).
    """
    zones = [z for some in _masked_zones(matrix, exclude, id_col) for z in some]
    flags = ", ".join(f"struct({literal(z)} AS zone, `{z}` AS flag)" for z in zones)
    return matrix.sparkSession.sql(f"""
        SELECT id, zone FROM (SELECT CAST(`{id_col}` AS int) AS id, inline(array({flags})) FROM {{matrix}}) WHERE flag = 'Yes'""",
                                   matrix=matrix)


def expand_zones(df: DataFrame, members: DataFrame, key: str = "id",
                 zone_col: str = "zone") -> DataFrame:
    """One copy of each row per service zone its ``key`` belongs to."""
    m = members.select(F.col("id").alias(key), F.col("zone").alias(zone_col))
    return df.join(m, key, "inner")


#: Service zones in one mask column; a matrix of more zones gets more columns.
MASK_BITS = 62


def _masked_zones(matrix: DataFrame, exclude, id_col: str) -> list[list[str]]:
    zones = [c for c in matrix.columns if c != id_col and c not in set(exclude)]
    return [zones[i:i + MASK_BITS] for i in range(0, len(zones), MASK_BITS)]


def _masks_text(words: list[list[str]], id_col: str) -> str:
    """The query of :func:`zone_masks` over frame ``matrix``."""
    def mask(zones):
        bits = " | ".join(f"CASE WHEN `{z}` = 'Yes' THEN {1 << i}L ELSE 0L END" for i, z in enumerate(zones))
        return f"bit_or({bits})"

    masks = "".join(f", {mask(z)} AS mask{w}" for w, z in enumerate(words))
    return f"SELECT CAST(`{id_col}` AS int) AS id{masks} FROM {{matrix}} WHERE `{id_col}` IS NOT NULL GROUP BY CAST(`{id_col}` AS int)"


def zone_masks(matrix: DataFrame, exclude=(), id_col: str = "ID") -> DataFrame:
    """``(id, mask0, mask1, ...)``: bit i of mask w says whether the id lies in the matrix's service zone
    ``62 w + i`` (``exclude`` left out). Membership is a set: an id on several lines is in the zones of each."""
    return matrix.sparkSession.sql(_masks_text(_masked_zones(matrix, exclude, id_col), id_col), matrix=matrix)


def zone_metrics(od: DataFrame, matrix: DataFrame, exclude=(), keys=("company",), id_col: str = "ID") -> DataFrame:
    """Per month, taxi zone, company and service zone:

    * ``pickups``  -- trips starting at the id (A5 expanded over zones),
    * ``dropoffs`` -- trips ending at the id,
    * ``inbound``  -- trips ending at the id whose pickup is outside the zone (A6).

    A measure is NULL where no trip contributes to it; a NULL pickup is outside every zone.

    Plan: one look-up of each end's mask, one aggregation by month, id and company with a sum for the
    pickups, one for the drop-offs and one for each zone's inbound drop-offs, then the id's set bits
    become rows. An OD row is two rows into the (partial) aggregation, whatever number of zones
    its ends lie in, and nothing is expanded before the sums.
    """
    words = _masked_zones(matrix, exclude, id_col)
    at = range(len(words))
    by = ", ".join(["year_month", *keys])

    def side(id_, pick, drop, masks, outside):
        columns = [f"{id_} AS id", f"{pick} AS pick", f"{drop} AS drop"]
        columns += [f"{masks.format(w)} AS in{w}" for w in at] + [f"{outside.format(w)} AS out{w}" for w in at]
        return f"struct({', '.join(columns)})"

    start = side("pulocationid", "count", "CAST(NULL AS bigint)", "pu.mask{0}", "0L")
    end = side("dolocationid", "CAST(NULL AS bigint)", "count", "do.mask{0}", "do.mask{0} & ~coalesce(pu.mask{0}, 0L)")
    bits = [(w, i, z) for w in at for i, z in enumerate(words[w])]
    sums = "".join(f", max(in{w}) AS in{w}" for w in at)
    sums += "".join(f", sum(CASE WHEN out{w} & {1 << i}L != 0 THEN drop END) AS inbound{w}_{i}" for w, i, _ in bits)
    zones = [f"CASE WHEN in{w} & {1 << i}L != 0 THEN struct({literal(z)} AS zone, inbound{w}_{i} AS inbound) END" for w, i, z in bits]
    if not zones:  # no zone, no rows
        zones = ["CAST(NULL AS struct<zone:string,inbound:bigint>)"]
    inside = " OR ".join(f"in{w} != 0" for w in at) or "false"
    masks = _masks_text(words, id_col)
    return sql(od, f"""
        SELECT {by}, id, zone, pickups, dropoffs, inbound
        FROM (SELECT {by}, id, pickups, dropoffs, inline(array_compact(array({', '.join(zones)})))
              FROM (SELECT {by}, id, sum(pick) AS pickups, sum(drop) AS dropoffs{sums}
                    FROM (SELECT {by}, inline(array({start}, {end}))
                          FROM {{df}} LEFT JOIN ({masks}) pu ON pulocationid = pu.id LEFT JOIN ({masks}) do ON dolocationid = do.id)
                    WHERE {inside} GROUP BY {by}, id))""", matrix=matrix)


def inbound(od: DataFrame, matrix: DataFrame, exclude=(), keys=("company",)) -> DataFrame:
    """Drop-offs inside a zone from pickups outside it, per month, id, zone."""
    by = ", ".join(["year_month", "id", *keys])
    return sql(zone_metrics(od, matrix, exclude, keys), f"SELECT {by}, zone, inbound AS count1 FROM {{df}} WHERE inbound IS NOT NULL")


def zone_volume(od: DataFrame, matrix: DataFrame, exclude=(), keys=("company",)) -> DataFrame:
    """Trips touching a zone, per month, taxi zone, company and service zone.

    A trip counts at its pickup when the pickup is inside the zone, else at its
    drop-off. Per key: ``count`` = pickups there, ``count1`` = inbound drop-offs
    from outside, ``volume = count + count1``. A key with inbound drop-offs but no
    pickup that month yields no row (the reference's left join from pickups).

    Plan: a projection of :func:`zone_metrics` -- one read of the OD table, one aggregation --
    instead of two aggregations and a join for every zone.
    """
    by = ", ".join(["year_month", "id", *keys])
    return sql(zone_metrics(od, matrix, exclude, keys), f"""
        SELECT {by}, zone, pickups AS count, coalesce(inbound, 0L) AS count1, pickups + coalesce(inbound, 0L) AS volume
        FROM {{df}} WHERE pickups IS NOT NULL""")

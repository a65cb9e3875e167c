"""Zone imbalance (Q6): pick-ups against drop-offs per (hour, zone).

Default plan (one pass): every trip is stacked into two rows - (hour,
pick-up zone, 1, 0) and (hour, drop-off zone, 0, 1) - and summed.  Partial
aggregation runs before the shuffle, so the doubled rows never cross the
network and a hot zone is one row per task.  This replaces the
reference's two aggregates and full outer join with one shuffle.  The
two-branch forms (full outer join; union of keys + two left joins) are
kept as variants for equivalence tests.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tripscope.functions.columns import zone_role
from tripscope.operators.quality import activity_filter

OUT = [
    "pickup_hour",
    "location_id",
    "borough",
    "zone",
    "pickups",
    "dropoffs",
    "activity",
    "net_pickups",
    "imbalance_ratio",
    "abs_imbalance_ratio",
]


def _counts_one_pass(t: DataFrame, hour_col: str) -> DataFrame:
    sides = F.explode(
        F.array(
            F.struct(F.col("pu_location_id").alias("location_id"), F.lit(1).alias("p"), F.lit(0).alias("d")),
            F.struct(F.col("do_location_id").alias("location_id"), F.lit(0).alias("p"), F.lit(1).alias("d")),
        )
    ).alias("s")
    stacked = t.select(F.col(hour_col).alias("pickup_hour"), sides).select("pickup_hour", "s.*")
    return stacked.groupBy("pickup_hour", "location_id").agg(
        F.sum("p").cast("long").alias("pickups"), F.sum("d").cast("long").alias("dropoffs")
    )


def _counts_full_outer(t: DataFrame, hour_col: str) -> DataFrame:
    pu = t.groupBy(F.col(hour_col).alias("pickup_hour"), F.col("pu_location_id").alias("location_id")).agg(
        F.count(F.lit(1)).alias("pickups")
    )
    do = t.groupBy(F.col(hour_col).alias("pickup_hour"), F.col("do_location_id").alias("location_id")).agg(
        F.count(F.lit(1)).alias("dropoffs")
    )
    # Fill only the two counts: filling the keys would turn a NULL zone into 0.
    return pu.join(do, ["pickup_hour", "location_id"], "full").na.fill(0, subset=["pickups", "dropoffs"])


def _counts_union(t: DataFrame, hour_col: str) -> DataFrame:
    pu = t.groupBy(F.col(hour_col).alias("pickup_hour"), F.col("pu_location_id").alias("location_id")).agg(
        F.count(F.lit(1)).alias("pickups")
    )
    do = t.groupBy(F.col(hour_col).alias("pickup_hour"), F.col("do_location_id").alias("location_id")).agg(
        F.count(F.lit(1)).alias("dropoffs")
    )
    keys = pu.select("pickup_hour", "location_id").union(do.select("pickup_hour", "location_id")).distinct()
    joined = keys.join(pu, ["pickup_hour", "location_id"], "left").join(do, ["pickup_hour", "location_id"], "left")
    return joined.select(
        "pickup_hour",
        "location_id",
        F.coalesce("pickups", F.lit(0)).alias("pickups"),
        F.coalesce("dropoffs", F.lit(0)).alias("dropoffs"),
    )


def rounded_ratio(num: Column, den: Column, digits: int) -> Column:
    """num / den rounded half away from zero to ``digits`` decimals, in
    exact integer arithmetic (no binary-double tie cases); 0 if den is 0."""
    scale = 10**digits
    a = F.abs(num) * (2 * scale) + den
    b = den * 2
    # exact integer floor(a / b): a - pmod(a, b) is a multiple of b
    q = ((a - F.pmod(a, b)) / b).cast("long")
    signed = F.when(num < 0, -q).otherwise(q)  # integral: never a negative zero
    return F.when(den > 0, signed.cast("double") / F.lit(float(scale))).otherwise(F.lit(0.0))


def _metrics(counts: DataFrame, zones: DataFrame, min_activity: int, digits: int | None) -> DataFrame:
    p, d = F.col("pickups"), F.col("dropoffs")
    m = counts.withColumns({"activity": p + d, "net_pickups": p - d})
    if digits is None:
        ratio = F.when(F.col("activity") > 0, F.col("net_pickups") / F.col("activity")).otherwise(F.lit(0.0))
        m = m.withColumn("imbalance_ratio", ratio).withColumn("abs_imbalance_ratio", F.abs("imbalance_ratio"))
    else:
        m = m.withColumn("imbalance_ratio", rounded_ratio(F.col("net_pickups"), F.col("activity"), digits))
        m = m.withColumn("abs_imbalance_ratio", F.abs("imbalance_ratio"))
    z = zone_role(zones, "of").withColumnsRenamed({"of_borough": "borough", "of_zone": "zone"})
    named = m.where(F.col("activity") >= min_activity).join(z, F.col("location_id") == F.col("of_id"))
    return named.select(*OUT)


def zone_imbalance(
    trips: DataFrame,
    zones: DataFrame,
    min_activity: int = 30,
    method: str = "one_pass",
    hour_col: str = "pickup_hour",
) -> DataFrame:
    """Per (pick-up hour, zone) with activity >= ``min_activity``: pickups,
    dropoffs (both at the pick-up hour), activity, net, ratio net/activity
    (0 without activity), absolute ratio, zone names (inner join)."""
    t = activity_filter(trips)
    counts = {"one_pass": _counts_one_pass, "full_outer": _counts_full_outer, "union": _counts_union}[method](
        t, hour_col
    )
    return _metrics(counts, zones, min_activity, None)


def zone_imbalance_union(
    trips: DataFrame, zones: DataFrame, min_activity: int = 30, digits: int = 4, hour_col: str = "pickup_hour"
) -> DataFrame:
    """The SQL form: union of keys, two left joins, ratios rounded."""
    return _metrics(_counts_union(activity_filter(trips), hour_col), zones, min_activity, digits)


#: The imbalance as one chain of common table expressions; ``{trips}`` and
#: ``{zones}`` are DataFrame arguments.  A duration above 0 implies both times.
ZONE_IMBALANCE_SQL = """
WITH valid AS (
  SELECT pickup_hour, pu_location_id, do_location_id FROM {trips} WHERE duration_minutes > 0 AND total_amount > 0),
sides AS (
  SELECT pickup_hour, stack(2, pu_location_id, 1, 0, do_location_id, 0, 1) AS (location_id, p, d) FROM valid),
counts AS (
  SELECT pickup_hour, location_id, sum(p) AS pickups, sum(d) AS dropoffs FROM sides GROUP BY pickup_hour, location_id),
active AS (
  SELECT *, pickups + dropoffs AS activity, pickups - dropoffs AS net_pickups FROM counts
  WHERE pickups + dropoffs >= :min_activity),
rated AS (
  SELECT *, CASE WHEN activity > 0 THEN net_pickups / activity ELSE 0D END AS imbalance_ratio FROM active)
SELECT pickup_hour, location_id, Borough AS borough, Zone AS zone, pickups, dropoffs, activity, net_pickups, imbalance_ratio,
       abs(imbalance_ratio) AS abs_imbalance_ratio
FROM rated JOIN {zones} ON location_id = LocationID
"""


def zone_imbalance_sql(trips: DataFrame, zones: DataFrame, min_activity: int = 30) -> DataFrame:
    """``zone_imbalance`` through the SQL surface."""
    return trips.sparkSession.sql(ZONE_IMBALANCE_SQL, args={"min_activity": min_activity}, trips=trips, zones=zones)


_NET = ["pickup_hour", "borough", "zone", "pickups", "dropoffs", "net_pickups"]


def top_surplus(found: DataFrame, k: int = 5) -> DataFrame:
    """Of ``zone_imbalance``'s rows the top k by net pick-ups (surplus of demand)."""
    return found.orderBy(F.desc("net_pickups"), *_NET[:-1], "location_id").limit(k).select(*_NET)


def top_deficit(found: DataFrame, k: int = 5) -> DataFrame:
    """Bottom k by net pick-ups (taxis piling up)."""
    return found.orderBy(F.asc("net_pickups"), *_NET[:-1], "location_id").limit(k).select(*_NET)


def top_ratio(found: DataFrame, k: int = 5) -> DataFrame:
    """Top k by absolute imbalance ratio."""
    cols = ["pickup_hour", "borough", "zone", "activity", "net_pickups", "abs_imbalance_ratio"]
    return found.orderBy(F.desc("abs_imbalance_ratio"), *cols[:-1], "location_id").limit(k).select(*cols)


def by_hour(found: DataFrame, digits: int | None = None) -> DataFrame:
    """Per hour: sum of |net| and mean absolute ratio (of the raw ratios;
    ``digits`` rounds the mean, as the reference prints it to 4)."""
    mean_ratio = F.try_divide(F.sum("abs_imbalance_ratio"), F.count("abs_imbalance_ratio"))
    if digits is not None:
        mean_ratio = F.round(mean_ratio, digits)
    return (
        found.groupBy("pickup_hour")
        .agg(
            F.sum(F.abs("net_pickups")).alias("total_abs_net_pickups"),
            mean_ratio.alias("mean_abs_imbalance_ratio"),
        )
        .orderBy(F.desc("total_abs_net_pickups"), "pickup_hour")
    )


def imbalance_top_surplus(trips: DataFrame, zones: DataFrame, min_activity: int = 30, k: int = 5) -> DataFrame:
    return top_surplus(zone_imbalance(trips, zones, min_activity), k)


def imbalance_top_deficit(trips: DataFrame, zones: DataFrame, min_activity: int = 30, k: int = 5) -> DataFrame:
    return top_deficit(zone_imbalance(trips, zones, min_activity), k)


def imbalance_top_ratio(trips: DataFrame, zones: DataFrame, min_activity: int = 30, k: int = 5) -> DataFrame:
    return top_ratio(zone_imbalance(trips, zones, min_activity), k)


def imbalance_by_hour(
    trips: DataFrame, zones: DataFrame, min_activity: int = 30, digits: int | None = None
) -> DataFrame:
    return by_hour(zone_imbalance(trips, zones, min_activity), digits)

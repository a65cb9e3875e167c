"""Payment mix, card against cash, vendors (Q4).

All are one aggregate over at most hours x payment codes (or vendors)
groups with map-side partial aggregation; the share within an hour is a
window over those few aggregated rows, partitioned by hour.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tripscope.functions.columns import PAYMENT_LABELS, maybe_round, mean, ratio, stored_seconds

CARD, CASH = 1, 2


def _paid_trips(trips: DataFrame, with_duration: bool) -> DataFrame:
    cond = (
        (F.col("trip_distance") > 0)
        & (F.col("fare_amount") > 0)
        & (F.col("total_amount") > 0)
        & F.col("payment_type").isin(CARD, CASH)
        & F.col("pickup_hour").isNotNull()
    )
    if with_duration:
        cond = cond & (F.col("duration_minutes") > 0)
    return trips.where(cond)


def payment_trips(trips: DataFrame) -> DataFrame:
    """The trips that the payment mix counts."""
    return _paid_trips(trips, with_duration=True)


def payment_label(labels: Mapping[int, str] = PAYMENT_LABELS) -> Column:
    """The label of ``payment_type``; NULL for a code without one."""
    codes = iter(labels.items())
    code, name = next(codes)
    label = F.when(F.col("payment_type") == code, name)
    for code, name in codes:
        label = label.when(F.col("payment_type") == code, name)
    return label


def tip_rate(tip: str = "tip_amount", fare: str = "fare_amount") -> Column:
    return ratio(F.col(tip), F.col(fare))


def payment_mix_by_hour(
    trips: DataFrame,
    labels: Mapping[int, str] = PAYMENT_LABELS,
    digits: bool = False,
    rate_digits: int | None = None,
) -> DataFrame:
    """Per (hour, payment method): trips, share in the hour, mean fare,
    total, tip, mean per-trip tip/fare, share of zero tips, mean distance,
    mean duration.  ``digits=True`` rounds every measure as the reference
    prints (2 or 4); ``rate_digits`` rounds only the mean of per-trip
    ratios, the one measure that is not a ratio of exact sums."""
    t = payment_trips(trips)
    dur = stored_seconds(trips.columns)
    g = t.groupBy("pickup_hour", "payment_type").agg(
        F.count(F.lit(1)).alias("trips"),
        mean("fare_amount").alias("avg_fare_amount"),
        mean("total_amount").alias("avg_total_amount"),
        mean("tip_amount").alias("avg_tip_amount"),
        ratio(F.sum(tip_rate()), F.count(tip_rate())).alias("tip_rate"),
        ratio(F.count_if(F.col("tip_amount") == 0), F.count(F.lit(1))).alias("zero_tip_share"),
        mean("trip_distance").alias("avg_trip_distance"),
        (mean(dur) / F.lit(60.0)).alias("avg_duration_minutes"),
    )
    share = ratio(F.col("trips"), F.sum("trips").over(Window.partitionBy("pickup_hour")))
    r2, r4 = (2, 4) if digits else (None, None)
    rate = r4 if digits else rate_digits
    return g.select(
        "pickup_hour",
        payment_label(labels).alias("payment_method"),
        "trips",
        maybe_round(share, r4).alias("payment_share_in_hour"),
        maybe_round(F.col("avg_fare_amount"), r2).alias("avg_fare_amount"),
        maybe_round(F.col("avg_total_amount"), r2).alias("avg_total_amount"),
        maybe_round(F.col("avg_tip_amount"), r2).alias("avg_tip_amount"),
        maybe_round(F.col("tip_rate"), rate).alias("tip_rate"),
        maybe_round(F.col("zero_tip_share"), r4).alias("zero_tip_share"),
        maybe_round(F.col("avg_trip_distance"), r2).alias("avg_trip_distance"),
        maybe_round(F.col("avg_duration_minutes"), r2).alias("avg_duration_minutes"),
    ).orderBy("pickup_hour", "payment_method")


def _is(code: int) -> Column:
    return F.col("payment_type") == code


def _card_cash_aggs(rate_digits: int | None = None) -> list[Column]:
    card_n = F.count_if(_is(CARD))
    return [
        card_n.alias("card_trips"),
        F.count_if(_is(CASH)).alias("cash_trips"),
        ratio(card_n, F.count(F.lit(1))).alias("card_share"),
        mean(F.when(_is(CARD), F.col("total_amount"))).alias("avg_total_card"),
        mean(F.when(_is(CASH), F.col("total_amount"))).alias("avg_total_cash"),
        mean(F.when(_is(CARD), F.col("fare_amount"))).alias("avg_fare_card"),
        mean(F.when(_is(CASH), F.col("fare_amount"))).alias("avg_fare_cash"),
        maybe_round(
            ratio(F.sum(F.when(_is(CARD), tip_rate())), F.count(F.when(_is(CARD), tip_rate()))),
            rate_digits,
        ).alias("avg_tip_rate_card"),
    ]


def card_vs_cash_by_hour(trips: DataFrame, rate_digits: int | None = None) -> DataFrame:
    """Per hour, card and cash side by side (conditional aggregates); no
    duration filter, as in the reference's step 2."""
    return (
        _paid_trips(trips, with_duration=False)
        .groupBy("pickup_hour")
        .agg(*_card_cash_aggs(rate_digits))
        .orderBy("pickup_hour")
    )


def vendor_card_summary(trips: DataFrame, rate_digits: int | None = None) -> DataFrame:
    """Per vendor: card share and mean card tip rate."""
    g = _paid_trips(trips, with_duration=False).groupBy("vendor_id").agg(*_card_cash_aggs(rate_digits))
    return g.select("vendor_id", "card_share", "avg_tip_rate_card").orderBy("vendor_id")


#: The vendor summary as SQL text; ``{trips}`` is a DataFrame argument.
VENDOR_CARD_SQL = """
SELECT vendor_id,
       CAST(count_if(payment_type = 1) AS DOUBLE) / count(*) AS card_share,
       round(try_divide(
         sum(CASE WHEN payment_type = 1 THEN CAST(tip_amount AS DOUBLE) / CAST(fare_amount AS DOUBLE) END),
         count(CASE WHEN payment_type = 1 THEN CAST(tip_amount AS DOUBLE) / CAST(fare_amount AS DOUBLE) END)),
         :digits) AS avg_tip_rate_card
FROM {trips}
WHERE trip_distance > 0 AND fare_amount > 0 AND total_amount > 0
  AND payment_type IN (1, 2) AND pickup_hour IS NOT NULL
GROUP BY vendor_id
ORDER BY vendor_id
"""


def vendor_card_summary_sql(trips: DataFrame, rate_digits: int = 4) -> DataFrame:
    """``vendor_card_summary`` through the SQL surface."""
    return trips.sparkSession.sql(VENDOR_CARD_SQL, args={"digits": rate_digits}, trips=trips)


def vendor_hourly_count(trips: DataFrame, vendor: int = 1, hour: str | Column = "pickup_hour") -> DataFrame:
    """Trips per pick-up hour of one vendor.  ``hour`` is the stored column,
    or an expression for raw rows (``hour_of_text``); rows without an hour
    (an unreadable time) do not count, as preparation drops them."""
    return (
        trips.where(F.col("vendor_id") == vendor)
        .groupBy((F.col(hour) if isinstance(hour, str) else hour).alias("pickup_hour"))
        .agg(F.count(F.lit(1)).alias("trips"))
        .where(F.col("pickup_hour").isNotNull())
        .orderBy("pickup_hour")
    )


def hour_of_text(column: str = "tpep_pickup_datetime", ts_format: str | None = None) -> Column:
    """Hour of a text timestamp; NULL where it does not parse."""
    return F.hour(F.try_to_timestamp(F.col(column), *([F.lit(ts_format)] if ts_format else [])))

"""The SQL surface: temp views over the prepared trips and zones; SQL in
the reference's style gives the DataFrame operators' answers."""

from __future__ import annotations

from pyspark.sql import functions as F

from tests.conftest import SF_MID
from tripscope.operators import demand, flows, prepare
from tripscope.sources.fixtures import trips_raw
from tripscope.sources.store import prepared_trips, register_views, zone_table


def test_sql_over_views_equals_operators(spark):
    register_views(spark, SF_MID)
    sql_counts = spark.sql(
        """
        SELECT pu.Borough AS pu_borough, d.Borough AS do_borough, COUNT(*) AS trips
        FROM trips t JOIN zones pu ON t.pu_location_id = pu.LocationID
                     JOIN zones d ON t.do_location_id = d.LocationID
        WHERE duration_minutes > 0 AND trip_distance > 0 AND total_amount > 0
        GROUP BY pu.Borough, d.Borough
        """
    )
    df_counts = flows.region_flow_counts(prepared_trips(spark, SF_MID), zone_table(spark, SF_MID), "merge")
    assert sql_counts.exceptAll(df_counts).count() == 0 and df_counts.exceptAll(sql_counts).count() == 0

    by_day = spark.sql(
        """
        SELECT pickup_day, pickup_hour, COUNT(*) AS trips,
               COUNT(*) * 100.0 / SUM(COUNT(*)) OVER () AS share
        FROM trips WHERE pickup_hour BETWEEN 3 AND 6
        GROUP BY pickup_day, pickup_hour ORDER BY trips DESC, pickup_day, pickup_hour LIMIT 12
        """
    ).select("pickup_day", "pickup_hour", "trips")
    ours = demand.demand_profile_by_day(spark.table("trips"), (3, 6), k=None).select(
        "pickup_day", "pickup_hour", "trips"
    )
    top = ours.orderBy(F.desc("trips"), "pickup_day", "pickup_hour").limit(12)
    assert by_day.exceptAll(top).count() == 0


def test_metrics_record_labels(spark):
    m = prepare.prepare_metrics(
        trips_raw(spark, SF_MID), dataset="trips_sf0.01", partition_column="pickup_day"
    ).collect()[0]
    assert m.dataset == "trips_sf0.01" and m.partition_column == "pickup_day"
    assert m.raw_rows == m.processed_rows + m.dropped_rows == 60000

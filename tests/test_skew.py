"""A segment holding every sale (the extreme of a hot key), spread over many input
partitions: all quantile methods agree, and the sketch path's first level is keyed by
map-task salt, so the hot segment is split across reducers."""

from pyspark.sql import functions as F

from pricelens.operators import market as MKT
from pricelens.plans import daily as P
from tests.conftest import SF_SMALL


def test_one_hot_segment(spark):
    sales = P.formatted_sales(spark, SF_SMALL)
    hot = sales.withColumns({"commune_code": F.lit("01000"), "commune_name": F.lit("HOT"),
                             "department_code": F.lit("0"), "property_type": F.lit("Apartment"),
                             "rooms_bucket": F.lit("3 rooms")}).repartition(24)
    results = {m: MKT.segment_stats(hot, method=m).collect() for m in ("sketch", "approx", "exact")}
    assert all(len(rows) == 1 for rows in results.values())
    assert results["sketch"] == results["approx"] == results["exact"]
    assert results["exact"][0].transaction_count == sales.count()
    salted = hot.withColumn("_salt", F.spark_partition_id() % MKT.SALT_BUCKETS)
    assert salted.select("_salt").distinct().count() == 24  # one salt per map task

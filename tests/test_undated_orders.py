import oracle
from pyspark.sql import functions as F

SF_DIR = "/root/testdata/sf0.001"


def test_orders_without_a_date_are_loaded(spark, tmp_path):
    """The yearly loads hold every order, in the query and in its SQL."""
    orders = spark.read.parquet(f"{SF_DIR}/orders.parquet").limit(40)
    undated = orders.withColumn("o_orderdate", F.when(F.col("o_orderkey") % 3 != 0, F.col("o_orderdate")))
    undated.write.parquet(str(tmp_path / "orders.parquet"))
    connection = oracle.duckdb.connect()
    connection.execute(f"CREATE VIEW orders AS SELECT * FROM '{tmp_path}/orders.parquet/*.parquet'")
    for name in ("time_travel_counts", "snapshot_log"):
        assert oracle.differences(spark, connection, name, str(tmp_path)) == []
    counts = oracle.ENTRIES["time_travel_counts"].run(spark, str(tmp_path))
    assert counts.agg(F.max("row_count")).first()[0] == 40

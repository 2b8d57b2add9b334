from __future__ import annotations

from pyspark.sql import functions as F

from siltbed.operators import history
from siltbed.operators.as_of import as_of_join
from siltbed.plans.prices import read_history, record_history
from siltbed.registry.core import given, instant, plain_time, query
from siltbed.session import work_dir
from siltbed.sources.tables import VersionedTable

KEYS = ["o_orderkey", "o_orderdate"]
CHECKS = ["o_totalprice", "o_orderstatus"]
FIRST, SECOND, THIRD = "2026-01-05T08:00:00Z", "2026-02-05T08:00:00Z", "2026-03-05T08:00:00Z"


def load(spark, sf_dir, at: str):
    """Orders as the first load brings them, or the corrections of the second.

    Pending orders get another price, and those of one priority lose their
    status, a value that turns NULL.
    """
    orders = given(spark, sf_dir, "orders").select(*KEYS, *CHECKS, "o_orderpriority")
    if at != FIRST:
        orders = (
            orders.filter("o_orderstatus = 'P' OR o_orderpriority = '1-URGENT'")
            .withColumn("o_totalprice", F.col("o_totalprice") + F.when(F.col("o_orderstatus") == "P", 1).otherwise(0))
            .withColumn(
                "o_orderstatus", F.when(F.col("o_orderpriority") != "1-URGENT", F.col("o_orderstatus"))
            )
        )
    return orders.select("*", instant(at).alias("ingestion_timestamp"))


def staged(spark, sf_dir, *times: str):
    frames = [load(spark, sf_dir, at) for at in times]
    for frame in frames[1:]:
        frames[0] = frames[0].unionByName(frame)
    return history.latest_load(frames[0], KEYS, "ingestion_timestamp", CHECKS)


def two_runs(spark, sf_dir):
    first = history.first_load(staged(spark, sf_dir, FIRST), KEYS, instant(FIRST))
    return history.apply_changes(first, staged(spark, sf_dir, FIRST, SECOND), KEYS, CHECKS, instant(SECOND))


def shown(df):
    return plain_time(df, "updated_at", "valid_from", "valid_to", "ingestion_timestamp")


VERSIONS = """
    WITH times AS (SELECT TIMESTAMP '2026-01-05 08:00:00' AS t1, TIMESTAMP '2026-02-05 08:00:00' AS t2),
    versions AS (
        SELECT o_orderkey, o_orderdate, o_totalprice, o_orderstatus, o_orderpriority, t1 AS ingestion_timestamp,
               t1 AS valid_from,
               CASE WHEN o_orderstatus = 'P' OR o_orderpriority = '1-URGENT' THEN t2 END AS valid_to
        FROM orders, times
        UNION ALL
        SELECT o_orderkey, o_orderdate, CASE WHEN o_orderstatus = 'P' THEN o_totalprice + 1 ELSE o_totalprice END,
               CASE WHEN o_orderpriority <> '1-URGENT' THEN o_orderstatus END, o_orderpriority, t2, t2, NULL
        FROM orders, times WHERE o_orderstatus = 'P' OR o_orderpriority = '1-URGENT'),
    history AS (
        SELECT sha256(concat_ws('|', o_orderkey::VARCHAR, o_orderdate::VARCHAR,
                      strftime(valid_from, '%Y-%m-%d %H:%M:%S.%f'))) AS scd_id,
               valid_from AS updated_at, valid_from, valid_to, o_orderkey, o_orderdate, o_totalprice,
               o_orderstatus, o_orderpriority, ingestion_timestamp
        FROM versions)
"""


@query(
    "scd2_first_load",
    """
    SELECT sha256(concat_ws('|', o_orderkey::VARCHAR, o_orderdate::VARCHAR, '2026-01-05 08:00:00.000000')) AS scd_id,
           TIMESTAMP '2026-01-05 08:00:00' AS updated_at, TIMESTAMP '2026-01-05 08:00:00' AS valid_from,
           CAST(NULL AS TIMESTAMP) AS valid_to, o_orderkey, o_orderdate, o_totalprice, o_orderstatus,
           o_orderpriority, TIMESTAMP '2026-01-05 08:00:00' AS ingestion_timestamp
    FROM orders
    """,
)
def scd2_first_load(spark, sf_dir):
    return shown(history.first_load(staged(spark, sf_dir, FIRST), KEYS, instant(FIRST)))


@query("scd2_apply", VERSIONS + "SELECT * FROM history")
def scd2_apply(spark, sf_dir):
    """First load and corrections; changed keys have a closed and an open version."""
    return shown(two_runs(spark, sf_dir))


@query("scd2_rerun_idempotent", VERSIONS + "SELECT * FROM history")
def scd2_rerun_idempotent(spark, sf_dir):
    """A third run over the same loads changes nothing."""
    source = staged(spark, sf_dir, FIRST, SECOND)
    again = history.apply_changes(two_runs(spark, sf_dir), source, KEYS, CHECKS, instant(THIRD))
    return shown(again)


@query("scd2_late_load", VERSIONS + "SELECT * FROM history")
def scd2_late_load(spark, sf_dir):
    """The first load arrives again after the corrections; its older records reopen nothing."""
    late = staged(spark, sf_dir, FIRST)
    again = history.apply_changes(
        two_runs(spark, sf_dir), late, KEYS, CHECKS, instant(THIRD), "ingestion_timestamp"
    )
    return shown(again)


@query("scd2_current", VERSIONS + "SELECT * FROM history WHERE valid_to IS NULL")
def scd2_current(spark, sf_dir):
    return shown(history.current(two_runs(spark, sf_dir)))


@query(
    "scd2_history_lookup",
    VERSIONS
    + """
    SELECT o_orderkey, o_orderdate, o_totalprice, o_orderstatus, valid_from, valid_to FROM history
    WHERE o_orderpriority = '1-URGENT' AND o_orderdate = TIMESTAMP '1995-06-06'
    """,
)
def scd2_history_lookup(spark, sf_dir):
    """All versions of the keys of one priority and day, oldest first."""
    found = two_runs(spark, sf_dir).filter(
        (F.col("o_orderpriority") == "1-URGENT")
        & (F.col("o_orderdate") == F.lit("1995-06-06").cast("timestamp_ntz"))
    )
    columns = ["o_orderkey", "o_orderdate", "o_totalprice", "o_orderstatus", "valid_from", "valid_to"]
    return shown(found).select(*columns).orderBy("o_orderkey", "valid_from")


@query(
    "scd2_as_of",
    VERSIONS
    + """
    SELECT 'before' AS moment, o_orderkey, o_totalprice, o_orderstatus FROM history
    WHERE valid_from <= TIMESTAMP '2026-02-05 07:59:59'
      AND (valid_to IS NULL OR valid_to > TIMESTAMP '2026-02-05 07:59:59')
    UNION ALL
    SELECT 'after', o_orderkey, o_totalprice, o_orderstatus FROM history
    WHERE valid_from <= TIMESTAMP '2026-02-05 08:00:00'
      AND (valid_to IS NULL OR valid_to > TIMESTAMP '2026-02-05 08:00:00')
    """,
)
def scd2_as_of(spark, sf_dir):
    """Values valid just before and at the instant of the correction."""
    versions = two_runs(spark, sf_dir)
    names = ["o_orderkey", "o_totalprice", "o_orderstatus"]
    before = history.as_of(versions, instant("2026-02-05T07:59:59Z")).select(F.lit("before").alias("moment"), *names)
    after = history.as_of(versions, instant(SECOND)).select(F.lit("after").alias("moment"), *names)
    return before.unionByName(after)


@query("scd2_stored", VERSIONS + "SELECT * FROM history")
def scd2_stored(spark, sf_dir):
    """The same history kept in a table by order year.

    The second run brings corrections only, and reads and writes the open
    versions of their years; the third brings them again.
    """
    table = VersionedTable(spark, work_dir(spark, "order-history"))
    year = F.date_format("o_orderdate", "yyyy")
    for at, run_at in ((FIRST, FIRST), (SECOND, SECOND), (SECOND, THIRD)):
        rows = load(spark, sf_dir, at)
        newest = history.latest_load(rows, KEYS, "ingestion_timestamp", CHECKS)
        record_history(table, newest, instant(run_at), KEYS, CHECKS, year, rows)
    return shown(read_history(table))


REPLAYED = """
    WITH states AS (
        SELECT user_id, ts, max(event_type) AS event_type FROM events GROUP BY user_id, ts),
    changes AS (
        SELECT * FROM (SELECT *, lag(event_type) OVER (PARTITION BY user_id ORDER BY ts) AS before,
                              row_number() OVER (PARTITION BY user_id ORDER BY ts) AS n FROM states)
        WHERE n = 1 OR before IS DISTINCT FROM event_type)
    SELECT sha256(concat_ws('|', user_id::VARCHAR, strftime(ts, '%Y-%m-%d %H:%M:%S.%f'))) AS scd_id,
           user_id, event_type, ts AS valid_from, lead(ts) OVER (PARTITION BY user_id ORDER BY ts) AS valid_to
    FROM changes
"""


@query("scd2_replay", REPLAYED)
def scd2_replay(spark, sf_dir):
    """All versions of every user's last event type, built from all events at once."""
    return history.replay(given(spark, sf_dir, "events"), ["user_id"], ["event_type"], "ts")


def stored(versions):
    """History as it lies between two loads."""
    folder = work_dir(versions.sparkSession, "history")
    versions.write.parquet(folder)
    return versions.sparkSession.read.schema(versions.schema).parquet(folder)


@query("scd2_out_of_order", REPLAYED)
def scd2_out_of_order(spark, sf_dir):
    """The same from three loads in the wrong order: two thirds of the events come late, and land in the past."""
    events = given(spark, sf_dir, "events")
    third = F.pmod(F.coalesce("event_id", F.lit(0)), F.lit(3))
    first, second, last = (events.filter(third == n) for n in (1, 2, 0))
    versions = stored(history.replay(first, ["user_id"], ["event_type"], "ts"))
    versions = stored(history.insert_late(versions, second, first, ["user_id"], ["event_type"], "ts"))
    return history.insert_late(versions, last, first.unionByName(second), ["user_id"], ["event_type"], "ts")


@query(
    "as_of_join",
    """
    SELECT f.l_orderkey, f.l_linenumber, f.l_partkey, f.l_shipdate, v.since, v.discount
    FROM (SELECT * FROM lineitem WHERE l_returnflag IS DISTINCT FROM 'R') f
    ASOF LEFT JOIN (SELECT l_partkey, l_shipdate AS since, max(l_discount) AS discount
                    FROM lineitem WHERE l_returnflag = 'R' GROUP BY ALL) v
    ON f.l_partkey = v.l_partkey AND f.l_shipdate >= v.since
    """,
)
def as_of_join_query(spark, sf_dir):
    """Every line with the discount of its part's last returned line at that time."""
    lines = given(spark, sf_dir, "lineitem")
    returned = lines.filter("l_returnflag = 'R'").select("l_partkey", "l_shipdate", "l_discount")
    facts = lines.filter("NOT l_returnflag <=> 'R'").select("l_orderkey", "l_linenumber", "l_partkey", "l_shipdate")
    columns = {"since": "l_shipdate", "discount": "l_discount"}
    return as_of_join(facts, returned, ["l_partkey"], "l_shipdate", "l_shipdate", columns, bucket="quarter")

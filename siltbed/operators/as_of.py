"""Looking up, for every fact, the version of its key at the fact's time."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def as_of_join(
    facts: DataFrame,
    versions: DataFrame,
    keys: list[str],
    at: str,
    valid_from: str,
    columns: dict[str, str],
    valid_to: str | None = None,
    bucket: str = "day",
    forward: bool = False,
    exact: bool = True,
) -> DataFrame:
    """The facts with columns (new name -> column) of the last version that begins no later than ``at``.

    With ``valid_to`` a version that has ended by then gives NULLs, like no version
    at all. ``forward`` takes the first version that begins no earlier; without
    ``exact`` one that begins at the very instant does not count. Of versions that
    begin together the one with the largest columns counts. Equal keys may be NULL;
    a fact without a time has no version, a version without a start is none.

    Facts and versions go through one sort per key and time bucket, so no task
    holds a whole key, and no version is compared with a fact. What was valid when a
    bucket begins is found from one row per key and bucket, and joins the sort as
    one more version.
    """
    taken = [valid_from, *columns.values(), *([valid_to] if valid_to else [])]
    version = F.struct(*[F.col(name).alias(f"v{n}") for n, name in enumerate(taken)])

    def unit(time: str):
        return F.date_trunc(bucket, F.col(time)).alias("_bucket")

    given = versions.filter(F.col(valid_from).isNotNull()).select(*keys, unit(valid_from), version.alias("_version"))
    asked = facts.select(*keys, unit(at)).distinct()
    # The version of a bucket that the buckets beyond it see; of those that begin together the largest.
    starts = given
    if forward:
        starts = given.groupBy(*keys, "_bucket", F.col("_version.v0").alias("_at")).agg(F.max("_version").alias("_version"))
    marks = (
        starts.groupBy(*keys, "_bucket")
        .agg((F.min if forward else F.max)("_version").alias("_version"))
        .withColumn("_asked", F.lit(False))
        .unionByName(
            asked.withColumn("_version", F.lit(None).cast(given.schema["_version"].dataType)).withColumn("_asked", F.lit(True))
        )
        .groupBy(*keys, "_bucket")
        .agg(F.max("_version").alias("_version"), F.bool_or("_asked").alias("_asked"))
    )
    # Without a time there is no bucket before or after.
    known = marks.filter(F.col("_bucket").isNotNull())
    order = F.col("_bucket").desc() if forward else F.col("_bucket").asc()
    before = Window.partitionBy(*keys).orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
    carried = (
        known.withColumn("_carried", F.last("_version", ignorenulls=True).over(before))
        .filter(F.col("_asked") & F.col("_carried").isNotNull())
        .select(*keys, "_bucket", F.col("_carried").alias("_version"))
    )
    fact = F.struct(*[F.col(f"`{c}`").alias(f"f{n}") for n, c in enumerate(facts.columns)])
    nothing = F.lit(None)
    # At one instant versions come before facts if they count there.
    place = 1 if exact else 3
    time_type = facts.schema[at].dataType
    fact_type = facts.select(fact.alias("f")).schema["f"].dataType
    version_type = given.schema["_version"].dataType
    stream = (
        carried.select(*keys, "_bucket", nothing.cast(time_type).alias("_at"), F.lit(0).alias("_place"), "_version", nothing.cast(fact_type).alias("_fact"))
        .unionByName(
            given.select(*keys, "_bucket", F.col("_version.v0").cast(time_type).alias("_at"), F.lit(place).alias("_place"), "_version", nothing.cast(fact_type).alias("_fact"))
        )
        .unionByName(
            facts.select(*keys, unit(at), F.col(at).alias("_at"), F.lit(2).alias("_place"), nothing.cast(version_type).alias("_version"), fact.alias("_fact"))
        )
    )
    # What is carried in stands before all of its bucket.
    time = F.col("_at").desc_nulls_first() if forward else F.col("_at").asc_nulls_first()
    sorted_ = Window.partitionBy(*keys, "_bucket").orderBy(F.col("_place") > 0, time, "_place", "_version")
    seen = F.last("_version", ignorenulls=True).over(sorted_.rowsBetween(Window.unboundedPreceding, 0))
    found = stream.withColumn("_seen", seen).filter(F.col("_fact").isNotNull())
    valid = F.lit(True)
    if valid_to:
        end = F.col(f"_seen.v{len(taken) - 1}")
        valid = end.isNull() | (F.col("_at") < end)
    return found.select(
        *[F.col(f"_fact.f{n}").alias(c) for n, c in enumerate(facts.columns)],
        *[F.when(valid, F.col(f"_seen.v{n}")).alias(name) for n, name in enumerate(columns, start=1)],
    )

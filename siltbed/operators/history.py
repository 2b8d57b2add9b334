"""Type-2 history: every version of a key with the interval it was valid in."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from siltbed.operators.merge import join_on, latest_per_key

META = ["scd_id", "updated_at", "valid_from", "valid_to"]


def version_id(keys: list[str], valid_from: Column) -> Column:
    """Hash that is unique per version of a key; NULL differs from an empty key."""
    parts = [F.coalesce(F.col(k).cast("string"), F.lit("\\N")) for k in keys]
    stamp = F.date_format(valid_from, "yyyy-MM-dd HH:mm:ss.SSSSSS")
    return F.sha2(F.concat_ws("|", *parts, stamp), 256)


def latest_load(staged: DataFrame, keys: list[str], at: str, ties: list[str]) -> DataFrame:
    """Only the newest staged record of a key.

    Staging keeps all loads. Comparing an older load with the open version
    would reopen the value that a correction replaced.
    """
    return latest_per_key(staged, keys, at, ties)


def _open(df: DataFrame, keys: list[str], run_at: Column) -> DataFrame:
    return df.select(
        version_id(keys, run_at).alias("scd_id"),
        run_at.alias("updated_at"),
        run_at.alias("valid_from"),
        F.nullif(run_at, run_at).alias("valid_to"),
        *df.columns,
    )


def first_load(source: DataFrame, keys: list[str], run_at: Column) -> DataFrame:
    """History of a first run: every record is open from the run on."""
    return _open(source, keys, run_at)


def _is_different(checks: list[str]) -> Column:
    different = F.lit(False)
    for name in checks:
        different = different | ~F.col(f"_old.{name}").eqNullSafe(F.col(f"_new.{name}"))
    return different


def current(history: DataFrame) -> DataFrame:
    return history.filter(F.col("valid_to").isNull())


def closed(history: DataFrame) -> DataFrame:
    return history.filter(F.col("valid_to").isNotNull())


def as_of(history: DataFrame, at: Column) -> DataFrame:
    """The version of every key that was valid at an instant."""
    return history.filter((F.col("valid_from") <= at) & (F.col("valid_to").isNull() | (at < F.col("valid_to"))))


def advance(
    open_rows: DataFrame,
    source: DataFrame,
    keys: list[str],
    checks: list[str],
    run_at: Column,
    loaded_at: str | None = None,
) -> DataFrame:
    """Open versions after a run, together with those the run closes.

    ``source`` holds one row per key. A key with a changed check column gives
    two rows, the closed and the new version; every other key gives one. Keys
    missing from the source stay open. One join on the key; both sides are
    unique in it, so no key is hot. A NULL in a key is a value like any other.

    With ``loaded_at``, the column that dates a record, an older record than the
    open version's is a late arrival and changes nothing.
    """
    names = source.columns
    old = open_rows.select(F.struct(*META, *names).alias("_old"), *[F.col(k).alias(f"_ok_{k}") for k in keys])
    new = _open(source, keys, run_at).select(
        F.struct(*META, *names).alias("_new"), *[F.col(k).alias(f"_nk_{k}") for k in keys]
    )
    matched = [F.col(f"_ok_{k}").eqNullSafe(F.col(f"_nk_{k}")) for k in keys]
    both = old.join(new, matched, "full_outer")
    late = F.lit(False)
    if loaded_at is not None:
        late = F.coalesce(F.col(f"_new.{loaded_at}") < F.col(f"_old.{loaded_at}"), F.lit(False))
    closing = F.col("_old").withField("valid_to", F.col("_new.valid_from"))
    versions = (
        F.when(F.col("_old").isNull(), F.array("_new"))
        .when(F.col("_new").isNull() | ~_is_different(checks) | late, F.array("_old"))
        .otherwise(F.array(closing, F.col("_new")))
    )
    return both.select(F.inline(versions)).select(*META, *names)


def apply_changes(
    history: DataFrame,
    source: DataFrame,
    keys: list[str],
    checks: list[str],
    run_at: Column,
    loaded_at: str | None = None,
) -> DataFrame:
    """Whole history after one run: closed versions pass through untouched."""
    moved = advance(current(history), source, keys, checks, run_at, loaded_at)
    return closed(history).select(*moved.columns).unionByName(moved)


def replay(
    staged: DataFrame,
    keys: list[str],
    checks: list[str],
    at: str,
    bucket: str = "day",
) -> DataFrame:
    """All versions of all loads in one pass, each valid from its load's time on.

    Consecutive loads with equal check columns are one version. Two loads at
    the same instant are ordered by their check columns, and of these only the
    last one has a non-empty interval, so only it is kept.

    No task holds all loads of a key: versions are found per key and time
    bucket. Only the first and the last change of a bucket depend on other
    buckets, and these alone meet per key.
    """
    unit = F.date_trunc(bucket, F.col(at)).alias("_bucket")
    state = F.struct(*checks)
    # Copies and ties of an instant meet here, map-side first.
    states = staged.groupBy(*keys, unit, F.col(at).alias("valid_from")).agg(F.max(state).alias("_state"))

    in_bucket = Window.partitionBy(*keys, "_bucket").orderBy("valid_from")
    changes = (
        states.withColumn("_before", F.lag("_state").over(in_bucket))
        .filter(~F.col("_before").eqNullSafe(F.col("_state")))
        .withColumn("_first", F.col("_before").isNull())
        .drop("_before")
        .withColumn("_next", F.lead("valid_from").over(in_bucket))
    )

    # Changes inside a bucket are settled and stay apart from those that meet per key.
    inside = F.when(~F.col("_first") & F.col("_next").isNotNull(), F.col("_bucket"))
    by_key = Window.partitionBy(*keys, "_inside").orderBy("valid_from")
    starts = ~F.col("_first") | ~F.col("_carried").eqNullSafe(F.col("_state"))
    linked = (
        changes.withColumn("_inside", inside)
        .withColumn("_carried", F.lag("_state").over(by_key))
        .withColumn("_starts", starts)
        # A bucket that goes on with the state before it may still bring a change.
        .filter(F.col("_starts") | F.col("_next").isNotNull())
        .withColumn("_change_at", F.when(F.col("_starts"), F.col("valid_from")).otherwise(F.col("_next")))
        .withColumn("_later", F.lead("_change_at").over(by_key))
    )
    return linked.filter("_starts").select(
        version_id(keys, F.col("valid_from")).alias("scd_id"),
        *keys,
        *[F.col(f"_state.{c}").alias(c) for c in checks],
        "valid_from",
        F.coalesce("_next", "_later").alias("valid_to"),
    )


def insert_late(
    history: DataFrame,
    late: DataFrame,
    staged: DataFrame,
    keys: list[str],
    checks: list[str],
    at: str,
    bucket: str = "day",
) -> DataFrame:
    """The history that ``replay`` made of ``staged``, after loads that arrived late: as if all had come in order.

    A late record splits the version it falls into: its values hold until the next
    staged record of the key, which may bring the old ones back. Where neighbours
    agree, versions are stitched together. Versions, late and staged records of the
    late keys go through the one sort per key and time bucket of a replay; staged
    records are read for these keys only, and versions of all other keys pass through
    untouched.
    """
    late = late.filter(F.col(at).isNotNull())
    touched = late.select(*keys).distinct()
    names = [*keys, at, *checks]
    observed = join_on(staged.filter(F.col(at).isNotNull()).select(*names), touched, keys, "left_semi")
    of_touched = join_on(history, touched, keys, "left_semi").select(*keys, F.col("valid_from").alias(at), *checks)
    records = of_touched.unionByName(observed).unionByName(late.select(*names))
    rebuilt = replay(records, keys, checks, at, bucket)
    return join_on(history, touched, keys, "left_anti").unionByName(rebuilt.select(*history.columns))

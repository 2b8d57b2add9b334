"""Entities whose records are known by several identifiers, any of which may be missing.

Two records are one entity if they share the value of an identifier, or if a chain
of such records joins them. Identifiers are the nodes of a graph and a record ties
its own together; its components are found by alternating stars, in which
every node only ever learns of the least node near it, so no task holds the
neighbours of a node.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from siltbed.operators.merge import first_per_key
from siltbed.session import work_dir


def _digest(*parts: Column) -> Column:
    return F.unhex(F.substring(F.sha2(F.concat(*parts), 256), 1, 32))


def _node(name: str) -> Column:
    """An identifier of a kind; blank ones are missing."""
    value = F.nullif(F.trim(F.col(f"`{name}`").cast("string")), F.lit(""))
    return _digest(F.lit(f"{name}:"), value)


def _large_star(edges: DataFrame) -> DataFrame:
    """Ties the larger neighbours of every node to the least of its neighbourhood."""
    both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy(F.col("a").alias("n")).agg(F.least(F.col("n"), F.min("b")).alias("least"))
    # An edge's larger end is what its smaller end passes on.
    return edges.join(least, edges["a"] == least["n"]).select(F.col("least").alias("a"), "b").distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    """Ties the smaller neighbours of every node, and the node, to the least of them."""
    least = edges.groupBy(F.col("b").alias("n")).agg(F.min("a").alias("least"))
    tied = edges.join(least, edges["b"] == least["n"]).select("least", "a")
    among = tied.filter("a <> least").select(F.col("least").alias("a"), F.col("a").alias("b"))
    return among.unionByName(least.select(F.col("least").alias("a"), F.col("n").alias("b"))).distinct()


def components(edges: DataFrame) -> DataFrame:
    """``node`` and ``root`` for every node but the roots; a root is the least node of its component.

    Edges are pairs (a, b). Every round is stored in the work folder; rounds grow
    with the logarithm of the longest chain, and the driver sees a count and a sum.
    """
    spark = edges.sparkSession
    folder = work_dir(spark, "components")
    edges.filter("a <> b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct().write.parquet(
        f"{folder}/0"
    )
    current = spark.read.parquet(f"{folder}/0")
    before = None
    turn = 0
    while True:
        turn += 1
        _small_star(_large_star(current)).write.parquet(f"{folder}/{turn}")
        current = spark.read.parquet(f"{folder}/{turn}")
        state = current.agg(
            F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(20,0)")), F.sum(F.xxhash64("b").cast("decimal(20,0)"))
        ).first()
        if state == before:
            return current.select(F.col("b").alias("node"), F.col("a").alias("root"))
        before = state


def identify(records: DataFrame, identifiers: list[str], entity: str = "entity") -> DataFrame:
    """Records with the id of their entity, which depends on its identifiers alone.

    No record vanishes: one without any identifier is an entity of its own,
    together with those that equal it in all columns.
    """
    nodes = [_node(name) for name in identifiers]
    # ``least`` passes over NULL; a second NULL keeps it lawful for a single identifier.
    named = records.withColumn("_own", F.least(*nodes, F.lit(None).cast("binary")))
    others = F.array_compact(F.array(*nodes))
    edges = named.select(F.col("_own").alias("a"), F.explode(others).alias("b"))
    found = components(edges)
    known = named.filter(F.col("_own").isNotNull())
    labelled = known.join(found, known["_own"] == found["node"], "left").withColumn(
        entity, F.lower(F.hex(F.coalesce("root", "_own")))
    )
    # Apart from the join, where all these would meet in one task.
    row = F.to_json(F.struct(*[F.col(f"`{c}`").alias(f"c{i}") for i, c in enumerate(records.columns)]))
    alone = named.filter(F.col("_own").isNull()).withColumn(entity, F.lower(F.hex(_digest(F.lit("row:"), row))))
    columns = [*[F.col(f"`{c}`") for c in records.columns], F.col(entity)]
    return labelled.select(*columns).unionByName(alone.select(*columns))


def entity_records(
    identified: DataFrame, label: str, priority: list[str], ties: list[str], entity: str = "entity"
) -> DataFrame:
    """One record per entity: that of the first source in ``priority``, then the least by ``ties``."""
    rank = F.lit(len(priority))
    for place, name in reversed(list(enumerate(priority))):
        rank = F.when(F.col(f"`{label}`") == name, place).otherwise(rank)
    return first_per_key(identified, [entity], [rank, *[F.col(f"`{c}`").asc_nulls_last() for c in ties]])

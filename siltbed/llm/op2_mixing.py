"""Mixing sources to target weights with exact word budgets.

Every document gets a hash-random key. Within its source, documents are ordered
by it; the key space is cut into about sqrt(rows) equal ranges, so a source of any
size is sorted in many tasks. Sums per source and range give each range its start
(a distributed prefix sum), and the running sum inside a range says which words
of a document lie before the cut. Whole epochs come first: a target of 2.4 times
the source takes each document twice and 40 % of the words a third time. The one
document at the cut gives its first words only, so budgets are met to the word.

Defined results: NULL text has size 0; NULL is a source of its own, last in
order; the random order follows id and text, so rows without an id, or with a
repeated one, are dealt out by their texts; rows that agree in source, id and text
are interchangeable; very long texts are cut at a word like others; an empty table,
or one without words, takes nothing. Other columns are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from siltbed.llm.common import WORD, free_name, power_of_two, quoted, ranked, text_digest, whole_text, written

#: Fixed values of the contract: weights by order of the sources, and the most epochs of a source.
WEIGHTS = [5, 2, 1]
MOST_EPOCHS = 3
KEY_BITS = 60


def word_count(column: str = "text") -> Column:
    return F.regexp_count(whole_text(column), F.lit(WORD)).cast("long")


def random_key(key: str, column: str, seed: str) -> Column:
    """60 random bits that depend on the id and the whole text, so that rows without ids are dealt out too."""
    id_ = F.coalesce(F.col(key).cast("string"), F.lit("null"))
    text = F.concat(F.lit(seed), id_, F.md5(whole_text(column).cast("binary")))
    return F.conv(F.substring(F.md5(text.cast("binary")), 1, KEY_BITS // 4), 16, 10).cast("long")


def source_targets(sources: DataFrame, weights: list[int], most: int) -> DataFrame:
    """source, source_size -> also target: shares of the total by weight, none above ``most`` times its size.

    The excess of capped sources goes to the others by weight until none is above.
    One number, the words per unit of weight, describes each round.
    """
    order = [F.col("source").asc_nulls_last()]
    listed = ranked(sources, order, "_rank", "op2-ranked")
    weight = F.element_at(F.array(*map(F.lit, weights)), (F.col("_rank") % len(weights) + 1).cast("int"))
    listed = written(
        listed.select("source", "source_size", weight.alias("weight"), (most * F.col("source_size")).alias("cap")),
        "op2-sources",
    )
    per_weight, before = None, -1.0
    while per_weight != before:
        before = per_weight
        above = F.lit(False) if before is None else F.col("cap") < F.col("weight") * F.lit(before)
        total, capped, open_weight = listed.agg(
            F.sum("source_size"), F.sum(F.when(above, F.col("cap"))), F.sum(F.when(~above, F.col("weight")))
        ).first()
        per_weight = ((total or 0) - (capped or 0)) / open_weight if open_weight else 0.0
    target = F.least(F.col("cap").cast("double"), F.col("weight") * F.lit(per_weight))
    return listed.withColumn("target", target).select("source", "source_size", "target")


def mix(
    docs: DataFrame,
    weights: list[int] = WEIGHTS,
    most: int = MOST_EPOCHS,
    seed: str = "mix",
    key: str = "doc_id",
    column: str = "text",
) -> DataFrame:
    """One row per document: doc_id, digest, size, source, source_size, target, epochs (whole ones) and part (words beyond)."""
    sized = written(
        docs.select(
            F.col(key).alias("doc_id"),
            F.col("source").alias("source"),
            word_count(column).alias("size"),
            random_key(key, column, seed).alias("rand"),
            text_digest(column).alias("digest"),
        ),
        "op2-sized",
    )
    bits = power_of_two(sized.count() ** 0.5)
    # NULL sources need a join key; the flag keeps them apart from empty names.
    sized = sized.withColumn("range", F.shiftright("rand", KEY_BITS - bits)).withColumns(
        {"no_source": F.col("source").isNull(), "named": F.coalesce(F.col("source").cast("string"), F.lit(""))}
    )
    ranges = written(
        sized.groupBy("no_source", "named", "range").agg(
            F.first("source").alias("source"), F.sum("size").alias("words")
        ),
        "op2-ranges",
    )
    totals = ranges.groupBy("source").agg(F.sum("words").alias("source_size"))
    targets = source_targets(totals, weights, most).withColumns(
        {"no_source": F.col("source").isNull(), "named": F.coalesce(F.col("source").cast("string"), F.lit(""))}
    ).drop("source")
    before = Window.partitionBy("no_source", "named").orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    starts = (
        ranges.withColumn("start", F.coalesce(F.sum("words").over(before), F.lit(0)))
        .drop("source", "words")
        .join(targets, ["no_source", "named"])
    )
    budget = F.floor("target")
    epochs = F.when(F.col("source_size") > 0, F.floor(budget / F.col("source_size"))).otherwise(0).cast("long")
    inside = (
        Window.partitionBy("no_source", "named", "range")
        .orderBy("rand", "doc_id", "digest")
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    left = (budget - F.col("epochs") * F.col("source_size")) - F.col("start") - F.coalesce(
        F.sum("size").over(inside), F.lit(0)
    )
    return (
        sized.join(starts, ["no_source", "named", "range"])
        .withColumn("epochs", epochs)
        .withColumn("part", F.greatest(F.lit(0).cast("long"), F.least("size", left)))
        .select("doc_id", "digest", "size", "source", "source_size", "target", "epochs", "part")
    )


def mix_columns(mixed: DataFrame) -> DataFrame:
    taken = F.col("epochs") * F.col("size") + F.col("part")
    return mixed.select("doc_id", "size", "source_size", "target", taken.alias("taken"))


def mixed_documents(docs: DataFrame, key: str = "doc_id", column: str = "text", **options) -> DataFrame:
    """The documents as the mix takes them: repeated by epoch, the one at the cut with its first words.

    ``n_chars``, if there, counts the text of the row.
    """
    names = ("id", "digest", "from", "whole", "part", "copy", "here", "rows", "nth", "row")
    id_, digest, source, whole, part, copy, here, rows, nth, row = (free_name(docs.columns, f"_mix_{x}") for x in names)
    mixed = mix(docs, key=key, column=column, **options)
    # Rows that agree in id, source and text share what they give; at most one of them is cut.
    full = (F.col("part") == F.col("size")) & (F.col("size") > 0)
    taken = written(
        mixed.groupBy("doc_id", "source", "digest")
        .agg(
            (F.sum("epochs") + F.count_if(full)).alias(whole),
            F.coalesce(F.max(F.when(~full, F.col("part"))), F.lit(0).cast("long")).alias(part),
            F.count(F.lit(1)).alias(rows),
        )
        .filter(F.col(whole) + F.col(part) > 0)
        .withColumnsRenamed({"doc_id": id_, "source": source, "digest": digest}),
        "op2-taken",
    )
    marked = docs.withColumn(here, text_digest(column))
    met = marked.join(
        taken.hint("shuffle_hash"),
        marked[key].eqNullSafe(taken[id_]) & marked["source"].eqNullSafe(taken[source]) & (marked[here] == taken[digest]),
    )
    single = met.filter(F.col(rows) == 1).withColumn(nth, F.lit(0).cast("long"))
    if not taken.filter(F.col(rows) > 1).isEmpty():
        # Numbered by a range sort, since such a group may be large.
        twins = ranked(
            met.filter(F.col(rows) > 1).withColumn(row, F.monotonically_increasing_id()), [F.col(c) for c in (digest, id_, source, row)], nth, "op2-twins"
        ).drop(row)
        first = twins.groupBy(digest, id_, source).agg(F.min(nth).alias(row)).toDF("d", "i", "s", row)
        same = (twins[digest] == first["d"]) & twins[id_].eqNullSafe(first["i"]) & twins[source].eqNullSafe(first["s"])
        numbered = twins.join(first, same).withColumn(nth, F.col(nth) - F.col(row))
        single = single.unionByName(numbered.select(*quoted(single.columns)))
    each = F.floor(F.col(whole) / F.col(rows))
    extra = F.col(whole) - each * F.col(rows)
    copies = each + F.when(F.col(nth) < extra, 1).otherwise(0)
    some = (F.col(part) > 0) & (F.col(nth) == extra)
    first_words = F.array_join(F.slice(F.regexp_extract_all(whole_text(column), F.lit(WORD), F.lit(0)), 1, F.col(part).cast("int")), " ")
    repeated = single.withColumn(copy, F.explode(F.sequence(F.lit(0), copies.cast("int")))).filter((F.col(copy) > 0) | some)
    text = F.when(F.col(copy) == 0, first_words).otherwise(F.col(column))
    shown = repeated.withColumn(column, text)
    if "n_chars" in docs.columns:
        shown = shown.withColumn("n_chars", F.when(F.col(copy) == 0, F.length(column)).otherwise(F.col("n_chars")))
    return shown.select(*quoted(docs.columns))


SQL = r"""
WITH sized AS (
  SELECT doc_id, source, md5(coalesce(text, '')) AS tie, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))::BIGINT AS size,
         ('0x' || substr(md5('mix' || coalesce(doc_id::VARCHAR, 'null') || md5(coalesce(text, ''))), 1, 15))::BIGINT AS rand
  FROM documents),
totals AS (SELECT source, sum(size)::BIGINT AS source_size, 3 * sum(size)::BIGINT AS cap FROM sized GROUP BY source),
weighed AS (
  SELECT *, CASE (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 WHEN 0 THEN 5 WHEN 1 THEN 2 ELSE 1 END AS weight
  FROM totals),
rated AS (
  SELECT *, sum(source_size) OVER () AS total, sum(weight) OVER () AS all_weight,
         sum(cap) OVER w - cap AS caps_below, sum(weight) OVER w - weight AS weight_below,
         row_number() OVER w AS place
  FROM weighed WINDOW w AS (ORDER BY cap / weight, source NULLS LAST ROWS UNBOUNDED PRECEDING)),
level AS (
  SELECT arg_min((total - caps_below)::DOUBLE / (all_weight - weight_below), place) FILTER (
    (total - caps_below)::DOUBLE / (all_weight - weight_below) * weight <= cap) AS per_weight FROM rated),
targets AS (SELECT source, source_size, least(cap::DOUBLE, weight * coalesce(per_weight, 0)) AS target FROM weighed, level),
ordered AS (
  SELECT doc_id, size, source_size, target,
         CASE WHEN source_size > 0 THEN floor(target)::BIGINT // source_size ELSE 0 END AS epochs,
         sum(size) OVER (PARTITION BY s.source ORDER BY rand, doc_id, tie ROWS UNBOUNDED PRECEDING) - size AS before
  FROM sized s JOIN targets t ON s.source IS NOT DISTINCT FROM t.source)
SELECT doc_id, size, source_size, target,
       (epochs * size + greatest(0, least(size, floor(target)::BIGINT - epochs * source_size - before)))::BIGINT AS taken
FROM ordered
"""

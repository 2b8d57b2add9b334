"""Prefix trie of conversations by range minima over sorted LCPs.

1. Turns are numbered by distributed ranks and rebuilt into conversations. A
   conversation is cut into segments of ``SEGMENT`` turns, each a row: the
   fingerprint of all segments before, its turns as 16-byte digests in order, and
   words per turn. So no row grows with a conversation.
2. Rows are range-sorted by segment number, fingerprint, digests and id; each task
   takes its sorted rows in blocks. The LCPs of neighbours fill a sparse table of
   range minima. A prefix is a candidate at the row where it is new in its block;
   it searches its left and its right extent there independently, by halving
   steps, which gives its members as an interval. No stack, no nested loops over rows.
3. A prefix that goes on over a block's border has one part per block; parts meet by
   the digest of the prefix, added up before the shuffle. Equal conversations stand
   together by id, so the ids that end at a node come as ascending runs, which are
   hashed as a stream.
4. Sums over subtrees are sums over members: a node belongs to its smallest member,
   which owns all nodes of its path from some depth on. So a subtree's sum is that
   of what its members own, less what its smallest member owns above it. A second
   pass over the intervals adds up what members own by prefix sums.

Defined results: NULL role or text is empty; turns of one conversation with equal
numbers go by their digest, NULL numbers first; repeated rows are turns of their
own; turns without conv_id are one conversation, counted as the largest possible
id and reported as NULL; very long texts are hashed whole; conversations of any
length are split; an empty table gives no node; other columns are not read.
"""

from __future__ import annotations

import hashlib
import struct
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from siltbed.llm.common import WORD, crc_sql, ranked, written

#: Turns in a row.
SEGMENT = 64
#: Sorted rows that are searched together.
BLOCK = 1024
DIGEST = 16
#: Stands for a missing conv_id.
NO_ID = 2**63 - 1
#: Fixed values of the contract: conversations that share a base, and how its turns are chosen.
BASE, HEADS = 20, 4

PARTS = "node binary, parent binary, depth long, words long, n long, conv long, ids binary, first_end long, sum_words long, sum_leaves long"


def turns(conversations: DataFrame) -> DataFrame:
    """conv, n (from 1), digest of role and text, words; every turn numbered within its conversation."""

    def part(name: str):
        return F.coalesce(F.col(name).cast("string"), F.lit(""))

    whole = F.concat(F.octet_length(part("role")).cast("string"), F.lit(":"), part("role"), part("text"))
    found = written(
        conversations.select(
            F.coalesce(F.col("conv_id").cast("long"), F.lit(NO_ID)).alias("conv"),
            "turn",
            F.substring(F.unhex(F.sha2(whole, 256)), 1, DIGEST).alias("digest"),
            F.regexp_count(part("text"), F.lit(WORD)).cast("long").alias("words"),
            F.monotonically_increasing_id().alias("row_no"),
        ),
        "op13-turns",
    )
    order = [F.col("conv"), F.col("turn").asc_nulls_first(), F.col("digest"), F.col("row_no")]
    placed = ranked(found, order, "rank", "op13-ranked")
    first = placed.groupBy("conv").agg(F.min("rank").alias("first"))
    return placed.join(first, "conv").select("conv", (F.col("rank") - F.col("first") + 1).alias("n"), "digest", "words")


def rebuilt(numbered: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(conv) of all conversations, and (conv, p, digest, words): the first turns of their base, then their own."""
    ids = numbered.groupBy("conv").agg(F.min("n").alias("_")).select("conv")
    text = F.when(F.col("conv") == NO_ID, F.lit("")).otherwise(F.col("conv").cast("string"))
    wanted = ids.select(
        "conv",
        F.pmod(F.crc32(text.cast("binary")), F.lit(HEADS)).alias("heads"),
        # SQL's remainder has the sign of the id; a missing id has no base but itself.
        F.when(F.col("conv") == NO_ID, F.col("conv")).otherwise(F.col("conv") - F.col("conv") % BASE).alias("base"),
    )
    heads = numbered.filter(F.col("n") < HEADS).select(F.col("conv").alias("base"), "n", "digest", "words")
    from_base = wanted.join(heads, "base").filter(F.col("n") <= F.col("heads")).select("conv", F.col("n").alias("p"), "digest", "words")
    # How many turns the base has to give; it gives the first ones without a gap.
    given = from_base.groupBy("conv").agg(F.count(F.lit(1)).alias("given"))
    shift = wanted.join(given, "conv", "left").select("conv", "heads", F.coalesce("given", F.lit(0)).alias("given"))
    own = (
        numbered.join(shift, "conv")
        .filter(F.col("n") > F.col("heads"))
        .select("conv", (F.col("n") - F.col("heads") + F.col("given")).alias("p"), "digest", "words")
    )
    return ids, from_base.unionByName(own)


def segments(ids: DataFrame, sequence: DataFrame, size: int = SEGMENT) -> DataFrame:
    """One row per conversation and ``size`` turns; a conversation without turns has one empty row."""
    seg = F.floor((F.col("p") - 1) / size).cast("long")
    turn = F.struct("p", "digest", "words")
    made = sequence.groupBy("conv", seg.alias("seg")).agg(F.array_sort(F.collect_list(turn)).alias("t"))
    digests = F.aggregate("t", F.lit(b""), lambda left, x: F.concat(left, x["digest"]))
    filled = ids.join(made, "conv", "left").select(
        "conv",
        F.coalesce("seg", F.lit(0)).alias("seg"),
        F.when(F.col("t").isNull(), F.lit(b"")).otherwise(digests).alias("digests"),
        F.coalesce(F.col("t.words"), F.array().cast("array<long>")).alias("words"),
    )
    marked = filled.withColumns({"h": F.xxhash64("seg", "digests"), "l": F.xxhash64("digests", F.lit("low"), "seg")})
    before = Window.partitionBy("conv").orderBy("seg").rowsBetween(Window.unboundedPreceding, -1)
    through = Window.partitionBy("conv").orderBy("seg").rowsBetween(Window.unboundedPreceding, 0)
    return marked.select(
        "seg",
        F.coalesce(F.bit_xor("h").over(before), F.lit(0).cast("long")).alias("high"),
        F.coalesce(F.bit_xor("l").over(before), F.lit(0).cast("long")).alias("low"),
        F.bit_xor("h").over(through).alias("high_after"),
        F.bit_xor("l").over(through).alias("low_after"),
        "digests",
        "words",
        "conv",
        F.lead("seg").over(Window.partitionBy("conv").orderBy("seg")).isNull().alias("last"),
    )


class SparseTable:
    """Minima of all ranges whose length is a power of two."""

    def __init__(self, values: np.ndarray):
        self.levels = [values]
        while 2 ** len(self.levels) <= len(values):
            half, last = 2 ** (len(self.levels) - 1), self.levels[-1]
            self.levels.append(np.minimum(last[:-half], last[half:]))

    def least(self, first: np.ndarray, last: np.ndarray) -> np.ndarray:
        """Minimum of values[first..last], for many ranges."""
        level = np.log2(last - first + 1).astype(np.int64)
        found = np.empty(len(first), self.levels[0].dtype)
        for k in np.unique(level):
            here = level == k
            row = self.levels[k]
            found[here] = np.minimum(row[first[here]], row[last[here] - 2**k + 1])
        return found

    def reach_right(self, start: np.ndarray, least: np.ndarray) -> np.ndarray:
        """The last position up to which values[start + 1..] are no less than ``least``."""
        at = start.copy()
        for k in reversed(range(len(self.levels))):
            row = self.levels[k]
            possible = at + 1 < len(row)
            step = possible & (row[np.minimum(at + 1, len(row) - 1)] >= least)
            at[step] += 2**k
        return at

    def reach_left(self, start: np.ndarray, least: np.ndarray) -> np.ndarray:
        """The first position from which values[.. + 1..start] are no less than ``least``."""
        at = start.copy()
        for k in reversed(range(len(self.levels))):
            row = self.levels[k]
            first = at - 2**k + 1
            step = (first >= 0) & (row[np.maximum(first, 0)] >= least)
            at[step] -= 2**k
        return at


def prefix_ids(seg: int, before: bytes, after: bytes, digests: bytes, size: int) -> list[bytes]:
    """Digests of the prefixes of one row, from none of its turns to all; that of a full segment is what the next begins with."""
    running, found = xxhash.xxh3_128(struct.pack("<q", seg) + before), [before]
    for at in range(0, len(digests), DIGEST):
        running.update(digests[at : at + DIGEST])
        found.append(running.digest())
    if len(found) == size + 1:
        found[-1] = after
    return found


def block_parts(rows: dict[str, list], size: int, owned: bool) -> list[tuple]:
    """The part of every prefix that this block of sorted rows holds."""
    count = len(rows["conv"])
    lengths = np.array([len(d) // DIGEST for d in rows["digests"]], np.int64)
    width = int(max(1, lengths.max()))
    padded = b"".join(d.ljust(width * DIGEST, b"\0") for d in rows["digests"])
    tokens = np.frombuffer(padded, np.uint64).reshape(count, width, 2)
    group = np.array([rows["seg"], rows["high"], rows["low"]], np.int64).T
    # LCP with the row before; -1 if that row does not even share what lies before the segment.
    same = (tokens[1:] == tokens[:-1]).all(2) & (np.arange(width) < np.minimum(lengths[1:], lengths[:-1])[:, None])
    alike = np.where(same.all(1), width, same.argmin(1))
    lcp = np.concatenate([[-1], np.where((group[1:] == group[:-1]).all(1), alike, -1)]) if count else np.empty(0, np.int64)
    table = SparseTable(lcp)
    # Candidates: prefixes that are new at their row. Prefixes of no turn are nodes of the segment before, but for the root.
    first_depth = np.maximum(lcp + 1, (group[:, 0] > 0).astype(np.int64))
    times = np.maximum(lengths - first_depth + 1, 0)
    row = np.repeat(np.arange(count), times)
    depth = np.arange(len(row)) - np.repeat(np.cumsum(times) - times, times) + np.repeat(first_depth, times)
    left, right = table.reach_left(row, depth), table.reach_right(row, depth)
    conv = np.array(rows["conv"], np.int64)
    least = SparseTable(conv).least(left, right)
    sums = [np.zeros(len(row), np.int64)] * 2
    if owned:
        running = [np.concatenate([[0], np.cumsum(np.array(rows[c], np.int64))]) for c in ("own_words", "own_leaves")]
        sums = [r[right + 1] - r[left] for r in running]
    last = np.array(rows["last"], bool)
    found, known, of = [], -1, []
    for n, (i, d, l, r) in enumerate(zip(row.tolist(), depth.tolist(), left.tolist(), right.tolist())):
        if i != known:
            seg = rows["seg"][i]
            before = struct.pack("<qq", rows["high"][i], rows["low"][i])
            after = struct.pack("<qq", rows["high_after"][i], rows["low_after"][i])
            of, known = prefix_ids(seg, before, after, rows["digests"][i], size), i
        ids = first_end = None
        if not owned and lengths[l] == d:
            # The members without further turns come first, by id.
            ends = conv[l : r + 1][last[l : r + 1] & (lengths[l : r + 1] == d)]
            if len(ends):
                ids, first_end = ends.astype("<i8").tobytes(), int(ends[0])
        words = rows["words"][i][d - 1] if d else 0
        parent = of[d - 1] if d else None
        found.append((of[d], parent, rows["seg"][i] * size + d, words, r - l + 1, int(least[n]), ids, first_end, int(sums[0][n]), int(sums[1][n])))
    return found


def parts(sorted_rows: DataFrame, size: int = SEGMENT, block: int = BLOCK, owned: bool = False) -> DataFrame:
    """Parts of prefixes, from the sorted rows of each task in blocks."""
    names = PARTS.split(", ")
    kinds = [{"binary": pa.binary(), "long": pa.int64()}[c.split()[1]] for c in names]
    names = [c.split()[0] for c in names]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, block):
                some = batch.slice(at, block)
                rows = {name: some.column(name).to_pylist() for name in some.schema.names}
                found = block_parts(rows, size, owned)
                arrays = [pa.array(c, k) for c, k in zip(zip(*found), kinds)] if found else [pa.array([], k) for k in kinds]
                yield pa.RecordBatch.from_arrays(arrays, names)

    return sorted_rows.mapInArrow(run, PARTS)


def in_order(rows: DataFrame) -> DataFrame:
    count = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    order = ["seg", "high", "low", "digests", "conv"]
    return rows.repartitionByRange(count, *order).sortWithinPartitions(*order)


def end_digests(found: DataFrame) -> DataFrame:
    """node, ends_sha256: the ids that end at a node, hashed as a stream of ascending runs."""
    runs = found.filter(F.col("ids").isNotNull()).select("node", "ids", "first_end")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        node, digest = None, hashlib.sha256()
        made: list[tuple[bytes, str]] = []
        for batch in batches:
            for next_node, ids in zip(batch.column("node").to_pylist(), batch.column("ids").to_pylist()):
                text = ",".join("" if i == NO_ID else str(i) for i in np.frombuffer(ids, "<i8").tolist())
                if next_node != node:
                    if node is not None:
                        made.append((node, digest.hexdigest()))
                    node, digest = next_node, hashlib.sha256(text.encode())
                else:
                    digest.update(b"," + text.encode())
            yield _digest_batch(made)
            made = []
        if node is not None:
            yield _digest_batch([(node, digest.hexdigest())])

    ordered = runs.repartition("node").sortWithinPartitions("node", "first_end")
    return ordered.mapInArrow(run, "node binary, ends_sha256 string")


def _digest_batch(made: list[tuple[bytes, str]]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array([m[0] for m in made], pa.binary()), pa.array([m[1] for m in made], pa.string())], ["node", "ends_sha256"]
    )


def prefix_trie(conversations: DataFrame, size: int = SEGMENT, block: int = BLOCK) -> DataFrame:
    """One row per node: node and parent (digests of their prefixes), conv, depth, parent_conv, n_convs, n_children, n_leaves, saved_words, ends_sha256."""
    numbered = written(turns(conversations), "op13-numbered")
    rows = written(segments(*rebuilt(numbered), size), "op13-rows")
    found = written(parts(in_order(rows), size, block), "op13-parts")
    nodes = written(
        found.groupBy("node").agg(
            F.first("parent").alias("parent"),
            F.first("depth").alias("depth"),
            F.first("words").alias("words"),
            F.sum("n").alias("n_convs"),
            F.min("conv").alias("conv"),
        ),
        "op13-nodes",
    )
    children = nodes.filter(F.col("parent").isNotNull()).groupBy(F.col("parent").alias("node")).agg(F.count(F.lit(1)).alias("n_children"))
    weighed = written(
        nodes.join(children, "node", "left")
        .withColumn("n_children", F.coalesce("n_children", F.lit(0)))
        .withColumn("saved", (F.col("n_convs") - 1) * F.col("words"))
        .withColumn("span", F.floor(F.col("depth") / size)),
        "op13-weighed",
    )
    leaf = F.when(F.col("n_children") == 0, 1).otherwise(0).cast("long")
    owned = weighed.groupBy("conv").agg(F.sum("saved").alias("own_words"), F.sum(leaf).alias("own_leaves"))
    nothing = F.lit(0).cast("long")
    with_own = written(
        rows.join(owned, "conv", "left").withColumns(
            {c: F.coalesce(c, nothing) for c in ("own_words", "own_leaves")}
        ),
        "op13-owned",
    )
    sums = (
        parts(in_order(with_own), size, block, owned=True)
        .groupBy("node")
        .agg(F.sum("sum_words").alias("sum_words"), F.sum("sum_leaves").alias("n_leaves"))
    )
    names = nodes.select(F.col("node").alias("parent"), F.col("conv").alias("parent_conv"))
    ended = end_digests(found)
    return (
        with_owned_above(weighed)
        .join(sums, "node")
        .join(ended, "node", "left")
        .join(names, "parent", "left")
        .select(
            "node",
            "parent",
            "conv",
            "depth",
            "parent_conv",
            "n_convs",
            "n_children",
            "n_leaves",
            (F.col("sum_words") - F.col("above")).alias("saved_words"),
            F.coalesce("ends_sha256", F.lit(hashlib.sha256().hexdigest())).alias("ends_sha256"),
        )
    )


def with_owned_above(weighed: DataFrame) -> DataFrame:
    """The nodes with what their smallest member owns above them, added up per span of depths first."""
    earlier = Window.partitionBy("conv").orderBy("span").rowsBetween(Window.unboundedPreceding, -1)
    inside = Window.partitionBy("conv", "span").orderBy("depth").rowsBetween(Window.unboundedPreceding, -1)
    spans = (
        weighed.groupBy("conv", "span")
        .agg(F.sum("saved").alias("saved_there"))
        .select("conv", "span", F.coalesce(F.sum("saved_there").over(earlier), F.lit(0)).alias("spans_above"))
    )
    return (
        weighed.withColumn("near", F.coalesce(F.sum("saved").over(inside), F.lit(0)))
        .join(spans, ["conv", "span"])
        .withColumn("above", F.col("near") + F.col("spans_above"))
    )


def node_columns(found: DataFrame) -> DataFrame:
    def id_of(name: str):
        return F.when(F.col(name) != NO_ID, F.col(name))

    return found.select(
        id_of("conv").alias("conv_id"),
        "depth",
        id_of("parent_conv").alias("parent_conv_id"),
        "n_convs",
        "n_children",
        "n_leaves",
        F.col("saved_words").alias("saved_tokens"),
        "ends_sha256",
    )


SQL = f"""
WITH numbered AS (
    SELECT conv_id AS c, coalesce(role, '') AS r, coalesce(text, '') AS x,
           row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST,
               sha256(strlen(coalesce(role, ''))::VARCHAR || ':' || coalesce(role, '') || coalesce(text, ''))) AS n
    FROM conversations),
ids AS (SELECT c, {crc_sql('c')} % 4 AS h, c - c % 20 AS base FROM numbered GROUP BY c),
turns AS (
    SELECT i.c, b.n, b.r, b.x FROM ids i JOIN numbered b ON b.c = i.base AND b.n <= i.h
    UNION ALL SELECT i.c, t.n + 4, t.r, t.x FROM ids i JOIN numbered t ON t.c IS NOT DISTINCT FROM i.c AND t.n > i.h),
paths AS (
    SELECT i.c, coalesce(list({{'r': r, 'x': x}} ORDER BY n) FILTER (n IS NOT NULL), []) AS path
    FROM ids i LEFT JOIN turns t ON t.c IS NOT DISTINCT FROM i.c GROUP BY i.c),
nodes AS (
    SELECT path[:d] AS p, d, min(c) AS conv_id, count(*) AS n_convs,
           sha256(coalesce(string_agg(coalesce(c::VARCHAR, ''), ',' ORDER BY c NULLS LAST) FILTER (len(path) = d), '')) AS ends_sha256
    FROM (SELECT *, unnest(range(len(path) + 1)) AS d FROM paths) GROUP BY ALL),
weighed AS (
    SELECT n.*, coalesce(k.kids, 0) AS n_children,
           CASE WHEN d > 0 THEN (n_convs - 1) * len(regexp_extract_all(p[d].x, '[^\\x20\\x09-\\x0D]+')) ELSE 0 END AS saved
    FROM nodes n LEFT JOIN (SELECT p[:d - 1] AS p, count(*) AS kids FROM nodes WHERE d > 0 GROUP BY 1) k USING (p)),
sums AS (
    SELECT p[:up] AS p, sum(saved)::BIGINT AS saved_tokens, count(*) FILTER (n_children = 0) AS n_leaves
    FROM (SELECT *, unnest(range(d + 1)) AS up FROM weighed) GROUP BY 1)
SELECT w.conv_id, w.d AS depth, above.conv_id AS parent_conv_id, w.n_convs, w.n_children, n_leaves, saved_tokens, w.ends_sha256
FROM weighed w JOIN sums USING (p) LEFT JOIN nodes above ON w.d > 0 AND above.p = w.p[:w.d - 1]
"""

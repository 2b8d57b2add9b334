"""Near-dedup by a chosen-path set similarity join.

1. One pass over the texts gives each document the size and fingerprint of its
   shingle set, the root nodes it falls into and a minwise signature. Documents
   with equal sets are one from here on.
2. Trees: the root and every node choose minwise positions at random, 1 /
   similarity of them on average; members that agree on the token there form a
   child. Nodes of one member, or of one known component, end. Small nodes are
   compared exhaustively, large ones branch again, until they are small or hold
   texts so much alike that they do not split.
3. Rounds with trees of their own. In the first two, each member of a small node
   goes with its most similar neighbour of another component, which joins large
   groups without pairing all members; nodes that stay large are dealt at random
   for that. These pairs, one per member at most, are confirmed on
   the full shingle sets of the whole texts. After a round, its links join
   components, not sets.
4. In the last round no pair leaves a task. Members of a node that have a similar
   member of another component travel with their full shingle sets, once per
   node, and are compared there exactly, by products of incidence matrices. A node
   that is still large is compared in blocks: its strays with one another and with
   its largest component, whose members are never compared among themselves. The
   comparisons are quadratic in the strays of such a node; what is sent is not, up
   to the blocks' number. Of the links only those are sent that join components.

A pair at the similarity limit is missed by a tree with a probability of 0.19 at
the first level and 0.53 at the fourth, so by the trees of the last round, which
leave out no pair of a node, with less than 1e-3 in the largest groups and 1e-8
elsewhere; components have many links and lose less.

Defined results: A-Z are lower-cased; a text with fewer words than a shingle is
one shingle; NULL, empty and wordless texts have none and are linked with
nothing; equal rows are linked; very long texts give all their shingles, as eight
bytes each; component_id ignores NULL ids and is NULL for a
group without any; an empty table gives an empty result. Other columns are not
read.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from siltbed.llm.common import keep_rows, text_digest, whole_text, with_text_columns, written

WIDTH = 5
PERCENT = 75
#: Signature length; estimates have a standard deviation of 0.04 at the limit.
POSITIONS = 128
#: Pairs estimated below this are not confirmed: 4.4 standard deviations under the limit.
LEAST_ESTIMATE = 0.58
TREES = (3, 3, 12)
#: Nodes of so many members are small.
LEAF = 256
LEVELS = 6
#: A child that keeps this share of its parent's members holds texts that are alike; it would not split further.
STUCK = 0.4
#: Large nodes that do not split, or are of the last level, are compared in blocks of about so many members, and bytes of their sets.
BLOCK = 1024
BLOCK_BYTES = 4 << 20
#: Shingles whose incidence is multiplied at once.
COLUMNS = 2048
REMEMBERED = 400_000
_SEEDS = np.random.default_rng(9).integers(1, 2**32, (2, POSITIONS), np.uint64).astype(np.uint32)
_ODD, _ADD = _SEEDS[0] | np.uint32(1), _SEEDS[1]
_PRIME = np.uint64(0x9E3779B97F4A7C15)


def shingler(width: int = WIDTH) -> Callable[[bytes], np.ndarray]:
    """The sorted distinct 64-bit shingle hashes of a text."""
    known: dict[bytes, int] = {}

    def shingles(text: bytes) -> np.ndarray:
        words = text.lower().split()
        if not words:
            return np.empty(0, np.uint64)
        if len(words) < width:
            return np.array([xxhash.xxh3_64_intdigest(b" ".join(words))], np.uint64)
        if len(known) > REMEMBERED:
            known.clear()
        for w in words:
            if w not in known:
                known[w] = xxhash.xxh3_64_intdigest(w)
        hashes = np.fromiter(map(known.__getitem__, words), np.uint64, len(words))
        count = len(words) - width + 1
        mixed = hashes[:count].copy()
        for shift in range(1, width):
            mixed ^= mixed >> np.uint64(29)
            mixed *= _PRIME
            mixed += hashes[shift : shift + count]
        mixed ^= mixed >> np.uint64(32)
        mixed *= _PRIME
        return np.unique(mixed)

    return shingles


def minwise(shingles: np.ndarray, block: int = 4096) -> np.ndarray:
    """For each position, the token with the smallest value of that position's permutation."""
    low = (shingles >> np.uint64(32)).astype(np.uint32)
    least = np.full(POSITIONS, np.iinfo(np.uint32).max, np.uint32)
    for at in range(0, len(low), block):
        np.minimum(least, (low[at : at + block, None] * _ODD + _ADD).min(0), out=least)
    return least


def root_positions(trees: int) -> list[tuple[int, int]]:
    """(tree, position): one or two for each tree, 4/3 on average."""
    random = np.random.default_rng(99)
    found = []
    for tree in range(trees):
        chosen = random.choice(POSITIONS, 2, replace=False)
        found += [(tree, int(p)) for p in chosen[: 1 + (tree % 3 == 2)]]
    return found


ROOTS = root_positions(sum(TREES))


def described(docs: DataFrame, key: str, column: str) -> DataFrame:
    """doc_id, n_shingles, set_id (fingerprint), roots, signature, digest of the text."""

    def compute() -> Callable[[list[bytes]], list[list]]:
        shingles = shingler()

        def work(texts: list[bytes]) -> list[list]:
            found: list[list] = [[], [], [], []]
            for text in texts:
                s = shingles(text)
                least = minwise(s)
                roots = [xxhash.xxh3_64_intdigest(b"%d %d %d" % (t, p, least[p])) - 2**63 for t, p in ROOTS]
                for column_, value in zip(
                    found,
                    (len(s), xxhash.xxh3_128_digest(s.tobytes()), roots, least.astype(np.uint16).tobytes()),
                ):
                    column_.append(value)
            return found

        return work

    fields = [
        T.StructField("n_shingles", T.LongType()),
        T.StructField("set_id", T.BinaryType()),
        T.StructField("roots", T.ArrayType(T.LongType())),
        T.StructField("signature", T.BinaryType()),
    ]
    given = docs.select(F.col(key).alias("doc_id"), F.col(column).alias("text"))
    found = with_text_columns(
        given.withColumn("digest", text_digest()), fields, compute
    )
    return found.select("doc_id", "digest", "_found.*")


def _children(members: DataFrame, level: int) -> DataFrame:
    """Members of large nodes by the tokens at one or two positions that their node chooses."""

    def child(n: int):
        position = F.pmod(F.xxhash64("node", F.lit(level), F.lit(n)), F.lit(POSITIONS)).cast("int")
        token = F.substring(F.col("signature"), position * 2 + 1, F.lit(2))
        return F.xxhash64("node", F.lit(n), token)

    second = F.pmod(F.xxhash64("node", F.lit(level), F.lit("two")), F.lit(3)) == 0
    nodes = F.when(second, F.array(child(0), child(1))).otherwise(F.array(child(0)))
    return members.select(F.explode(nodes).alias("node"), "set_no", "component", F.col("n").alias("parent_n"))


def _blocks(large: DataFrame, sets: DataFrame) -> DataFrame:
    """node, side, set_no: a node for every two blocks of a large node whose members have to meet.

    Strays, the members outside a node's largest component, meet one another and
    the largest component. Members of side 0 are compared with all others of their
    node, the rest with the other side only.
    """
    members = large.join(sets.select("set_no", "component", "n_shingles"), "set_no")
    largest = (
        members.groupBy("node", "component")
        .agg(F.count(F.lit(1)).alias("n"))
        .groupBy("node")
        .agg(F.max_by("component", F.struct("n", "component")).alias("largest"))
    )
    sorted_out = members.join(largest, "node").withColumn("stray", F.col("component") != F.col("largest"))

    def blocks(stray: bool):
        own = F.when(F.col("stray") == F.lit(stray), F.lit(1))
        full = F.greatest(F.sum(own) / BLOCK, F.sum(own * F.col("n_shingles")) * 8 / BLOCK_BYTES)
        return F.coalesce(F.ceil(full), F.lit(0)).cast("long")

    sizes = sorted_out.groupBy("node").agg(blocks(True).alias("strays"), blocks(False).alias("settled"))
    dealt = sorted_out.join(sizes, "node").withColumn(
        "own",
        F.when(F.col("stray"), F.pmod(F.xxhash64("set_no", "node"), "strays")).otherwise(
            F.col("strays") + F.pmod(F.xxhash64("set_no", "node"), "settled")
        ),
    )
    # A stray's block meets all blocks, one of the largest component those of strays.
    zero = F.lit(0).cast("long")
    count = F.when(F.col("stray"), F.col("strays") + F.col("settled")).otherwise(F.col("strays"))
    met = dealt.withColumn("other", F.explode(F.sequence(zero, count - 1)))
    low, high = F.least("own", "other"), F.greatest("own", "other")
    side = F.when(low == high, 0).when(F.col("own") == low, 1).otherwise(2)
    return met.select(F.xxhash64("node", low, high).alias("node"), side.alias("side"), "set_no")


def small_nodes(sets: DataFrame, roots: tuple[int, int], label: str, all_pairs: bool) -> DataFrame:
    """node, side, set_no: memberships in nodes to compare, from the trees of the given roots.

    With ``all_pairs``, members of a node that stays large meet in blocks; else such
    nodes are dealt at random into small ones, enough to find a neighbour.
    """
    wanted = F.slice("roots", roots[0] + 1, roots[1] - roots[0])
    members = sets.select(F.explode(wanted).alias("node"), "set_no", "component", F.lit(None).cast("long").alias("parent_n"))
    leaves = []
    for level in range(1, LEVELS + 1):
        sizes = (
            members.groupBy("node")
            .agg(
                F.count(F.lit(1)).alias("n"),
                F.min("component").alias("low"),
                F.max("component").alias("high"),
                F.max("parent_n").alias("parent_n"),
            )
            .filter("n > 1 AND low <> high")
            .select("node", "n", F.coalesce(F.col("n") >= STUCK * F.col("parent_n"), F.lit(False)).alias("stuck"))
        )
        alive = written(members.join(sizes, "node").select("node", "set_no", "n", "stuck"), f"{label}-level{level}")
        leaves.append(alive.filter(F.col("n") <= LEAF).select("node", F.lit(0).alias("side"), "set_no"))
        large = alive.filter(F.col("n") > LEAF)
        if level == LEVELS:
            stays, splits = large, None
        else:
            stays, splits = large.filter("stuck"), large.filter("NOT stuck")
        part = F.pmod(F.xxhash64("set_no", "node"), F.ceil(F.col("n") * 4 / (3 * LEAF)))
        parts = stays.select(F.xxhash64("node", part).alias("node"), F.lit(0).alias("side"), "set_no")
        if not stays.isEmpty():
            leaves.append(_blocks(stays.drop("n", "stuck"), sets) if all_pairs else parts)
        if splits is None or splits.isEmpty():
            break
        # Stored, since both their sizes and they themselves are needed.
        parents = splits.join(sets.select("set_no", "component", "signature"), "set_no")
        members = written(_children(parents, level), f"{label}-children{level}")
    return reduce(DataFrame.unionByName, leaves)


def _by_node(given: DataFrame, work: Callable[[pa.Table], Iterator[pa.RecordBatch]], schema: str) -> DataFrame:
    """Work on whole nodes, several at once; a node is never cut."""
    ordered = given.repartition("node").sortWithinPartitions("node", "set_no")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept: pa.Table | None = None
        for batch in batches:
            table = pa.Table.from_batches([batch])
            if kept is not None:
                table = pa.concat_tables([kept, table])
            node = table.column("node").to_numpy()
            # The last node may go on in the next batch.
            whole = int(np.searchsorted(node, node[-1])) if len(node) else 0
            kept = table.slice(whole).combine_chunks()
            if whole:
                yield from work(table.slice(0, whole))
        if kept is not None and kept.num_rows:
            yield from work(kept)

    return ordered.mapInArrow(run, schema)


def _with_signatures(sets: DataFrame, nodes: DataFrame) -> DataFrame:
    found = nodes.join(sets.select("set_no", "component", "signature"), "set_no")
    return found.select("node", "side", "set_no", "component", "signature")


def neighbours(sets: DataFrame, nodes: DataFrame) -> DataFrame:
    """Pairs (a < b): members of nodes with their most similar neighbour of another component, if similar by estimate."""
    return _by_node(_with_signatures(sets, nodes), _nearest, "a long, b long").dropDuplicates(["a", "b"])


def similar_members(sets: DataFrame, nodes: DataFrame) -> DataFrame:
    """node, side, set_no, component of members with a similar one of another component; equal nodes are one."""
    found = _by_node(_with_signatures(sets, nodes), _alike, "node long, side int, set_no long, component long")
    return found.dropDuplicates(["node", "set_no"])


def _estimates(table: pa.Table) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Rows that may be compared and are similar by estimate: first, second, estimate."""
    node, side, component = (table.column(c).to_numpy() for c in ("node", "side", "component"))
    raw = b"".join(table.column("signature").to_pylist())
    signature = np.frombuffer(raw, np.uint16).reshape(-1, POSITIONS)
    distance = 1
    while True:
        # Row i against row i + distance of the same node: all pairs of all nodes at once.
        first = np.flatnonzero(node[:-distance] == node[distance:])
        if not len(first):
            return
        other = (side[first] != side[first + distance]) | (side[first] == 0)
        first = first[other & (component[first] != component[first + distance])]
        estimate = (signature[first] == signature[first + distance]).mean(1)
        similar = estimate >= LEAST_ESTIMATE
        yield first[similar], first[similar] + distance, estimate[similar]
        distance += 1


def _nearest(table: pa.Table) -> Iterator[pa.RecordBatch]:
    ids = table.column("set_no").to_numpy()
    best = np.zeros(len(ids))
    partner = np.full(len(ids), -1)
    for first, second, estimate in _estimates(table):
        better = estimate > best[second]
        best[second[better]], partner[second[better]] = estimate[better], first[better]
    linked = np.flatnonzero(partner >= 0)
    yield _pair_batch(ids[partner[linked]], ids[linked])


def _pair_batch(a: np.ndarray, b: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(np.minimum(a, b)), pa.array(np.maximum(a, b))], ["a", "b"])


def _alike(table: pa.Table) -> Iterator[pa.RecordBatch]:
    similar = np.zeros(table.num_rows, bool)
    for first, second, _ in _estimates(table):
        similar[first] = similar[second] = True
    rows = np.flatnonzero(similar)
    node, side, ids, component = (table.column(c).to_numpy()[rows] for c in ("node", "side", "set_no", "component"))
    # Trees often bring the same members together; named by its members, such a node is one.
    starts = np.flatnonzero(np.diff(node, prepend=node[:1] - 1)) if len(node) else np.empty(0, np.int64)
    stops = np.append(starts[1:], len(node))
    names = [
        xxhash.xxh3_64_intdigest(ids[a:b].astype("<i8").tobytes() + side[a:b].astype("<i4").tobytes()) - 2**63
        for a, b in zip(starts, stops)
    ]
    name = np.repeat(np.array(names, np.int64), stops - starts)
    yield pa.RecordBatch.from_arrays(
        [pa.array(name), pa.array(side.astype(np.int32)), pa.array(ids), pa.array(component)], ["node", "side", "set_no", "component"]
    )


def stored_texts(wanted: DataFrame, sets: DataFrame, docs: DataFrame, key: str, column: str) -> DataFrame:
    """set_no, text (compressed) of the wanted sets, stored once: each has one text that stands for all that give it."""
    named = written(
        wanted.select("set_no").distinct().join(sets.select("set_no", "first_digest", "first_id"), "set_no"), "op9-wanted"
    )
    texts = docs.select(F.col(key).alias("doc_id"), whole_text(column).cast("binary").alias("text"))

    def packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shrink = zstandard.ZstdCompressor(level=1).compress
        for batch in batches:
            blobs = pa.array(map(shrink, batch.column("text").to_pylist()), pa.binary())
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("digest"), blobs], ["doc_id", "digest", "text"])

    schema = T.StructType([texts.schema["doc_id"], T.StructField("digest", T.BinaryType()), T.StructField("text", T.BinaryType())])
    small = texts.select("doc_id", text_digest().alias("digest"), "text").mapInArrow(packed, schema)
    # Rows repeated with id and text give the same text again; one of them is enough.
    once = Window.partitionBy("set_no").orderBy("doc_id")
    return written(
        small.join(
            named.hint("shuffle_hash"),
            small["doc_id"].eqNullSafe(named["first_id"]) & (small["digest"] == named["first_digest"]),
        )
        .select("set_no", "text", small["doc_id"])
        .withColumn("nth", F.row_number().over(once))
        .filter("nth = 1")
        .select("set_no", "text"),
        "op9-texts",
        compression="none",
    )


def exact_links(members: DataFrame, texts: DataFrame) -> DataFrame:
    """Links (a, b) between components of a node's members, found on their full shingle sets; enough to join them."""
    given = members.join(texts, "set_no").select("node", "side", "set_no", "component", "text")
    return _by_node(given, _linked, "a long, b long")


def _linked(table: pa.Table) -> Iterator[pa.RecordBatch]:
    shingles, grow = shingler(), zstandard.ZstdDecompressor().decompress
    node, side, ids, component = (table.column(c).to_numpy() for c in ("node", "side", "set_no", "component"))
    blobs = table.column("text")
    starts = np.flatnonzero(np.diff(node, prepend=node[:1] - 1))
    found: list[tuple[int, int]] = []
    for a, b in zip(starts, np.append(starts[1:], len(node))):
        of_node = [shingles(grow(blob)) for blob in blobs.slice(a, b - a).to_pylist()]
        common = intersections(of_node)
        sizes = np.array([len(s) for s in of_node])
        alike = 100 * common >= PERCENT * (sizes[:, None] + sizes[None, :] - common)
        sides, parts = side[a:b], component[a:b]
        alike &= (sides[:, None] != sides[None, :]) | (sides[:, None] == 0)
        alike &= parts[:, None] != parts[None, :]
        # One pair for any two components, then as many as it takes to join them.
        first, second = np.nonzero(np.triu(alike, 1))
        named, local = np.unique(parts, return_inverse=True)
        low, high = np.minimum(local[first], local[second]), np.maximum(local[first], local[second])
        _, one = np.unique(low * len(named) + high, return_index=True)
        into = list(range(len(named)))
        for k in one.tolist():
            x, y = _root(into, int(low[k])), _root(into, int(high[k]))
            if x != y:
                into[x] = y
                found.append((int(ids[a + first[k]]), int(ids[a + second[k]])))
    pairs = np.array(found, np.int64).reshape(-1, 2)
    yield _pair_batch(pairs[:, 0], pairs[:, 1])


def _root(into: list[int], x: int) -> int:
    while into[x] != x:
        into[x] = into[into[x]]
        x = into[x]
    return x


def intersections(sets: list[np.ndarray]) -> np.ndarray:
    """How many shingles any two sets have in common, as products of incidence matrices of a bounded width."""
    count = len(sets)
    flat = np.concatenate(sets) if sets else np.empty(0, np.uint64)
    owner = np.repeat(np.arange(count), [len(s) for s in sets])
    _, place, times = np.unique(flat, return_inverse=True, return_counts=True)
    # Shingles of one set only are common to none.
    shared = times[place] > 1
    columns = (np.cumsum(times > 1) - 1)[place[shared]]
    owner = owner[shared]
    order = np.argsort(columns, kind="stable")
    columns, owner = columns[order], owner[order]
    # Counts stay below 2 ** 24 within a product, where float32 is exact.
    common = np.zeros((count, count), np.float64)
    width = int(columns[-1]) + 1 if len(columns) else 0
    for start in range(0, width, COLUMNS):
        a, b = np.searchsorted(columns, [start, start + COLUMNS])
        incidence = np.zeros((count, min(COLUMNS, width - start)), np.float32)
        incidence[owner[a:b], columns[a:b] - start] = 1
        common += incidence @ incidence.T
    return common.astype(np.int64)


def confirmed(pairs: DataFrame, texts: DataFrame) -> DataFrame:
    """The pairs whose full shingle sets are similar enough."""
    blobs = texts
    seconds = pairs.join(blobs.withColumnRenamed("set_no", "b"), "b").select("a", "b", "text")
    firsts = pairs.select("a").distinct().join(blobs.withColumnRenamed("set_no", "a"), "a")
    given = (
        seconds.unionByName(firsts.select("a", F.lit(None).cast("long").alias("b"), "text"))
        .repartition("a")
        .sortWithinPartitions("a", F.col("b").asc_nulls_first())
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingles, grow = shingler(), zstandard.ZstdDecompressor().decompress
        left = np.empty(0, np.uint64)
        for batch in batches:
            found: tuple[list[int], list[int]] = ([], [])
            for a, b, blob in zip(*(batch.column(c).to_pylist() for c in ("a", "b", "text"))):
                right = shingles(grow(blob))
                if b is None:
                    left = right
                    continue
                common = len(np.intersect1d(left, right, assume_unique=True))
                if 100 * common >= PERCENT * (len(left) + len(right) - common):
                    found[0].append(a)
                    found[1].append(b)
            yield pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in found], ["a", "b"])

    return given.mapInArrow(run, "a long, b long")


def components(links: DataFrame, label: str) -> DataFrame:
    """set_no, component (smallest set_no reachable) for all sets with links, by hooking and pointer jumping."""
    both = written(links.unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b"))), f"{label}-links")
    labels = written(
        both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("component")).withColumnRenamed("a", "set_no"),
        f"{label}-0",
    )
    turn = 0
    while True:
        turn += 1
        near = (
            both.join(labels.withColumnRenamed("set_no", "b"), "b")
            .groupBy(F.col("a").alias("set_no"))
            .agg(F.min("component").alias("near"))
        )
        hooked = written(
            labels.join(near, "set_no").select(
                "set_no", F.least("component", "near").alias("component"), F.col("component").alias("old")
            ),
            f"{label}-{turn}-hook",
        )
        to = hooked.select(F.col("set_no").alias("component"), F.col("component").alias("next"))
        # Labels are sets themselves; following one is a join on few different values.
        labels = written(
            hooked.join(to, "component").select("set_no", F.col("next").alias("component"), "old"), f"{label}-{turn}"
        )
        if labels.filter(F.col("component") != F.col("old")).isEmpty():
            return labels.select("set_no", "component")
        labels = labels.drop("old")


def joined(known: DataFrame | None, links: DataFrame, label: str) -> DataFrame:
    """Components after more links: (set_no, component), extended and merged."""
    if known is None:
        return components(links, label)
    named = links
    for end in ("a", "b"):
        of_end = known.select(F.col("set_no").alias(end), F.col("component").alias("of"))
        named = named.join(of_end, end, "left").withColumn(end, F.coalesce("of", end)).drop("of")
    named = written(named.filter("a <> b").distinct(), f"{label}-named")
    if named.isEmpty():
        return known
    merged = components(named, label)
    # A component's number is one of its sets, so only sets without one are new here.
    new = merged.join(known, "set_no", "left_anti").select("set_no", F.col("set_no").alias("component"))
    to = merged.select(F.col("set_no").alias("component"), F.col("component").alias("next"))
    everyone = known.unionByName(new).join(to, "component", "left")
    return written(everyone.select("set_no", F.coalesce("next", "component").alias("component")), f"{label}-joined")


def near_groups(docs: DataFrame, key: str = "doc_id", column: str = "text") -> DataFrame:
    """One row per document: doc_id, digest, n_shingles, component_id, component (a number; NULL without shingles)."""
    rows = written(described(docs, key, column), "op9-rows")
    sets = written(
        rows.filter("n_shingles > 0")
        .groupBy("set_id")
        .agg(
            F.min(F.struct("doc_id", "digest")).alias("first"),
            F.min("doc_id").alias("least_id"),
            F.first("roots").alias("roots"),
            F.first("signature").alias("signature"),
            F.first("n_shingles").alias("n_shingles"),
        )
        .select(
            F.monotonically_increasing_id().alias("set_no"),
            "set_id",
            F.col("first.doc_id").alias("first_id"),
            F.col("first.digest").alias("first_digest"),
            "least_id",
            "roots",
            "signature",
            "n_shingles",
        ),
        "op9-sets",
    )
    known = None
    first_root = 0
    for turn, trees in enumerate(TREES):
        last_root = sum(tree < sum(TREES[: turn + 1]) for tree, _ in ROOTS)
        if known is None:
            current = sets.withColumn("component", F.col("set_no"))
        else:
            current = sets.join(known, "set_no", "left").withColumn("component", F.coalesce("component", "set_no"))
        current = current.select("set_no", "component", "roots", "signature", "n_shingles")
        if known is not None:
            current = written(current, "op9-current")
        last = turn == len(TREES) - 1
        nodes = small_nodes(current, (first_root, last_root), f"op9-round{turn}", all_pairs=last)
        if last:
            found = written(similar_members(current, nodes), "op9-members")
            wanted = found
        else:
            found = written(neighbours(current, nodes), "op9-pairs")
            wanted = found.select(F.explode(F.array("a", "b")).alias("set_no"))
        if not found.isEmpty():
            texts = stored_texts(wanted, sets, docs, key, column)
            links = written(exact_links(found, texts) if last else confirmed(found, texts), "op9-confirmed")
            known = joined(known, links, f"op9-components{turn}")
        first_root = last_root
    if known is None:
        labelled = sets.withColumn("component", F.col("set_no"))
    else:
        labelled = sets.join(known, "set_no", "left").withColumn("component", F.coalesce("component", "set_no"))
    labelled = written(labelled.select("set_id", "component", "least_id"), "op9-labelled")
    ids = labelled.groupBy("component").agg(F.min("least_id").alias("component_id"))
    of_set = labelled.join(ids, "component").select("set_id", "component", "component_id")
    return rows.join(of_set, "set_id", "left").select(
        "doc_id",
        "digest",
        "n_shingles",
        F.when(F.col("n_shingles") > 0, F.col("component_id")).otherwise(F.col("doc_id")).alias("component_id"),
        F.when(F.col("n_shingles") > 0, F.col("component")).alias("component"),
    )


def group_columns(groups: DataFrame) -> DataFrame:
    return groups.select(
        "doc_id", "n_shingles", "component_id", F.col("doc_id").eqNullSafe(F.col("component_id")).alias("kept")
    )


def drop_near_copies(docs: DataFrame, key: str = "doc_id", column: str = "text") -> DataFrame:
    """The documents with all their columns, one row per component; of rows that agree in id and text one stays."""
    groups = written(near_groups(docs, key, column), "op9-groups")
    linked = groups.filter(F.col("component").isNotNull())
    winners = linked.groupBy("component").agg(F.min(F.struct("doc_id", "digest")).alias("w")).select("w.*")
    alone = groups.filter(F.col("component").isNull()).select("doc_id", "digest")
    stays = winners.unionByName(alone).distinct()
    twins = groups.groupBy("doc_id", "digest").agg(F.count(F.lit(1)).alias("twins"))
    kept = stays.join(
        twins, stays["doc_id"].eqNullSafe(twins["doc_id"]) & (stays["digest"] == twins["digest"])
    ).select(stays["doc_id"], stays["digest"], "twins")
    return keep_rows(docs, written(kept, "op9-kept"), key, column)

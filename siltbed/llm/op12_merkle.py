"""Merkle manifest of a dataset by cogrouped subtree exchange.

Rows are leaves; the leaves of a source, by doc_id, form a tree in which every
three neighbours become their hash; the roots of the sources form a tree of the
same kind above them. A superblock is what ``3 ** LEVELS`` neighbours reduce to.

1. Leaf hashes are built-in expressions, stored once. Positions are distributed
   ranks, so a source of any size is dealt over all tasks.
2. Going up, each superblock is reduced to one node; these nodes are the leaves of
   the next tier, a table smaller by the size of a superblock, until every source
   has one node. The same tiers then go over the sources.
3. Going down, the nodes of a superblock and the one row with everything outside it
   (siblings up to the root, root of the source, root) are cogrouped: local
   reduction, joining of proofs and, at the leaves, folding happen there together.
   A group holds one superblock, whatever the input.

Defined results: values are hashed as ``-`` if NULL, else as byte count, ``:`` and
value; a NULL source is a source, the first; leaves with equal doc_id go by their
hash, NULL ids first, and equal rows are equal leaves; texts of any length are one
value; an empty table gives an empty result; columns other than the hashed ones
are not read, whatever their names.
"""

from __future__ import annotations

from collections.abc import Iterable
from hashlib import sha256

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from siltbed.llm.common import crc_fold, crc_sql, ranked, written

#: Fixed values of the contract: neighbours per node and the hashed columns.
FAN = 3
COLUMNS = ["doc_id", "source", "lang", "n_chars", "text"]
#: Levels in a superblock, which holds 729 nodes.
LEVELS = 6

TIER = "tree long, block long, pos long, size long, node string"
OUTER = "tree long, block long, siblings array<string>, shape array<int>, subroot string, root string"


def hashed(parts: Iterable[str]) -> str:
    return sha256("".join(parts).encode()).hexdigest()


def _value(column: Column) -> Column:
    text = column.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def leaf_hash(text: Column, columns: list[str] = COLUMNS) -> Column:
    """SHA-256 of the row's values; ``text`` stands for the last of the columns."""
    parts = [_value(F.col(f"`{c}`")) for c in columns[:-1]] + [_value(text)]
    return F.sha2(F.concat(*parts), 256)


def leaves(docs: DataFrame, tampered: Column | None = None) -> DataFrame:
    """Stored: doc_id, source, leaf, changed (leaf of the row with the text ``tampered``; NULL where that is NULL)."""
    changed = leaf_hash(tampered) if tampered is not None else F.lit(None).cast("string")
    return written(
        docs.select(
            "doc_id",
            "source",
            leaf_hash(F.col("text")).alias("leaf"),
            (F.when(tampered.isNotNull(), changed) if tampered is not None else changed).alias("changed"),
            # Deals out rows that agree in everything else.
            F.monotonically_increasing_id().alias("row_no"),
        ),
        "op12-leaves",
    )


def positioned(found: DataFrame, levels: int = LEVELS) -> DataFrame:
    """Leaves with tree (the number of their source, in order), block, pos and size; doc_id as text, which pandas keeps exact."""
    order = [F.col(c).asc_nulls_first() for c in ("source", "doc_id", "leaf", "row_no")]
    placed = ranked(found, order, "rank", "op12-ranked")
    sources = placed.groupBy("source").agg(F.min("rank").alias("first"), F.count(F.lit(1)).alias("size"))
    numbered = ranked(sources, [F.col("first")], "tree", "op12-sources")
    met = placed.join(numbered.withColumnRenamed("source", "of"), F.col("source").eqNullSafe(F.col("of")))
    pos = F.col("rank") - F.col("first")
    return written(
        met.select(F.col("doc_id").cast("string").alias("doc_id"), "leaf", "changed", "tree", _block(pos, levels).alias("block"), pos.alias("pos"), "size"),
        "op12-positions",
    )


def _block(pos: Column, levels: int) -> Column:
    return F.floor(pos / F.lit(FAN**levels)).cast("long")


def levels_inside(size: int, levels: int) -> int:
    """How many levels a superblock of a tree with ``size`` nodes in this tier has."""
    count = 0
    while size > 1 and count < levels:
        size, count = -(-size // FAN), count + 1
    return count


def reduced(nodes: list[str], levels: int) -> list[list[str]]:
    """All levels of a superblock, from its nodes to the one they reduce to."""
    found = [nodes]
    for _ in range(levels):
        below = found[-1]
        found.append([hashed(below[at : at + FAN]) for at in range(0, len(below), FAN)])
    return found


def path_inside(levels: list[list[str]], at: int) -> tuple[list[str], list[int]]:
    """Siblings of a node, level by level and left to right, and per level 3 * left ones + right ones."""
    siblings, shape = [], []
    for nodes in levels[:-1]:
        start = at - at % FAN
        left, right = nodes[start:at], nodes[at + 1 : start + FAN]
        siblings += left + right
        shape.append(FAN * len(left) + len(right))
        at //= FAN
    return siblings, shape


def folded(node: str, siblings: list[str], shape: list[int]) -> str:
    """The root that a node and its siblings lead to."""
    at = 0
    for level in shape:
        left, right = divmod(level, FAN)
        stop = at + left + right
        node = sha256("".join([*siblings[at : at + left], node, *siblings[at + left : stop]]).encode()).hexdigest()
        at = stop
    return node


def _reduce(block: pd.DataFrame, levels: int) -> pd.DataFrame:
    block = block.sort_values("pos")
    size, tree, number = (int(block[c].iloc[0]) for c in ("size", "tree", "block"))
    top = reduced(block["node"].tolist(), levels_inside(size, levels))[-1][0]
    left = -(-size // FAN**levels)
    return pd.DataFrame({"tree": [tree], "block": [number // FAN**levels], "pos": [number], "size": [left], "node": [top]})


def _tiers(bottom: DataFrame, levels: int, label: str) -> list[DataFrame]:
    """The bottom tier and those above it, up to one node per tree."""
    found = [bottom]
    while not found[-1].filter("size > 1").isEmpty():
        above = found[-1].groupBy("tree", "block").applyInPandas(lambda block: _reduce(block, levels), TIER)
        found.append(written(above, f"{label}{len(found)}"))
    return found


def _outer_rows(nodes: pd.DataFrame, outer: pd.DataFrame, levels: int, top: bool) -> pd.DataFrame:
    """What lies outside each superblock below: one row per node of this superblock."""
    nodes = nodes.sort_values("pos")
    inside = reduced(nodes["node"].tolist(), levels_inside(int(nodes["size"].iloc[0]), levels))
    above = outer.iloc[0]
    rows = []
    for at, (pos, node) in enumerate(zip(nodes["pos"], nodes["node"])):
        siblings, shape = path_inside(inside, at)
        rows.append(
            (
                # A node of the tree of sources is the root of a source; other nodes are superblocks of their tree.
                pos if top else above["tree"],
                0 if top else pos,
                [*siblings, *above["siblings"]],
                [*shape, *map(int, above["shape"])],
                node if top else above["subroot"],
                above["root"],
            )
        )
    return pd.DataFrame(rows, columns=["tree", "block", "siblings", "shape", "subroot", "root"])


def _leaf_rows(nodes: pd.DataFrame, outer: pd.DataFrame, levels: int, proofs: bool) -> pd.DataFrame:
    """Proofs of the leaves of one superblock, folded."""
    nodes = nodes.sort_values("pos")
    inside = reduced(nodes["leaf"].tolist(), levels_inside(int(nodes["size"].iloc[0]), levels))
    above = outer.iloc[0]
    outer_siblings, outer_shape = list(above["siblings"]), list(map(int, above["shape"]))
    made: dict[str, list] = {"proof_sha256": [], "folded_root": [], "siblings": [], "shape": []}
    for at, (leaf, changed) in enumerate(zip(nodes["leaf"], nodes["changed"])):
        siblings, shape = path_inside(inside, at)
        siblings, shape = siblings + outer_siblings, shape + outer_shape
        made["proof_sha256"].append(hashed(siblings))
        made["folded_root"].append(folded(changed if isinstance(changed, str) else leaf, siblings, shape))
        if proofs:
            made["siblings"].append(siblings)
            made["shape"].append(shape)
    found = nodes[["doc_id", "tree", "pos", "leaf"]].assign(subroot=above["subroot"], root=above["root"])
    for name in ("proof_sha256", "folded_root", *(["siblings", "shape"] if proofs else [])):
        found[name] = made[name]
    return found


def manifest(docs: DataFrame, tampered: Column | None = None, proofs: bool = False, levels: int = LEVELS) -> DataFrame:
    """One row per document: doc_id, tree, pos, leaf, subroot, root, proof_sha256, folded_root.

    ``folded_root`` is what the proof makes of the leaf of the row with the text
    ``tampered`` where that is given, else of its own. With ``proofs`` the siblings
    and their places are there too, as ``folded`` takes them.
    """
    bottom = positioned(leaves(docs, tampered), levels)
    nodes = bottom.select("tree", "block", "pos", "size", F.col("leaf").alias("node"))
    own = _tiers(nodes, levels, "op12-tier")
    # The nodes of the top tree are the roots of the sources, numbered in order.
    count = own[-1].count()
    pos = F.col("tree")
    roots = own[-1].select(
        F.lit(-1).cast("long").alias("tree"),
        _block(pos, levels).alias("block"),
        pos.alias("pos"),
        F.lit(count).cast("long").alias("size"),
        "node",
    )
    above = _tiers(written(roots, "op12-roots"), levels, "op12-top")
    empty = F.array().cast("array<string>")
    outer = above[-1].select(
        "tree", "block", empty.alias("siblings"), F.array().cast("array<int>").alias("shape"), F.lit("").alias("subroot"), F.col("node").alias("root")
    )
    for number in range(len(above) - 2, -1, -1):
        outer = _exchanged(above[number], outer, levels, number == 0)
    if len(above) == 1:
        # One source: its root is the root.
        outer = outer.select(F.lit(0).cast("long").alias("tree"), F.lit(0).cast("long").alias("block"), "siblings", "shape", F.col("root").alias("subroot"), "root")
    for tier in reversed(own[1:-1]):
        outer = _exchanged(tier, outer, levels, False)
    schema = "doc_id string, tree long, pos long, leaf string, subroot string, root string, proof_sha256 string, folded_root string"
    if proofs:
        schema += ", siblings array<string>, shape array<int>"
    keys = ["tree", "block"]
    found = bottom.groupBy(*keys).cogroup(outer.groupBy(*keys)).applyInPandas(lambda nodes, above: _leaf_rows(nodes, above, levels, proofs), schema)
    return found.withColumn("doc_id", F.col("doc_id").cast(docs.schema["doc_id"].dataType))


def _exchanged(tier: DataFrame, outer: DataFrame, levels: int, top: bool) -> DataFrame:
    keys = ["tree", "block"]
    met = tier.groupBy(*keys).cogroup(outer.groupBy(*keys))
    return written(met.applyInPandas(lambda nodes, above: _outer_rows(nodes, above, levels, top), OUTER), "op12-outer")


def without_line_breaks(docs: DataFrame) -> Column:
    """The text that the contract's tampering leaves; NULL where it leaves the row as it is."""
    return F.when(crc_fold("doc_id", 2) == 0, F.translate("text", "\n", ""))


def manifest_columns(found: DataFrame) -> DataFrame:
    return found.select(
        "doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", (F.col("folded_root") == F.col("root")).alias("verified")
    )


def _leaf_sql(text: str) -> str:
    values = [*COLUMNS[:-1], text]
    parts = [f"coalesce(strlen({v}::VARCHAR)::VARCHAR || ':' || {v}::VARCHAR, '-')" for v in values]
    return f"sha256({' || '.join(parts)})"


SQL = f"""
WITH RECURSIVE leaves AS MATERIALIZED (
    SELECT *, row_number() OVER (PARTITION BY tree ORDER BY doc_id NULLS FIRST, leaf) - 1 AS pos
    FROM (SELECT doc_id, dense_rank() OVER (ORDER BY source NULLS FIRST) - 1 AS tree, {_leaf_sql('text')} AS leaf,
                 CASE WHEN {crc_sql('doc_id')} % 2 = 0 AND text IS NOT NULL THEN {_leaf_sql("replace(text, chr(10), '')")} END AS changed
          FROM documents)),
own AS (
    SELECT tree, 0 AS level, pos, leaf AS node, count(*) OVER (PARTITION BY tree) AS size FROM leaves
    UNION ALL
    SELECT tree, any_value(level) + 1, pos // 3, sha256(string_agg(node, '' ORDER BY pos)), any_value((size + 2) // 3)
    FROM own WHERE size > 1 GROUP BY tree, pos // 3),
above AS (
    SELECT tree AS pos, 0 AS level, node, count(*) OVER () AS size FROM own WHERE size = 1
    UNION ALL
    SELECT pos // 3, any_value(level) + 1, sha256(string_agg(node, '' ORDER BY pos)), any_value((size + 2) // 3)
    FROM above WHERE size > 1 GROUP BY pos // 3),
runs AS MATERIALIZED (
    SELECT false AS top, tree, level, pos // 3 AS run, list(node ORDER BY pos) AS nodes FROM own WHERE size > 1 GROUP BY ALL
    UNION ALL
    SELECT true, 0, level, pos // 3, list(node ORDER BY pos) FROM above WHERE size > 1 GROUP BY ALL),
heights AS MATERIALIZED (
    SELECT tree, max(level) AS height, max(node) FILTER (size = 1) AS subroot FROM own GROUP BY tree),
paths AS (
    SELECT doc_id, leaf, l.tree, pos AS place, coalesce(changed, leaf) AS node, '' AS siblings, 0 AS step, height, subroot,
           (SELECT max(level) FROM above) AS top_height
    FROM leaves l JOIN heights USING (tree)
    UNION ALL
    SELECT doc_id, leaf, p.tree, place // 3,
           sha256(array_to_string(list_concat(nodes[:place % 3], [node], nodes[place % 3 + 2:]), '')),
           siblings || array_to_string(list_concat(nodes[:place % 3], nodes[place % 3 + 2:]), ''),
           step + 1, height, subroot, top_height
    FROM (SELECT * REPLACE (CASE WHEN step = height THEN tree ELSE place END AS place) FROM paths) p
    JOIN runs r ON r.top = (step >= height) AND r.tree = CASE WHEN step < height THEN p.tree ELSE 0 END
        AND r.level = step - CASE WHEN step >= height THEN height ELSE 0 END AND r.run = place // 3
    WHERE step < height + top_height)
SELECT doc_id, leaf, subroot, root, sha256(siblings) AS proof_sha256, node AS folded_root, node = root AS verified
FROM paths, (SELECT node AS root FROM above WHERE size = 1) WHERE step = height + top_height
"""

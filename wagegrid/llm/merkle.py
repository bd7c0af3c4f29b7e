"""Merkle manifest of a dataset, with proofs found by pointer jumping.

Every row is a leaf.  The leaves of a tree, in order of a key, are joined two by two until
one node, the subroot, remains; the subroots of all trees, in order of the trees' names, are
the leaves of one more tree, whose last node is the root.  A node is the SHA-256 of its
children's digests as hex text; the last node of a level may have a single child.

A proof holds, level by level, the sibling digests from a leaf up to the root.  Every node
starts with its own sibling and points at its parent.  A round joins the nodes with those
they point at: the segments are put end to end and the distance doubles, so that a leaf of a
tree of ``n`` leaves reaches the root in log2(log2(n)) rounds.  After ``r`` rounds only nodes at levels divisible by ``2**r`` are still pointed at,
and only these stay.  All of it is DataFrame functions.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wagegrid import settings
from wagegrid.llm.common import looked_up
from wagegrid.operators import positions

#: Levels of a tree that are worked out in one array.
BLOCK_LEVELS = 8
#: Leaves numbered by one task.
ROWS_PER_SLICE = 1_000_000
#: Nodes that a join sends to all tasks at most.
BROADCAST_NODES = 100_000

# A segment is one entry per level, "left.right/": the dot stands for the digest below.
_HERE, _END = ".", "/"


def leaf_digest(*columns: Column) -> Column:
    """SHA-256 (hex) of the values, each ``-`` if null, else its UTF-8 byte count, ``:`` and itself."""
    texts = [c.cast("string") for c in columns]
    sized = [F.coalesce(F.concat(F.octet_length(t).cast("string"), F.lit(":"), t), F.lit("-")) for t in texts]
    return F.sha2(F.concat(*sized).cast("binary"), 256)


def _parents(level: Column) -> Column:
    """The level above: digests of neighbours two by two."""
    at = F.sequence(F.lit(0), F.floor((F.size(level) - 1) / 2).cast("int"))
    pair = lambda i: F.concat(F.get(level, 2 * i), F.coalesce(F.get(level, 2 * i + 1), F.lit("")))
    return F.transform(at, lambda i: F.sha2(pair(i).cast("binary"), 256))


def _entry(digests: str, at: str) -> Column:
    """The segment entry of the node ``at``: its sibling's digest on the side where it is."""
    left, right = F.get(F.col(digests), F.col(at) - 1), F.get(F.col(digests), F.col(at) + 1)
    even = F.col(at) % 2 == 0
    return F.concat(F.when(even, "").otherwise(left), F.lit(_HERE), F.when(even, F.coalesce(right, F.lit(""))).otherwise(""), F.lit(_END))


def _blocks(rows: DataFrame, base: int, carried: list[str]) -> DataFrame:
    """One row per run of ``2**BLOCK_LEVELS`` neighbours: ``levels`` holds the digests at level
    ``base``, those above, and so on, up to the subroot at most.
    """
    order = lambda a, b: F.when(a["at"] < b["at"], -1).otherwise(1)
    inside = F.array_sort(F.collect_list(F.struct("at", "digest", *carried)), order)
    held = rows.groupBy("tree", "height", F.shiftright("at", BLOCK_LEVELS).alias("block")).agg(inside.alias("nodes"))
    lowest = F.array(F.col("nodes.digest"))
    more = F.sequence(F.lit(1), F.least(F.lit(BLOCK_LEVELS), F.col("height") - base))
    raised = F.aggregate(more, lowest, lambda made, _: F.concat(made, F.array(_parents(F.element_at(made, -1)))))
    held = held.withColumn("levels", F.when(F.col("height") > base, raised).otherwise(lowest))
    return settings.written(held.drop("nodes") if base else held, f"merkle-{base}")


def _nodes(blocks: DataFrame, base: int) -> DataFrame:
    """(tree, height, level, at, segment): nodes above the leaves with a parent, and their sibling's entry."""
    levels = blocks.select("tree", "height", "block", F.posexplode("levels").alias("i", "digests"))
    levels = levels.withColumn("level", F.col("i") + base).where("level > 0 AND level < height")
    # the highest level of a block is the lowest of the next
    nodes = levels.where(F.col("i") < BLOCK_LEVELS).select("*", F.posexplode("digests").alias("k", "digest"))
    at = F.expr(f"shiftleft(block, {BLOCK_LEVELS} - i)") + F.col("k")
    return nodes.select("tree", "height", "level", at.alias("at"), _entry("digests", "k").alias("segment"))


def tree_proofs(leaves: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Subroots and proofs of the trees in ``leaves``: (tree long, at long, digest string, ...).

    ``at`` counts the leaves of a tree from 0.  First result: tree, subroot.  Second: every row
    of ``leaves`` with ``segment``, its proof up to the subroot (empty for a lone leaf).
    """
    carried = [c for c in leaves.columns if c not in ("tree", "at", "digest")]
    counts = settings.written(
        leaves.groupBy("tree").agg(F.count("*").alias("n")).select(
            "tree", F.when(F.col("n") > 1, F.length(F.bin(F.col("n") - 1))).otherwise(0).cast("int").alias("height")
        ), "merkle-heights",
    )
    highest = counts.agg(F.max("height")).first()[0] or 0
    rows, parts, nodes = looked_up(leaves, counts, "tree", F.xxhash64("at")), [], None
    subroots = None
    for base in range(0, max(highest, 1), BLOCK_LEVELS):
        held = _blocks(rows, base, carried if base == 0 else [])
        parts.append(held)
        nodes = _nodes(held, base) if nodes is None else nodes.unionByName(_nodes(held, base))
        last = F.get(F.element_at("levels", F.col("height") - base + 1), F.lit(0))
        ends = held.where(F.col("height").between(base + (base > 0), base + BLOCK_LEVELS)).select("tree", last.alias("subroot"))
        subroots = ends if subroots is None else subroots.unionByName(ends)
        rows = held.where(F.col("height") > base + BLOCK_LEVELS).select(
            "tree", "height", F.col("block").alias("at"), F.get(F.element_at("levels", -1), F.lit(0)).alias("digest")
        )
    subroots = settings.written(subroots, "merkle-subroots")

    first = parts[0].select("tree", "height", "block", F.col("levels")[0].alias("digests"), F.posexplode("nodes").alias("k", "node"))
    proofs = first.select(
        "tree", "height", (F.shiftleft("block", BLOCK_LEVELS) + F.col("k")).alias("at"), "node.digest",
        *[F.col("node")[c].alias(c) for c in carried],
        F.when(F.col("height") > 0, _entry("digests", "k")).otherwise("").alias("segment"),
    )
    proofs, step = proofs.withColumn("level", F.lit(0)), 1
    while step < highest:
        # segments of all rows span ``step`` levels now, or end at the subroot
        nodes = settings.written(nodes, f"merkle-up-{step}")
        proofs = _jumped(proofs, nodes.where(F.col("level") == step), step)
        met = nodes.where(F.col("level") % (2 * step) == step)
        nodes = _jumped(nodes.where(F.col("level") % (2 * step) == 0), met, step)
        step *= 2
    return subroots, proofs.drop("height", "level")


def _jumped(rows: DataFrame, nodes: DataFrame, step: int) -> DataFrame:
    """``rows`` with the segment of the ancestor ``step`` levels above behind their own.

    A node's place gives the place of its ancestor; there is none above the subroot.  An
    ancestor has at most ``2**step`` rows that point at it, so that joins for long
    distances have few nodes on their other side.
    """
    found = settings.small_side(nodes.select(
        F.col("tree").alias("#tree"), F.col("level").alias("#level"), F.col("at").alias("#at"), F.col("segment").alias("#more")
    ), BROADCAST_NODES)
    above = (F.col("level") + step == F.col("#level")) & (F.shiftright("at", step) == F.col("#at"))
    joined = rows.join(found, (F.col("tree") == F.col("#tree")) & above, "left")
    return joined.withColumn("segment", F.concat("segment", F.coalesce("#more", F.lit("")))).select(*rows.columns)


def manifest(docs: DataFrame, digest: str, tree: str, key: str) -> DataFrame:
    """All columns of ``docs`` with subroot, root and proof, for leaf digests in column ``digest``.

    Each value of ``tree`` (a string; null is a tree of its own, the first) is a tree; its
    leaves ascend by ``key`` (nulls first), rows with equal keys by their digest.  Equal rows
    are leaves of their own.  Trees are ordered bytewise.  ``proof`` is the text of the
    sibling segments, read by ``proof_siblings`` and ``folded``.  An empty table has no rows.
    Columns named subroot, root or proof are replaced.
    """
    kept = docs.drop("subroot", "root", "proof")
    name = F.coalesce(F.concat(F.lit("="), F.col(tree)), F.lit(""))
    leaves = kept.select(
        name.alias("name"), F.col(digest).alias("digest"), F.struct(*[F.col(f"`{c}`") for c in kept.columns]).alias("row"),
        F.struct(F.col(f"`{key}`"), F.col(f"`{digest}`"), F.monotonically_increasing_id()).alias("order"),
    )
    leaves = settings.written(leaves, "merkle-leaves")
    trees = settings.written(
        positions.row_numbers(leaves.select("name").distinct(), "name", name="tree"), "merkle-trees"
    )
    leaves = looked_up(leaves, trees, "name", F.xxhash64("order")).drop("name")
    # a tree that holds most rows is numbered in slices
    per_task = leaves.count() // int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    leaves = positions.row_numbers(
        leaves, "order", within=("tree",), name="at", rows_per_slice=max(1, min(ROWS_PER_SLICE, per_task))
    )
    subroots, proofs = tree_proofs(leaves.drop("order"))

    tops = subroots.select(F.lit(0).cast("long").alias("tree"), F.col("tree").alias("at"), F.col("subroot").alias("digest"))
    roots, upper = tree_proofs(tops)
    root = roots.first()
    facts = upper.select(
        F.col("at").alias("tree"), F.col("digest").alias("subroot"), F.lit(root.subroot if root else None).alias("root"),
        F.col("segment").alias("#upper"),
    )
    joined = looked_up(proofs, settings.written(facts, "merkle-tops"), "tree", F.xxhash64("at"))
    return joined.select("row.*", "subroot", "root", F.concat("segment", "#upper").alias("proof"))


def proof_siblings(proof: Column) -> Column:
    """The sibling digests of a proof, from the leaf to the root, end to end."""
    return F.translate(proof, _HERE + _END, "")


def folded(leaf: Column, proof: Column) -> Column:
    """The root that follows from a leaf digest and a proof."""
    entries = F.filter(F.split(proof, _END), lambda e: e != "")
    return F.aggregate(entries, leaf, lambda now, e: F.sha2(F.replace(e, F.lit(_HERE), now).cast("binary"), 256))


def checked_manifest(docs: DataFrame, columns: list[str], tree: str, key: str, tampered: Column, changed: dict[str, Column]) -> DataFrame:
    """key, leaf, subroot, root, proof_sha256, folded_root, verified for every row.

    ``columns`` make the leaf.  Rows where ``tampered`` holds are folded from the leaf of the
    values in ``changed`` (a null stays null) along the proof of the true one.
    """
    plain = leaf_digest(*[F.col(c) for c in columns])
    other = leaf_digest(*[changed.get(c, F.col(c)) for c in columns])
    rows = docs.select(
        F.col(key).alias("key"), F.col(tree).alias("tree_name"), plain.alias("leaf"),
        F.when(F.coalesce(tampered, F.lit(False)), other).otherwise(F.lit(None).cast("string")).alias("changed"),
    )
    rows = manifest(rows, "leaf", "tree_name", "key")
    rows = rows.withColumn("folded_root", folded(F.coalesce("changed", "leaf"), F.col("proof")))
    return rows.select(
        F.col("key").alias(key), "leaf", "subroot", "root", F.sha2(proof_siblings(F.col("proof")).cast("binary"), 256).alias("proof_sha256"),
        "folded_root", (F.col("folded_root") == F.col("root")).alias("verified"),
    )

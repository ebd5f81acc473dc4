"""Merkle manifest of a dataset: a digest per row, per group and for the whole, with a proof for every row.

Every row is a leaf. Within a group leaves are ranked, and the binary digits of the rank say where a leaf hangs:
the lowest digit is grouped away first, which nests two children in the struct of their parent, then the next.
Eight digits are grouped away within a block of 256 nodes, all in one task, after a single shuffle by block; the
block roots are the nodes of the next tier, and so on. What a group is left with is its subroot, and the subroots
are the leaves of one more tree. Proofs come back down the same way: ``transform`` walks the nested structs of a
block from its root to its leaves, each child taking its sibling's digest along, and ``explode`` makes them rows.
The way above a block meets the block by grouping on the block's number, one row each. No node holds more than a
block, no join takes part in the trees or the proofs, and a group that holds most rows has most blocks.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallyloom.llm.texts import settle

#: Digits grouped away within a block.
BITS = 8

PROOF = "array<struct<sibling: string, is_left: boolean>>"


def digest(text: Column) -> Column:
    """Lowercase hex SHA-256."""
    return F.sha2(text, 256)


def leaf_digest(fields: Sequence[Column]) -> Column:
    """Digest of the fields, each ``-`` if null, else its UTF-8 byte count, ``:`` and its value."""
    texts = [f.cast("string") for f in fields]
    sized = [F.coalesce(F.concat(F.octet_length(t).cast("string"), F.lit(":"), t), F.lit("-")) for t in texts]
    return digest(F.concat(*sized))


def fold(leaf: Column, proof: Column) -> Column:
    """The root that a leaf digest and its proof lead to. A step without a sibling hashes the node alone."""
    def up(node: Column, step: Column) -> Column:
        sibling = F.coalesce(step["sibling"], F.lit(""))
        return digest(F.when(step["is_left"], F.concat(sibling, node)).otherwise(F.concat(node, sibling)))

    return F.aggregate(proof, leaf, up)


def _ranked(rows: DataFrame, order: Sequence[str], name: str) -> DataFrame:
    """``rows`` with ``_rank`` (0.. within ``_g`` by ``order``) and ``_levels``, the height of the group's tree.

    One range shuffle sorts the table; a row's place in its part, less where its group begins there, plus the
    group's rows in earlier parts, is its rank. So no task holds a group. ``order`` tells all rows apart.
    """
    sorted_rows = rows.repartitionByRange("_g", *order).sortWithinPartitions("_g", *order)
    # The id counts rows within a part, and has the part's number above bit 33.
    placed = settle(sorted_rows.withColumn("_at", F.monotonically_increasing_id()), name)
    part = F.shiftright("_at", 33).alias("_part")
    sizes = placed.groupBy("_g", part).agg(F.count("*").alias("_n"), F.min("_at").alias("_first"))
    along = Window.partitionBy("_g").orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    total = F.sum("_n").over(Window.partitionBy("_g"))
    begins = sizes.select(
        "_g", "_part", "_first", F.coalesce(F.sum("_n").over(along), F.lit(0)).alias("_before"),
        F.when(total > 1, F.length(F.bin(total - 1))).otherwise(0).alias("_levels"),
    )
    return placed.withColumn("_part", part).join(begins, ["_g", "_part"]).withColumn(
        "_rank", F.col("_before") + F.col("_at") - F.col("_first")
    ).drop("_part", "_at", "_first", "_before")


def _blocks(nodes: DataFrame, base: int) -> DataFrame:
    """One row per block of ``nodes`` (``_g, _levels, _rank, _hash, _load``): the block's root with all below it nested.

    ``base`` is the level of ``nodes`` in their tree; where a tree has no level left, a node is handed up as it is.
    """
    digits = [F.shiftright("_rank", i).bitwiseAND(1).alias(f"_d{i}") for i in range(BITS)]
    rows = nodes.select(
        "_g", "_levels", F.shiftright("_rank", BITS).alias("_block"), *digits,
        F.struct(F.col("_hash").alias("hash"), F.col("_load").alias("load")).alias("_node"),
    ).repartition("_g", "_block")
    for i in range(BITS):
        keys = ["_g", "_levels", "_block", *(f"_d{j}" for j in range(i + 1, BITS))]
        children = F.sort_array(F.collect_list(F.struct(F.col(f"_d{i}").alias("digit"), F.col("_node").alias("node"))))
        rows = rows.groupBy(*keys).agg(children.alias("_children"))
        below = F.transform("_children", lambda c: c["node"]["hash"])
        parent = F.when(F.col("_levels") > base + i, digest(F.array_join(below, ""))).otherwise(below[0])
        rows = rows.select(*keys, F.struct(parent.alias("hash"), F.col("_children").alias("children")).alias("_node"))
    return rows


def _climb(nodes: DataFrame, name: str) -> tuple[list[DataFrame], DataFrame]:
    """The stored blocks of each tier, lowest first, and one node per group: ``(_g, _hash)``."""
    highest = nodes.agg(F.max("_levels")).first()[0] or 0
    tiers: list[DataFrame] = []
    while not tiers or BITS * len(tiers) < highest:
        tiers.append(settle(_blocks(nodes, BITS * len(tiers)), f"{name}_{len(tiers)}"))
        nodes = tiers[-1].select(
            "_g", "_levels", F.col("_block").alias("_rank"), F.col("_node.hash").alias("_hash"), F.col("_block").alias("_load")
        )
    return tiers, nodes.select("_g", "_hash")


def _descend(tiers: list[DataFrame], above: DataFrame) -> DataFrame:
    """Every node of the lowest tier as ``(_load, _hash, _top, _proof)``.

    ``above`` has a row per group: ``_g``, what its nodes take along (``_top``) and the proof above its root.
    """
    above = above.withColumn("_block", F.lit(0).cast("long"))
    for tier in range(len(tiers) - 1, -1, -1):
        # One block and one way above it per key; they meet by grouping.
        met = tiers[tier].unionByName(above, allowMissingColumns=True).groupBy("_g", "_block").agg(
            *(F.first(c, ignorenulls=True).alias(c) for c in ("_levels", "_node", "_top", "_proof"))
        )
        nodes = F.array(F.struct(F.col("_node").alias("node"), F.col("_proof").alias("proof")))
        for i in range(BITS - 1, -1, -1):
            nodes = _children(nodes, F.col("_levels") > tier * BITS + i)
        rows = met.select("_g", "_top", F.explode(nodes).alias("_n"))
        node = [F.col("_n.node.load").alias("_load"), F.col("_n.node.hash").alias("_hash"), "_top", F.col("_n.proof").alias("_proof")]
        rows = rows.select("_g", *node)
        above = rows.select("_g", F.col("_load").alias("_block"), "_top", "_proof") if tier else rows.drop("_g")
    return above


def _children(nodes: Column, is_level: Column) -> Column:
    """The children of ``nodes``, in order, each with the proof from it to the root."""
    def below(parent: Column) -> Column:
        children = parent["node"]["children"]

        def child(c: Column, i: Column) -> Column:
            step = F.struct(F.get(children, 1 - i)["node"]["hash"].alias("sibling"), (i == 1).alias("is_left"))
            way = F.when(is_level, F.concat(F.array(step), parent["proof"])).otherwise(parent["proof"])
            return F.struct(c["node"].alias("node"), way.alias("proof"))

        return F.transform(children, child)

    return F.flatten(F.transform(nodes, below))


def manifest(
    docs: DataFrame, fields: Sequence[str] = ("doc_id", "source", "lang", "n_chars", "text"), group: str = "lang",
    order: str = "doc_id", changed: dict[str, Column] | None = None,
) -> DataFrame:
    """``(<order>, <group>, leaf, changed_leaf, subroot, root, proof)``, one row per row of ``docs``.

    ``fields`` are hashed by ``leaf_digest``. Leaves of a ``group`` value ascend by ``order`` (null first; leaves with
    the same ``order`` by their digest, and equal ones in any order, which changes no digest). ``proof`` lists the
    siblings from the leaf to ``root``, for ``fold``. ``changed`` gives other expressions for some fields, from which
    ``changed_leaf`` is made; it is the leaf where nothing changes.

    Repeated rows are leaves each. A null group is a group of its own, before the others, which follow by their UTF-8
    bytes; a null field is hashed as such. A table of one row has its leaf for subroot and root, and an empty proof.
    An empty table gives an empty result; columns other than the named ones are not read. Texts are read once and
    never shuffled.
    """
    plain = [F.col(f"`{f}`") for f in fields]
    other = [(changed or {}).get(f, c) for f, c in zip(fields, plain)]
    leaves = settle(
        docs.select(
            # '' is the null group: first, and no value begins otherwise than with '='.
            F.coalesce(F.concat(F.lit("="), F.col(f"`{group}`").cast("string")), F.lit("")).alias("_g"),
            F.col(f"`{order}`").alias("_order"), leaf_digest(plain).alias("_hash"), leaf_digest(other).alias("_changed"),
            F.monotonically_increasing_id().alias("_row"),
        ),
        "leaves",
    )
    load = F.struct(F.col("_order").alias("id"), F.col("_changed").alias("changed"))
    ranked = _ranked(leaves, ["_order", "_hash", "_row"], "ranked_leaves")
    tiers, subroots = _climb(ranked.select("_g", "_levels", "_rank", "_hash", load.alias("_load")), "leaf_blocks")
    # The tree over the subroots: one group, whose leaves carry the name of the group they stand for.
    groups = subroots.select(F.lit("").alias("_g"), F.col("_g").alias("_name"), "_hash")
    upper, root = _climb(
        _ranked(groups, ["_name"], "ranked_subroots").select("_g", "_levels", "_rank", "_hash", F.col("_name").alias("_load")),
        "subroot_blocks",
    )
    start = root.select("_g", F.col("_hash").alias("_top"), F.array().cast(PROOF).alias("_proof"))
    above = _descend(upper, start).select(
        F.col("_load").alias("_g"), F.struct(F.col("_hash").alias("subroot"), F.col("_top").alias("root")).alias("_top"), "_proof"
    )
    # The name of the group goes along with its subroot.
    above = above.withColumn("_top", F.struct(F.col("_g").alias("group"), "_top.subroot", "_top.root"))
    name = F.when(F.col("_top.group") != "", F.expr("substring(_top.group, 2)"))
    return _descend(tiers, above).select(
        F.col("_load.id").alias(order), name.alias(group), F.col("_hash").alias("leaf"),
        F.col("_load.changed").alias("changed_leaf"), "_top.subroot", "_top.root", F.col("_proof").alias("proof"),
    )


def verified(rows: DataFrame) -> DataFrame:
    """``manifest`` rows with ``proof_sha256``, ``folded_root`` (from ``changed_leaf``) and ``verified``."""
    siblings = F.array_join(F.transform("proof", lambda s: s["sibling"]), "")
    return rows.withColumn("proof_sha256", digest(siblings)).withColumn(
        "folded_root", fold(F.col("changed_leaf"), F.col("proof"))
    ).withColumn("verified", F.col("folded_root") == F.col("root"))

"""Merkle dataset manifest with a proof for every row, by butterfly exchange.

A leaf is the SHA-256 of a row's fields. Per group (a language) the leaves, in order
of id, are hashed up ``FANOUT`` at a time to a subroot; the subroots, in order of the
group's name (null first), are hashed up likewise to the root.

Leaves are dealt in aligned blocks of ``FANOUT ** block_levels`` consecutive leaves. A
block hashes its own leaves to one node. Then the blocks' nodes are exchanged as a
butterfly: in round r the up to ``FANOUT`` blocks whose numbers differ in digit r only
swap the nodes of their subtrees, and each hashes their parent for itself. After round
r a block thus knows its ancestor at level r + 1 and the siblings met on the way, so
when the rounds end it holds its whole upper proof and the subroot without a pass back
down. Blocks that a ragged last subtree lacks take part as blocks without leaves (fewer
than twice the blocks in all): they hold no node of their own, but relay what they
learned. The subroots are exchanged the same way. In the end each block joins its upper
proof with its own leaves' proofs.

Every round is one shuffle of one row a block, keyed by groups of at most ``FANOUT``
rows. Positions come from a range partitioning and a table of counts per (range,
group), so no group is ever sorted or hashed in one task, whatever its share.

Defined cases: null fields are hashed as '-', so null and empty differ; a null id comes
first in its group and has no tampered form; rows of equal id are ordered by their
leaf, repeated rows each have a leaf and a proof; a single row is root, subroot and leaf
at once, with an empty proof; an empty table gives no rows; a null group is a group of
its own; columns other than the named ones are not read.
"""

from __future__ import annotations

from hashlib import sha256

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from chunkwise.llm.common import fold, stored

FANOUT = 8
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
PROOF = "left array<string>, right array<string>"


def field_bytes(value: Column) -> Column:
    """'-' for null, else the UTF-8 byte count, a colon and the value."""
    text = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def leaf_hash(fields: dict[str, Column]) -> Column:
    return F.sha2(F.concat(*[field_bytes(c) for c in fields.values()]), 256)


def _leaves(docs: DataFrame, fields: tuple[str, ...], doc_id: str, text: str, group: str,
            tampered: Column | None) -> DataFrame:
    """``tree, doc_id, leaf, altered, _row``; digests as bytes. ``tree`` sorts as the group
    does, null first. ``altered`` is the leaf with the text in lower case, where ``tampered``."""
    plain = {c: F.col(f"`{c}`") for c in fields}
    lowered = plain | {text: F.translate(plain[text], "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")}
    hit = F.coalesce(tampered, F.lit(False)) if tampered is not None else F.lit(False)
    return docs.select(
        F.coalesce(F.concat(F.lit("+"), F.col(f"`{group}`").cast("string")), F.lit("")).alias("tree"),
        F.col(f"`{doc_id}`").alias("doc_id"), F.unhex(leaf_hash(plain)).alias("leaf"),
        F.when(hit, F.unhex(leaf_hash(lowered))).alias("altered"),
        F.monotonically_increasing_id().alias("_row"))


def positions(rows: DataFrame, tree: str, order: list[str], name: str) -> DataFrame:
    """``rows`` with ``pos`` (from 0 in its tree, by ``order``) and ``n`` (rows of the tree).

    ``order`` has to be unique in a tree. Rows are range-partitioned and written with
    their place in their range; counts per (range, tree) give the offsets, a table of at
    most ranges + trees rows.
    """
    ranged = rows.repartitionByRange(tree, *order).sortWithinPartitions(tree, *order)
    ranged = stored(ranged.withColumn("_at", F.monotonically_increasing_id()), name)
    ranged = ranged.withColumn("_range", F.shiftright("_at", 33))
    cells = ranged.groupBy("_range", tree).agg(F.min("_at").alias("_first"), F.count(F.lit(1)).alias("_n"))
    ahead = Window.partitionBy(tree).orderBy("_range")
    cells = (cells.withColumn("_off", F.sum("_n").over(ahead) - F.col("_n"))
             .withColumn("n", F.sum("_n").over(Window.partitionBy(tree))).drop("_n"))
    return (ranged.join(cells, ["_range", tree])
            .withColumn("pos", F.col("_off") + F.col("_at") - F.col("_first"))
            .drop("_range", "_at", "_off", "_first"))


def _parent(nodes: list[str]) -> str:
    return sha256("".join(nodes).encode()).hexdigest()


def hash_up(nodes: list[str], levels: int) -> list[list[str]]:
    """The given level and ``levels`` more above it, ``FANOUT`` nodes to a parent."""
    out = [nodes]
    for _ in range(levels):
        below = out[-1]
        out.append([_parent(below[i:i + FANOUT]) for i in range(0, len(below), FANOUT)])
    return out


def _block_depth(n: int, block_levels: int) -> int:
    """Levels hashed inside a block of a tree of ``n`` leaves."""
    depth, width = 0, 1
    while width < n and depth < block_levels:
        depth, width = depth + 1, width * FANOUT
    return depth


def _with_relays(nodes: DataFrame) -> DataFrame:
    """``tree, slot, n, node`` filled up to whole subtrees below the topmost level: relay
    slots have no node. Their number is below that of the nodes."""
    span = F.aggregate(F.sequence(F.lit(1), F.lit(20)), F.lit(1).cast("long"),
                       lambda a, _: F.when(a * FANOUT < F.col("n"), a * FANOUT).otherwise(a))
    trees = nodes.groupBy("tree").agg(F.first("n").alias("n")).withColumn("_span", span)
    full = F.ceil(F.col("n") / F.col("_span")) * F.col("_span")
    relays = (trees.withColumn("_full", full).where("_full > n")
              .select("tree", F.explode(F.sequence(F.col("n"), F.col("_full") - 1)).alias("slot"), "n",
                      F.lit(None).cast("string").alias("node")))
    return nodes.select("tree", "slot", "n", "node").unionByName(relays)


def butterfly(nodes: DataFrame) -> DataFrame:
    """``tree, slot, top, left, right`` for rows ``tree, slot, n, node`` (slots 0..n - 1).

    ``top`` is the tree's root; ``left`` and ``right`` hold, level by level, the joined
    digests of the siblings before and after the slot's ancestor.
    """
    most = nodes.agg(F.max("n")).first()[0] or 1
    none = F.expr("cast(array() as array<string>)")
    state = _with_relays(nodes).withColumn("left", none).withColumn("right", none)
    step = 1
    while step < most:
        group = Window.partitionBy("tree", F.floor(F.col("slot") / (step * FANOUT)), F.col("slot") % step)
        swapped = state.withColumn("_met", F.array_sort(F.collect_list(F.struct("slot", "node")).over(group)))
        joined = lambda keep: F.concat_ws("", F.transform(F.filter("_met", keep), lambda m: m["node"]))
        present = F.exists("_met", lambda m: m["node"].isNotNull())
        parent = F.when(present, F.sha2(joined(lambda m: m["node"].isNotNull()), 256))
        before = joined(lambda m: m["node"].isNotNull() & (m["slot"] < F.col("slot")))
        after = joined(lambda m: m["node"].isNotNull() & (m["slot"] > F.col("slot")))
        going = F.col("n") > step  # more than one node left at this level
        state = swapped.select(
            "tree", "slot", "n", F.when(going, parent).otherwise(F.col("node")).alias("node"),
            F.when(going, F.concat("left", F.array(before))).otherwise(F.col("left")).alias("left"),
            F.when(going, F.concat("right", F.array(after))).otherwise(F.col("right")).alias("right"))
        step *= FANOUT
    return state.where("slot < n").select("tree", "slot", F.col("node").alias("top"), "left", "right")


def manifest(docs: DataFrame, fields: tuple[str, ...] = FIELDS, doc_id: str = "doc_id", text: str = "text",
             group: str = "lang", tampered: Column | None = None, block_levels: int = 3) -> DataFrame:
    """``doc_id, leaf, altered, subroot, root, left, right``, one row per row of ``docs``.

    ``left[i]`` and ``right[i]`` are the joined digests of the siblings before and after
    the row's ancestor at level i, through the subroot up to the root. ``altered`` is the
    leaf of the tampered row where ``tampered`` (a column of ``docs``) holds, else null.
    """
    size = FANOUT ** block_levels
    leaves = stored(_leaves(docs, fields, doc_id, text, group, tampered), "leaves")
    placed = positions(leaves, "tree", ["doc_id", "leaf", "_row"], "ordered-leaves").drop("_row")
    placed = stored(placed.withColumn("slot", F.floor(F.col("pos") / size))
                    .withColumn("n_blocks", F.ceil(F.col("n") / size)), "placed-leaves")

    def block_node(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values("pos")
        levels = hash_up([bytes(x).hex() for x in rows["leaf"]], _block_depth(int(rows["n"].iloc[0]), block_levels))
        return pd.DataFrame({"tree": [key[0]], "slot": [key[1]], "n": [rows["n_blocks"].iloc[0]],
                             "node": [levels[-1][0]]})

    nodes = (placed.select("tree", "slot", "pos", "n", "n_blocks", "leaf").groupBy("tree", "slot")
             .applyInPandas(block_node, "tree string, slot long, n long, node string"))
    blocks = stored(butterfly(stored(nodes, "block-nodes")), "block-proofs")
    subroots = blocks.where("slot = 0").select(F.lit("").alias("all"), F.col("tree").alias("name"),
                                               F.col("top").alias("node"))
    subroots = stored(positions(subroots, "all", ["name"], "subroots"), "placed-subroots")
    roots = butterfly(subroots.select(F.col("all").alias("tree"), F.col("pos").alias("slot"), "n", "node"))
    roots = stored(subroots.select(F.col("name").alias("tree"), F.col("pos").alias("slot"))
                   .join(roots.select("slot", F.col("top").alias("root"), F.col("left").alias("_left"),
                                      F.col("right").alias("_right")), "slot").drop("slot"), "root-proofs")
    upper = blocks.join(roots, "tree").select(
        "tree", "slot", F.col("top").alias("subroot"), "root", F.concat("left", "_left").alias("left"),
        F.concat("right", "_right").alias("right"))

    out_type = f"doc_id string, leaf string, altered string, subroot string, root string, {PROOF}"

    def proofs(key: tuple, rows: pd.DataFrame, above: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values("pos").reset_index(drop=True)
        above = above.iloc[0]
        leaf = [bytes(x).hex() for x in rows["leaf"]]
        levels = hash_up(leaf, _block_depth(int(rows["n"].iloc[0]), block_levels))[:-1]
        left, right = [], []
        for i in range(len(leaf)):
            before, after = [], []
            for nodes in levels:
                run = i - i % FANOUT
                before.append("".join(nodes[run:i]))
                after.append("".join(nodes[i + 1:run + FANOUT]))
                i //= FANOUT
            left.append([*before, *above["left"]])
            right.append([*after, *above["right"]])
        return pd.DataFrame({"doc_id": rows["doc_id"], "leaf": leaf,
                             "altered": [bytes(x).hex() if x is not None else None for x in rows["altered"]],
                             "subroot": above["subroot"], "root": above["root"], "left": left, "right": right})

    id_type = docs.schema[doc_id].dataType
    own = placed.select("tree", "slot", "pos", "n", F.col("doc_id").cast("string").alias("doc_id"), "leaf", "altered")
    proved = own.groupBy("tree", "slot").cogroup(upper.groupBy("tree", "slot")).applyInPandas(proofs, out_type)
    return proved.withColumn("doc_id", F.col("doc_id").cast(id_type))  # pandas holds ids beside null as floats


def folded(leaf: Column, left: Column, right: Column) -> Column:
    """The root that ``leaf`` and the siblings of a proof lead to."""
    return F.aggregate(F.arrays_zip(left.alias("l"), right.alias("r")), leaf,
                       lambda h, s: F.sha2(F.concat(s["l"], h, s["r"]), 256))


def proof_hash(left: Column, right: Column) -> Column:
    """SHA-256 of all siblings, level by level, left to right."""
    return F.sha2(F.concat_ws("", F.flatten(F.zip_with(left, right, lambda a, b: F.array(a, b)))), 256)


def tamper_mark(doc_id: Column) -> Column:
    return fold(doc_id, 3) == 0


def digest(proved: DataFrame) -> DataFrame:
    """The contract's columns from ``manifest``: each proof is folded from the altered leaf
    where there is one."""
    root = folded(F.coalesce("altered", "leaf"), F.col("left"), F.col("right"))
    out = proved.select("doc_id", "leaf", "subroot", "root",
                        proof_hash(F.col("left"), F.col("right")).alias("proof_sha256"), root.alias("folded_root"))
    return out.withColumn("verified", F.col("folded_root") == F.col("root"))

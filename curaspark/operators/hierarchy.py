"""Parent links to nested sets: sizes upward, preorder ranges downward, cycles as what stays unprocessed (problem 5)."""

from __future__ import annotations

from functools import reduce

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from curaspark.functions.text import node_id, trimmed
from curaspark.session import BROADCAST_ROWS, as_table, counted_table, scratch

#: A parent with more than 1/HOT of the rows of a round is hot. There are fewer than HOT of them, so they are broadcast.
HOT = 1024
#: Preorder positions of one task of the path sweep.
SWEEP = 20_000
#: Ids of one block of siblings; unique ids bound its rows.
SIBLINGS_LOG2 = 16


def latest_nodes(nodes: DataFrame) -> DataFrame:
    """One row per tax_id: id, parent (null for a root), rank.

    The row with the latest loaded_at counts, a null loaded_at last; of equal ones the greatest parent and rank. Rows without
    tax_id are dropped. parent is null where it is empty, no id, the node itself, or an id without a row.
    Ranks come trimmed and in lower case, 'no rank' where there is none.
    """
    rank = F.lower(trimmed(F.col("rank")))
    rows = nodes.filter("tax_id is not null").select(
        F.col("tax_id").cast("bigint").alias("id"), F.struct("loaded_at", node_id(F.col("parent")).alias("parent"), F.when(F.coalesce(rank, F.lit("")) != "", rank).otherwise("no rank").alias("rank")).alias("r")
    )
    one, n = counted_table(rows.groupBy("id").agg(F.max("r").alias("r")).select("id", F.when(F.col("r.parent") != F.col("id"), F.col("r.parent")).alias("parent"), "r.rank"))
    have = _lookup(one, "parent", one.select(F.col("id").alias("parent"), F.lit(True).alias("known")), n)
    return as_table(have.select("id", F.when(F.col("known"), F.col("parent")).alias("parent"), "rank"))


def _lookup(left: DataFrame, on: str, right: DataFrame, rows: int) -> DataFrame:
    """left with the columns of right, unique in `on`, null where right has no row. Both have at most `rows` rows.

    Up to BROADCAST_ROWS right is broadcast. Beyond that the keys that more than rows / HOT rows of left have, fewer than HOT of
    them, are broadcast, and only the others shuffle: after a few doublings most pointers meet at a few nodes.
    """
    if rows <= BROADCAST_ROWS:
        return left.join(F.broadcast(right), on, "left")
    hot = left.groupBy(on).agg(F.count(F.lit(1)).alias("_n")).filter(F.col("_n") * HOT > rows).select(on)
    marked = left.join(F.broadcast(hot.join(right, on, "left").withColumn("_hot", F.lit(True))), on, "left")
    cold = marked.filter("_hot is null").drop(*[c for c in right.columns if c != on]).join(right, on, "left")
    return marked.filter("_hot").unionByName(cold).drop("_hot")


def subtree_sizes(nodes: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(sizes, cycles) of latest_nodes: id, size of every processed node; cycle_min_id, id of every node on a cycle.

    Sizes go upward by pointer doubling: in round k every node that still has an ancestor 2^k steps up adds what it has
    gathered to that ancestor and then points 2^k further. So the rounds are the logarithm of the depth, and each is
    one aggregation and one join. Nodes that never run out of ancestors stay unprocessed: they are on a cycle or
    below one, and those that others still point at once that set no longer shrinks are the cycles. The tables of the rounds go at the end.
    """
    with scratch(nodes.sparkSession) as keep:
        sizes, cycles = _sizes_and_cycles(nodes)
        return keep(sizes), keep(cycles)


def _sizes_and_cycles(nodes: DataFrame) -> tuple[DataFrame, DataFrame]:
    active = nodes.filter("parent is not null").select("id", F.col("parent").alias("up"), F.lit(1).cast("bigint").alias("size"))
    active, n = counted_table(active)
    image, adds, cycles = -1, [nodes.select("id", F.lit(1).cast("bigint").alias("size"))], None
    while n:
        got, now = counted_table(active.groupBy(F.col("up").alias("id")).agg(F.sum("size").alias("add")))
        adds.append(got.select("id", F.col("add").alias("size")))
        moved = _lookup(active, "up", active.select(F.col("id").alias("up"), F.col("up").alias("next")), n).filter("next is not null")
        before = n
        moved = _lookup(moved, "id", got, max(n, now)) if n <= BROADCAST_ROWS else moved.join(got, "id", "left")
        active, n = counted_table(moved.select("id", F.col("next").alias("up"), (F.col("size") + F.coalesce(F.col("add"), F.lit(0))).alias("size")))
        if n == before:
            if now == image:
                cycles = got.select("id")
                break
            image = now
    stuck = active.select("id")
    if cycles is None:
        cycles = stuck
        sizes = reduce(DataFrame.unionByName, adds)
    else:
        sizes = reduce(DataFrame.unionByName, adds).join(stuck, "id", "left_anti")
    return as_table(sizes.groupBy("id").agg(F.sum("size").alias("size"))), _cycle_minima(nodes, cycles)


def _cycle_minima(nodes: DataFrame, cycles: DataFrame) -> DataFrame:
    """cycle_min_id, id: minima over 2^k steps, doubled until none changes."""
    now = as_table(nodes.join(cycles, "id", "left_semi").select("id", F.col("parent").alias("up"), F.col("id").alias("low")))
    while not now.isEmpty():
        other = now.select(F.col("id").alias("up"), F.col("up").alias("next"), F.col("low").alias("low2"))
        then = as_table(now.join(other, "up").select("id", F.col("next").alias("up"), F.least("low", "low2").alias("low"), (F.col("low2") < F.col("low")).alias("fell")))
        now = then.drop("fell")
        if then.filter("fell").isEmpty():
            break
    return as_table(now.select(F.col("low").alias("cycle_min_id"), "id"))


def preorder(nodes: DataFrame, sizes: DataFrame) -> DataFrame:
    """id, parent, rank, lft, rgt of every processed node; siblings in the order of their ids, lft from 1 without gaps.

    The place of a node among its siblings is a prefix sum of sizes in two steps, within blocks of 2^16 ids and over the blocks of a
    parent, so no task holds all children of a parent with a third of the rows. The places then add up
    downward along the path to the root, again by doubling.
    """
    with scratch(nodes.sparkSession) as keep:
        return keep(_preorder(nodes, sizes))


def _preorder(nodes: DataFrame, sizes: DataFrame) -> DataFrame:
    t = nodes.join(sizes, "id").withColumn("_p", F.coalesce("parent", F.lit(-1))).withColumn("_b", F.shiftright("id", SIBLINGS_LOG2))
    t = as_table(t)
    blocks = t.groupBy("_p", "_b").agg(F.sum("size").alias("_s")).withColumn("_before", F.sum("_s").over(W.partitionBy("_p").orderBy("_b")) - F.col("_s")).drop("_s")
    inside = F.sum("size").over(W.partitionBy("_p", "_b").orderBy("id")) - F.col("size")
    placed = t.withColumn("_in", inside).join(blocks, ["_p", "_b"]).select("id", "parent", "rank", "size", (F.col("_in") + F.col("_before") + 1).alias("off"))
    whole, rows = counted_table(placed)
    done = [whole.filter("parent is null").select("id", "off")]
    active = whole.filter("parent is not null").select("id", F.col("parent").alias("up"), "off")
    n = -1
    while n:
        # An active row's pointer is active as well, or done with its whole sum known.
        known = active.select(F.col("id").alias("up"), F.col("up").alias("next"), F.col("off").alias("more"))
        for d in done:
            known = known.unionByName(d.select(F.col("id").alias("up"), F.lit(None).cast("bigint").alias("next"), F.col("off").alias("more")))
        moved = as_table(_lookup(active, "up", known, rows).select("id", F.col("next").alias("up"), (F.col("off") + F.col("more")).alias("off")))
        done.append(moved.filter("up is null").select("id", "off"))
        active = moved.filter("up is not null")
        n = active.count()
    lft = reduce(DataFrame.unionByName, done)
    return as_table(whole.drop("off").join(lft, "id").select("id", "parent", "rank", F.col("off").alias("lft"), (F.col("off") + F.col("size") - 1).alias("rgt")))


def paths(ranges: DataFrame) -> DataFrame:
    """preorder() with depth, root, path_ids and path_ranks, from the root to the node itself; with path_names if ranges has names (`name`).

    Preorder positions are dense, so blocks of SWEEP positions are tasks of equal size. A node whose range reaches into
    later blocks is given to those as well (one row per open ancestor at a block's start). Within a block, sorted by lft, the open
    ancestors are a stack.
    """
    block = lambda c: F.floor((F.col(c) - 1) / SWEEP)
    own = ranges.withColumn("block", block("lft")).withColumn("own", F.lit(True))
    open_ = ranges.filter(block("rgt") > block("lft")).withColumn("block", F.explode(F.sequence(block("lft") + 1, block("rgt")))).withColumn("own", F.lit(False))

    named = "name" in ranges.columns
    carried = ["id", "rank", "name"] if named else ["id", "rank"]

    def sweep(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values("lft")
        stack: list[tuple] = []
        seen: list[list] = [[] for _ in carried]
        for lft, rgt, *values in zip(rows.lft, rows.rgt, *(rows[c] for c in carried)):
            while stack and stack[-1][0] < lft:
                stack.pop()
            stack.append((rgt, *values))
            for k, out in enumerate(seen, 1):
                out.append([x[k] for x in stack])
        for c, out in zip(carried, seen):
            rows[f"path_{c}s"] = out
        rows = rows[rows.own.to_numpy()]
        rows["depth"] = rows.path_ids.str.len() - 1
        rows["root"] = rows.path_ids.str[0]
        return rows[kept]

    kept = ["id", "parent", "rank", "lft", "rgt", "depth", "root", *(f"path_{c}s" for c in carried)]
    kind = "id bigint, parent bigint, rank string, lft bigint, rgt bigint, depth int, root bigint, path_ids array<bigint>, path_ranks array<string>"
    return own.unionByName(open_).groupBy("block").applyInPandas(sweep, kind + ", path_names array<string>" * named)


def hierarchy(nodes: DataFrame) -> DataFrame:
    """One row per tax_id: parent, rank, depth, root, path_ids, path_ranks, lft, rgt, n_descendants, on_cycle, cycle_min_tax_id.

    The descendants of a node are the rows whose lft lies in (lft, rgt]; descendants() lists them. Nodes on or below a cycle have no
    root: depth, root, paths and ranges are null. An empty table gives no rows; for nulls, repeated
    and odd rows see latest_nodes. Other columns of nodes play no part.
    """
    latest = latest_nodes(nodes)
    sizes, cycles = subtree_sizes(latest)
    tree = paths(preorder(latest, sizes))
    rest = latest.join(sizes, "id", "left_anti").join(cycles, "id", "left").select("id", "parent", "rank", "cycle_min_id")
    out = tree.withColumn("cycle_min_id", F.lit(None).cast("bigint")).unionByName(rest, allowMissingColumns=True)
    return out.select(
        F.col("id").cast("int").alias("tax_id"), F.col("parent").cast("int").alias("parent_tax_id"), "rank", "depth", F.col("root").cast("int").alias("root"), "path_ids", "path_ranks", "lft", "rgt",
        (F.col("rgt") - F.col("lft")).alias("n_descendants"), F.col("cycle_min_id").isNotNull().alias("on_cycle"), F.col("cycle_min_id").cast("int").alias("cycle_min_tax_id"),
    )


def cycle_nodes(nodes: DataFrame) -> DataFrame:
    """cycle_min_tax_id, tax_id of every node that reaches itself over at least one other node."""
    _, cycles = subtree_sizes(latest_nodes(nodes))
    return cycles.select(F.col("cycle_min_id").cast("int").alias("cycle_min_tax_id"), F.col("id").cast("int").alias("tax_id"))


def descendants(tree: DataFrame, ids: DataFrame) -> DataFrame:
    """tax_id, descendant of every node in ids (a column tax_id, unique): the range (lft, rgt] of hierarchy(), by blocks of positions.

    A wanted range goes to each block of SWEEP positions that it touches, so the join is on equal block numbers and its tasks are alike.
    """
    block = lambda c: F.floor((c - 1) / SWEEP)
    wanted = tree.join(ids.select("tax_id").distinct(), "tax_id").filter("rgt > lft").select("tax_id", F.col("lft").alias("_l"), F.col("rgt").alias("_r"))
    wanted = wanted.withColumn("block", F.explode(F.sequence(block(F.col("_l") + 1), block(F.col("_r")))))
    nodes = tree.filter("lft is not null").select(F.col("tax_id").alias("descendant"), "lft", block(F.col("lft")).alias("block"))
    return nodes.join(wanted, "block").filter("lft > _l and lft <= _r").select("tax_id", "descendant")



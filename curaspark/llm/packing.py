"""Items into containers of fixed capacity by minimum bin slack (problem 7)."""

from __future__ import annotations

from bisect import bisect_left
from collections import Counter, defaultdict
from collections.abc import Iterator
from functools import reduce
from operator import neg

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from curaspark.session import BROADCAST_ROWS, as_table

#: Largest capacity, so also the most distinct sizes of a pack; what is sent to every task has a few numbers for each.
MAX_CAPACITY = 1 << 20
#: Distinct sizes that one task plans with; more are dealt out to several tasks, and what fills no container meets again.
SHARE = 2_000
#: Packs that are worked on at a time.
PACKS = 16
#: Items of one size are numbered within buckets of about so many rows.
BUCKET_ROWS = 50_000


def fullest(counts: dict[int, int], sizes: list[int], capacity: int) -> dict[int, int]:
    """The combination of available sizes that fills a bin most, with the largest size in it: size to how many.

    Bitset subset sums: bit s of a number tells that the sum s can be made; taking one more item of a size shifts it.
    sizes: those of counts, falling. Sums that a size adds are remembered with it, so the combination is read backwards. Stops as
    soon as the bin can be full.
    """
    first = next(s for s in sizes if s <= capacity)
    room = capacity - first
    full, mask = 1 << room, (1 << (room + 1)) - 1
    bits, steps = 1, []
    for s in sizes:
        if s > room:
            continue
        left = counts[s] - (s == first)
        take = 1
        most = min(left, room // s)
        while most > 0:  # 1, 2, 4, ... and the rest: every count up to `most`
            k = min(take, most)
            steps.append((s, k, bits))
            bits |= (bits << (s * k)) & mask
            most -= k
            take *= 2
        if bits & full:
            break
    at = bits.bit_length() - 1
    out = {first: 1}
    for s, k, had in reversed(steps):
        if not had >> at & 1:
            out[s] = out.get(s, 0) + k
            at -= s * k
    return out


#: A combination: (size to how many), how often it is taken.
Combination = tuple[dict[int, int], int]


def combinations(counts: dict[int, int], capacity: int) -> list[Combination]:
    """Minimum bin slack over counts of sizes 1..capacity: the fullest combination of what is left, again and again.

    It is taken out as often as the counts allow, which uses up a size or leaves too few of it; so the number of combinations follows the
    number of sizes, not of items.
    """
    counts = {s: c for s, c in counts.items() if c > 0}
    sizes = sorted(counts, reverse=True)
    out = []
    while sizes:
        best = fullest(counts, sizes, capacity)
        times = min(counts[s] // k for s, k in best.items())
        for s, k in best.items():
            counts[s] -= times * k
            if not counts[s]:
                del sizes[bisect_left(sizes, -s, key=neg)]
        out.append((best, times))
    return out


def split_full(counts: dict[int, int], capacity: int) -> tuple[list[Combination], dict[int, int]]:
    """The combinations() without slack, and the counts of all that is in others."""
    made = combinations(counts, capacity)
    full = [(b, t) for b, t in made if sum(s * k for s, k in b.items()) == capacity]
    left = Counter(counts)
    for b, t in full:
        left.subtract({s: k * t for s, k in b.items()})
    return full, {s: c for s, c in left.items() if c}


def placed(made: list[Combination]) -> list[tuple[int, int, int, int, int]]:
    """Rows (size, from_rank, to_rank, per_bin, first_bin) of combinations, ranks from 0: bin b of a combination gets the next per_bin items of each of its sizes."""
    used: Counter = Counter()
    out, bin_ = [], 0
    for best, times in made:
        for s, k in best.items():
            out.append((s, used[s], used[s] + times * k, k, bin_))
            used[s] += times * k
        bin_ += times
    return out


def plan(counts: dict[int, int], capacity: int) -> list[tuple[int, int, int, int, int]]:
    """placed() combinations() of counts, in one go."""
    return placed(combinations(counts, capacity))


def planned(counts: DataFrame, caps: dict[str, int], share: int = SHARE) -> dict[str, list[tuple[int, int, int, int, int]]]:
    """placed() rows of each pack. counts: pack_name, s, c, at most capacity rows a pack.

    Sizes are dealt out by turns to shares of about `share` sizes, so every share has small and large ones; tasks plan these and keep what fills
    its container. What is left of all shares is dealt out again, until one share holds it; that one keeps all its combinations. The work of
    a task, which grows with the square of its sizes, is bounded.
    """
    done: dict[str, list[Combination]] = defaultdict(list)
    rows = counts
    kind = "pack_name string, last boolean, best map<int,bigint>, times bigint"
    while True:
        n = {r.pack_name: r.n for r in rows.groupBy("pack_name").agg(F.count(F.lit(1)).alias("n")).collect()}
        shares = {p: max(1, -(-k // share)) for p, k in n.items()}
        if not shares:
            return {p: placed(done[p]) for p in caps}
        number = F.create_map(*[F.lit(x) for kv in shares.items() for x in kv])
        turn = F.pmod(F.row_number().over(W.partitionBy("pack_name").orderBy("s")), number[F.col("pack_name")])  # at most capacity rows

        def work(key: tuple, part: pd.DataFrame) -> pd.DataFrame:
            name, counts = key[0], dict(zip(part.s.tolist(), part.c.tolist()))
            if shares[name] == 1:
                full, left = combinations(counts, caps[name]), {}
            else:
                full, left = split_full(counts, caps[name])
            made = [(name, False, b, t) for b, t in full] + [(name, True, {s: c}, 1) for s, c in left.items()]
            return pd.DataFrame(made, columns=["pack_name", "last", "best", "times"])

        got = as_table(rows.withColumn("turn", turn).groupBy("pack_name", "turn").applyInPandas(work, kind))
        for r in got.filter("not last").orderBy("pack_name", "times", F.map_keys("best")).collect():  # at most as many as there are sizes
            done[r.pack_name].append((r.best, r.times))
        rows = got.filter("last").select("pack_name", F.map_keys("best")[0].alias("s"), F.map_values("best")[0].alias("c"))
        before = n
        n = {r.pack_name: r.n for r in rows.groupBy("pack_name").agg(F.count(F.lit(1)).alias("n")).collect()}
        if n and all(n[p] > before[p] // 2 for p in n):
            share *= 4  # few containers could be filled, so more sizes have to meet


def packed(items: DataFrame, row_id: str, size: str, packs: DataFrame) -> DataFrame:
    """pack_name, row_id, part, size, container, container of every item in each pack of packs (pack_name, capacity_tokens).

    An item larger than the capacity is cut: parts of full capacity, each in a container of its own, and the rest, which is packed like any
    item. Others are never cut. An item of size 0 or null takes no room: part 0, size 0, no container (null). Repeated
    packs count once with their largest capacity; packs without name or with a capacity below 1 or null are left out. No items give no rows.

    Tasks plan combinations on the counts of the sizes, at most capacity numbers a pack (see planned()); every item then finds its
    container by its rank among the items of its size. Ranks come from counts by (size, bucket of hashed ids), so a size with a third of all items
    is many buckets. Containers are numbered from 0 in each pack.
    """
    caps = packs.filter("pack_name is not null and capacity_tokens > 0").groupBy("pack_name").agg(F.max("capacity_tokens").cast("int").alias("cap"))
    listed = [(r.pack_name, r.cap) for r in caps.orderBy("pack_name").limit(BROADCAST_ROWS + 1).collect()]
    if len(listed) > BROADCAST_ROWS or any(c > MAX_CAPACITY for _, c in listed):
        raise ValueError(f"there may be {BROADCAST_ROWS} packs with capacities up to {MAX_CAPACITY}")
    base = as_table(items.select(F.col(row_id).alias("_id"), F.greatest(F.coalesce(F.col(size).cast("bigint"), F.lit(0)), F.lit(0)).alias("_n")))
    buckets = max(1, -(-base.count() // BUCKET_ROWS))
    parts = [_packed(base, dict(listed[i : i + PACKS]), buckets) for i in range(0, len(listed), PACKS)]
    if not parts:
        parts = [base.limit(0).select(F.lit("").alias("pack_name"), "_id", F.lit(0).cast("bigint").alias("part"), F.lit(0).alias("s"), F.lit(0).cast("bigint").alias("container"))]
    return reduce(DataFrame.unionByName, parts).select("pack_name", F.col("_id").alias(row_id), "part", F.col("s").alias("size"), "container")


def _packed(base: DataFrame, caps_: dict[str, int], buckets: int) -> DataFrame:
    """packed() of a few packs. base: _id, _n."""
    of = F.explode(F.array(*[F.struct(F.lit(p).alias("pack_name"), F.lit(c).alias("cap")) for p, c in caps_.items()])).alias("_p")
    each = base.select("*", of).select("_id", "_n", "_p.*")
    # Whole parts of a cut item, and what is left of any item.
    rest = each.select("pack_name", "cap", "_id", (F.col("_n") / F.col("cap")).cast("bigint").alias("part"), F.when(F.col("_n") == 0, 0).otherwise(F.col("_n") % F.col("cap")).cast("int").alias("s"), "_n").filter("s > 0 or _n = 0").drop("_n")
    exact = each.filter("_n >= cap").select("pack_name", "cap", "_id", F.explode(F.sequence(F.lit(0), (F.col("_n") / F.col("cap")).cast("bigint") - 1)).alias("part"), F.col("cap").alias("s"))
    parts = rest.unionByName(exact).withColumn("_b", F.pmod(F.xxhash64("_id", "part"), F.lit(buckets)))
    tally = as_table(parts.filter("s > 0").groupBy("pack_name", "s", "_b").agg(F.count(F.lit(1)).alias("c")))
    before = tally.withColumn("_before", F.sum("c").over(W.partitionBy("pack_name", "s").orderBy("_b")) - F.col("c")).drop("c")
    plans = {}
    for name, made in planned(as_table(tally.groupBy("pack_name", "s").agg(F.sum("c").alias("c"))), caps_).items():
        rows: dict[int, list] = {}
        for s, a, b, k, first in made:
            rows.setdefault(s, []).append((a, b, k, first))
        plans[name] = {s: np.array(v, np.int64).T for s, v in rows.items()}
    shared = base.sparkSession.sparkContext.broadcast(plans)

    def place(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        plans = shared.value
        for b in batches:
            bins = np.zeros(len(b), np.int64)
            for (name, s), at in b.groupby(["pack_name", "s"]).indices.items():
                start, _, k, first = plans[name][s]
                rank = b["_rank"].to_numpy()[at]
                i = np.searchsorted(start, rank, side="right") - 1
                bins[at] = first[i] + (rank - start[i]) // k[i]
            yield b[["pack_name", "_id", "part", "s"]].assign(container=bins)

    numbered = parts.filter("s > 0").withColumn("_r", F.row_number().over(W.partitionBy("pack_name", "s", "_b").orderBy("_id", "part")) - 1)
    numbered = numbered.join(before, ["pack_name", "s", "_b"]).select("pack_name", "_id", "part", "s", (F.col("_r") + F.col("_before")).alias("_rank"))
    kind = dict(base.dtypes)["_id"]
    found = numbered.mapInPandas(place, f"pack_name string, _id {kind}, part bigint, s int, container bigint")
    empty = parts.filter("s = 0").select("pack_name", "_id", "part", "s", F.lit(None).cast("bigint").alias("container"))
    return found.unionByName(empty)

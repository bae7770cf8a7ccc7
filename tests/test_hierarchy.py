import random

import pytest

from curaspark.operators import hierarchy as H

SCHEMA = "tax_id int, parent string, rank string, loaded_at timestamp_ntz, id string, n int, size string, up string"


def nodes(spark, rows):
    from datetime import datetime

    full = [(t, p, r, None if d is None else datetime(2020, 1, 1 + d), "x", 7, "y", "z") for t, p, r, d in rows]
    return spark.createDataFrame(full, "tax_id int, parent string, rank string, loaded_at timestamp, id string, n int, size string, up string")


def brute(parent):
    """depth and path of each node, None on or below a cycle; nodes on cycles."""
    paths, cyc = {}, set()
    for t in parent:
        seen, x = [t], t
        while parent[x] is not None:
            x = parent[x]
            if x in seen:
                break
            seen.append(x)
        else:
            paths[t] = seen[::-1]
            continue
        if x == t:
            cyc.add(t)
    return paths, cyc


def check(spark, parent):
    rows = [(t, None if p is None else str(p), "r", 0) for t, p in parent.items()]
    got = {r.tax_id: r for r in H.hierarchy(nodes(spark, rows)).collect()}
    paths, cyc = brute(parent)
    assert set(got) == set(parent)
    lft = {}
    for t, r in got.items():
        assert r.on_cycle == (t in cyc)
        if t in paths:
            assert r.path_ids == paths[t] and r.depth == len(paths[t]) - 1 and r.root == paths[t][0]
            assert r.n_descendants == sum(t in p[:-1] for p in paths.values())
            lft[t] = (r.lft, r.rgt)
        else:
            assert r.depth is None and r.lft is None
    assert sorted(a for a, _ in lft.values()) == list(range(1, len(lft) + 1))
    for t, (a, b) in lft.items():
        assert {u for u, (c, _) in lft.items() if a <= c <= b} == {u for u, p in paths.items() if t in p}
    for t in cyc:
        ring, x = {t}, parent[t]
        while x != t:
            ring.add(x)
            x = parent[x]
        assert got[t].cycle_min_tax_id == min(ring)


def test_random_forests_with_cycles(spark):
    rng = random.Random(3)
    ids = rng.sample(range(1, 200_000), 120)
    parent = {t: (None if i == 0 or rng.random() < 0.05 else ids[rng.randrange(i)]) for i, t in enumerate(ids)}
    for ring in (ids[5:7], ids[20:29]):
        for a, b in zip(ring, ring[1:] + ring[:1]):
            parent[a] = b
    check(spark, parent)


def test_deep_chain_and_star_over_small_blocks(spark, monkeypatch):
    monkeypatch.setattr(H, "SWEEP", 16)
    monkeypatch.setattr(H, "SIBLINGS_LOG2", 3)
    monkeypatch.setattr(H, "BROADCAST_ROWS", 0)
    monkeypatch.setattr(H, "HOT", 4)
    parent = {1: None} | {i: i - 1 for i in range(2, 90)} | {i: 40 for i in range(200, 300)} | {500: 501, 501: 500, 502: 500}
    check(spark, parent)


def test_long_cycle_with_tail(spark):
    ring = list(range(10, 47))
    check(spark, {a: b for a, b in zip(ring, ring[1:] + ring[:1])} | {100 + i: (99 + i if i else 10) for i in range(40)})


def test_writings_versions_and_nulls(spark):
    df = nodes(spark, [
        (1, None, "No Rank ", 1), (2, " taxon:1", None, 1), (2, "9", "genus", 0), (3, "2.0", "", None), (4, "４", "x", 1), (5, "+0002​", "SPECIES", 1),
        (6, "77", "x", 1), (None, "1", "x", 1), (7, "abc", "x", 1), (7, "abc", "x", 1),
    ])
    got = {r.tax_id: (r.parent_tax_id, r["rank"], r.depth) for r in H.hierarchy(df).collect()}
    assert got == {1: (None, "no rank", 0), 2: (1, "no rank", 1), 3: (2, "no rank", 2), 4: (None, "x", 0), 5: (2, "species", 2), 6: (None, "x", 0), 7: (None, "x", 0)}


def test_empty(spark):
    df = nodes(spark, [])
    assert H.hierarchy(df).count() == 0 and H.cycle_nodes(df).count() == 0


def test_only_cycles(spark):
    got = H.cycle_nodes(nodes(spark, [(5, "6", "x", 0), (6, "5", "x", 0)])).collect()
    assert {(r.cycle_min_tax_id, r.tax_id) for r in got} == {(5, 5), (5, 6)}


def test_descendants(spark):
    parent = {1: None, 2: 1, 3: 2, 4: 1, 5: 3}
    tree = H.hierarchy(nodes(spark, [(t, None if p is None else str(p), "r", 0) for t, p in parent.items()]))
    got = H.descendants(tree, spark.createDataFrame([(2,), (4,), (9,)], "tax_id int")).collect()
    assert {(r.tax_id, r.descendant) for r in got} == {(2, 3), (2, 5)}


@pytest.mark.parametrize("n", [1, 2])
def test_single_nodes(spark, n):
    check(spark, dict.fromkeys(range(1, n + 1)))

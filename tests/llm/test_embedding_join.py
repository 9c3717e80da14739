import numpy as np
import pytest
from pyspark.sql import functions as F

from tracewell.llm import embedding_join
from tracewell.llm.components import components


def brute(rows, c=0.9):
    ok = [i for i, (_, e) in enumerate(rows) if e and None not in e and np.isfinite(np.array(e, "f8")).all() and any(e)]
    width = max((len(rows[i][1]) for i in ok), default=1)
    links = {i: set() for i in range(len(rows))}
    x = np.zeros((len(rows), width))
    for i in ok:
        x[i, : len(rows[i][1])] = rows[i][1]
    for i in ok:
        for j in ok:
            if i != j and x[i] @ x[j] / (np.linalg.norm(x[i]) * np.linalg.norm(x[j])) >= c:
                links[i].add(j)
    out, seen = {}, set()
    for i in range(len(rows)):
        if i in seen:
            continue
        group, todo = {i}, [i]
        while todo:
            new = links[todo.pop()] - group
            group |= new
            todo += new
        seen |= group
        low = min((rows[j][0] for j in group if rows[j][0] is not None), default=None)
        for j in group:
            out[j] = (rows[j][0], len(links[j]), low, rows[j][0] == low)
    return sorted((out[i] for i in range(len(rows))), key=repr)


def got(spark, rows, kind="array<float>"):
    table = spark.createDataFrame(rows, f"vec_id long, embedding {kind}").withColumn("code", F.lit("x"))
    return sorted((tuple(r) for r in embedding_join.near_duplicates(table).collect()), key=repr)


def test_equals_brute_force_over_several_blocks(spark, monkeypatch):
    monkeypatch.setattr(embedding_join, "BLOCK", 32)
    monkeypatch.setattr(embedding_join, "TILE", 8)
    monkeypatch.setattr(embedding_join, "FAN", 2)
    rng = np.random.default_rng(4)
    centres = rng.normal(size=(12, 10))
    x = np.concatenate([centres[rng.integers(0, 12, 300)] + rng.normal(0, s, (300, 10)) for s in (0.3,)] + [rng.normal(size=(60, 10))])
    x = np.concatenate([x, x[:5], 3 * x[:4]]).astype("f4")
    rows = [(int(i), v.tolist()) for i, v in zip(rng.permutation(len(x)), x, strict=True)]
    want = brute(rows)
    assert sum(r[1] for r in want) > 300
    assert got(spark, rows) == want


def test_odd_rows(spark):
    rows = [
        (1, None), (2, []), (3, [0.0, 0.0]), (4, [1.0, None]), (5, [float("nan"), 1.0]), (6, [float("inf"), 1.0]), (7, [1.0, 0.0]), (8, [1.0, 0.1]),
        (None, [0.0, 1.0]), (None, [0.0, 1.0]), (9, [0.0, 2.0]), (10, [-1.0, 0.0]), (11, [-1.0, -0.0, 0.0]), (7, [1.0, 0.0]), (12, [1e-30, 1e-31]),
        (13, [0.9, float(np.sqrt(1 - 0.81))]),
    ]
    assert got(spark, rows, "array<double>") == brute(rows)
    assert got(spark, rows[:6]) == brute(rows[:6])
    assert got(spark, []) == []


def test_a_large_group_of_copies_and_near_copies(spark):
    rng = np.random.default_rng(2)
    base = rng.normal(size=16)
    rows = [(i, base.tolist()) for i in range(300)] + [(300 + i, (base + rng.normal(0, 0.05, 16)).tolist()) for i in range(300)]
    result = got(spark, rows, "array<double>")
    assert {r[2] for r in result} == {0} and {r[1] for r in result} == {599} and sum(r[3] for r in result) == 1


def test_components_of_paths_stars_and_rings(spark):
    edges = [(i, i + 1) for i in range(40)] + [(100, i) for i in range(101, 140)] + [(200 + i, 200 + (i + 1) % 9) for i in range(9)] + [(5, 5)]
    got = {r["node"]: r["component"] for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {**dict.fromkeys(range(41), 0), **dict.fromkeys(range(100, 140), 100), **dict.fromkeys(range(200, 209), 200)}
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_boxes_skip_what_is_far(spark):
    boxes = spark.createDataFrame([(i, [3.0 * i], [3.0 * i + 1]) for i in range(20)], "block long, lo array<double>, hi array<double>")
    near = {(r["a"], r["b"]) for r in embedding_join._block_pairs(boxes, 2.0).collect()}
    assert near == {(i, j) for i in range(20) for j in range(i, min(20, i + 2))}
    assert embedding_join._cosine(np.array([1e200, 1e200]), np.array([1e-200, 1e-200])) == pytest.approx(1)

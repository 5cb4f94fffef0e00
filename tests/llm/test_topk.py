import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from portflow.llm import topk

SCHEMA = "vec_id long, embedding array<float>, score string, rank string, block int"


def brute(rows, k=10, every=3):
    good = []
    for row, (key, v) in enumerate(rows):
        if key is not None and v is not None and all(x is not None and math.isfinite(x) for x in v):
            good.append((row, key, [math.floor(1024 * float(np.float32(x))) for x in v]))
    out = []
    for row, key, q in good:
        if key % every == 0:
            scores = sorted((-sum(a * b for a, b in zip(q, x)), i) for r, i, x in good if r != row)[:k]
            out += [(key, n + 1, i, -s) for n, (s, i) in enumerate(scores)]
    return sorted(out)


def ours(spark, rows, k=10, every=3):
    table = spark.createDataFrame([(i, v, "s", "r", 1) for i, v in rows], SCHEMA)
    found = topk.top_products(table, F.col("vec_id") % every == 0, k=k).collect()
    return sorted((r.query_id, r.rank, r.vec_id, r.score) for r in found)


@pytest.mark.parametrize("blocks", [(4096, 512), (40, 7)])
def test_equals_all_products(spark, monkeypatch, blocks):
    monkeypatch.setattr(topk, "BLOCK_ROWS", blocks[0])
    monkeypatch.setattr(topk, "QUERY_ROWS", blocks[1])
    random_ = np.random.default_rng(1)
    base = random_.normal(size=(300, 32)) * random_.lognormal(size=(300, 1)) * np.linspace(2, 0.05, 32)
    rows = [(int(i), [float(x) for x in v]) for i, v in zip(random_.permutation(300), base)]
    assert ours(spark, rows) == brute(rows)


def test_odd_vectors(spark):
    nan, inf = float("nan"), float("inf")
    rows = [
        (0, [1.0, 2.0]), (1, None), (2, [None, 1.0]), (3, [nan, 1.0]), (4, [inf, 1.0]), (5, [0.0, 0.0]), (6, [1.0, 2.0]),
        (6, [1.0, 2.0]), (7, [-1.0, 3.5]), (None, [9.0, 9.0]), (9, []), (12, [2.0]), (15, [0.00097, -0.00001]),
    ]
    assert ours(spark, rows) == brute(rows)
    assert ours(spark, rows, k=2) == brute(rows, 2)


def test_ties_take_the_smaller_id(spark):
    rows = [(i, [1.0, 0.5]) for i in random.Random(1).sample(range(60), 60)]
    assert ours(spark, rows) == brute(rows)


def test_large_components_stay_exact(spark):
    rows = [(i, [1e6 + i, -2e6, 3.0 * i]) for i in range(30)]
    assert ours(spark, rows) == brute(rows)


def test_no_queries_or_rows(spark):
    assert ours(spark, []) == [] and ours(spark, [(1, [1.0]), (2, [2.0])]) == []
    assert ours(spark, [(3, [1.0])]) == []


def test_huge_components_take_part(spark):
    rows = [(i, [1.0 + i, 0.5]) for i in range(10)] + [(10, [3e9, 1.0]), (11, [-3e9, 0.25])]
    assert ours(spark, rows) == brute(rows)
    # The terms of a product may be beyond 64 bits where their sum is not.
    rows = [(0, [3e9, 3e9, 1.0]), (1, [3e9, -3e9, 2.0]), (2, [1.0, 2.0, 3.0])]
    assert ours(spark, rows) == brute(rows)


@pytest.mark.parametrize("huge", [4e9, 1e30])
def test_scores_beyond_64_bits_fail(spark, huge):
    with pytest.raises(Exception, match="beyond 64-bit integers"):
        ours(spark, [(0, [huge, 0.0]), (1, [huge, 1.0]), (2, [1.0, 1.0])])

import hashlib
import random

import pytest
from pyspark.sql import functions as F

from portflow.llm import exact_dedup as ed
from portflow.llm.common import ROW

SCHEMA = "doc_id long, text string, n int, name string, level string, pos int, _llm string"


def table(spark, rows):
    return spark.createDataFrame([(k, t, 1, "n", "l", 2, "x") for k, t in rows], SCHEMA)


def brute(rows):
    groups = {}
    for key, text in rows:
        groups.setdefault(text or "", []).append(key)
    out = []
    for text, keys in groups.items():
        best = max(keys, key=lambda k: (k is not None, k or 0))
        sha = hashlib.sha256(text.encode()).hexdigest()
        first = True
        for key in keys:
            kept = key == best and first
            first = first and not kept
            out.append((key, best, len(keys), kept, sha))
    return sorted(out, key=str)


def ours(spark, rows, **options):
    found = ed.exact_duplicates(table(spark, rows), **options).collect()
    assert len({r[ROW] for r in found}) == len(rows)
    return sorted(((r.doc_id, r.keep_id, r.group_size, r.kept, r.text_sha256) for r in found), key=str)


def corpus():
    rng = random.Random(4)
    base = ["".join(rng.choices("ab é", k=rng.randint(0, 90))) for _ in range(60)]
    texts = rng.choices(base, k=200) + [t + "x" for t in base[:20]] + ["hot copy " * 9] * 100
    rng.shuffle(texts)
    return list(zip(rng.sample(range(10**6), len(texts)), texts))


@pytest.mark.parametrize("options", [{}, {"block_bytes": 7}])
def test_equals_grouping_by_text(spark, options):
    rows = corpus()
    assert ours(spark, rows, **options) == brute(rows)


def test_poor_fingerprints_change_nothing(spark):
    rows = corpus()[:150]
    found = ours(spark, rows, block_bytes=16, fingerprint=lambda block: F.crc32(block) % 3)
    assert found == brute(rows)


def test_odd_rows(spark):
    long = "0123456789" * 5000
    rows = [
        (1, None), (2, ""), (3, " "), (4, "a"), (4, "a"), (4, "b"), (None, "a"), (None, "c"), (None, "c"), (5, long), (6, long),
        (7, long + "."), (8, long[:-1]), (9, "Ä"), (10, "Ä"), (11, "\x00"), (12, ""),
    ]
    assert ours(spark, rows) == brute(rows)


def test_blocks_that_swap_places_differ(spark):
    a, b = "a" * 8, "b" * 8
    rows = [(1, a + b), (2, b + a), (3, a + b + a), (4, a + a + b), (5, a + b)]
    assert ours(spark, rows, block_bytes=8) == brute(rows)


def test_empty_table(spark):
    assert ours(spark, []) == []


def test_filter_keeps_columns_and_one_row_of_each_group(spark):
    rows = corpus()
    kept = ed.without_exact_copies(table(spark, rows))
    assert kept.columns == table(spark, rows).columns
    assert sorted((r.doc_id, r.text) for r in kept.collect()) == sorted(
        (max(k for k, t in rows if t == text), text) for text in {t for _, t in rows}
    )

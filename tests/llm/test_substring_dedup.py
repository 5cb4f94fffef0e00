import hashlib
import random

import numpy as np
import pytest

from portflow.llm import substring_dedup as sd

SCHEMA = "doc_id long, text string, spans string, _llm_row2 int"


def brute(rows, length=50):
    """(doc_id, n_bytes, n_removed, n_spans, sha256) by comparing every window."""
    owner = {}
    data = [(k, (t or "").encode()) for k, t in rows]
    big = float("inf")
    for k, t in data:
        for i in range(len(t) - length + 1):
            w = t[i : i + length]
            owner[w] = min(owner.get(w, big), big if k is None else k)
    out = []
    for k, t in data:
        cut = bytearray(len(t))
        for i in range(len(t) - length + 1):
            if owner[t[i : i + length]] < (big if k is None else k):
                cut[i : i + length] = b"\1" * length
        spans = sum(1 for i in range(len(t)) if cut[i] and (i == 0 or not cut[i - 1]))
        kept = bytes(b for b, c in zip(t, cut) if not c)
        out.append((k, len(t), sum(cut), spans, hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=str)


def ours(spark, rows, **options):
    docs = spark.createDataFrame([(k, t, "x", 1) for k, t in rows], SCHEMA)
    found = sd.without_repeats(docs, **options).collect()
    for r in found:
        assert hashlib.sha256(r.kept).hexdigest() == r.kept_sha256
    return sorted(((r.doc_id, r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in found), key=str)


def corpus(seed, n=120):
    rng = random.Random(seed)
    word = lambda: "".join(rng.choices("abcdeé ", k=rng.randint(1, 9)))
    text = lambda k: " ".join(word() for _ in range(k))
    shared = [text(rng.randint(5, 40)) for _ in range(8)]
    ids = rng.sample(range(10_000), n)
    return [
        (i, " ".join(rng.choice([text(rng.randint(0, 12)), rng.choice(shared)]) for _ in range(rng.randint(0, 6))))
        for i in ids
    ]


@pytest.mark.parametrize("seed, options", [(1, {}), (2, {"range_bytes": 500, "flush_bytes": 700})])
def test_equals_comparison_of_all_windows(spark, seed, options):
    rows = corpus(seed)
    found = ours(spark, rows, **options)
    assert found == brute(rows)
    assert sum(r[2] for r in found) > 0


def test_odd_texts(spark, monkeypatch):
    monkeypatch.setattr(sd, "CHUNK_BYTES", 64)
    monkeypatch.setattr(sd, "BATCH_WINDOWS", 32)
    copy = "x" * 30 + "0123456789" * 9
    rows = [
        (1, None), (2, ""), (3, "short"), (4, "a" * 500), (5, "b" + "a" * 70), (6, "a" * 49), (7, copy), (8, copy),
        (9, copy[20:80]), (10, copy + copy), (10, copy), (None, copy), (None, "q" * 60), (0, "a" * 50),
        (12, "new " + copy[:49]), (13, "é" * 40), (14, "é" * 26), (15, "tail " + "é" * 25),
    ]
    assert ours(spark, rows) == brute(rows)
    assert ours(spark, rows, length=20) == brute(rows, 20)


def test_empty_table(spark):
    assert ours(spark, []) == []


def test_levels_and_shared_fingerprints_match_brute_force(monkeypatch):
    monkeypatch.setattr(sd, "BATCH_WINDOWS", 40)
    rng = random.Random(5)
    pieces = ["".join(rng.choices("ab", k=60)) for _ in range(6)]
    runs = [(doc, rng.choice(pieces)[rng.randint(0, 5) :]) for doc in sorted(rng.choices(range(30), k=40))]
    docs = np.array([d for d, _ in runs])
    sizes = np.array([len(t) for _, t in runs])
    body = np.frombuffer("".join(t for _, t in runs).encode(), np.uint8).copy()
    first = {}
    for d, t in runs:
        for i in range(len(t) - 49):
            first.setdefault(t[i : i + 50], d)
    expected = [d > first[t[i : i + 50]] for d, t in runs for i in range(len(t) - 49)]
    for bits in (64, 5, 1):
        with np.errstate(over="ignore"):
            _, _, covered = sd.covered_windows(docs, sizes, body, 50, bits)
        assert covered.tolist() == expected


def test_level_sizes_grow_geometrically():
    levels = sd._Levels()
    for i in range(100):
        ids = np.arange(i * 10, i * 10 + 10, dtype=np.uint64)
        levels.add((ids, np.zeros(10, np.int64), np.zeros(10, np.int64)))
    sizes = [len(level[0]) for level in levels.levels]
    assert sum(sizes) == 1000 and len(sizes) <= 7 and all(a > b for a, b in zip(sizes, sizes[1:]))
    assert all((np.diff(level[0].astype(np.int64)) > 0).all() for level in levels.levels)


def test_batches_of_either_size_are_sorted_alike():
    rng = np.random.default_rng(8)
    # The first run is one batch by itself, too large for places within fingerprints; it repeats the later ones' strings.
    long = rng.integers(97, 123, (1 << sd.PLACE_BITS) + 500).astype(np.uint8)
    runs = [long, long[1000:1400], rng.integers(97, 123, 300).astype(np.uint8), long[-700:]]
    docs, sizes = np.array([1, 2, 3, 4]), np.array([len(run) for run in runs])
    with np.errstate(over="ignore"):
        index, offset, covered = sd.covered_windows(docs, sizes, np.concatenate(runs), 50)
        again = sd.covered_windows(docs[1:], sizes[1:], np.concatenate(runs[1:]), 50)[2]
    assert [covered[index == k].all() for k in range(4)] == [False, True, False, True]
    assert [covered[index == k].any() for k in range(4)] == [False, True, False, True] and not again.any()
    assert len(offset) == (sizes - 49).sum()

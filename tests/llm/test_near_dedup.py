import math
import random
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from portflow.llm import near_dedup as nd

SCHEMA = "doc_id long, text string, key string, similarity int, a string"


def words(text):
    return "".join(c if c.isalnum() else " " for c in (text or "").lower()).split()


def vector(text):
    found = words(text)
    return Counter(tuple(found[i : i + 5]) for i in range(max(1, len(found) - 4))) if found else Counter()


def brute(rows):
    """Class id of every row, by comparing all pairs."""
    sets = [vector(t) for _, t in rows]
    df = Counter(x for s in sets for x in s)
    n = len(rows)
    weight = {
        x: 1 - nd.IDF_SHARE + nd.IDF_SHARE * min(1, max(0, math.log(n / k) / math.log(1 / nd.RARE_SHARE))) for x, k in df.items()
    }
    parent = list(range(n))

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i in range(n):
        for j in range(i):
            common = sum(min(c, sets[j][x]) * weight[x] for x, c in sets[i].items() if x in sets[j])
            if common:
                total = sum(c * weight[x] for s in (sets[i], sets[j]) for x, c in s.items())
                if common / (total - common) >= nd.SIMILARITY:
                    parent[root(i)] = root(j)
    groups = {}
    for i in range(n):
        groups.setdefault(root(i), []).append(i)
    out = []
    for members in groups.values():
        ids = [rows[i][0] for i in members if rows[i][0] is not None]
        out += [(rows[i][0], min(ids) if ids else None, len(members)) for i in members]
    return sorted(out, key=str)


def ours(spark, rows):
    found = nd.near_classes(spark.createDataFrame([(k, t, "k", 3, "z") for k, t in rows], SCHEMA)).collect()
    assert sum(r.kept for r in found) == len({(r.class_id, r.class_size) for r in found if r.class_id is not None}) + sum(
        r.class_id is None for r in found if r.class_size == 1
    )
    return sorted(((r.doc_id, r.class_id, r.class_size) for r in found), key=str)


def edited(rng, tokens, n):
    tokens = list(tokens)
    for _ in range(n):
        tokens[rng.randrange(len(tokens))] = "new%d" % rng.randrange(10**6)
    return tokens


def corpus(seed):
    """Unrelated texts, families of copies with few and many edits, a chain, and a shared passage."""
    rng = random.Random(seed)
    fresh = lambda k: ["w%d" % rng.randrange(3000) for _ in range(k)]
    texts = [fresh(rng.randint(1, 300)) for _ in range(40)]
    for edits in (0, 1, 2, 4, 8):
        base = fresh(200)
        texts += [base] + [edited(rng, base, edits) for _ in range(8)]
    chain = fresh(150)
    for _ in range(12):
        texts.append(chain)
        chain = edited(rng, chain, 2)
    passage = fresh(80)
    texts += [fresh(60) + passage + fresh(60) for _ in range(20)]
    rng.shuffle(texts)
    ids = rng.sample(range(10**6), len(texts))
    return [(i, " ".join(t)) for i, t in zip(ids, texts)]


@pytest.mark.parametrize("seed, pivots, growth", [(1, 6, 4), (2, 1, 1), (3, 1, 2)])
def test_classes_equal_those_of_all_pairs(spark, monkeypatch, seed, pivots, growth):
    monkeypatch.setattr(nd, "PIVOTS", pivots)
    monkeypatch.setattr(nd, "PIVOT_GROWTH", growth)
    rows = corpus(seed)
    expected, found = brute(rows), ours(spark, rows)
    # Sampling may miss a pair right at the threshold; here none is.
    assert found == expected
    assert sum(size > 1 for _, _, size in found) > 40


def test_odd_rows(spark):
    long = " ".join("w%d" % i for i in range(4000))
    rows = [
        (1, None), (2, ""), (3, " .,!"), (4, "one"), (5, "One!"), (6, "two words"), (7, long), (8, long + " x"),
        (8, long), (None, long), (None, None), (9, "é à ü"), (10, "É À Ü"), (11, "a b c d e"), (12, "a b c d e"),
    ]
    assert ours(spark, rows) == brute(rows)


def test_empty_and_wordless_tables(spark):
    assert ours(spark, []) == []
    assert ours(spark, [(1, ""), (2, None)]) == [(1, 1, 1), (2, 2, 1)]


def test_draws_agree_as_often_as_the_similarity():
    rng = np.random.default_rng(3)
    hashes = np.sort(rng.integers(0, 2**63, 400).astype(np.uint64))
    one, two = rng.uniform(0.5, 3, 400).astype(np.float32), rng.uniform(0.5, 3, 400).astype(np.float32)
    two[:40] = 1e-6
    first = np.array([0, 400])
    sampler = nd.Sampler(3000)
    with np.errstate(over="ignore"):
        agree = np.mean(sampler.draws(hashes, one, first) == sampler.draws(hashes, two, first))
    assert agree == pytest.approx(np.minimum(one, two).sum() / np.maximum(one, two).sum(), abs=0.03)


def test_frequencies_are_exact(spark, monkeypatch):
    monkeypatch.setattr(nd, "FLUSH_SHINGLES", 500)
    rows = corpus(4)
    texts = spark.createDataFrame(rows, "_llm_row long, data string").withColumn("data", F.col("data").cast("binary"))
    found = sorted(r.n for r in nd.frequent_shingles(texts, 3, 5).collect())
    assert found == sorted(n for n in Counter(x for _, t in rows for x in vector(t)).values() if n >= 3)


def test_components(spark):
    rng = random.Random(1)
    links = [(i, i + 1) for i in range(0, 40)] + [(100, 200 + i) for i in range(30)] + [(rng.randint(300, 320), 321) for _ in range(9)]
    found = {r.id: r["class"] for r in nd.components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert all(found[i] == 0 for i in range(41)) and all(found[200 + i] == 100 for i in range(30))
    assert len(set(found[a] for a, _ in links[70:])) == 1
    assert nd.components(spark.createDataFrame([], "a long, b long")).collect() == []


def crowd(seed):
    """Many edits of one text: few edits link them, more leave them alone, and some differ from another one by little."""
    rng = random.Random(seed)
    base = ["w%d" % rng.randrange(3000) for _ in range(120)]
    texts = [edited(rng, base, rng.choice((0, 1, 2, 3, 4, 6, 9))) for _ in range(220)]
    texts += [edited(rng, rng.choice(texts), 1) for _ in range(40)]
    return [(i, " ".join(t)) for i, t in enumerate(texts)]


def test_large_bucket_compares_few_pairs(spark, monkeypatch):
    sizes = []
    plain = nd.similarities

    def counted(pairs, table):
        pairs = nd.stored(pairs)
        sizes.append(pairs.count())
        return plain(pairs, table)

    # One band for all, so that every link is a candidate and all texts are in one bucket.
    one = F.array(F.lit(7).cast("long"))
    signatures = nd.signatures
    monkeypatch.setattr(nd, "signatures", lambda texts, weights: signatures(texts, weights).withColumn("bands", one))
    monkeypatch.setattr(nd, "similarities", counted)
    rows = crowd(5)
    assert ours(spark, rows) == brute(rows)
    # All pairs are 33,670; a round of random pivots after another compared most of them.
    assert sum(sizes) < 16 * len(rows)


def test_pairs_that_the_prefixes_leave_out_are_no_links(spark):
    rows = crowd(6)
    texts = spark.createDataFrame(rows, "_llm_row long, data string").withColumn("data", F.col("data").cast("binary"))
    weights = nd.shingle_weights(texts)
    overlaps = nd.Overlaps(nd.stored(nd.vectors(texts, weights)))
    found = {frozenset(p) for p in overlaps.rare_pairs().collect()}
    based = nd.stored(overlaps.profiles().withColumns({"key": F.lit(1), "class": F.col("id")}))
    found |= {frozenset(p) for p in nd._common_pairs(based, based).collect()}
    table = {r.id: nd._unpacked(bytes(r.vector), "<f4") for r in overlaps.table.collect()}
    links = {
        frozenset((i, j)) for i in table for j in table if i < j and nd.weighted_jaccard(table[i], table[j]) >= nd.SIMILARITY
    }
    assert links <= found and len(links) > 100

import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest

from portflow.llm import divergence

SCHEMA = "doc_id long, text string, lang string, source string, term string, place int, part string"


def brute(rows, min_docs=30, top=50):
    pattern = re.compile(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+")
    lower = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    docs, counts, groups = defaultdict(Counter), defaultdict(Counter), set()
    for _, text, lang, source in rows:
        lang, source = lang or "", source or ""
        groups.add((lang, source))
        terms = [t.translate(lower) for t in pattern.findall(text or "")]
        docs[lang].update(set(terms))
        counts[lang, source].update(terms)
    out = []
    for lang in {g[0] for g in groups}:
        kept = sorted(t for t, n in docs[lang].items() if n >= min_docs)
        sources = sorted((s for g, s in groups if g == lang), key=lambda s: s.encode())

        def shares(counter):
            total = sum(counter[t] for t in kept) + 5 * len(kept)
            return {t: 1 + 10**9 * (counter[t] + 5) // total for t in kept}

        p = {s: shares(counts[lang, s]) for s in sources}
        q = shares(sum((counts[lang, s] for s in sources), Counter()))
        for s in sources:
            pairs = [(-sum(abs(p[s][t] - p[o][t]) for t in kept), o) for o in sources if o != s]
            terms = [(q[t] - p[s][t], t) for t in kept if counts[lang, s][t] and p[s][t] > q[t]]
            for part, found, limit in (("pair", pairs, len(pairs)), ("term", terms, top)):
                found.sort(key=lambda x: (x[0], x[1].encode()))
                out += [(lang, s, part, item, -value, i + 1) for i, (value, item) in enumerate(found[:limit])]
    return sorted(out)


def ours(spark, rows, **options):
    docs = spark.createDataFrame([(*row, "x", 1, "y") for row in rows], SCHEMA)
    found = divergence.source_divergence(docs.repartition(4), **options)
    assert found.columns == ["lang", "source", "part", "item", "value", "rank"]
    return sorted(tuple(r) for r in found.collect())


def corpus(n=400):
    rng = random.Random(3)
    stems = ["Word%s" % c for c in "abcdefghijklmnopqrstuvwxyz"] + ["éa", "ÉA", "日本", "foo-bar", "a.a", "x y", "x　y", "Iİ"]
    ends = ["", ",", ".", "!!", "###", ")", "'s"]
    rows = []
    for i in range(n):
        common = rng.randint(1, len(stems))
        words = [rng.choice(stems[:common]) + rng.choice(ends) for _ in range(rng.randint(0, 30))]
        lang, source = rng.choice(["en", "fr", None, ""]), rng.choice(["s%d" % k for k in range(6)] + [None, "é", "\U0001F600", "�"])
        rows.append((i, rng.choice([" ", "\n", "\x0b\t"]).join(words), lang, source if i % 3 else "s0"))
    return rows


@pytest.mark.parametrize("min_docs", [1, 9])
def test_equals_plain_counts(spark, monkeypatch, min_docs):
    monkeypatch.setattr(divergence, "BATCH_BYTES", 900)
    monkeypatch.setattr(divergence, "PAIRS", 300)
    monkeypatch.setattr(divergence, "ROWS", 7)
    monkeypatch.setattr(divergence, "SIDE", 3)
    monkeypatch.setattr(divergence, "CELLS", 20)
    rows = corpus()
    found = ours(spark, rows, min_docs=min_docs, top_terms=5)
    assert found == brute(rows, min_docs, 5)
    assert {r[2] for r in found} == {"pair", "term"}


def test_documents_of_several_chunks_count_once(spark):
    """'Ab' and 'ab,' are chunks of one term; 20 documents hold both, so it is in 20 or 30 of them."""
    both = [(i, "Ab ab, ab, own", "en", "s%d" % (i % 2)) for i in range(20)]
    more = [(i, "ab! x%d" % i, "en", "s1") for i in range(20, 30)]
    for rows in (both, both + more, both + more[:9]):
        assert ours(spark, rows) == brute(rows)


def test_odd_rows(spark):
    rows = [(1, None, None, None), (1, "", "", ""), (None, "7 %", "en", "a"), (2, None, "en", "b"), (2, "w " * 5_000 + "w" * 50_000, "en", "a")]
    assert ours(spark, rows) == brute(rows)
    assert ours(spark, rows * 30) == brute(rows * 30)
    assert ours(spark, rows, min_docs=1) == brute(rows, 1)
    assert ours(spark, []) == []


def test_shares_beyond_64_bits():
    n = np.array([0, 7, 4 * 10**15])
    found = divergence.shares(n, np.array(8 * 10**15), 7)
    assert found.tolist() == [1 + 10**9 * (x + 5) // (8 * 10**15 + 35) for x in n.tolist()]


def test_a_chunk_may_fill_many_batches(spark):
    """Rows of one chunk come from every task; Arrow batches of two rows cut between them."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "2")
    try:
        rows = [(i, "same Same, other%d" % (i % 4), "en", "s%d" % (i % 3)) for i in range(60)]
        docs = spark.createDataFrame([(*row, "x", 1, "y") for row in rows], SCHEMA).repartition(9)
        assert sorted(tuple(r) for r in divergence.source_divergence(docs, min_docs=10).collect()) == brute(rows, 10)
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")

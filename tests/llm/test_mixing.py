import random
import re
from collections import Counter, defaultdict

import pytest

from portflow.llm import mixing

SCHEMA = "doc_id long, text string, source string, size int, target string, n_chars long, place string, block int"


def table(spark, rows):
    return spark.createDataFrame([(k, t, s, 1, "t", len(t or ""), "p", 2) for k, t, s in rows], SCHEMA)


def count(text):
    return len(re.findall(r"[^\x20\x09-\x0D]+", text or ""))


def targets(sizes):
    """Share the total by weight, cap, share the excess again, until nothing is above."""
    names = sorted((s for s in sizes if s is not None)) + ([None] if None in sizes else [])
    weight = {s: (5, 2, 1)[i % 3] for i, s in enumerate(names)}
    total, capped = sum(sizes.values()), set()
    while True:
        rest = total - sum(3 * sizes[s] for s in capped)
        open_weight = sum(w for s, w in weight.items() if s not in capped)
        found = {s: 3 * sizes[s] if s in capped else rest * weight[s] / open_weight for s in names}
        above = {s for s in names if s not in capped and found[s] > 3 * sizes[s]}
        if not above:
            return found
        capped |= above


def corpus(seed=1, n=400):
    rng = random.Random(seed)
    sources = ["b", "a", "hot", "é", "Z", None, "tiny"]
    rows = []
    for i in rng.sample(range(10**6), n):
        source = rng.choices(sources, [3, 4, 12, 2, 3, 2, 0.2])[0]
        rows.append((i, " \t".join("w%d" % rng.randrange(99) for _ in range(rng.randint(0, 60))), source))
    return rows


def test_targets_and_taken_words(spark):
    rows = corpus()
    found = mixing.taken_words(mixing.mix(table(spark, rows))).collect()
    assert sorted((r.doc_id, r.size) for r in found) == sorted((k, count(t)) for k, t, _ in rows)
    sizes, taken, source = Counter(), Counter(), {k: s for k, _, s in rows}
    for r in found:
        sizes[source[r.doc_id]] += r.size
        taken[source[r.doc_id]] += r.taken
        assert 0 <= r.taken <= 3 * r.size
    expected = targets(dict(sizes))
    for r in found:
        assert r.source_size == sizes[source[r.doc_id]]
        assert r.target == pytest.approx(expected[source[r.doc_id]])
    assert all(abs(taken[s] - expected[s]) <= 0.5 for s in sizes)
    again = mixing.taken_words(mixing.mix(table(spark, rows))).collect()
    assert sorted(map(str, again)) == sorted(map(str, found))


def test_schedule_is_even_and_complete(spark):
    rows = corpus(2)
    mixed = mixing.mix(table(spark, rows))
    source = {r[mixing.ROW]: r.source for r in mixed.sizes.collect()}
    words, slots = defaultdict(int), defaultdict(set)
    for p in mixed.pieces.collect():
        words[(source[p[mixing.ROW]], p.slot)] += p.words
        slots[source[p[mixing.ROW]]].add(p.slot)
    owned = sorted(s for group in slots.values() for s in group)
    assert owned == list(range(len(owned)))
    # Any stretch of the schedule has nearly each source's share of slots.
    n = len(owned)
    for group in slots.values():
        for start in range(0, n - n // 5, n // 7):
            stretch = sum(start <= s < start + n // 5 for s in group)
            assert abs(stretch - len(group) * (n // 5) / n) <= 4
    block = max(words.values())
    full = [w for w in words.values() if w == block]
    assert len(full) >= n - 2 * len(slots)


def test_odd_rows(spark):
    rows = [(1, None, "a"), (2, "", "a"), (3, "x", None), (3, "x", None), (None, "y z", "b"), (None, None, None), (4, "q " * 5000, "c")]
    found = mixing.taken_words(mixing.mix(table(spark, rows))).collect()
    assert sorted((str(r.doc_id), r.size) for r in found) == sorted((str(k), count(t)) for k, t, _ in rows)
    total = Counter()
    for k, t, s in rows:
        total[s] += count(t)
    expected = targets(dict(total))
    assert sum(r.taken for r in found) == pytest.approx(sum(expected.values()), abs=len(total))
    assert all(r.taken <= 3 * r.size for r in found)


@pytest.mark.parametrize("rows", [[], [(1, None, None)], [(1, "", "a"), (2, " \n", "b")]])
def test_nothing_to_mix(spark, rows):
    found = mixing.taken_words(mixing.mix(table(spark, rows))).collect()
    assert sorted((r.doc_id, r.size, r.target, r.taken) for r in found) == sorted((k, 0, 0.0, 0) for k, _, _ in rows)
    assert mixing.mixed_documents(table(spark, rows)).collect() == []


def test_mixed_documents_hold_the_taken_words(spark):
    rows = corpus(3)
    docs = table(spark, rows)
    taken = {r.doc_id: r.taken for r in mixing.taken_words(mixing.mix(docs)).collect() if r.taken}
    mixed = mixing.mixed_documents(docs)
    assert mixed.columns == docs.columns
    texts = {k: t for k, t, _ in rows}
    found = {r.doc_id: r for r in mixed.collect()}
    assert found.keys() == taken.keys()
    for key, r in found.items():
        assert count(r.text) == taken[key] and r.n_chars == len(r.text)
        whole, part = divmod(taken[key], count(texts[key]))
        assert r.text.split() == texts[key].split() * whole + texts[key].split()[:part]
        if not part:
            assert r.text == "\n".join([texts[key]] * whole)

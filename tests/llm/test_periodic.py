import random

import numpy as np
import pytest

from portflow.llm import periodic


def numbered(words):
    names = {}
    return np.array([names.setdefault(w, len(names)) for w in words], np.int64)


def smallest_period(words):
    return next(q for q in range(1, len(words) + 1) if words[q:] == words[: len(words) - q])


def brute(words, min_words):
    """Every stretch that repeats with a period and that no word extends, by comparing words."""
    n, out = len(words), []
    for q in range(1, n // 2 + 1):
        start = 0
        while start < n - q:
            end = start
            while end + q < n and words[end] == words[end + q]:
                end += 1
            length = end - start + q
            if length >= max(min_words, 2 * q) and smallest_period(words[start : start + length]) == q:
                out.append((start, length, q))
            start = end + 1
    return sorted(out)


def collapse(words, runs):
    gone = {i for start, length, q in runs for i in range(start + q, start + length)}
    return " ".join(w for i, w in enumerate(words) if i not in gone)


def texts():
    rng = random.Random(5)
    out = [["a"] * 40, list("ab") * 20, list("aab") * 9 + list("ab") * 9, [], ["x"], list("abcabc"), list("abcdefabcdef")]
    for size in (10, 30, 60, 120):
        for letters in ("ab", "abc", "abcdefgh"):
            for _ in range(12):
                words = [rng.choice(letters) for _ in range(size)]
                at, period = rng.randrange(size), rng.randint(1, size // 2)
                out.append([words[at + (i - at) % period] if i >= at and at + period < size else w for i, w in enumerate(words)])
    return out


@pytest.mark.parametrize("min_words", [2, 5, 12])
def test_runs_equal_word_comparisons(min_words):
    for words in texts():
        ours = periodic.find_runs(numbered(words), min_words) if words else []
        assert sorted(ours) == brute(words, min_words), words


def test_large_classes_use_many_blocks(monkeypatch):
    monkeypatch.setattr(periodic, "BLOCK", 4)
    for words in texts()[:40]:
        ours = periodic.find_runs(numbered(words), 3) if words else []
        assert sorted(ours) == brute(words, 3), words


def test_positions_know_their_neighbours(monkeypatch):
    monkeypatch.setattr(periodic, "BLOCK", 3)
    rng = random.Random(2)
    numbers = rng.sample(range(500), 200)
    ours, known = periodic.Positions(numbers[0]), [numbers[0]]
    for x in numbers[1:]:
        below, above = [y for y in known if y < x], [y for y in known if y > x]
        assert ours.insert(x) == (max(below, default=-1), min(above, default=-1))
        known.append(x)
    assert list(ours) == sorted(known)


def test_one_word_very_often():
    n = 60_000
    assert periodic.find_runs(np.zeros(n, np.int64)) == [(0, n, 1)]


def test_table(spark, monkeypatch):
    monkeypatch.setattr(periodic, "BATCH_BYTES", 200)
    long = " ".join(["w%d" % (i % 700) for i in range(9_000)])
    rows = [(i, " ".join(words)) for i, words in enumerate(texts())]
    rows += [(None, "a " * 20), (1, None), (1, ""), (1, " \t\n"), (7, "a b " * 12 + "　 é\x0b" * 12), (8, long), (8, long)]
    docs = spark.createDataFrame([(k, t, 1, "x", [2]) for k, t in rows], "doc_id long, text string, n_words int, start string, runs array<int>")
    found = [
        (r.doc_id, r.n_words, [tuple(x) for x in r.runs], r.collapsed) for r in periodic.periodic_runs(docs.repartition(3)).collect()
    ]
    wanted = []
    for key, text in rows:
        words = [w.decode() for w in (text or "").encode().split()]
        runs = brute(words, 12) if text != long else [(0, 9_000, 700)]
        wanted.append((key, len(words), sorted(runs), collapse(words, runs)))
    assert sorted(found, key=str) == sorted(wanted, key=str)
    assert periodic.periodic_runs(docs.limit(0)).count() == 0

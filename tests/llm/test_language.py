import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from portflow.llm import language as lg
from portflow.llm.common import ROW, id_hash_mod
from portflow.llm.queries import op4_language

SCHEMA = "doc_id long, lang string, text string, score string, n int"


def table(spark, rows):
    return spark.createDataFrame([(*r, "s", 1) for r in rows], SCHEMA)


def grams_of(text):
    """Characters as the model sees them, with their three predecessors."""
    out, last = [" "] * 3, " "
    for c in text.lower():
        c = c if c.isalpha() else " "
        if c != " " or last != " ":
            out.append(c)
        last = c
    return ["".join(out[i - 3 : i + 1]) for i in range(3, len(out))]


class KneserNey:
    """The textbook recursion over dictionaries."""

    def __init__(self, texts, alphabet):
        self.counts = [Counter(g for t in texts for g in grams_of(t))]
        for _ in range(3):
            self.counts.insert(0, Counter(g[1:] for g in self.counts[0]))
        self.alphabet = alphabet
        self.discounts, self.totals, self.kinds = [], [], []
        for counts in self.counts:
            n = Counter(counts.values())
            self.discounts.append(n[1] / (n[1] + 2 * n[2]) if n[1] else 0.5)
            totals, kinds = defaultdict(int), defaultdict(int)
            for g, c in counts.items():
                totals[g[:-1]] += c
                kinds[g[:-1]] += 1
            self.totals.append(totals)
            self.kinds.append(kinds)

    def chance(self, gram):
        k = len(gram) - 1
        lower = self.chance(gram[1:]) if k else 1 / (self.alphabet + 1)
        total = self.totals[k].get(gram[:-1], 0)
        if not total:
            return lower
        d = self.discounts[k]
        return max(self.counts[k].get(gram, 0) - d, 0) / total + d * self.kinds[k][gram[:-1]] / total * lower


def test_counts_and_probabilities_equal_the_recursion(spark):
    texts = {"aa": ["Abra cadabra, abra!", "cab 12 bac"], "bb": ["xyzzy abba", "yx-xy zyzzyva Äb"]}
    rows = [(i, k, t.lower()) for i, (k, t) in enumerate((k, t) for k, ts in texts.items() for t in ts)]
    found = lg.gram_counts(spark.createDataFrame(rows, f"{ROW} long, lang string, text string").select("lang", "text")).collect()
    expected = Counter((k, g) for k, ts in texts.items() for t in ts for g in grams_of(t))
    name = lambda code: "".join(chr(code >> 16 * k & 0xFFFF) for k in (3, 2, 1, 0))
    assert {(r.lang, name(r.gram & (1 << 64) - 1)): r.n for r in found} == dict(expected)
    counts = {}
    for lang in texts:
        own = sorted((r.gram & (1 << 64) - 1, r.n) for r in found if r.lang == lang)
        counts[lang] = (np.array([g for g, _ in own], np.uint64), np.array([n for _, n in own]))
    models = lg.build(counts)
    alphabet = len({g[-1] for ts in texts.values() for t in ts for g in grams_of(t)})
    tests = ["abra xyz unseen ß abracadabra", "q", "zzz cab"]
    grams, owner, _ = lg.Characters().sequences([t.lower() for t in tests])
    logs = models.log_probabilities(grams)
    for column, lang in enumerate(models.languages):
        plain = KneserNey(texts[lang], alphabet)
        wanted = [plain.chance(g) for t in tests for g in grams_of(t)]
        assert np.exp(logs[:, column]) == pytest.approx(wanted, rel=1e-4)


def test_held_out_accuracy(spark):
    found = op4_language(spark, "/root/testdata/sf0.01")
    truth = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "lang", "text")
    rows = found.join(truth, "doc_id").collect()
    assert len(rows) == truth.count()
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1) and 0 <= r.score <= 1 for r in rows)
    held = [r for r in rows if r.held_out]
    assert np.mean([r.lang == r.lang_pred for r in held]) > 0.97


def test_odd_rows(spark):
    rows = [(i, "en" if i % 2 else "xx", "hello there world " if i % 2 else "żółw ćma ąę ") for i in range(40)]
    rows += [(100, "en", None), (101, None, "hello"), (102, "en", ""), (103, "en", "123 !?"), (None, None, "there " * 9000), (104, "en", "😀𝒳")]
    docs = table(spark, rows)
    models = lg.fit(lg.training_rows(docs, F.lit(True)))
    found = {(r.doc_id): r for r in lg.predict(docs.select("doc_id", "score", "text").withColumnRenamed("score", "s"), models).collect()}
    assert len(found) == len(rows)
    assert all(found[k].lang_pred == "und" and found[k].rejected for k in (100, 102, 103))
    assert found[None].lang_pred == "en" and found[101].lang_pred == "en" and found[0].lang_pred == "xx"
    assert all(0 <= r.score <= 1 for r in found.values())


def test_nothing_to_learn_from(spark):
    docs = table(spark, [(1, None, "some text"), (2, "en", None)])
    models = lg.fit(lg.training_rows(docs, id_hash_mod("doc_id", 3) != 1))
    found = lg.predict(docs.select("doc_id", "text"), models).collect()
    assert sorted((r.doc_id, r.lang_pred) for r in found) == [(1, "und"), (2, "und")]
    assert lg.predict(docs.select("doc_id", "text").limit(0), models).collect() == []


def test_one_language(spark):
    docs = table(spark, [(i, "en", "only one language here") for i in range(9)])
    found = lg.predict(docs.select("doc_id", "text"), lg.fit(lg.training_rows(docs, F.lit(True)))).collect()
    assert {r.lang_pred for r in found} == {"en"}


def test_a_model_in_tables_equals_one_in_memory(spark, monkeypatch):
    rng = random.Random(4)
    words = {k: ["".join(rng.choices(a, k=rng.randint(1, 7))) for _ in range(60)] for k, a in (("aa", "abcde"), ("bb", "defgé"), ("cc", "日本語中文字"))}
    rows = [(i, k, " ".join(rng.choices(words[k], k=12))) for i, k in enumerate(list(words) * 60)]
    rows += [(1000, None, "qqq zzz abcde"), (1001, None, None), (1002, None, "12"), (1003, None, "")]
    docs = table(spark, rows)
    found = []
    # All in memory; none, all and some of the 4-grams broadcast.
    for cells in (1 << 23, 3, 1 << 11):
        monkeypatch.setattr(lg, "MAX_CELLS", cells)
        models = lg.fit(lg.training_rows(docs, F.lit(True)))
        assert (models.shelf is None) == (cells == 1 << 23)
        found.append({r.doc_id: r for r in lg.predict(docs.select("doc_id", "text"), models).collect()})
    for other in found[1:]:
        assert other.keys() == found[0].keys()
        for key, r in found[0].items():
            assert (other[key].lang_pred, other[key].rejected) == (r.lang_pred, r.rejected)
            assert other[key].score == pytest.approx(r.score, abs=1e-4)
            assert (other[key].cross_entropy or 0) == pytest.approx(r.cross_entropy or 0, rel=1e-5)


def test_no_gram_is_dropped(spark):
    # 340,000 4-grams of one language, all equally frequent but one.
    codes = np.arange(0x4E00, 0x4E00 + 20_000)
    rng = np.random.default_rng(1)
    texts = ["".join(map(chr, rng.permutation(codes))) for _ in range(17)]
    # A character that only the least frequent 4-grams hold.
    rows = [(i, "zh", t) for i, t in enumerate(texts) for _ in range(2)] + [(99, "zh", "가")]
    frame = spark.createDataFrame(rows, f"{ROW} long, lang string, text string")
    models = lg.fit(frame)
    assert len(models.tables[-1][0]) > 300_000
    assert 0xAC00 in models.tables[0][0]


def test_only_calibration_texts_are_kept_out_of_the_counts(spark, monkeypatch):
    held = spark.range(4000).where(F.pmod(F.xxhash64("id", F.lit(5)), F.lit(lg.HELD_EVERY)) == 0)
    held = [r.id for r in held.collect()]
    assert len(held) > 50
    # A language all of whose rows would be drawn, and a bound far below one in 40.
    langs = {i: "rare" for i in held[:3]}
    rows = [(i, langs.get(i, "en"), "żółw" if i in langs else "hello there") for i in range(4000)]
    frame = spark.createDataFrame(rows, f"{ROW} long, lang string, text string")
    monkeypatch.setattr(lg, "MAX_CALIBRATION", 10)
    counted = []
    plain = lg.gram_counts
    monkeypatch.setattr(lg, "gram_counts", lambda rows: counted.append(rows.count()) or plain(rows))
    models = lg.fit(frame)
    assert models.languages == ("en", "rare")
    assert 4000 - 10 <= counted[0] < 4000

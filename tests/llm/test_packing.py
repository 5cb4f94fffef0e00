import random
import tracemalloc
import zlib
from collections import defaultdict

import numpy as np
import pytest

from portflow.llm import packing

SCHEMA = "doc_id long, text string, length int, start string, rank int"


@pytest.fixture(scope="module")
def reference():
    from tokenizers import Tokenizer

    model = Tokenizer.from_file(packing.tokenizer_path())
    model.encode_special_tokens = True
    return lambda text: [*model.encode(text or "", add_special_tokens=False).ids, 0]


def padding(sequences):
    sizes = [sum(r.length for r in rows) for rows in sequences.values()]
    return sum(0 if size & (size - 1) == 0 else packing.CAPACITY - size for size in sizes)


def check(rows, found, reference):
    """Every id of every document in one piece, sequences gapless and within the capacity."""
    ids = [(key, reference(text)) for key, text in rows]
    expected = defaultdict(int)
    for r in found:
        expected[(r.doc_id, r.doc_tokens)] += r.length
    totals = defaultdict(int)
    for key, tokens in ids:
        totals[(key, len(tokens))] += len(tokens)
    assert expected == totals
    by_id = defaultdict(list)
    for key, tokens in ids:
        by_id[key].append(tokens)
    for r in found:
        pieces = [np.array(t[r.start : r.start + r.length], "<u4").tobytes() for t in by_id[r.doc_id]]
        assert r.ids_crc32 in [zlib.crc32(p) for p in pieces]
    sequences = defaultdict(list)
    for r in found:
        sequences[r.sequence_id].append(r)
    for parts in sequences.values():
        at = 0
        for r in sorted(parts, key=lambda r: r.offset):
            assert r.offset == at and r.length > 0
            at += r.length
        assert at <= packing.CAPACITY
    return padding(sequences)


def corpus(n, seed=1):
    rng = random.Random(seed)
    return [(i, " ".join("w%d" % rng.randint(0, 999) for _ in range(rng.randint(0, 900)))) for i in range(n)]


def test_packs_everything_with_little_padding(spark, reference):
    rows = corpus(300)
    docs = spark.createDataFrame([(k, t, 1, "s", 2) for k, t in rows], SCHEMA)
    found = packing.pack(docs).collect()
    total = sum(r.length for r in found)
    assert check(rows, found, reference) < 0.01 * total


def test_odd_rows(spark, reference):
    rows = [
        (1, None), (2, ""), (None, "no id"), (3, "same"), (3, "same"), (3, "other text"), (4, "x " * 2000),
        (5, "  \n\t 'tis it's I'll '' we've <|endoftext|> 日本 1٣ "), (6, "a" * 9000),
    ]
    docs = spark.createDataFrame([(k, t, None, None, None) for k, t in rows], SCHEMA)
    check(rows, packing.pack(docs).collect(), reference)


def test_empty_table(spark):
    assert packing.pack(spark.createDataFrame([], SCHEMA)).collect() == []


def test_one_common_length(spark, reference):
    rows = [(i, "copy of one text " * 60) for i in range(200)]
    docs = spark.createDataFrame([(k, t, 1, "s", 2) for k, t in rows], SCHEMA)
    check(rows, packing.pack(docs).collect(), reference)


def test_token_ids_equal_those_of_the_library(reference, monkeypatch):
    rng = random.Random(2)
    alphabet = "  \n\t'' s t r e v l m d aé日1٣½.!  ́ǅ" + "<|endoftext|>"
    texts = ["".join(rng.choices(alphabet, k=rng.randint(0, 60))) for _ in range(3000)] + [t for _, t in corpus(20)]
    encoder = packing.PieceTokenizer(packing.tokenizer_path())
    expected = [reference(t) for t in texts]
    assert [np.frombuffer(x, "<u4").tolist() for x, _ in packing._encoded(encoder, iter(texts))] == expected
    # In segments, as for very long texts, and with a cache that is emptied all the time.
    monkeypatch.setattr(packing, "SEGMENT_CHARS", 40)
    monkeypatch.setattr(packing, "CACHED_PIECES", 10)
    parts, current = [], b""
    for ids, ends in packing._encoded(encoder, iter(texts)):
        current += ids
        if ends:
            parts.append(np.frombuffer(current, "<u4").tolist())
            current = b""
    assert parts == expected


def test_a_worker_stays_small_over_very_many_different_words(reference):
    rng = random.Random(11)
    letters = str.maketrans("0123456789abcdef", "abcdefghijklmnop")
    texts = [" ".join("%x" % rng.getrandbits(40) for _ in range(5_000)).translate(letters) for _ in range(100)]
    encoder = packing.PieceTokenizer(packing.tokenizer_path())
    tracemalloc.start()
    try:
        found = [zlib.crc32(ids) for ids, _ in packing._encoded(encoder, iter(texts))]
        peak = tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()
    assert found[::25] == [zlib.crc32(np.array(reference(t), "<u4").tobytes()) for t in texts[::25]]
    assert peak < 80e6


@pytest.mark.parametrize("n", [1, 50, 5000])
def test_plan_uses_every_remainder_once(n):
    rng = random.Random(n)
    histogram = defaultdict(int)
    for _ in range(n):
        histogram[rng.randint(1, 1023)] += 1
    used = defaultdict(int)
    patterns = packing.plan(histogram)
    for pattern in patterns:
        assert sum(length * copies for length, copies in pattern.counts) <= 1024
        for length, copies in pattern.counts:
            used[length] += copies * pattern.times
    assert used == histogram


def test_fill_is_the_closest_possible():
    rng = random.Random(7)
    for _ in range(200):
        items = [rng.randint(1, 40) for _ in range(rng.randint(1, 9))]
        capacity = rng.randint(max(items), 120)
        histogram = {x: items.count(x) for x in items}
        lengths = sorted(histogram, reverse=True)
        used = packing._fill(lengths[0], lengths, histogram, capacity)
        sums = {lengths[0]}
        rest = sorted(items)
        rest.remove(lengths[0])
        for x in rest:
            sums |= {s + x for s in sums}
        assert sum(a * b for a, b in used.items()) == max(s for s in sums if s <= capacity)
        assert all(copies <= histogram[x] for x, copies in used.items())


def test_queries_give_added_tokens_their_id(spark, tmp_path, monkeypatch):
    from tokenizers import Tokenizer

    from portflow.llm.queries import op3_packing

    model = Tokenizer.from_file(packing.tokenizer_path())
    plain = lambda text: [*model.encode(text or "", add_special_tokens=False).ids, 0]
    mark = "<|endoftext|>"
    rng = random.Random(3)
    parts = [mark, " ", "  ", "a", "it's", "\n", "日", "<|", "|>", "x" * 30]
    texts = ["a <|endoftext|> b", mark, mark * 2, None, "", *("".join(rng.choices(parts, k=rng.randint(0, 20))) for _ in range(300))]
    texts.append(("word " * 400 + mark) * 6)
    rows = list(enumerate(texts))
    spark.createDataFrame(rows, "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    assert plain(texts[0]) == [64, 220, 50256, 275, 0]
    check(rows, op3_packing(spark, str(tmp_path)).collect(), plain)
    monkeypatch.setattr(packing, "SEGMENT_CHARS", 40)
    encoder = packing.PieceTokenizer(packing.tokenizer_path(), added_tokens=True)
    found, current = [], b""
    for ids, ends in packing._encoded(encoder, (t or "" for t in texts)):
        current += ids
        if ends:
            found.append(np.frombuffer(current, "<u4").tolist())
            current = b""
    assert found == [plain(t) for t in texts]

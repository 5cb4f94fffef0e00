import random

from pyspark.sql import functions as F

from portflow.llm import fixity

SCHEMA = "offset long, length long, digest string"


def audit(spark, one, two, range_bytes=100):
    frames = [spark.createDataFrame(x, SCHEMA) for x in (one, two)]
    return sorted(tuple(r) for r in fixity.audit(*frames, range_bytes).collect())


def archive(n=400, seed=1):
    rng, offset, rows = random.Random(seed), 0, []
    for i in range(n):
        length = rng.randint(1, 90)
        rows.append((offset, length, "d%d" % i))
        offset += length
    return rows


def test_finds_exactly_the_damaged_records(spark):
    one = archive()
    rng = random.Random(2)
    two, expected = [], []
    for offset, length, digest in one:
        fate = rng.random()
        if fate < 0.02:
            expected.append((offset, length, "missing"))
        elif fate < 0.04:
            two.append((offset, length, "broken"))
            expected.append((offset, length, "changed"))
        elif fate < 0.05:
            two.append((offset, length + 1, digest))
            expected.append((offset, length, "changed"))
        else:
            two.append((offset, length, digest))
    two.append((10**6, 5, "late"))
    expected.append((10**6, 5, "unexpected"))
    assert audit(spark, one, two) == sorted(expected)


def test_descends_into_damaged_ranges_only(spark):
    one = archive()
    two = [(o, n, "x" if i == 77 else d) for i, (o, n, d) in enumerate(one)]
    frames = [spark.createDataFrame(x, SCHEMA) for x in (one, two)]
    last = max(o for o, _, _ in one) // 100
    found = fixity.damaged_ranges(*(fixity.tree(f, last, 100) for f in frames)).collect()
    assert [r.node for r in found] == [one[77][0] // 100]


def test_equal_and_empty_replicas(spark):
    one = archive(50)
    assert audit(spark, one, list(reversed(one))) == []
    assert audit(spark, [], []) == []
    assert audit(spark, one[:2], []) == [(o, n, "missing") for o, n, _ in one[:2]]
    assert audit(spark, [], one[:2]) == [(o, n, "unexpected") for o, n, _ in one[:2]]


def test_layout_of_odd_pages(spark):
    pages = [(3, "u", "h"), (1, None, None), (1, None, None), (None, "z", "é" * 9), (2, "", ""), (1, "u", "x" * 5000)]
    docs = spark.createDataFrame(pages, "page_id long, url string, html string")
    data = fixity.record()
    records = docs.select("page_id", F.octet_length(data).cast("long").alias("length"), fixity.digest(data).alias("digest"))
    laid = sorted(fixity.laid_out(records, "page_id", "digest", "length").collect(), key=lambda r: r.offset)
    assert [r.page_id for r in laid] == [1, 1, 1, 2, 3, None]
    assert [r.offset for r in laid] == [sum(x.length for x in laid[:i]) for i in range(6)]
    assert fixity.laid_out(records.limit(0), "page_id", "digest", "length").collect() == []

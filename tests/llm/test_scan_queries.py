"""The queries of the text scans and of the source audit, on small tables of their own."""

import hashlib
import random
import zlib

import duckdb
import pytest
from test_divergence import corpus
from test_periodic import brute, collapse
from test_secret_scan import texts

from portflow.llm import queries

SCHEMA = "doc_id long, text string, lang string, source string, n_chars int"


def folder_of(spark, tmp_path, rows):
    spark.createDataFrame(rows, SCHEMA).coalesce(2).write.parquet(f"{tmp_path}/documents.parquet")
    return str(tmp_path)


@pytest.mark.parametrize("name", ["op11_source_divergence", "op12_secret_scans"])
def test_query_equals_its_sql(spark, tmp_path, name):
    if name.startswith("op11"):
        rows = [(*row, 1) for row in corpus()]
    else:
        rows = [(i, text, "en", "s", 1) for i, text in enumerate([*texts(), None, "token=abcdef"])] + [(None, "x", None, None, 1)] * 2
    folder = folder_of(spark, tmp_path, rows)
    found = queries.QUERIES[name](spark, folder)
    connection = duckdb.connect()
    connection.execute(f"CREATE VIEW documents AS SELECT * FROM '{folder}/documents.parquet/*.parquet'")
    wanted = connection.execute(queries.ORACLES[name])
    assert [c[0] for c in wanted.description] == found.columns
    assert sorted(map(str, (tuple(r) for r in found.collect()))) == sorted(map(str, wanted.fetchall()))


def planted(key, text):
    """The words the contract states, one by one."""
    words = [w.decode() for w in (text or "").encode().split()]
    n, h = len(words), zlib.crc32(b"" if key is None else str(key).encode())
    if h % 10 or not n:
        return words
    g = h // 10
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return [w if i < a else words[a + (i - a) % p] for i, w in enumerate(words)]


def test_periodic_query(spark, tmp_path):
    rng = random.Random(8)
    rows = [(None, "a b " * 9), (3, None), (3, ""), (-7, " \n"), (10**17, "one two " * 30)]
    for i in range(250):
        words = ["w%d" % rng.randrange(rng.choice([3, 400])) for _ in range(rng.randint(0, 90))]
        rows.append((i, rng.choice([" ", "\n", " \t"]).join(words) + rng.choice(["", " "])))
    folder = folder_of(spark, tmp_path, [(k, t, "en", "s", 1) for k, t in rows])
    found = [tuple(r) for r in queries.op13_periodic_runs(spark, folder).collect()]
    wanted, changed = [], 0
    for key, text in rows:
        words = planted(key, text)
        changed += words != planted(1, text)
        runs = brute(words, 12)
        best = max(runs, key=lambda r: (r[1], -r[0], -r[2]), default=(None,) * 3)
        listed = "".join("%d,%d,%d\n" % (s, n, q) for s, n, q in sorted(runs, key=lambda r: (r[0], r[2])))
        shas = [hashlib.sha256(x.encode()).hexdigest() for x in (listed, collapse(words, runs))]
        wanted.append((key, len(runs), *best, 1000 * best[1] // best[2] if runs else None, *shas))
    assert sorted(map(str, found)) == sorted(map(str, wanted))
    assert changed > 10 and sum(r[1] > 0 for r in found) > 10

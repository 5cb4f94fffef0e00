import random
from collections import defaultdict

import pytest

from portflow.llm import line_dedup as ld

SCHEMA = "doc_id long, text string, source string, pos int, site string, removed int"


def brute(rows, min_sites=8, min_chars=1):
    sites = defaultdict(set)
    strip = " \t\n\x0b\x0c\r"
    for _, text, source in rows:
        for line in (text or "").split("\n"):
            sites[line.strip(strip)].add(source)
    out = []
    for key, text, _ in rows:
        lines = (text or "").split("\n")
        kept = [x for x in lines if len(x.strip(strip)) < min_chars or len(sites[x.strip(strip)]) < min_sites]
        out.append((key, len(lines), len(lines) - len(kept), "\n".join(kept)))
    return sorted(out, key=str)


def ours(spark, rows, **options):
    docs = spark.createDataFrame([(k, t, s, 1, "x", 2) for k, t, s in rows], SCHEMA)
    found = ld.without_boilerplate(docs, **options).collect()
    return sorted(((r.doc_id, r.n_lines, r.n_removed, r.kept) for r in found), key=str)


def corpus():
    rng = random.Random(1)
    common = [("boilerplate line number %d " % i) * 2 for i in range(30)]
    rows = []
    for i in range(300):
        lines = [rng.choice(common) if rng.random() < 0.4 else "own line %d of the document %d" % (j, i) for j in range(rng.randint(1, 9))]
        # Line i stands on i sites or fewer, so counts around every threshold occur.
        lines += ["spread of line %02d over sites" % k for k in range(20) if i % 20 < k]
        # Lines of 1 to 19 characters, on all sites or on few.
        if i % 3:
            lines += ["x" * rng.randint(1, 19), "y" * (i % 20)]
        rows.append((i, "\n".join(lines), "site%d" % (i % 20) if i % 21 else None))
    rows.append((900, "one line of its own", "site3"))
    return rows


@pytest.mark.parametrize("min_sites", [2, 8, 15])
def test_equals_exact_site_counts(spark, min_sites):
    rows = corpus()
    found = ours(spark, rows, min_sites=min_sites)
    assert found == brute(rows, min_sites)
    assert any(r[2] for r in found) and any(not r[2] for r in found)


def test_longer_lines_only(spark):
    rows = corpus()
    assert ours(spark, rows, min_chars=20) == brute(rows, min_chars=20) != brute(rows)


def test_odd_rows(spark):
    line = "a line that is long enough"
    rows = [(1, None, "a"), (2, "", None), (None, line, None), (3, line + "\n\n " + line + " \n", "b"), (3, line, "b"), (4, "short\n" * 400 + line, "c")]
    assert ours(spark, rows, min_sites=3) == brute(rows, 3)
    assert ours(spark, rows, min_sites=4) == brute(rows, 4)
    assert ours(spark, []) == []

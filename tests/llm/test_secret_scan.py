import math
import random
import re
from collections import Counter

import pytest

from portflow.llm import secret_scan as scan

KEY = "Zk3pQ9xLw7Rt2VbN8mYc4HsD"
HASH = "04dbebab91ab85687d33eeaaf9ac699e1188f962"

BASE = [
    ("assign", re.compile(r"""([Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd]|[Pp][Aa][Ss][Ss][Ww][Dd]|[Ss][Ee][Cc][Rr][Ee][Tt]|[Tt][Oo][Kk][Ee][Nn]|[Aa][Pp][Ii]_?[Kk][Ee][Yy])["']? *[:=] *["']?([A-Za-z0-9+/_.=-]+)"""), 2, 6),
    ("access", re.compile("AKIA[A-Z0-9]+"), 0, 20),
    ("hex", re.compile("[0-9a-f]+"), 0, 24),
]


def entropy(text):
    return -sum(n / len(text) * math.log2(n / len(text)) for n in Counter(text).values())


def brute(text, window=scan.WINDOW, allowed=scan.ALLOWED):
    """Patterns as stated, and the entropy of every window from scratch."""
    base = [(kind, m.start(), m.end()) for kind, p, g, least in BASE for m in p.finditer(text) if len(m[g]) >= least]
    covers = [(s, e) for _, s, e in base] + [m.span() for p in allowed for m in re.finditer(p, text)]
    added = []
    for kind, (chars, bits) in scan.CLASSES.items():
        inside = [bool(re.match(f"[{chars}]", c)) for c in text]
        marked, joined = [], []
        for i in range(len(text) - window + 1):
            part = text[i : i + window]
            if all(inside[i : i + window]) and re.search("[0-9]", part) and re.search("[A-Za-z]", part) and entropy(part) >= bits - 1e-9:
                marked.append(i)
        for i in marked:
            if joined and i <= joined[-1][1] and all(inside[joined[-1][0] : i + window]):
                joined[-1][1] = i + window
            else:
                joined.append([i, i + window])
        added += [(kind, s, e) for s, e in joined if not any(a <= s and e <= b for a, b in covers)]
    order = {kind: i for i, kind in enumerate(scan.KINDS)}
    return sorted(base + added, key=lambda x: (x[1], order[x[0]]))


def texts():
    rng = random.Random(4)
    alphabets = ["0123456789abcdef", "0123456789ABCDEF", "ABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789", "abcXYZ019+/_-", "aA1", KEY]
    out = [
        "", "no secret: at all", "token = short", 'API_KEY="abcdef"', "Password:hunter22 PASSWD = 'x.y.z=='", "token=token:abcdefgh",
        "secret=a:token=abcdefg", "toKen=abcdef toKen=abcdef ſecret=abcdef", "éü token : " + KEY, "AKIA" + "A" * 15, "xAKIA" + "Q7" * 8,
        "AKIAAKIA" + "B" * 12, HASH, "x" + HASH + "A", HASH[:23], HASH.upper(), "日本 " + KEY + KEY[::-1], "https://a.example.org/" + KEY,
        "https://a.org/?q=" + KEY, "123e4567-e89b-12d3-a456-426614174000", "sha256:" + KEY * 2, "data:image/png;base64," + KEY * 3,
        KEY + "EXAMPLE", "a" * 60, "1" * 60, "1234567890" * 6, "password=" + KEY * 2, KEY + "." + KEY, KEY * 40,
    ]
    for _ in range(150):
        words = []
        for _ in range(rng.randint(1, 4)):
            words.append(rng.choice(["", "é", "token=", "https://h.org/", "sha1:"]) + "".join(rng.choice(rng.choice(alphabets)) for _ in range(rng.randint(15, 60))))
        out.append(rng.choice([" ", ".", "\n"]).join(words))
    return out


@pytest.mark.parametrize("window", [24, 30])
def test_equals_entropy_of_every_window(window):
    scanner = scan.Scanner(window)
    kinds = Counter()
    for text in texts():
        found = scanner.spans(text)
        assert found == brute(text, window), text
        kinds.update(span[0] for span in found)
    assert set(kinds) == set(scan.KINDS)


def test_allow_list_suppresses_only_added_spans():
    quiet, loud = scan.Scanner(), scan.Scanner(allowed=())
    text = "https://a.org/" + KEY + " https://a.org/" + HASH
    at = text.index(HASH)
    assert quiet.spans(text) == [("hex", at, at + len(HASH))]
    assert [s[0] for s in loud.spans(text)] == ["entropy_base64", "hex"]


def test_table(spark, monkeypatch):
    monkeypatch.setattr(scan, "BATCH_BYTES", 300)
    rows = [(i, text) for i, text in enumerate(texts())]
    rows += [(None, "token=abcdef"), (1, None), (1, "token=abcdef"), (1, "token=abcdef"), (5, ("plain words " * 9_000) + KEY)]
    docs = spark.createDataFrame([(k, t, "x", 1, [2]) for k, t in rows], "doc_id long, text string, kind string, start int, spans array<int>")
    found = [(r.doc_id, [tuple(s) for s in r.spans]) for r in scan.secret_spans(docs.repartition(3)).collect()]
    wanted = [(k, brute(t or "") if k != 5 or len(t) < 9_000 else [("entropy_base64", 108_000, 108_024)]) for k, t in rows]
    assert sorted(found, key=str) == sorted(wanted, key=str)
    assert scan.secret_spans(docs.limit(0)).count() == 0
    shown = docs.where("kind = 'x'").limit(0).sparkSession.createDataFrame([([("hex", 1, 30), ("assign", 40, 50)],)], f"spans {scan.SPAN_TYPE}")
    assert shown.select(scan.span_text(scan.F.col("spans"))).first()[0] == "hex:1:30,assign:40:50"

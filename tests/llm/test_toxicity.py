import random
import zlib

import numpy as np

from portflow.llm import toxicity as tx
from portflow.llm.common import with_row
from portflow.llm.queries import op5_toxicity

SCHEMA = "doc_id long, text string, score string, predicted string, label int"


def corpus(n=1500, seed=1):
    rng = random.Random(seed)
    rows, labels = [], []
    for i in range(n):
        bad = rng.random() < 0.15
        words = ["w%d" % rng.randrange(400) for _ in range(rng.randint(5, 80))]
        if bad:
            words += rng.choices(["vile", "NASTY", "rotten!"], k=rng.randint(1, 4))
            rng.shuffle(words)
        rows.append((i, " ".join(words)))
        labels.append((i, 1, int(bad)))
    return rows, labels


def frames(spark, rows, labels):
    docs = spark.createDataFrame([(*r, "s", "p", 7) for r in rows], SCHEMA)
    return with_row(docs), spark.createDataFrame(labels, "doc_id long, quality int, toxic int")


def test_finds_toxic_texts_it_has_not_seen(spark):
    rows, labels = corpus()
    docs, known = frames(spark, rows, labels)
    train, test = docs.where("doc_id % 2 = 0"), docs.where("doc_id % 2 = 1").select("doc_id", "text")
    model = tx.fit(train, tx.labelled_rows(train, known))
    found = {r.doc_id: r for r in tx.score(test, model).collect()}
    truth = {i: bad for i, _, bad in labels}
    toxic = np.array([r.predicted for k, r in found.items() if truth[k]])
    clean = np.array([r.predicted for k, r in found.items() if not truth[k]])
    assert toxic.mean() > 0.95 and clean.mean() < 0.02
    assert all(r.predicted == (r.score >= 0.5) and 0 <= r.score <= 1 for r in found.values())


def test_learns_without_negative_labels(spark):
    rows, labels = corpus(1200, 2)
    docs, known = frames(spark, rows, labels)
    # Positives alone, and a given prior: the unlabelled texts hold both classes.
    positive = [x for (i, t), (_, _, bad) in zip(rows, labels) if bad for x in tx._sets([t.encode()])][:90]
    unlabelled = tx._sets([t.encode() for _, t in rows])
    model = tx.centred(tx.train(positive, unlabelled, 0.15), positive, unlabelled, 0.15)
    found = tx.score(docs.select("doc_id", "text"), model).collect()
    truth = {i: bad for i, _, bad in labels}
    assert np.mean([r.predicted == truth[r.doc_id] for r in found]) > 0.97


def test_registered_query(spark):
    folder = "/root/testdata/sf0.1"
    found = op5_toxicity(spark, folder).toPandas()
    labels = spark.read.parquet(f"{folder}/labels.parquet").toPandas()
    assert len(found) == spark.read.parquet(f"{folder}/documents.parquet").count()
    assert (found.held_out == [zlib.crc32(str(i).encode()) % 5 == 0 for i in found.doc_id]).all()
    held = found[found.held_out].merge(labels, on="doc_id")
    toxic, clean = held[held.toxic == 1].score.values, held[held.toxic == 0].score.values
    assert np.mean((toxic[:, None] > clean) + 0.5 * (toxic[:, None] == clean)) > 0.9
    assert (clean >= 0.5).mean() < 0.03 and (toxic >= 0.5).mean() > 0.7


def test_odd_rows(spark):
    rows, labels = corpus(300, 3)
    rows += [(1000, None), (1001, ""), (None, "vile nasty rotten"), (1002, "vile " * 20000), (1002, "w1 w2"), (1003, "!!!")]
    labels += [(1000, 0, 0), (1001, 0, 1), (None, 0, 1), (5, 0, None), (6, None, 0), (6, None, 1), (9999, 1, 1), (1002, 0, 1)]
    docs, known = frames(spark, rows, labels)
    model = tx.fit(docs, tx.labelled_rows(docs, known))
    found = tx.score(docs.select("doc_id", "text"), model).collect()
    assert len(found) == len(rows) and all(0 <= r.score <= 1 for r in found)
    by_id = {r.doc_id: r for r in found if r.doc_id != 1002}
    assert by_id[None].predicted == 1 and by_id[1000].predicted == 0 and by_id[1000].score == by_id[1001].score
    kept = tx.without_toxic(docs, model)
    assert kept.columns == docs.columns
    assert sorted((str(r.doc_id), str(r.text)) for r in kept.collect()) == sorted(
        (str(k), str(t)) for (k, t), r in zip(rows, sorted(found, key=lambda r: 0)) if r.predicted == 0
    )


def test_nothing_to_learn_from(spark):
    docs, known = frames(spark, [(1, "text"), (2, None)], [])
    model = tx.fit(docs, tx.labelled_rows(docs, known))
    assert [r.predicted for r in tx.score(docs.select("doc_id", "text"), model).collect()] == [0, 0]
    assert tx.score(docs.select("doc_id", "text").limit(0), model).collect() == []


def test_features_of_long_texts_are_all_learned(spark):
    common = " ".join("%05dw" % i for i in range(6000))
    marks = ["mark%dx" % i for i in range(20)]
    docs = spark.createDataFrame([(i, common + " " + " ".join(marks) * (i % 4 == 0)) for i in range(100)], "doc_id long, text string")
    docs = with_row(docs)
    known = spark.createDataFrame([(i, int(i % 4 == 0)) for i in range(100)], "doc_id long, toxic int")
    model = tx.fit(docs, tx.labelled_rows(docs, known))
    # None of the marks may be missing, whatever its hash.
    found = tx._sets([" ".join(marks).encode()])[0]
    assert len(found) > 20 and np.isin(found, model.words).all()
    assert len(tx._sets([common.encode()])[0]) > 6000

import re
from collections import defaultdict

import corpus_pipeline
import pytest
from test_mixing import targets
from test_near_dedup import brute
from test_packing import check

from portflow.llm import toxicity
from portflow.llm.common import id_hash_mod, stored, with_row

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def outputs(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    found = [docs]
    for _, stage in corpus_pipeline.STAGES:
        found.append(stored(stage(spark, found[-1], FOLDER)))
    return found


def test_stages_and_columns(outputs):
    assert [name for name, _ in corpus_pipeline.STAGES] == ["toxicity", "exact_dedup", "near_dedup", "mixing", "packing"]
    assert all(x.columns == outputs[0].columns for x in outputs[:-1])
    assert all(x.count() > 0 for x in outputs)


def rows_of(df):
    return sorted(((r.doc_id, r.text) for r in df.collect()), key=str)


def test_toxicity_drops_what_scores_high(spark, outputs):
    docs = with_row(outputs[0])
    train = docs.where(id_hash_mod("doc_id", 5) != 0)
    labels = spark.read.parquet(f"{FOLDER}/labels.parquet")
    model = toxicity.fit(train, toxicity.labelled_rows(train, labels))
    scored = {r.doc_id: r.predicted for r in toxicity.score(outputs[0].select("doc_id", "text"), model).collect()}
    assert rows_of(outputs[1]) == [r for r in rows_of(outputs[0]) if not scored[r[0]]]


def test_exact_copies_go(outputs):
    best = {}
    for key, text in rows_of(outputs[1]):
        best[text] = max(key, best.get(text, key))
    assert rows_of(outputs[2]) == sorted(((k, t) for t, k in best.items()), key=str)


def test_one_of_each_near_class_stays(outputs):
    classes = {i: c for i, c, _ in brute(rows_of(outputs[2]))}
    assert {k for k, _ in rows_of(outputs[3])} == set(classes.values())


def test_mix_meets_targets(outputs):
    count = lambda t: len(re.findall(r"[^\x20\x09-\x0D]+", t))
    before = {r.doc_id: r for r in outputs[3].collect()}
    sizes, taken = defaultdict(int), defaultdict(int)
    for r in before.values():
        sizes[r.source] += count(r.text)
    for r in outputs[4].collect():
        assert count(r.text) <= 3 * count(before[r.doc_id].text) and r.n_chars == len(r.text)
        taken[r.source] += count(r.text)
    assert all(abs(taken[s] - t) <= 0.5 for s, t in targets(dict(sizes)).items())


def test_packing_holds_every_token(outputs):
    from tokenizers import Tokenizer

    from portflow.llm import packing

    model = Tokenizer.from_file(packing.tokenizer_path())
    model.encode_special_tokens = True
    rows = [(r.doc_id, r.text) for r in outputs[4].collect()]
    found = outputs[5].collect()
    padding = check(rows, found, lambda t: [*model.encode(t, add_special_tokens=False).ids, 0])
    assert padding < 0.02 * sum(r.length for r in found)


def test_run_gives_the_last_stage(spark, outputs):
    assert sorted(map(str, corpus_pipeline.run(spark, FOLDER).collect())) == sorted(map(str, outputs[5].collect()))

"""Toxicity by non-negative positive-unlabelled learning.

Only confirmed toxic texts count as labelled. All other training texts are a mix of both classes, so the risk of the
negative class is taken from the unlabelled texts and corrected by what positives contribute to it:

    risk = prior * loss(positives, +1) + max(0, loss(unlabelled, -1) - prior * loss(positives, -1))

A mini-batch whose corrected part falls below zero is over-fitted; its step goes the other way. The classifier is a
linear one over the distinct words of a text, trained in numpy on the driver from a bounded sample; scoring reads every whole text
once and shuffles nothing.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from portflow.llm.common import ROW, binary_parts, slices, stored, text_or_empty, with_row, word_hashes

# Bounds of the training sample: confirmed toxic texts, and texts of any kind.
MAX_POSITIVE = 3_000
MAX_UNLABELLED = 6_000
# Bytes of the word beginnings that are features.
PREFIXES = (4, 6, 8)
# Words of the model: at most so many, each so many standard errors apart between the two samples.
MAX_MODEL_WORDS = 1 << 14
MIN_DISTANCE = 4.0
BATCH_BYTES = 4 << 20


def word_sets(raw: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The distinct features of each text, concatenated, and where each text's start.

    Features are hashes of words and of their beginnings, so that a stem counts whatever ends the word.
    """
    words, first, begun = word_hashes(raw, bounds, PREFIXES)
    n = len(bounds) - 1
    owner = np.tile(np.repeat(np.arange(n), np.diff(first)), 1 + len(PREFIXES))
    hashes = np.concatenate([words, *begun])
    hashes, owner = hashes[hashes != 0], owner[hashes != 0]
    order = np.lexsort((hashes, owner))
    hashes, owner = hashes[order], owner[order]
    new = np.ones(len(hashes), bool)
    new[1:] = (hashes[1:] != hashes[:-1]) | (owner[1:] != owner[:-1])
    hashes, owner = hashes[new], owner[new]
    return hashes, np.searchsorted(owner, np.arange(n + 1))


@dataclass(frozen=True)
class Model:
    """Words as a sorted hash array with their weights; all other words weigh nothing."""

    words: np.ndarray
    weights: np.ndarray
    bias: float

    def scores(self, hashes: np.ndarray, first: np.ndarray) -> np.ndarray:
        """The probability of label 1 for each set of words."""
        total = np.zeros(len(hashes) + 1)
        if len(self.words):
            at = np.minimum(np.searchsorted(self.words, hashes), len(self.words) - 1)
            np.cumsum(np.where(self.words[at] == hashes, self.weights[at], 0.0), out=total[1:])
        return 1 / (1 + np.exp(-np.clip(total[first[1:]] - total[first[:-1]] + self.bias, -60, 60)))


def _sets(texts: list[bytes]) -> list[np.ndarray]:
    out: list[np.ndarray] = []
    sizes = np.fromiter(map(len, texts), np.int64, len(texts))
    with np.errstate(over="ignore"):
        for lo, hi in slices(sizes, BATCH_BYTES):
            raw = np.frombuffer(b"".join(texts[lo:hi]), np.uint8)
            hashes, first = word_sets(raw, np.concatenate(([0], np.cumsum(sizes[lo:hi]))))
            out.extend(hashes[a:b] for a, b in zip(first[:-1], first[1:]))
    return out


def _matrix(sets: list[np.ndarray], words: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Word numbers of each text, concatenated, and where each text's start."""
    sizes, numbers = [], []
    for hashes in sets:
        at = np.minimum(np.searchsorted(words, hashes), len(words) - 1)
        found = at[words[at] == hashes]
        numbers.append(found)
        sizes.append(len(found))
    return np.concatenate([*numbers, np.zeros(0, np.int64)]), np.concatenate(([0], np.cumsum(sizes))).astype(np.int64)


def _telling_words(positive: list[np.ndarray], unlabelled: list[np.ndarray]) -> tuple[np.ndarray, ...]:
    """Words whose share of positives differs clearly from that of unlabelled texts, with both shares."""
    values, counts = np.unique(np.concatenate([*positive, *unlabelled]), return_counts=True)
    values = values[counts >= 2]
    if not len(values):
        return values, np.zeros(0), np.zeros(0)
    shares = []
    for sets in (positive, unlabelled):
        numbers, _ = _matrix(sets, values)
        shares.append((np.bincount(numbers, minlength=len(values)) + 0.5) / (len(sets) + 1))
    pooled = (shares[0] * len(positive) + shares[1] * len(unlabelled)) / (len(positive) + len(unlabelled))
    spread = np.sqrt(pooled * (1 - pooled) * (1 / len(positive) + 1 / len(unlabelled)))
    distance = np.abs(shares[0] - shares[1]) / np.maximum(spread, 1e-12)
    best = np.lexsort((values, -distance))[:MAX_MODEL_WORDS]
    best = np.sort(best[distance[best] > MIN_DISTANCE])
    return values[best], shares[0][best], shares[1][best]


def train(
    positive: list[np.ndarray],
    unlabelled: list[np.ndarray],
    prior: float,
    epochs: int = 40,
    rate: float = 0.02,
    decay: float = 1e-4,
    seed: int = 7,
) -> Model:
    """Fit a linear classifier with the non-negative risk estimator (logistic loss, Adam, decoupled decay).

    It starts at half the log odds ratios of the features among positives and in the negative part of the unlabelled
    texts, with the class prior's share of the unlabelled texts scored as positive.
    Without positives or unlabelled texts, every text gets the prior as its score.
    """
    prior = min(max(prior, 1e-3), 0.9)
    bias = float(np.log(prior / (1 - prior)))
    nothing = Model(np.zeros(0, np.uint64), np.zeros(0), bias)
    if not positive or not unlabelled:
        return nothing
    words, in_positive, in_any = _telling_words(positive, unlabelled)
    if not len(words):
        return nothing
    parts = [_matrix(positive, words), _matrix(unlabelled, words)]
    sizes = [len(positive), len(unlabelled)]
    # The share among negatives follows from the shares among positives and among all; it can't be below one text's.
    negative = np.clip((in_any - prior * in_positive) / (1 - prior), 0.5 / (len(unlabelled) + 1), None)
    negative = np.minimum(negative, 0.98)
    in_positive = np.minimum(in_positive, 0.98)
    weights = np.log(in_positive * (1 - negative) / (negative * (1 - in_positive))) / 2
    # Features overlap, so the bias is set by the share of texts that should come out above it.
    totals = _forward(parts[1], np.arange(sizes[1]), np.append(weights, 0.0))[0]
    weights = np.append(weights, -float(np.quantile(totals, 1 - prior)))
    moment, energy = np.zeros(len(weights)), np.zeros(len(weights))
    random, step = np.random.default_rng(seed), 0
    batches = max(1, min(sizes) // 64)
    for _ in range(epochs):
        orders = [np.array_split(random.permutation(n), batches) for n in sizes]
        for chosen in zip(*orders):
            outs = [_forward(part, rows, weights) for part, rows in zip(parts, chosen)]
            positive_out, any_out = (np.clip(z, -60, 60) for z, _, _ in outs)
            risk = np.mean(np.logaddexp(0, any_out)) - prior * np.mean(np.logaddexp(0, positive_out))
            chance = [1 / (1 + np.exp(-z)) for z in (positive_out, any_out)]
            if risk >= 0:
                pulls = [np.full(len(chosen[0]), -prior / len(chosen[0])), chance[1] / len(chosen[1])]
            else:
                pulls = [prior * chance[0] / len(chosen[0]), -chance[1] / len(chosen[1])]
            gradient = np.zeros(len(weights))
            for (_, numbers, owner), pull in zip(outs, pulls):
                gradient[:-1] += np.bincount(numbers, pull[owner], len(words))
                gradient[-1] += pull.sum()
            step += 1
            moment += 0.1 * (gradient - moment)
            energy += 0.001 * (gradient**2 - energy)
            weights -= rate * (moment / (1 - 0.9**step)) / (np.sqrt(energy / (1 - 0.999**step)) + 1e-8)
            weights[:-1] *= 1 - decay
    return Model(words, weights[:-1], float(weights[-1]))


def centred(model: Model, positive: list[np.ndarray], unlabelled: list[np.ndarray], prior: float) -> Model:
    """Move and scale the scores so that 0.5 has the lowest estimated risk on texts that were not trained on.

    The estimate is that of training with the 0-1 loss: the error on positives, and the share of unlabelled texts above
    the cut beyond what positives explain.
    """
    if not positive or not unlabelled or not len(model.words):
        return model
    plain = np.append(model.weights, 0.0)
    high, any_ = (np.sort(_forward(_matrix(x, model.words), np.arange(len(x)), plain)[0]) for x in (positive, unlabelled))
    values = np.unique(np.concatenate([high, any_]))
    cuts = np.concatenate([(values[1:] + values[:-1]) / 2, [values[-1] + 1]])
    caught = 1 - np.searchsorted(high, cuts) / len(high)
    above = 1 - np.searchsorted(any_, cuts) / len(any_)
    risk = above - 2 * prior * caught
    best = np.flatnonzero(risk <= risk.min() + 1e-9)
    cut = float(cuts[best[len(best) // 2]])
    scale = 3 / max(1e-6, float(np.median(np.abs(high - cut))))
    return Model(model.words, model.weights * scale, -cut * scale)


def _forward(part: tuple, rows: np.ndarray, weights: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    numbers, first = part
    picked = np.concatenate([numbers[first[r] : first[r + 1]] for r in rows])
    owner = np.repeat(np.arange(len(rows)), first[rows + 1] - first[rows])
    return np.bincount(owner, weights[picked], len(rows)) + weights[-1], picked, owner


def fit(docs: DataFrame, toxic: DataFrame, text: str = "text") -> Model:
    """Train on rows of ``docs`` and their labels ``toxic`` (row, label); rows without a label have none there.

    The class prior is the share of label 1 among the labelled rows. The samples are the rows with the smallest hashes of
    their numbers, up to the bounds above; the unlabelled texts are drawn from all of ``docs``, whatever their label.
    """
    seen = toxic.groupBy("label").agg(F.count(F.lit(1)).alias("n")).where("label in (0, 1)").collect()
    counts = {r.label: r.n for r in seen}
    prior = counts.get(1, 0) / max(1, sum(counts.values()))
    order = F.xxhash64(F.col(ROW), F.lit(11))
    # Ids of the bounded sample first; the texts are then fetched by a semi-join with that small table.
    ids = docs.select(ROW)
    chosen = [
        stored(toxic.where("label = 1").select(ROW).orderBy(order).limit(MAX_POSITIVE)),
        stored(ids.orderBy(order).limit(MAX_UNLABELLED)),
    ]

    # Every fifth text of either sample is kept for the cut.
    numbers = [sorted(r[ROW] for r in rows.collect()) for rows in chosen]
    trained = [np.array([x for i, x in enumerate(own) if i % 5], np.int64) for own in numbers]
    if not all(map(len, trained)):
        return train([], [], prior)
    kept_out = [own[::5] for own in numbers]
    texts = docs.select(ROW, text_or_empty(text).cast("binary").alias("data"))
    sets = [stored(_feature_sets(texts.join(F.broadcast(rows), ROW, "left_semi"))) for rows in chosen]
    words = _candidates(sets, trained)

    def reduced(rows: DataFrame) -> dict[int, np.ndarray]:
        """The candidates among each text's features, by its number."""

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                found = [np.frombuffer(x, np.uint64) for x in batch.column(1).to_pylist()]
                data = [x[np.isin(x, words, assume_unique=True)].tobytes() for x in found]
                yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(data, pa.binary())], [ROW, "words"])

        found = rows.mapInArrow(run, f"{ROW} long, words binary").toArrow()
        return {k: np.frombuffer(x, np.uint64) for k, x in zip(found.column(ROW).to_pylist(), found.column("words").to_pylist())}

    by_row = [reduced(rows) for rows in sets]
    model = train(*([part[k] for k in own.tolist()] for part, own in zip(by_row, trained)), prior)
    return centred(model, *([part[k] for k in own] for part, own in zip(by_row, kept_out)), prior)


def _feature_sets(rows: DataFrame) -> DataFrame:
    """(row, words): all distinct features of each text (row, data), packed."""

    def extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [x.tobytes() for x in _sets(batch.column(1).to_pylist())]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(found, pa.binary())], [ROW, "words"])

    return rows.mapInArrow(extract, f"{ROW} long, words binary")


def _candidates(sets: list[DataFrame], trained: list[np.ndarray]) -> np.ndarray:
    """Every feature that :func:`_telling_words` can choose from the trained texts; the counts are summed by Spark."""
    sizes = [len(own) for own in trained]

    def counts(rows: DataFrame, own: np.ndarray, place: int) -> DataFrame:
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                inside = np.isin(batch.column(0).to_numpy(), own)
                found = [np.frombuffer(x, np.uint64) for x, good in zip(batch.column(1).to_pylist(), inside) if good]
                words, n = np.unique(np.concatenate([*found, np.zeros(0, np.uint64)]), return_counts=True)
                for lo, hi in slices(np.ones(len(words), np.int64), 1 << 18):
                    columns = [pa.array(words[lo:hi].view(np.int64)), *[pa.array(n[lo:hi] * (k == place)) for k in range(2)]]
                    yield pa.RecordBatch.from_arrays(columns, ["word", "n_0", "n_1"])

        return rows.mapInArrow(run, "word long, n_0 long, n_1 long")

    each = [counts(rows, own, k) for k, (rows, own) in enumerate(zip(sets, trained))]
    summed = each[0].unionByName(each[1]).groupBy("word").agg(F.sum("n_0").alias("n_0"), F.sum("n_1").alias("n_1"))
    shares = [(F.col(f"n_{k}") + 0.5) / (n + 1) for k, n in enumerate(sizes)]
    pooled = (shares[0] * sizes[0] + shares[1] * sizes[1]) / sum(sizes)
    spread = F.sqrt(pooled * (1 - pooled) * (1 / sizes[0] + 1 / sizes[1]))
    distance = F.abs(shares[0] - shares[1]) / F.greatest(spread, F.lit(1e-12))
    # Some room for rounding, and for ties at the end of the model's words.
    telling = summed.where(F.col("n_0") + F.col("n_1") >= 2).select("word", distance.alias("distance"))
    telling = telling.where(F.col("distance") > MIN_DISTANCE - 1e-6).orderBy(F.desc("distance"), "word").limit(2 * MAX_MODEL_WORDS)
    return np.sort(telling.select("word").toArrow().column("word").to_numpy().view(np.uint64))


def _batch_scores(model: Model, texts: pa.Array) -> np.ndarray:
    """The score of every text; null counts as the empty text, whose score is that of the bias alone."""
    raw, bounds = binary_parts(texts.fill_null("") if texts.null_count else texts)
    found = np.zeros(len(texts))
    with np.errstate(over="ignore"):
        for lo, hi in slices(np.diff(bounds), BATCH_BYTES):
            found[lo:hi] = model.scores(*word_sets(raw[bounds[lo] : bounds[hi]], bounds[lo : hi + 1] - bounds[lo]))
    return found


def score(docs: DataFrame, model: Model, text: str = "text") -> DataFrame:
    """The columns of ``docs`` but the text, with ``score`` (0 to 1) and ``predicted`` (1 from 0.5 on)."""
    kept = [c for c in docs.columns if c != text]
    rows = docs.select(*[F.col(f"`{c}`") for c in kept], F.col(text))
    shared = docs.sparkSession.sparkContext.broadcast(model)
    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema.fields[:-1])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = _batch_scores(shared.value, batch.column(len(kept)))
            columns = [*batch.columns[:-1], pa.array(found), pa.array((found >= 0.5).astype(np.int32))]
            yield pa.RecordBatch.from_arrays(columns, [*kept, "score", "predicted"])

    return rows.mapInArrow(run, f"{kinds}, score double, predicted int")


def without_toxic(docs: DataFrame, model: Model, text: str = "text") -> DataFrame:
    """``docs`` without the rows that score 0.5 or more, in one pass and with all columns."""
    place = docs.columns.index(text)
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield batch.filter(pa.array(_batch_scores(shared.value, batch.column(place)) < 0.5))

    return docs.mapInArrow(run, docs.schema)


def labelled_rows(docs: DataFrame, labels: DataFrame, doc_id: str = "doc_id") -> DataFrame:
    """(row, label) for rows of ``docs`` that have a label; ids with contradicting labels take the larger one."""
    label = labels.where(F.col("toxic").isin(0, 1) & F.col("doc_id").isNotNull())
    label = label.groupBy(F.col("doc_id").alias("_label_id")).agg(F.max("toxic").alias("label"))
    return docs.select(ROW, F.col(doc_id).alias("_id")).join(label, F.col("_id") == F.col("_label_id")).select(ROW, "label")

"""Language identification with interpolated Kneser-Ney character models.

Every language has a model of character 4-grams over lower-case letters, where anything between letters counts as one
space. The counts come from all training texts and are summed by Spark. A 4-gram is four 16-bit characters in one
64-bit integer, so its suffixes and its context are bit operations, and a model is a sorted array of such integers
with one log-probability per language. A text gets the language with the lowest cross-entropy per character.

Every 4-gram of the counts is in the model. Up to ``MAX_CELLS`` log-probabilities are built on the driver and broadcast;
larger models are tables made by Spark from all counts. Then only the most frequent 4-grams are broadcast, and a text's
others find their log-probabilities by a join.

How far to trust that is calibrated on training texts that were kept out of the counts: a logistic curve over the margin between the two
best languages gives the score, and texts below a score that kept-out texts rarely have when the prediction is right are
marked as rejected, as are texts that even the best language finds far more surprising than its own.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, replace

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from portflow.llm.common import ROW, slices, stored, with_row
from portflow.llm.packing import LETTER, code_classes

ORDER = 4
SPACE = 32
UNKNOWN = "und"
# 4-grams times languages that are broadcast; a model of more is kept in tables. It decides the plan, never the result.
MAX_CELLS = 1 << 23
# Calibration texts: at most one in so many training rows of a language, and a bound on how many.
HELD_EVERY = 40
MAX_CALIBRATION = 4_000
GROUP_CHARS = 1 << 20
FLUSH_GRAMS = 1 << 21
ACCEPTED_ACCURACY = 0.99


class Characters:
    """Turns texts into padded sequences of 16-bit characters."""

    def __init__(self) -> None:
        self.letters = code_classes() == LETTER

    def sequences(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """4-grams of all texts in a row, the text of each, and the number of letters per text.

        A 4-gram ends at every character; three spaces stand before each text.
        """
        sizes = np.fromiter(map(len, texts), np.int64, len(texts))
        codes = np.frombuffer("".join(texts).encode("utf-32-le", "surrogatepass"), "<u4").astype(np.int64)
        owner = np.repeat(np.arange(len(texts)), sizes)
        is_letter = self.letters[codes]
        n_letters = np.bincount(owner[is_letter], minlength=len(texts))
        keep = np.ones(len(codes), bool)
        if len(codes):
            keep[1:] = is_letter[1:] | is_letter[:-1]
            first = np.cumsum(sizes) - sizes
            first = first[first < len(codes)]
            # A text does not begin with a space: the padding is there already.
            keep[first] = is_letter[first]
        codes, owner = np.where(is_letter, codes & 0xFFFF, SPACE)[keep].astype(np.uint64), owner[keep]
        pad = ORDER - 1
        padded = np.full(len(codes) + pad * len(texts), SPACE, np.uint64)
        at = np.arange(len(codes)) + pad * (owner + 1)
        padded[at] = codes
        grams = padded[at]
        for k in range(1, ORDER):
            grams = grams | (padded[at - k] << np.uint64(16 * k))
        return grams, owner, n_letters


def _grouped(texts: list[str]) -> Iterator[tuple[int, int, list[str]]]:
    sizes = np.fromiter(map(len, texts), np.int64, len(texts))
    for lo, hi in slices(sizes, GROUP_CHARS):
        yield lo, hi, texts[lo:hi]


def gram_counts(rows: DataFrame) -> DataFrame:
    """(lang, gram, n) over all of ``rows`` (lang, text), summed within each task first."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        characters = Characters()
        held: dict[str, list[tuple[np.ndarray, np.ndarray]]] = {}
        size = 0

        def flush() -> Iterator[pa.RecordBatch]:
            for lang, parts in held.items():
                grams, counts = _summed(parts)
                for lo in range(0, len(grams), 1 << 18):
                    some, n = grams[lo : lo + (1 << 18)], counts[lo : lo + (1 << 18)]
                    columns = [pa.array([lang] * len(some)), pa.array(some.view(np.int64)), pa.array(n)]
                    yield pa.RecordBatch.from_arrays(columns, ["lang", "gram", "n"])
            held.clear()

        for batch in batches:
            langs = np.array(batch.column(0).to_pylist(), dtype=object)
            texts = batch.column(1).to_pylist()
            for lo, hi, some in _grouped(texts):
                grams, owner, _ = characters.sequences(some)
                for lang in sorted(set(langs[lo:hi])):
                    found = np.unique(grams[(langs[lo:hi] == lang)[owner]], return_counts=True)
                    held.setdefault(lang, []).append(found)
                    size += len(found[0])
                if size > FLUSH_GRAMS:
                    for lang, parts in held.items():
                        held[lang] = [_summed(parts)]
                    size = sum(len(p[0][0]) for p in held.values())
                    if size > FLUSH_GRAMS // 2:
                        yield from flush()
                        size = 0
        yield from flush()

    counted = rows.mapInArrow(count, "lang string, gram long, n long")
    return counted.groupBy("lang", "gram").agg(F.sum("n").alias("n"))


def _summed(parts: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    grams, group = np.unique(np.concatenate([p[0] for p in parts]), return_inverse=True)
    counts = np.bincount(group, np.concatenate([p[1] for p in parts]), len(grams))
    return grams, counts.astype(np.int64)


def _find(known: np.ndarray, wanted: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where sorted ``known`` has each value, and whether it does."""
    if not len(known):
        return np.zeros(len(wanted), np.int64), np.zeros(len(wanted), bool)
    at = np.minimum(np.searchsorted(known, wanted), len(known) - 1)
    return at, known[at] == wanted


def _low(grams: np.ndarray, order: int) -> np.ndarray:
    """The last ``order`` characters."""
    return grams & np.uint64((1 << (16 * order)) - 1) if order < ORDER else grams


def _low_column(gram: Column, order: int) -> Column:
    return gram.bitwiseAND(F.lit((1 << (16 * order)) - 1).cast("long")) if order < ORDER else gram


@dataclass(frozen=True)
class Shelf:
    """A model in tables: per order (gram, values) and (context, values), with one value per language as in ``Models``."""

    grams: tuple[DataFrame, ...]
    contexts: tuple[DataFrame, ...]
    floor: float

    def values(self, wanted: DataFrame) -> DataFrame:
        """(gram, values): the log-probabilities of each of the distinct 4-grams ``wanted``, seen or not."""
        rows, steps = wanted, []
        for order in range(ORDER, 0, -1):
            gram, context = F.col("gram"), F.col("context")
            own = self.grams[order - 1].select(gram.alias(f"g{order}"), F.col("values").alias(f"t{order}"))
            weights = self.contexts[order - 1].select(context.alias(f"h{order}"), F.col("values").alias(f"w{order}"))
            # At most 65,536 characters, and one context.
            own, weights = (F.broadcast(x) if order == 1 else x for x in (own, weights))
            low = _low_column(gram, order)
            rows = rows.join(own, low == F.col(f"g{order}"), "left")
            rows = rows.join(weights, F.shiftrightunsigned(low, 16) == F.col(f"h{order}"), "left")
            steps.append(order)
        value = None
        for order in reversed(steps):
            if value is None:
                value = F.transform(F.col("w1"), lambda w: w + F.lit(self.floor))
            else:
                backed = F.zip_with(F.col(f"w{order}"), value, lambda w, x: w + x)
                value = F.when(F.col(f"w{order}").isNull(), value).otherwise(backed)
            value = F.coalesce(F.col(f"t{order}"), value)
        return rows.select("gram", value.alias("values"))


@dataclass(frozen=True)
class Models:
    """The models of all languages. ``tables[k]`` and ``contexts[k]`` hold, for order k + 1, sorted grams and sorted
    contexts with a row of log-probabilities and of logarithms of back-off weights, one column per language."""

    languages: tuple[str, ...]
    tables: tuple[tuple[np.ndarray, np.ndarray], ...]
    contexts: tuple[tuple[np.ndarray, np.ndarray], ...]
    floor: float
    slope: float = 1.0
    offset: float = 0.0
    least_score: float = 0.0
    ceilings: tuple[float, ...] = ()
    # Of a model in tables; ``tables`` then holds the most frequent 4-grams only, as its last entry.
    shelf: Shelf | None = None

    def log_probabilities(self, grams: np.ndarray) -> np.ndarray:
        """One row per gram: its last character's log-probability after the others, for every language."""
        out = np.zeros((len(grams), len(self.languages)), np.float32)
        left = np.arange(len(grams))
        for order in range(ORDER, 0, -1):
            wanted = _low(grams[left], order)
            at, found = _find(self.tables[order - 1][0], wanted)
            out[left[found]] += self.tables[order - 1][1][at[found]]
            left, wanted = left[~found], wanted[~found]
            if not len(left):
                return out
            at, found = _find(self.contexts[order - 1][0], wanted >> np.uint64(16))
            out[left[found]] += self.contexts[order - 1][1][at[found]]
        out[left] += self.floor
        return out

    def entropies(self, grams: np.ndarray, owner: np.ndarray, n: int) -> np.ndarray:
        """Cross-entropy per character of each of ``n`` texts (rows) in each language (columns), in nats."""
        logs = self.log_probabilities(grams)
        counts = np.maximum(1, np.bincount(owner, minlength=n))
        sums = [np.bincount(owner, logs[:, k].astype(np.float64), n) for k in range(len(self.languages))]
        return -np.stack(sums, axis=1) / counts[:, None] if sums else np.zeros((n, 0))


def _continued(grams: np.ndarray, order: int) -> tuple[np.ndarray, np.ndarray]:
    """Suffixes one shorter, with the number of different characters seen before each."""
    return np.unique(_low(grams, order), return_counts=True)


def build(counts: dict[str, tuple[np.ndarray, np.ndarray]]) -> Models:
    """Interpolated Kneser-Ney models from the 4-gram counts of each language (sorted grams, counts)."""
    languages = tuple(sorted(counts))
    by_order: list[dict[str, tuple[np.ndarray, np.ndarray]]] = [{} for _ in range(ORDER)]
    for lang in languages:
        grams, n = counts[lang]
        by_order[ORDER - 1][lang] = (grams, n.astype(np.float64))
        for order in range(ORDER - 1, 0, -1):
            grams, n = _continued(grams, order)
            by_order[order - 1][lang] = (grams, n.astype(np.float64))
    letters = np.unique(np.concatenate([by_order[0][lang][0] for lang in languages] or [np.zeros(0, np.uint64)]))
    uniform = 1.0 / (len(letters) + 1)
    tables, contexts = [], []
    for order in range(1, ORDER + 1):
        seen = by_order[order - 1]
        grams = np.unique(np.concatenate([seen[lang][0] for lang in languages] or [letters]))
        histories = np.unique(grams >> np.uint64(16))
        chances = np.zeros((len(grams), len(languages)))
        weights = np.ones((len(histories), len(languages)))
        for k, lang in enumerate(languages):
            own, n = seen[lang]
            once, twice = np.sum(n == 1), np.sum(n == 2)
            discount = once / (once + 2 * twice) if once and once + 2 * twice else 0.5
            history = np.searchsorted(histories, own >> np.uint64(16))
            total = np.bincount(history, n, len(histories))
            kinds = np.bincount(history, minlength=len(histories))
            known = total > 0
            weights[known, k] = discount * kinds[known] / total[known]
            chances[np.searchsorted(grams, own), k] = np.maximum(n - discount, 0) / total[history]
        if order == 1:
            lower = np.full((len(grams), len(languages)), uniform)
        else:
            lower = np.exp(tables[-1][1][np.searchsorted(tables[-1][0], _low(grams, order - 1))].astype(np.float64))
        chances += weights[np.searchsorted(histories, grams >> np.uint64(16))] * lower
        tables.append((grams, np.log(np.maximum(chances, 1e-30)).astype(np.float32)))
        contexts.append((histories, np.log(np.maximum(weights, 1e-30)).astype(np.float32)))
    return Models(languages, tuple(tables), tuple(contexts), float(np.log(uniform)))


def shelved(counts: DataFrame, languages: tuple[str, ...]) -> Models:
    """What :func:`build` gives, from counts (lang, gram, n) of any number, by Spark alone."""
    numbers = F.array_position(F.array(*[F.lit(x) for x in languages]), F.col("lang")).cast("int") - 1
    seen = [stored(counts.select(numbers.alias("k"), "gram", F.col("n").cast("double").alias("n")))]
    for order in range(ORDER - 1, 0, -1):
        low = _low_column(F.col("gram"), order).alias("gram")
        seen.insert(0, stored(seen[0].groupBy("k", low).agg(F.count(F.lit(1)).cast("double").alias("n"))))
    uniform = 1.0 / (seen[0].select("gram").distinct().count() + 1)

    def wide(value: Column, missing: float) -> Column:
        each = [F.max(F.when(F.col("k") == k, value)) for k in range(len(languages))]
        return F.array(*[F.coalesce(x, F.lit(missing)) for x in each])

    def log(chance: Column) -> Column:
        return F.log(F.greatest(chance, F.lit(1e-30)))

    grams, contexts = [], []
    for order in range(1, ORDER + 1):
        own = seen[order - 1].withColumn("context", F.shiftrightunsigned("gram", 16))
        discounts = [0.5] * len(languages)
        for r in own.groupBy("k").agg(F.count_if(F.col("n") == 1).alias("once"), F.count_if(F.col("n") == 2).alias("twice")).collect():
            if r.once:
                discounts[r.k] = r.once / (r.once + 2 * r.twice)
        discount = F.get(F.array(*[F.lit(d) for d in discounts]), F.col("k"))
        histories = stored(own.groupBy("k", "context").agg(F.sum("n").alias("total"), F.count(F.lit(1)).alias("kinds")))
        weight = log(discount * F.col("kinds") / F.col("total"))
        contexts.append(stored(histories.groupBy("context").agg(wide(weight, 0.0).alias("values"))))
        share = F.greatest(F.col("n") - discount, F.lit(0.0)) / F.col("total")
        shares = own.join(histories, ["k", "context"]).groupBy("gram", "context")
        shares = shares.agg(wide(share, 0.0).alias("shares"), F.sum("n").alias("n"))
        rows = shares.join(contexts[-1].withColumnRenamed("values", "weights"), "context")
        if order == 1:
            rows = rows.withColumn("lower", F.transform("weights", lambda _: F.lit(float(np.log(uniform)))))
        else:
            lower = grams[-1].select(F.col("gram").alias("suffix"), F.col("values").alias("lower"))
            rows = rows.join(lower, _low_column(F.col("gram"), order - 1) == F.col("suffix"))
        backed = F.zip_with("weights", "lower", lambda w, x: F.exp(w + x))
        values = F.zip_with("shares", backed, lambda a, b: log(a + b))
        grams.append(stored(rows.select("gram", values.alias("values"), "n")))
    most = max(1, MAX_CELLS // len(languages))
    share = max(0.0, 1 - most / max(1, grams[-1].count()))
    # Strictly more frequent than that quantile: however many 4-grams occur equally often, not more are broadcast.
    least = grams[-1].agg(F.percentile_approx("n", F.lit(share), F.lit(10_000))).first()[0]
    hot = grams[-1].where(F.col("n") > F.lit(least)).select("gram", "values").toArrow()
    found = hot.column("gram").to_numpy().view(np.uint64)
    order = np.argsort(found)
    logs = hot.column("values").combine_chunks().flatten().to_numpy().reshape(len(found), len(languages))
    floor = float(np.log(uniform))
    table = (found[order], logs[order].astype(np.float32))
    shelf = Shelf(tuple(x.select("gram", "values") for x in grams), tuple(contexts), floor)
    return Models(languages, (table,), (), floor, shelf=shelf)


def _evidence(entropies: np.ndarray, n_grams: np.ndarray) -> np.ndarray:
    """A logarithm of how much better the best language explains the whole text than the second best."""
    if entropies.shape[1] < 2:
        return np.full(len(entropies), 5.0)
    ordered = np.partition(entropies, 1, axis=1)
    return np.log1p((ordered[:, 1] - ordered[:, 0]) * n_grams)


def calibrated(models: Models, entropies: np.ndarray, n_grams: np.ndarray, truth: list[str]) -> Models:
    """Fit the score, the least accepted score and the ceilings to texts that the counts have not seen."""
    best = entropies.argmin(axis=1) if len(entropies) and models.languages else np.zeros(0, np.int64)
    right = np.array([models.languages[b] == t for b, t in zip(best, truth)], bool)
    x = _evidence(entropies, n_grams) if len(best) else np.zeros(0)
    # Two texts of each outcome are assumed besides, so that few texts give a gentle curve.
    x = np.concatenate([x, [0.0, 0.0, 3.0, 3.0]])
    y = np.concatenate([right, [False, False, True, True]]).astype(float)
    slope, offset = 1.0, 0.0
    for _ in range(200):
        p = 1 / (1 + np.exp(-np.clip(slope * x + offset, -30, 30)))
        w = np.maximum(p * (1 - p), 1e-9)
        hessian = np.array([[np.sum(w * x * x) + 1e-3, np.sum(w * x)], [np.sum(w * x), np.sum(w) + 1e-3]])
        step = np.linalg.solve(hessian, [np.sum((y - p) * x) - 1e-3 * slope, np.sum(y - p) - 1e-3 * offset])
        slope, offset = slope + float(np.clip(step[0], -1, 1)), offset + float(np.clip(step[1], -1, 1))
    slope = max(slope, 0.0)
    score = 1 / (1 + np.exp(-np.clip(slope * x + offset, -30, 30)))[: len(right)]
    least = 0.0
    if len(right):
        order = np.argsort(score)
        accuracy = np.cumsum(right[order][::-1])[::-1] / np.arange(len(right), 0, -1)
        enough = np.flatnonzero(accuracy >= ACCEPTED_ACCURACY)
        least = float(score[order[enough[0]]]) if len(enough) else float(score.max())
        if accuracy[0] >= ACCEPTED_ACCURACY:
            least = 0.0
    ceilings = []
    for k in range(len(models.languages)):
        own = entropies[right & (best == k), k] if len(right) else np.zeros(0)
        ceilings.append(float(own.mean() + 6 * own.std() + 0.5) if len(own) >= 20 else float("inf"))
    return replace(models, slope=slope, offset=offset, least_score=least, ceilings=tuple(ceilings))


def measured(rows: DataFrame, models: Models) -> DataFrame:
    """Replace the last column of ``rows``, a lower-case text, by n_letters, n_grams and entropies (one per language)."""
    kept = rows.columns[:-1]
    shared = rows.sparkSession.sparkContext.broadcast(replace(models, shelf=None))
    kinds = "".join(f"`{f.name}` {f.dataType.simpleString()}, " for f in rows.schema.fields[:-1])
    names = [*kept, "n_letters", "n_grams", "entropies"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        models, characters = shared.value, Characters()
        for batch in batches:
            for lo, hi, some in _grouped(batch.column(len(kept)).to_pylist()):
                grams, owner, n_letters = characters.sequences(some)
                entropies = models.entropies(grams, owner, len(some))
                n_grams = np.bincount(owner, minlength=len(some))
                columns = [c.slice(lo, hi - lo) for c in batch.columns[:-1]]
                columns += [pa.array(n_letters), pa.array(n_grams), _lists(entropies)]
                yield pa.RecordBatch.from_arrays(columns, names)

    def partly(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        (known, logs), characters = shared.value.tables[-1], Characters()
        for batch in batches:
            for lo, hi, some in _grouped(batch.column(len(kept)).to_pylist()):
                grams, owner, n_letters = characters.sequences(some)
                n_grams = np.bincount(owner, minlength=len(some))
                at, found = _find(known, grams)
                sums = [np.bincount(owner[found], logs[at[found], k].astype(np.float64), len(some)) for k in range(logs.shape[1])]
                rest, text = grams[~found], owner[~found]
                order = np.lexsort((rest, text))
                rest, text = rest[order], text[order]
                new = np.ones(len(rest), bool)
                new[1:] = (rest[1:] != rest[:-1]) | (text[1:] != text[:-1])
                first = np.flatnonzero(new)
                ends = np.searchsorted(text[first], np.arange(len(some) + 1)).astype(np.int32)
                columns = [c.slice(lo, hi - lo) for c in batch.columns[:-1]]
                columns += [pa.array(n_letters), pa.array(n_grams), _lists(np.stack(sums, axis=1))]
                for values in (rest[first].view(np.int64), np.diff(first, append=len(rest))):
                    columns.append(pa.ListArray.from_arrays(pa.array(ends), pa.array(values, pa.int64())))
                yield pa.RecordBatch.from_arrays(columns, [*names[:-1], "sums", "grams", "times"])

    counted = f"{kinds}n_letters long, n_grams long"
    if models.shelf is None:
        return rows.mapInArrow(run, f"{counted}, entropies array<double>")
    parts = rows.mapInArrow(partly, f"{counted}, sums array<double>, grams array<long>, times array<long>")
    parts = with_row(stored(parts).withColumnRenamed(ROW, "_own_row"))
    rare = parts.select(ROW, F.explode(F.arrays_zip("grams", "times")).alias("x")).select(ROW, "x.grams", "x.times")
    rare = rare.withColumnRenamed("grams", "gram")
    values = stored(models.shelf.values(rare.select("gram").distinct()))
    each = [F.sum(F.col("times") * F.get("values", F.lit(k))) for k in range(len(models.languages))]
    more = rare.join(values, "gram").groupBy(ROW).agg(F.array(*each).alias("more"))
    total = F.when(F.col("more").isNull(), F.col("sums")).otherwise(F.zip_with("sums", "more", lambda a, b: a + b))
    entropies = F.transform(total, lambda x: -x / F.greatest("n_grams", F.lit(1)))
    found = parts.join(more, ROW, "left").withColumn("entropies", entropies).drop(ROW)
    return found.withColumnRenamed("_own_row", ROW).select(*[F.col(f"`{c}`") for c in names])


def _lists(values: np.ndarray) -> pa.Array:
    """One list per row."""
    ends = np.arange(len(values) + 1, dtype=np.int32) * values.shape[1]
    return pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(values.ravel(), pa.float64()))


def calibration_rows(rows: DataFrame) -> DataFrame:
    """The numbers of the training rows that calibrate."""
    most = {r.lang: r["count"] // HELD_EVERY for r in rows.groupBy("lang").count().collect()}
    drawn = F.pmod(F.xxhash64(F.col(ROW), F.lit(5)), F.lit(HELD_EVERY)) == 0
    chosen, taken = [], dict.fromkeys(most, 0)
    for r in rows.where(drawn).select(ROW, "lang").orderBy(F.xxhash64(ROW), ROW).limit(MAX_CALIBRATION).collect():
        if taken[r.lang] < most[r.lang]:
            taken[r.lang] += 1
            chosen.append((r[ROW],))
    return stored(rows.sparkSession.createDataFrame(chosen, f"{ROW} long"))


def fit(rows: DataFrame) -> Models:
    """Learn from ``rows`` (row, lang, text) without nulls: every language's counts, then the calibration.

    At most ``MAX_CALIBRATION`` training rows, by a hash of their numbers, calibrate and are kept out of the counts. They are
    no more than one in ``HELD_EVERY`` of a language's rows, so one with fewer rows is learned from all of them.
    """
    sample = calibration_rows(rows)
    counts = gram_counts(rows.join(F.broadcast(sample), ROW, "left_anti").select("lang", "text"))
    counts = stored(counts)
    sizes = {r.lang: r["count"] for r in counts.groupBy("lang").count().collect()}
    if sum(sizes.values()) * len(sizes) > MAX_CELLS:
        models = shelved(counts, tuple(sorted(sizes)))
    else:
        kept = counts.toArrow()
        langs = np.array(kept.column("lang").to_pylist(), dtype=object)
        grams, n = (kept.column(c).to_numpy() for c in ("gram", "n"))
        by_lang = {}
        for lang in sorted(set(langs)):
            own = langs == lang
            order = np.argsort(grams[own].view(np.uint64))
            by_lang[lang] = (grams[own].view(np.uint64)[order], n[own][order])
        models = build(by_lang)
    chosen = rows.join(F.broadcast(sample), ROW, "left_semi").select("lang", "text")
    found = measured(chosen, models).where("n_letters > 0").toArrow()
    values = np.array(found.column("entropies").to_pylist()).reshape(found.num_rows, len(models.languages))
    return calibrated(models, values, found.column("n_grams").to_numpy(), found.column("lang").to_pylist())


def predict(docs: DataFrame, models: Models, text: str = "text") -> DataFrame:
    """Add lang_pred, score, cross_entropy and rejected to the columns of ``docs``; the text column goes.

    Texts that are null or have no letter get ``und`` with score 1, no cross-entropy, and count as rejected; so does every text
    if no language was learned, with score 0.
    """
    kept = [c for c in docs.columns if c != text]
    rows = docs.select(*[F.col(f"`{c}`") for c in kept], F.coalesce(F.col(text), F.lit("")).alias(text))
    rows = rows.withColumn(text, F.lower(F.col(text)))
    shared = docs.sparkSession.sparkContext.broadcast(replace(models, tables=(), contexts=(), shelf=None))
    kinds = "".join(f"`{f.name}` {f.dataType.simpleString()}, " for f in rows.schema.fields[:-1])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        models = shared.value
        names = np.array([*models.languages, UNKNOWN], dtype=object)
        for batch in batches:
            n_letters, n_grams, lists = batch.columns[-3:]
            n_letters, n_grams = n_letters.to_numpy(), n_grams.to_numpy()
            n = batch.num_rows
            entropies = lists.flatten().to_numpy().reshape(n, len(models.languages))
            known = (n_letters > 0) & (entropies.shape[1] > 0)
            best, score, entropy = np.full(n, len(names) - 1), (n_letters == 0) * 1.0, np.full(n, np.nan)
            rejected = np.ones(n, bool)
            if known.any():
                own = entropies[known]
                best[known] = own.argmin(axis=1)
                entropy[known] = own.min(axis=1)
                x = _evidence(own, n_grams[known])
                score[known] = 1 / (1 + np.exp(-np.clip(models.slope * x + models.offset, -30, 30)))
                ceiling = np.array([*(models.ceilings or [np.inf] * len(models.languages)), np.inf])
                rejected[known] = (score[known] < models.least_score) | (entropy[known] > ceiling[best[known]])
            found = [pa.array(names[best], pa.string()), pa.array(score), pa.array(entropy, from_pandas=True)]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:-3], *found, pa.array(rejected)],
                [*kept, "lang_pred", "score", "cross_entropy", "rejected"],
            )

    schema = f"{kinds}lang_pred string, score double, cross_entropy double, rejected boolean"
    return measured(rows, models).mapInArrow(run, schema)


def training_rows(docs: DataFrame, condition, text: str = "text", lang: str = "lang") -> DataFrame:
    """(row, lang, text) of the rows that may be learned from: a text, a language, and the condition."""
    return (
        with_row(docs)
        .where(condition & F.col(lang).isNotNull() & F.col(text).isNotNull() & (F.col(lang) != UNKNOWN))
        .select(ROW, F.col(lang).alias("lang"), F.lower(F.col(text)).alias("text"))
    )

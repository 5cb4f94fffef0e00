"""The classifier against a plain one: dictionaries, one text at a time, the same risk and the same steps."""

import math
import random
import re

import numpy as np

from portflow.llm import toxicity as tx


def features(text):
    """Words in lower case, and the first 4, 6 and 8 bytes of longer ones."""
    out = set()
    for word in re.findall(rb"[A-Za-z0-9\x80-\xFF]+", text.encode()):
        word = word.lower()
        out.add((0, word))
        out |= {(n, word[:n]) for n in (4, 6, 8) if len(word) > n}
    return out


def sigmoid(z):
    return 1 / (1 + math.exp(-max(-60.0, min(60.0, z))))


def plain_train(positive, unlabelled, prior, epochs, rate=0.02, decay=1e-4, seed=7):
    sides = (positive, unlabelled)
    seen = {f: tuple(sum(f in text for text in side) for side in sides) for f in set().union(*positive, *unlabelled)}
    weights = {}
    for feature, counts in seen.items():
        if sum(counts) < 2:
            continue
        p, u = ((n + 0.5) / (len(side) + 1) for n, side in zip(counts, sides))
        pooled = (p * len(positive) + u * len(unlabelled)) / (len(positive) + len(unlabelled))
        spread = math.sqrt(pooled * (1 - pooled) * (1 / len(positive) + 1 / len(unlabelled)))
        if abs(p - u) / max(spread, 1e-12) > 4:
            negative = min(max((u - prior * p) / (1 - prior), 0.5 / (len(unlabelled) + 1)), 0.98)
            p = min(p, 0.98)
            weights[feature] = math.log(p * (1 - negative) / (negative * (1 - p))) / 2

    def total(text, bias):
        return sum(w for f, w in weights.items() if f in text) + bias

    ordered = sorted(total(text, 0.0) for text in unlabelled)
    place = (1 - prior) * (len(ordered) - 1)
    low = int(place)
    high = min(low + 1, len(ordered) - 1)
    weights["bias"] = 0.0
    bias = -(ordered[low] + (ordered[high] - ordered[low]) * (place - low))
    weights["bias"] = bias
    moment, energy = dict.fromkeys(weights, 0.0), dict.fromkeys(weights, 0.0)
    rng, step, reversed_steps = np.random.default_rng(seed), 0, 0
    batches = max(1, min(map(len, sides)) // 64)
    for _ in range(epochs):
        orders = [np.array_split(rng.permutation(len(side)), batches) for side in sides]
        for chosen in zip(*orders):
            texts = [[side[i] for i in own] for side, own in zip(sides, chosen)]
            outs = [[sum(w for f, w in weights.items() if f == "bias" or f in text) for text in side] for side in texts]
            loss = [sum(math.log1p(math.exp(-abs(z))) + max(z, 0) for z in out) / len(out) for out in outs]
            # The risk of the negative class: what positives add to the unlabelled texts' is taken off.
            if loss[1] - prior * loss[0] >= 0:
                pulls = [[-prior / len(outs[0])] * len(outs[0]), [sigmoid(z) / len(outs[1]) for z in outs[1]]]
            else:
                reversed_steps += 1
                pulls = [[prior * sigmoid(z) / len(outs[0]) for z in outs[0]], [-sigmoid(z) / len(outs[1]) for z in outs[1]]]
            step += 1
            for feature in weights:
                slope = sum(
                    pull for side, own in zip(texts, pulls) for text, pull in zip(side, own) if feature == "bias" or feature in text
                )
                moment[feature] += 0.1 * (slope - moment[feature])
                energy[feature] += 0.001 * (slope**2 - energy[feature])
                weights[feature] -= rate * (moment[feature] / (1 - 0.9**step)) / (math.sqrt(energy[feature] / (1 - 0.999**step)) + 1e-8)
                if feature != "bias":
                    weights[feature] *= 1 - decay
    scores = lambda text: sigmoid(sum(w for f, w in weights.items() if f == "bias" or f in text))
    return scores, len(weights) - 1, reversed_steps


def corpus(n, bad_share, seed):
    rng = random.Random(seed)
    out = []
    for _ in range(n):
        words = ["w%d" % rng.randrange(60) for _ in range(rng.randint(3, 25))]
        if rng.random() < bad_share:
            words += rng.choices(["Vilest", "vilely", "NASTY", "rotten!", "été-méchant", "abominablement"], k=2)
        out.append(" ".join(words))
    return out


def test_scores_equal_the_plain_estimator():
    positive, unlabelled = corpus(140, 1.0, 1), corpus(260, 0.2, 2)
    turned = 0
    for prior, epochs in ((0.2, 6), (0.6, 12)):
        scores, n_words, reversed_steps = plain_train([features(t) for t in positive], [features(t) for t in unlabelled], prior, epochs)
        turned += reversed_steps
        sets = [tx._sets([t.encode() for t in side]) for side in (positive, unlabelled)]
        model = tx.train(*sets, prior, epochs=epochs)
        assert len(model.words) == n_words > 5
        texts = [*positive[:40], *unlabelled, "", "vilest", "unknown words"]
        found = tx._sets([t.encode() for t in texts])
        first = np.concatenate(([0], np.cumsum([len(x) for x in found])))
        ours = model.scores(np.concatenate(found), first)
        assert np.allclose(ours, [scores(features(t)) for t in texts], atol=1e-6)
        assert ours.max() - ours.min() > 0.3
    # Both kinds of steps have been taken.
    assert turned > 0

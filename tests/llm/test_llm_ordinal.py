"""The classifier's features against plain Python, and its fit against the slope of the likelihood."""

import re

import numpy as np
import pyarrow as pa
import pytest

from panelmill.llm import ordinal

ODD = ["", None, " ", "  a  b ", "A!! #x x", "\n\t", "é ÉÉ 12", "Word word WORD, words", "#one TWO three 4 " * 30]


def _plain(text):
    """Feature buckets of one text, by sets and counts of words."""
    words = [w for w in re.split(r"[ \t\n\x0b\x0c\r]+", text or "") if w]
    found = set()
    for w in words:
        core = w.strip(".,;:!?\"'()[]{}*#$%&|<>-_/\\").lower()
        if core:
            found.add(ordinal._bucket("w:" + core))
        found |= {ordinal._bucket("p:" + core[:n]) for n in (4, 5) if len(core) >= n}
    shares = {
        "distinct": len(set(words)),
        "upper": sum(len(w) > 1 and w.upper() == w and w.lower() != w for w in words),
        "marked": sum(any(c in "*#$%&|<>!" for c in w) for w in words),
        "bare": sum(not w.strip(".,;:!?\"'()[]{}*#$%&|<>-_/\\") for w in words),
        "digits": sum(any(c.isdigit() for c in w) for w in words),
    }
    for name, n in shares.items():
        step = sum(n / max(1, len(words)) >= e for e in (0.02, 0.05, 0.1, 0.2, 0.35, 0.5, 0.7, 0.9))
        found.add(ordinal._bucket(f"s:{name}:{step}"))
    return found


@pytest.mark.parametrize("room", [100_000, 7, 1])
def test_features_equal_plain_sets_however_small_the_table(room):
    features = ordinal.Features(room)
    for texts in (ODD, ODD[::-1], ODD[:0], ODD[4:5]):
        doc, bucket = features.of(pa.array(texts, pa.string()))
        pairs = list(zip(doc.tolist(), bucket.tolist(), strict=True))
        assert len(pairs) == len(set(pairs))
        assert set(pairs) == {(i, b) for i, text in enumerate(texts) for b in _plain(text)}


def _loss(w, thresholds, doc, bucket, buckets, grade, decay):
    """Mean weighted negative log likelihood with the penalty, a row at a time."""
    sizes = np.bincount(grade, minlength=3)
    weight = [1 / np.sqrt(sizes[g]) for g in grade]
    total = 0.0
    for i, g in enumerate(grade):
        score = sum(w[list(buckets).index(b)] for d, b in zip(doc, bucket, strict=True) if d == i)
        above = [1.0, *[1 / (1 + np.exp(t - score)) for t in thresholds], 0.0]
        total -= weight[i] * len(grade) / sum(weight) * np.log(above[g] - above[g + 1])
    return total / len(grade) + decay / 2 * float(np.dot(w, w))


def test_fit_is_a_minimum_of_the_plain_loss():
    rng = np.random.default_rng(3)
    grade = np.array([0, 1, 2, 2, 1, 0, 2, 1, 0, 2, 0, 1])
    pairs = sorted({(i, int(b)) for i in range(12) for b in rng.choice(5, 2)} | {(i, 5 + int(g)) for i, g in enumerate(grade) if i % 3})
    doc, bucket = (np.array(x) for x in zip(*pairs, strict=True))
    model = ordinal.fit_ordinal(doc, bucket, grade, 3, rounds=6000, rate=0.02, decay=0.05)
    assert np.all(np.diff(model.thresholds) > 0)
    best = _loss(model.weights, model.thresholds, doc, bucket, model.buckets, grade, 0.05)
    for at in range(len(model.weights) + 2):
        for step in (-0.02, 0.02):
            w, t = model.weights.copy(), model.thresholds.copy()
            if at < len(w):
                w[at] += step
            else:
                t[at - len(w)] += step
            assert _loss(w, t, doc, bucket, model.buckets, grade, 0.05) > best - 1e-7


def test_several_documents_of_one_rated_key_are_fitted_once(spark):
    docs = spark.createDataFrame([(1, "b good text"), (1, "a text"), (1, None), (2, "x"), (None, "y")], "doc_id long, text string")
    labels = spark.createDataFrame([(1, 1, 0), (2, 0, 0), (None, 1, 0)], "doc_id long, quality int, toxic int")
    once = spark.createDataFrame([(1, "a text"), (2, "x")], "doc_id long, text string")
    a, b = ordinal.train(docs, labels), ordinal.train(once, labels)
    assert a.buckets.tolist() == b.buckets.tolist() and np.allclose(a.thresholds, b.thresholds)
    kept = ordinal.keep_best(docs.withColumn("kept", docs.doc_id), docs, labels, keep=0.0)
    assert kept.columns == ["doc_id", "text", "kept"] and kept.count() == 5

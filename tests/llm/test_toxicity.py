import zlib

import numpy as np
import pytest

from larder.llm import toxicity
from tests.llm.data import documents, prose, with_clashes

BAD = ["vilest", "rottening", "rottened", "rottenous"]


def corpus(n, seed=0):
    draw = np.random.default_rng(seed)
    rows, labels = [], []
    for k in range(n):
        sentences = [prose(seed * 10_000 + k * 7 + j, int(draw.integers(3, 12))) for j in range(int(draw.integers(1, 9)))]
        toxic = k % 4 == 0
        if toxic:
            place = int(draw.integers(0, len(sentences)))
            words = sentences[place].split()
            words.insert(1, BAD[k // 4 % len(BAD)])
            sentences[place] = " ".join(words)
        rows.append((k, ". ".join(sentences) + "."))
        labels.append((k, int(toxic)))
    return rows, labels


def labelled(spark, labels):
    return spark.createDataFrame(labels, "doc_id long, toxic int")


@pytest.fixture(scope="module")
def result(spark):
    rows, labels = corpus(600)
    odd = [(9001, None), (9002, ""), (9003, "..."), (None, "vilest of all"), (9004, "fine. " * 3000 + "you rottenish one")]
    known = labels + [(None, 1), (9001, None), (77_777, 1), (0, 0)]
    found = toxicity.toxic_documents(with_clashes(documents(spark, rows + odd)), labelled(spark, known)).collect()
    return rows, dict(labels), found


def test_held_out_documents_are_told_apart(result):
    rows, labels, found = result
    assert len(found) == len(rows) + 5
    held = [r for r in found if r["doc_id"] in labels and r["held_out"]]
    assert {r["doc_id"] for r in held} == {k for k in labels if zlib.crc32(str(k).encode()) % 4 == 2}
    right = sum(r["predicted"] == labels[r["doc_id"]] for r in held)
    assert right / len(held) > 0.95
    assert all(0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= 0.3) for r in found)


def test_offending_sentences_are_located(result):
    rows, labels, found = result
    texts = dict(rows)
    right = 0
    toxic = [r for r in found if labels.get(r["doc_id"]) and r["held_out"]]
    for r in toxic:
        parts = [texts[r["doc_id"]][s["start"] : s["start"] + s["length"]] for s in r["offending"]]
        right += bool(parts) and all(any(b in p for b in BAD) for p in parts)
    assert right / len(toxic) > 0.9


def test_odd_documents(result):
    found = {r["doc_id"]: r for r in result[2]}
    assert found[9001]["score"] == found[9002]["score"] == found[9003]["score"] < 0.3
    assert found[None]["predicted"] == 1 and found[None]["held_out"] is False
    assert found[9004]["predicted"] == 1


def test_held_out_labels_are_not_learned(spark):
    rows, labels = corpus(200, 3)
    turned = [(k, 1 - t if zlib.crc32(str(k).encode()) % 4 == 2 else t) for k, t in labels]
    a, b = (toxicity.train(documents(spark, rows), labelled(spark, x), rounds=1) for x in (labels, turned))
    assert (a.weights == b.weights).all() and a.bias == b.bias


def test_slope_of_the_noisy_or():
    draw = np.random.default_rng(0)
    weights = draw.normal(0, 1, toxicity.SLOTS)
    for toxic in (0, 1):
        slots = draw.integers(0, toxicity.SLOTS, 9).astype(np.int32)
        sizes = np.array([4, 3, 2], np.int32)

        def loss(w):
            starts = np.cumsum(sizes) - sizes
            p = toxicity.noisy_or(np.add.reduceat(w[slots], starts) - 1.0)
            return -np.log(p if toxic else 1 - p)

        slope = []
        for s in slots:
            up, down = weights.copy(), weights.copy()
            up[s] += 1e-5
            down[s] -= 1e-5
            slope.append((loss(up) - loss(down)) / 2e-5)
        # with huge sums of squares a step is the slope over their root
        moved, squares = weights.copy(), np.full(toxicity.SLOTS + 1, 1e12)
        toxicity._descend([(toxic, slots, sizes)], moved, -1.0, squares)
        step = (weights - moved)[slots] * 1e6 / toxicity._RATE - toxicity._DECAY * weights[slots]
        assert np.allclose(step, slope, atol=1e-4)


def test_without_toxic_keeps_columns(spark):
    rows, labels = corpus(400, 5)
    df = with_clashes(documents(spark, rows + [(None, None)]))
    model = toxicity.train(df, labelled(spark, labels))
    kept = toxicity.without_toxic(df, model)
    assert kept.columns == df.columns
    ids = {r["doc_id"] for r in kept.collect()}
    assert None in ids and sum(labels[i][1] for i in ids if i is not None) <= 8 and len(ids) > 290


def test_no_rows_and_no_labels(spark):
    none = labelled(spark, [])
    assert toxicity.toxic_documents(documents(spark, []), none).count() == 0
    assert toxicity.toxic_documents(documents(spark, [(1, "a b")]), none).first()["predicted"] == 0

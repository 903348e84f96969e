import random
import zlib

import numpy as np

from starmart.llm import quality as Q

DOCS = "doc_id long, text string, lang string, source string, n_chars long, score double, predicted string"


def rows(n, seed):
    rng = random.Random(seed)
    out = []
    for i in range(n):
        words = ["".join(rng.choice(["lo", "re", "ip", "sum", "do", "lor"]) for _ in range(rng.randint(1, 4)))
                 for _ in range(rng.randint(20, 120))]
        good = int(rng.random() < 0.8)
        if not good:
            kind = rng.randrange(3)
            words = ([w.upper() + "!!" for w in words] if kind == 0 else [words[0]] * len(words) if kind == 1
                     else [w + rng.choice(["###", "&&&", "$$$"]) for w in words])
        out.append((i, " ".join(words), rng.choice(["en", "de"]), f"src{rng.randrange(4)}", good))
    return out


def frames(spark, data):
    docs = spark.createDataFrame([(i, t, g, s, len(t), 1.0, "x") for i, t, g, s, _ in data], DOCS)
    return docs, spark.createDataFrame([(i, y, "x") for i, *_, y in data if i % 3], "doc_id long, quality int, text string")


def test_held_out_accuracy_and_odd_rows(spark):
    data = rows(1800, 1)
    docs, labels = frames(spark, data)
    odd = spark.createDataFrame([(9000, None, None, None, None, 0.0, ""), (9001, "", "en", "src1", 0, 0.0, ""),
                                 (None, data[0][1], "en", "src0", 5, 0.0, ""), (9002, "LOREM!! " * 30000, "en", "new", -3, 0.0, ""),
                                 (4, data[4][1], data[4][2], data[4][3], len(data[4][1]), 0.0, "")], DOCS)
    labels = labels.union(spark.createDataFrame([(None, 1, ""), (7, None, ""), (8, 5, "")], labels.schema))
    got = Q.score_quality(docs.union(odd), labels).collect()
    assert len(got) == 1805
    truth = {i: y for i, *_, y in data}
    held = [r for r in got if r.held_out and r.doc_id in truth]
    assert sum(r.predicted == truth[r.doc_id] for r in held) / len(held) > 0.97
    assert all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.5) for r in got)
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) for r in got if r.doc_id is not None)
    by_id = {r.doc_id: r for r in got}
    assert by_id[9002].predicted == 0 and by_id[None].held_out is None
    assert len({r.score for r in got if r.doc_id == 4}) == 1


def test_held_out_labels_are_not_used(spark):
    docs, labels = frames(spark, rows(400, 2))
    turned = [(r.doc_id, 1 - r.quality if zlib.crc32(str(r.doc_id).encode()) % 5 == 0 else r.quality, "x") for r in labels.collect()]
    one, two = Q.fit(docs, labels), Q.fit(docs, spark.createDataFrame(turned, labels.schema))
    assert one.views == two.views and one.mix == two.mix


def test_without_labels_or_rows(spark):
    docs, labels = frames(spark, rows(60, 3))
    assert {r.score for r in Q.score_quality(docs, labels.limit(0)).collect()} == {0.5}
    assert {r.score for r in Q.score_quality(docs, labels.where("quality = 1")).collect()} == {0.5}
    assert Q.score_quality(docs.limit(0), labels).count() == 0


def test_views_teach_each_other():
    """With few labels, the exchanged pseudo-labels make a view better than its labels alone."""
    rng = np.random.default_rng(1)

    def draw(n):
        y = rng.integers(0, 2, n).astype(float)
        strong = y[:, None] * 4 - 2 + rng.normal(size=(n, 2))
        weak = (y[:, None] * 2 - 1) * 0.35 + rng.normal(size=(n, 30))
        return [strong, weak], y

    (labelled, y), (pool, _), (test, test_y) = draw(24), draw(3000), draw(4000)
    alone = Q.logistic(labelled[1], y)
    taught = Q.co_train(labelled, y, pool)[1]

    def accuracy(w):
        return ((Q.predict(w, test[1]) >= 0) == test_y).mean()

    assert accuracy(taught) > accuracy(alone) + 0.02


def test_calibrated_scores_match_frequencies():
    rng = np.random.default_rng(2)
    y = (rng.random(4000) < 0.8).astype(float)
    views = [y[:, None] * 1.5 + rng.normal(size=(4000, 1)), y[:, None] + rng.normal(size=(4000, 1))]
    half = [[v[:2000] for v in views], [v[2000:] for v in views]]
    model = Q.train(half[0], y[:2000], half[1], y[2000:], [v[:0] for v in views], 0.8)
    p = model.scores(views)[:, 0]
    for low in (0.2, 0.5, 0.8):
        near = abs(p - low) < 0.15
        assert abs(y[near].mean() - p[near].mean()) < 0.1

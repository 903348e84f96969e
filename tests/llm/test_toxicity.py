import random
import zlib

import numpy as np

from starmart.llm import toxicity as T

BAD = ["vermin", "cretin", "dunce", "lout", "swine"]


def rows(n, seed, share=0.2):
    rng = random.Random(seed)
    words = [a + b + c for a in "ba ti ro ne".split() for b in "lu ma si".split() for c in "to re n".split()]
    out = []
    for i in range(n):
        toxic = int(rng.random() < share)
        text = [rng.choice(words) for _ in range(rng.randint(5, 120))]
        for _ in range(2 + len(text) // 40 if toxic else 0):
            text.insert(rng.randrange(len(text)), rng.choice(BAD) + rng.choice(["", "s", ""]))
        out.append((i, " ".join(text).capitalize() + ".", toxic))
    return out


def frames(spark, data):
    docs = spark.createDataFrame([(i, t, 1, "x") for i, t, _ in data], "doc_id long, text string, toxic int, score string")
    labels = spark.createDataFrame([(i, x, 1.0) for i, _, x in data if i is not None], "doc_id long, toxic int, text double")
    return docs, labels


def test_held_out_accuracy_and_odd_rows(spark):
    data = rows(1500, 1)
    docs, labels = frames(spark, data)
    odd = spark.createDataFrame([(9000, None, 0, ""), (9001, "", 0, ""), (None, "vermin swine dunce", 0, ""),
                                 (9002, "9 !! 漢字", 0, ""), (9003, "calm " * 20000 + " vermin cretin lout", 0, ""),
                                 (3, data[3][1], 0, ""), (3, data[3][1], 0, "")], docs.schema)
    labels = labels.union(spark.createDataFrame([(None, 1, 0.0), (5, None, 0.0), (6, 7, 0.0), (data[3][0], data[3][2], 0.0)], labels.schema))
    got = T.score_toxicity(docs.union(odd), labels).collect()
    truth = {i: x for i, _, x in data}
    held = [r for r in got if r.doc_id in truth and r.held_out]
    assert sum(r.predicted == truth[r.doc_id] for r in held) / len(held) > 0.97
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) for r in got if r.doc_id is not None)
    assert all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.5) for r in got)
    by_id = {r.doc_id: r for r in got}
    assert by_id[9000].predicted == by_id[9001].predicted == by_id[9002].predicted == 0
    assert by_id[9000].score == by_id[9001].score
    assert by_id[None].predicted == 1 and by_id[None].held_out is None
    assert len({r.score for r in got if r.doc_id == 3}) == 1


def test_scores_of_a_row_depend_on_its_text_alone(spark):
    docs, labels = frames(spark, rows(400, 2))
    model = T.fit(docs, labels)
    for r in docs.limit(30).collect():
        assert model.score(r.text) == model.score(r.text)
    got = {r.doc_id: r.score for r in T.score_toxicity(docs.repartition(5), labels).collect()}
    for r in docs.collect():
        assert abs(got[r.doc_id] - model.score(r.text)) < 1e-12


def test_held_out_labels_are_not_used(spark):
    data = rows(400, 3)
    docs, labels = frames(spark, data)
    turned = spark.createDataFrame([(i, 1 - x if zlib.crc32(str(i).encode()) % 5 == 0 else x, 1.0) for i, _, x in data], labels.schema)
    one, two = T.fit(docs, labels), T.fit(docs, turned)
    assert (one.toxic, one.ordinary, one.weights) == (two.toxic, two.ordinary, two.weights)


def test_without_labels_or_rows(spark):
    docs, labels = frames(spark, rows(50, 4))
    assert {r.predicted for r in T.score_toxicity(docs, labels.limit(0)).collect()} == {0}
    assert {r.predicted for r in T.score_toxicity(docs, labels.where("toxic = 0")).collect()} == {0}
    assert T.score_toxicity(docs.limit(0), labels).count() == 0
    assert T.score_toxicity(docs, labels.where("toxic = 1")).count() == 50


def test_copies_do_not_make_a_word_toxic():
    texts = ["alpha beta gamma delta"] * 50
    counts, total = T.code_contexts(texts)
    assert set(counts.values()) == {1} and total == 4


def test_threshold_of_best_f1():
    x = np.array([[0.0], [0.1], [0.2], [0.9], [1.0], [1.1]])
    w = T.calibrate(x, np.array([0, 0, 0, 1, 1, 1]))
    z = w[0] + x[:, 0] * w[1]
    assert (z[:3] < 0).all() and (z[3:] >= 0).all()

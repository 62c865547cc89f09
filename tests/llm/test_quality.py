from __future__ import annotations

import numpy as np
from edge import CLASHING, edge_docs, edge_rows, no_docs

from tierstone.llm.quality import OrdinalModel, TextFeatures, fit_ordinal, score, train

BAD = ["vile", "nasty", "horrid"]


def corpus(seed, n):
    rng = np.random.default_rng(seed)
    common = [f"word{k}" for k in range(200)]
    rows, labels = [], []
    for k in range(n):
        grade = int(rng.integers(0, 3))
        own = list(rng.choice(common, int(rng.integers(20, 120))))
        if grade == 0:
            own[3:3] = list(rng.choice(BAD, 3))
        if grade == 1:
            own = [w + "$$$" for w in own]
        rows.append((k, " ".join(own)))
        labels.append((k, int(grade == 2), int(grade == 0)))
    return rows, labels


def labels_frame(spark, rows):
    return spark.createDataFrame(rows, "doc_id long, quality int, toxic int")


def test_held_out_accuracy(spark):
    rows, labels = corpus(1, 600)
    model = train(edge_docs(spark, rows), labels_frame(spark, labels))
    held_rows, held_labels = corpus(2, 200)
    found = score(edge_docs(spark, held_rows), model, "rated")
    got = {r["doc_id"]: r["rated"] for r in found.collect()}
    good = {i for i, q, _ in held_labels if q}
    assert np.mean([got[i]["accepted"] == (i in good) for i in got]) > 0.95
    mean = lambda ids: np.mean([got[i]["expected_grade"] for i in ids])
    toxic = {i for i, _, t in held_labels if t}
    assert mean(toxic) < mean(set(got) - good - toxic) < mean(good)


def test_tails_are_ordered_and_sum_to_the_expected_grade():
    model = OrdinalModel(np.zeros(4, np.float32), np.array([-1.0, 0.5]))
    tails = model.tails(np.array([-3.0, 0.0, 9.0]))
    assert (tails[:, 0] > tails[:, 1]).all() and (np.diff(tails[:, 0]) > 0).all()


def test_thresholds_ascend():
    rng = np.random.default_rng(0)
    rows = [(np.array([g]), np.array([1.0])) for g in rng.integers(0, 3, 300)]
    grades = np.array([int(i[0]) for i, _ in rows])
    model = fit_ordinal(rows, grades, 8)
    assert (np.diff(model.thresholds) > 0).all()
    assert model.weights[0] < model.weights[1] < model.weights[2]


def test_edges(spark):
    rows, labels = corpus(3, 300)
    odd = [(None, 1, 0), (1, None, 0), (2, 1, None), (99999, 1, 0), (3, 7, 0)]
    model = train(edge_docs(spark, rows), labels_frame(spark, labels + odd))
    found = score(edge_docs(spark), model, "rated")
    assert found.columns == ["doc_id", "text", *CLASHING, "rated"]
    assert found.count() == len(edge_rows())
    null = found.where("text IS NULL").select("rated.score").collect()
    assert {r[0] for r in null} == {0.0}
    assert score(no_docs(spark), model, "rated").count() == 0


def test_without_labels_everything_is_accepted(spark):
    model = train(edge_docs(spark), labels_frame(spark, []))
    assert score(edge_docs(spark), model, "rated").where("NOT rated.accepted").count() == 0


def test_features_ignore_white_space_and_read_whole_texts():
    features = TextFeatures()
    a, b = features("One  two\n two three"), features(" One two two\tthree ")
    assert (a[0] == b[0]).all() and np.allclose(a[1], b[1])
    long = "word " * 300_000
    assert not np.array_equal(features(long)[0], features(long + "vile")[0])

"""The quality classifier against dictionaries in plain Python."""

import zlib

import brute
import numpy as np
import pytest

from churnloom.llm import quality_classifier as C


def test_scores_as_by_hand(spark):
    good = [f"the plain sentence {i} reads well and ends here" for i in range(30)]
    bad = [f"$$$ {i} ### buy buy buy now {i * 7} %%%" for i in range(18)]
    rows = [(i, t, y) for i, (t, y) in enumerate([(t, 1) for t in good] + [(t, 0) for t in bad])]
    docs = spark.createDataFrame(
        [(i, t) for i, t, _ in rows] + [(900, ""), (901, None), (902, "ab"), (903, "größe 日本 🙂 x x x")], "doc_id bigint, text string"
    )
    labels = spark.createDataFrame([(i, y) for i, _, y in rows], "doc_id bigint, quality int")
    known = [(t, y) for i, t, y in rows if zlib.crc32(str(i).encode()) % 3 != 1]
    ratio, weights = brute.classifier_weights(known)
    rows_of = [C.features(t) for t, _ in known]
    marks = np.array([y for _, y in known])
    fitted = C.descend(rows_of, marks, C.ratios(rows_of, marks))
    assert np.allclose(fitted, [weights.get(f, 0.0) for f in range(C.WIDTH)], atol=1e-9)
    # Which weights are zero to the last digit depends on the order of adding.
    used = {f: float(fitted[f]) for f in np.flatnonzero(fitted).tolist()}
    got = {r.doc_id: r for r in C.scores(docs, labels).collect()}
    texts = {r.doc_id: r.text or "" for r in docs.collect()}
    assert len(got) == len(texts)
    for i, text in texts.items():
        assert C.features(text).tolist() == brute.indicators(text)
        assert got[i].score == pytest.approx(brute.classifier_score(text, ratio, used), abs=1e-9)
        assert got[i].predicted == (got[i].score >= 0.5)
        assert got[i].held_out == (zlib.crc32(str(i).encode()) % 3 == 1)

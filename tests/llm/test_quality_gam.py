import random
import zlib

import numpy as np

from retentio.llm import quality_gam as q


def test_pairs_are_learned():
    rng = np.random.default_rng(0)
    x = np.zeros((2000, len(q.FEATURES)))
    x[:, :2] = rng.random((2000, 2))
    y = ((x[:, 0] > 0.5) ^ (x[:, 1] > 0.5)).astype(float)  # no single feature tells anything
    model = q.fit(x, y)
    assert ((model.score(x) > 0.5) == (y > 0)).mean() > 0.9 and (1, 0) in model.pairs


def test_held_out_documents(spark, nothing):
    rng = random.Random(2)
    good = lambda: " ".join("".join(rng.choices("abcdefgh", k=5)) for _ in range(80)) + "."
    bad = lambda: " ".join(rng.choice(("WIN!!", "cash###", "now***")) for _ in range(80))
    labels = [(k, int(rng.random() < 0.6), 0) for k in range(400)]
    rows = [(k, good() if y else bad(), "en", "a") for k, y, _ in labels] + [(900, None, "en", "a"), (None, "", None, None), (901, "word " * 30000, "en", "a")]
    from .conftest import frame

    docs = frame(spark, rows)
    truth = spark.createDataFrame([*labels, (3, None, 0), (None, 1, 0)], "doc_id long, quality int, toxic int")
    model = q.train(docs.drop("label"), truth)
    got = {r.doc_id: r for r in q.classify(docs, model).collect()}
    assert len(got) == len(rows) and all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.3) for r in got.values())
    assert all(r.held_out == (i is not None and zlib.crc32(str(i).encode()) % 5 == 0) for i, r in got.items())
    held = [(y, got[k].predicted) for k, y, _ in labels if got[k].held_out]
    assert np.mean([a == b for a, b in held]) > 0.95
    blank = q.train(docs, truth.limit(0))
    assert {round(r.score, 6) for r in q.classify(docs, blank).collect()} == {0.5}
    assert q.classify(nothing, model).collect() == []

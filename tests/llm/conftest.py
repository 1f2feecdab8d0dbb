import random

import pytest

#: Extra columns whose names the operators use inside.
EXTRA = ", row string, key int, size int, token string, set string, component string, label string, _row int, n int"


def frame(spark, rows):
    """documents (doc_id, text, lang, source) with clashing extra columns."""
    return spark.createDataFrame([(*r, "x", 1, 2, "t", "s", "c", "l", 3, 4) for r in rows],
                                 "doc_id long, text string, lang string, source string" + EXTRA)


@pytest.fixture(scope="session")
def edge_rows():
    """Nulls, empty and long texts, ties, repeated rows, near copies."""
    rng = random.Random(3)
    words = [f"w{k}" for k in range(300)]
    base = [[rng.choice(words) for _ in range(n)] for n in (3, 5, 9, 60, 150, 400)]
    rows = [(None, None, None, None), (None, "no id here", "en", None), (900, "", "en", "a"), (901, " \n\t", None, "a"), (902, "\x85a b\xa0c", "en", "b"),
            (903, "é" * 700 + " " + "漢字 🙂 " * 50, "fr", "b"), (904, "long " * 20000, "en", "c"), (905, "same id", "en", "c"), (905, "SAME id", "en", "c")]
    rows += [(905, "same id", "en", "c")] * 2
    for k in range(120):
        w = list(rng.choice(base))
        for _ in range(rng.choice((0, 0, 1, 2, 5))):
            w[rng.randrange(len(w))] = rng.choice(words)
        rows.append((k, " ".join(w[:5]) + "\n" + " ".join(w[5:]), rng.choice(("en", "fr")), rng.choice("abcd")))
    return rows


@pytest.fixture(scope="session")
def edges(spark, edge_rows):
    return frame(spark, edge_rows).cache()


@pytest.fixture(scope="session")
def nothing(spark):
    return frame(spark, []).cache()

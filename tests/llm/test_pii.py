import hashlib
import random
import re

import numpy as np

from retentio.llm import pii_rules as r
from retentio.llm import pii_tagger as t

RULES = [(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", lambda s: True),
         (r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", lambda s: all(int(x) <= 255 for x in s.split("."))),
         (r"[0-9]([\x20-]?[0-9])+", r.is_card), (r"\+[0-9][\x20().0-9-]+[0-9]", r.is_phone)]


def plain(text):
    return [(k, *m.span()) for k, (rule, ok) in enumerate(RULES) for m in re.finditer(rule, text) if ok(m.group())]


def test_rules_equal_the_patterns():
    rng = random.Random(2)
    for _ in range(5000):
        text = "".join(rng.choice("a@.1234567890+-() %_é") for _ in range(rng.randrange(40)))
        assert r.base_spans(text) == plain(text)
    assert r.luhn("4539578763621486") and not r.luhn("4539578763621487")
    assert r.base_spans("a" * 100_000 + "1" * 100_000 + "@") == []


def test_gradient():
    tagger, rng = t.Tagger(hidden=3), np.random.default_rng(0)
    chars, tags = rng.integers(0, t.CLASSES, (2, 5)), rng.integers(0, t.TAGS, (2, 5))

    def loss():
        e, w = tagger.emissions(chars), tagger.w["t"]
        s, rows = e[0], np.arange(2)
        for k in range(1, 5):
            s = np.log(np.exp(s[:, :, None] + w).sum(1)) + e[k]
        gold = sum(e[k][rows, tags[:, k]] for k in range(5)) + sum(w[tags[:, k - 1], tags[:, k]] for k in range(1, 5))
        return (np.log(np.exp(s).sum(1)) - gold).mean()

    g = tagger.gradient(chars, tags)
    for name, w in tagger.w.items():
        for _ in range(5):
            at = tuple(rng.integers(0, n) for n in w.shape)
            old = w[at]
            w[at] = old + 1e-5
            up = loss()
            w[at] = old - 1e-5
            down = loss()
            w[at] = old
            assert abs((up - down) / 2e-5 - g[name][at]) < 1e-5


def test_trained_tagger_adds_touching_values(spark, edge_rows, nothing):
    from .conftest import frame

    rng = random.Random(7)
    word = lambda: "".join(rng.choices("abcdefg", k=6))

    def card():
        d = "4" + "".join(rng.choices("0123456789", k=14))
        return next(d + c for c in "0123456789" if r.luhn(d + c))

    make = {0: lambda: f"{word()}.{rng.randrange(99)}@mail.{word()}.com", 1: lambda: ".".join(str(rng.randrange(256)) for _ in range(4)), 2: card,
            3: lambda: f"+1 ({rng.randrange(200, 999)}) 555-{rng.randrange(1000, 9999)}"}
    rows = [(k, " ".join([word() for _ in range(9)] + [make[k % 4]()] + [word() for _ in range(9)]), "en", "a") for k in range(400)]
    rows += [(500 + k, f"{word()} version {k}.0 of {word()}", "en", "a") for k in range(100)]
    docs = frame(spark, rows + edge_rows)
    tagger = t.train(t.training_windows(docs))
    found, total = 0, 0
    for _, text, *_ in rows[:400]:
        base = set(r.base_spans(text))
        total += len(base)
        found += len(base & set(t.tag_texts(tagger, [text])[0]))
    assert found > 0.8 * total
    touching = [f"{word()} {word()} {make[3]()} {make[2]()} {word()}" for _ in range(20)]  # the rules see one long number
    assert not any(r.base_spans(x) for x in touching)
    got = t.find_pii(frame(spark, [(k, x, "en", "a") for k, x in enumerate(touching)] + edge_rows), tagger).collect()
    assert sum(bool(g.spans) for g in got if g.doc_id is not None and g.doc_id < 20) >= 10
    assert all(g.base_sha256 == hashlib.sha256(b"").hexdigest() for g in got) and len(got) == 20 + len(edge_rows)
    assert t.find_pii(nothing, tagger).collect() == [] and t.train([("abc", [])]) is None


def test_very_long_runs_of_zeros_are_no_crash():
    assert r.base_spans("0" * 5000 + ".1.1.1") == [(1, 0, 5006)]
    assert r.base_spans("1" * 5000 + ".1.1.1") == [] and r.is_ip("000.0.00.255") and not r.is_ip("0.0.0.256")

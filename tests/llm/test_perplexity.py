import math
import random
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from retentio.llm import perplexity as p


def test_base_rules():
    assert p.base_rules(None) == (0, 0, 0, 0, 0)
    assert p.base_rules("a b c\na b c\n\n \nx # <é>") == (9, 11, 3, 1, 6)
    assert p.base_rules("x\x85y z\xa0") == (2, 5, 0, 0, 0)


def model_by_hand(codes):
    """Interpolated modified Kneser-Ney probabilities of the trigrams, from dictionaries."""
    tri = Counter(codes)
    bi = Counter(c & 0xFFFF for c in tri)
    uni = Counter(c & 0xFF for c in bi)

    def level(counts, lower):
        n = [sum(1 for v in counts.values() if v == k) for k in range(5)]
        y = n[1] / (n[1] + 2 * n[2]) if n[1] + 2 * n[2] else 0
        d = [0] + [max(0.0, k - (k + 1) * y * n[k + 1] / n[k]) if n[k] else float(k) for k in (1, 2, 3)]
        total, held = Counter(), Counter()
        for g, c in counts.items():
            total[g >> 8] += c
            held[g >> 8] += min(d[min(c, 3)], c)
        return {g: (c - min(d[min(c, 3)], c)) / total[g >> 8] + held[g >> 8] / total[g >> 8] * lower(g) for g, c in counts.items()}

    p1 = level(uni, lambda g: 1 / 256)
    p2 = level(bi, lambda g: p1[g & 0xFF])
    return level(tri, lambda g: p2[g & 0xFFFF])


def test_model_and_bands(spark, edges, edge_rows):
    model = p.language_model(edges)
    for lang in ("en", "fr", None):
        texts = [t for _, t, k, _ in edge_rows if k == lang and t]
        if not texts:
            continue
        want = model_by_hand([int(c) for t in texts for c in p.trigrams(t)])
        table = p.Model([lang], model.where(model.lang.eqNullSafe(lang)).toArrow())
        codes = np.array(sorted(want))
        assert np.exp(table.log_probabilities(lang, codes)) == pytest.approx([want[c] for c in codes], rel=1e-4)
        unseen = table.log_probabilities(lang, p.trigrams("\x01\x01\x01"))
        assert np.isfinite(unseen).all() and (unseen < 0).all()
    for block in (p.BLOCK, 1):  # 1: a round per language
        rows = p.perplexity_rules(edges, block=block).collect()
        assert len(rows) == len(edge_rows)
        base = Counter((str(r.doc_id), r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) for r in rows)
        assert base == Counter((str(i), *p.base_rules(t)) for i, t, *_ in edge_rows)
        for r in rows:
            assert r.base_failed == (r.n_words < 50 or 100 * r.n_repeat_words > 50 * r.n_words)
            assert not (r.base_failed and r.kept) and (r.perplexity is None or r.perplexity >= 1)


def test_bands_reject_what_is_unlike_the_language(spark):
    rng = random.Random(1)
    words = ["".join(rng.choice(("an", "the", "re", "on", "ing", "st")) for _ in range(rng.randrange(1, 4))) for _ in range(200)]
    rows = [(k, " ".join(rng.choices(words, k=120)), "en") for k in range(150)]
    rows.append((500, " ".join("".join(rng.choices("qxzjkvw%#", k=6)) for _ in range(120)), "en"))
    kept = {r.doc_id: r.kept for r in p.perplexity_rules(spark.createDataFrame(rows, "doc_id long, text string, lang string")).collect()}
    assert not kept.pop(500) and all(kept.values())


def prose(rng, words, n):
    return " ".join(rng.choices(words, k=n))


def test_copies_of_one_text_do_not_set_the_band(spark):
    rng = random.Random(2)
    words = ["".join(rng.choice(("an", "the", "re", "on", "ing", "st")) for _ in range(rng.randrange(1, 4))) for _ in range(200)]
    rows = [(k, prose(rng, words, 120), "en") for k in range(120)]
    rows += [(1000 + k, rows[0][1], "en") for k in range(200)]  # copies of one text: above half of the language
    kept = {r.doc_id: r.kept for r in p.perplexity_rules(spark.createDataFrame(rows, "doc_id long, text string, lang string")).collect()}
    assert len(kept) == 320 and all(kept.values())


def test_a_language_of_few_texts_is_judged_too(spark):
    rng = random.Random(4)
    words = ["".join(rng.choice(("an", "the", "re", "on", "ing", "st")) for _ in range(rng.randrange(1, 4))) for _ in range(200)]
    rows = [(k, prose(rng, words, 120), "en") for k in range(60)] + [(100 + k, prose(rng, words, 120), None) for k in range(12)]
    rows.append((500, " ".join("".join(rng.choices("qxzjkvw%#", k=6)) for _ in range(120)), None))
    got = p.perplexity_rules(spark.createDataFrame(rows, "doc_id long, text string, lang string")).collect()
    assert {r.doc_id for r in got if not r.kept} == {500} and all(r.band_low < r.band_high for r in got)


def test_word_model_has_every_word(spark):
    texts = [("a b a \u6f22\u5b57", "en"), ("b c \u00e9\u00e8", "en"), ("a", None), ("c d e f g", "en")]
    df = spark.createDataFrame([(k, *r) for k, r in enumerate(texts)] , "key long, text string, lang string")
    counts = Counter((lang, w) for t, lang in texts for w in p.words_of(t))
    assert len(counts) == 11 and ("en", "\u5b57") in counts
    model = p.word_model(df)
    assert {(r.lang, r.word): r.n for r in model.collect()} == {(lang, p.WordKeys(lang)[w]): n for (lang, w), n in counts.items()}
    want = {}
    for k, (t, lang) in enumerate(texts):
        own = Counter(p.words_of(t))
        rest = sum(n for (x, _), n in counts.items() if x == lang) - sum(own.values()) + 0.5 * sum(x == lang for x, _ in counts)
        want[k] = -sum(n * math.log((counts[lang, w] - n + 0.5) / rest) for w, n in own.items()) / sum(own.values())
    heads = p.HEAD
    try:
        for p.HEAD in (heads, 1, 7):  # all by the broadcast, all or most by the join
            assert {r.key: r.word_level for r in p.word_levels(df, model).collect()} == pytest.approx(want)
    finally:
        p.HEAD = heads


def test_short_junk_is_rejected(spark):
    rng = random.Random(5)
    words = ["".join(rng.choice(("an", "the", "re", "on", "ing", "st", "ou", "le")) for _ in range(rng.randrange(1, 4))) for _ in range(300)]
    rows = [(k, prose(rng, words[:20] * 15 + words, 70), "en") for k in range(150)]
    for k in range(30):  # enough of each kind that the character model knows the marks
        rows.append((500 + k, " | ".join(rng.choices(words[20:], k=70)), "en"))
        rows.append((600 + k, " ".join(w + rng.choice(("###", "$$$")) for w in rng.choices(words, k=70)), "en"))
    kept = {r.doc_id for r in p.perplexity_rules(spark.createDataFrame(rows, "doc_id long, text string, lang string")).collect() if r.kept}
    assert len([k for k in kept if k < 500]) >= 148 and len([k for k in kept if k >= 500]) <= 6


def test_empty(nothing):
    assert p.perplexity_rules(nothing).collect() == []
    assert math.isfinite(p.WIDTH)


def test_repeated_words_and_marks_by_hand():
    rng = random.Random(6)
    for _ in range(200):
        words = rng.choices(("a", "b", "c#", "é", "$|"), k=rng.randrange(0, 30))
        text = "".join(w + rng.choice((" ", "\n", "\t", "\v\f", "\r ")) for w in words)
        grams = Counter(zip(words, words[1:], words[2:]))
        again = {k + j for k, g in enumerate(zip(words, words[1:], words[2:])) if grams[g] > 1 for j in range(3)}
        got = p.base_rules(text)
        assert got[:3] + got[4:] == (len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text), len(again))


def test_distinct_trigrams_of_one_text_after_another():
    model = object.__new__(p.Model)
    model.slots = np.empty(0, dtype=np.int32)
    for text in ("abcabcabc", "x", "bcabca漢字", "abcabcabc" * 50):
        codes = p.trigrams(text)
        grams, which = model.distinct(codes)
        assert (grams[which] == codes).all() and sorted(grams) == sorted(set(codes.tolist()))
        assert len(model.slots) <= 20 ** 3  # not a place for every trigram of 256 classes


def test_a_task_takes_texts_out_in_pieces():
    batch = pa.RecordBatch.from_arrays([pa.array(range(1201)), pa.array(["a b"] * 1201), pa.array(["en"] * 1201)], names=["key", "text", "lang"])
    pieces = list(p._pieces([batch, batch.slice(0, 0)]))
    assert [b.num_rows for b in pieces] == [500, 500, 201] and pa.Table.from_batches(pieces).equals(pa.Table.from_batches([batch]))
    found = list(p._count_words(iter([batch])))
    assert sum(b.num_rows for b in found) == 2 and found[0].column("n").to_pylist() == [1201, 1201]


def test_word_keys_take_no_memory_and_tell_languages_apart():
    keys = p.WordKeys("en")
    words = [f"w{k}" for k in range(1000)] + ["é", "\U0001f600"]
    assert len(set(keys.of(words).tolist())) == len(words) and keys["é"] == keys.of(["é"])[0]
    assert len({p.WordKeys(lang)["a"] for lang in ("en", "fr", "", None)}) == 4

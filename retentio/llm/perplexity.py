"""Quality rules: n-gram perplexity under a modified Kneser-Ney model per language.

1. Tasks count the character trigrams of all texts by language; Spark sums them
   and derives the model: discounts from counts of counts, continuation counts
   for the lower orders, probabilities and back-off weights.
2. The model is kept as sorted arrays of 64-bit n-gram hashes beside arrays of
   log probabilities and back-offs. Characters are folded to 256 classes, so a
   language has 256 ** 3 trigrams at most; languages share a broadcast up to
   ``BLOCK`` entries, and go in several rounds beyond.
3. A text is scored in windows; its perplexity is that of its median window, so
   a foreign passage in a clean text does not count. Each language has a lower
   and an upper band around its median. Their width comes from the language's
   own spread (median absolute deviation), not less than the pooled one for few
   texts, and narrows with the text's length.
   A text and its copies count once there, and the spread has a floor.
4. Beside the characters a text is judged by its words: counted by 64-bit hashes
   over all distinct texts, so that this model has an entry for every word of the
   input. Words that make up 1 / ``HEAD`` of a language are looked up in a
   broadcast, ``HEAD`` a language at most; all others by a join on the hash. A
   text's own words are taken off the counts before it is judged. The two
   distances from the language's medians and their difference must lie in the
   band; in a short text junk shows in the difference first.
"""

from __future__ import annotations

import math
import re
from collections import Counter

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import bitmap_of, ship, stored

ORDER = 3
WINDOW = 64
#: Half width of a band, in robust standard deviations.
WIDTH = 3.5
#: Least spread of a level, in nats: copies and near copies do not shrink a band to a point.
FLOOR = 0.005
#: Texts that the pooled spread of all languages counts for, beside a language's own.
POOLED = 20
#: Windows from which a text's own sampling noise is small.
LONG_TEXT = 40
#: Words from which a text's own sampling noise is small, and the least spread of its words' level.
LONG_WORDS, WORD_FLOOR = 400, 0.02
#: Words with this part of a language are looked up in a broadcast, the others by a join.
HEAD = 1_000_000
#: Model entries that are broadcast at once.
BLOCK = 4_000_000
#: Texts that a task takes out of an Arrow batch at once.
PIECE = 500
MIN_WORDS, MAX_REPEATED = 50, 50
SYMBOLS = b"#*$%&|<>"
_STEP = 1000
ALL = object()  # the key of all languages together, null among them
_START = 2  # stands before the first character
#: Scripts written without blanks: each character is a word.
_IDEOGRAPHS = re.compile("[\u2e80-\ua4cf\uf900-\ufaff\U0001b000-\U0001b16f\U00020000-\U0003ffff]")
_MUL = np.uint64(0x9E3779B97F4A7C15)


def classes(text: str) -> np.ndarray:
    """Character classes: ASCII as it is, the rest by code point modulo 128."""
    cp = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
    return np.where(cp < 128, cp, 128 + (cp & 127)).astype(np.int64)


def trigrams(text: str) -> np.ndarray:
    """Codes (24 bits) of the trigrams that end at each character."""
    c = np.concatenate((np.full(ORDER - 1, _START), classes(text)))
    return c[:-2] << 16 | c[1:-1] << 8 | c[2:]


def gram_hash(language: int, order, code: np.ndarray) -> np.ndarray:
    z = (np.uint64(language) << np.uint64(32) | np.uint64(order) << np.uint64(28) | code.astype(np.uint64)) * _MUL
    return z ^ z >> np.uint64(31)


def base_rules(text: str | None) -> tuple[int, int, int, int, int]:
    """n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words."""
    if not text:
        return 0, 0, 0, 0, 0
    raw = text.encode()
    words = raw.split()
    if not words:
        return 0, 0, len(raw) - len(raw.translate(None, SYMBOLS)), 0, 0
    blanks = len(raw) - len(raw.translate(None, b" \t\n\v\f\r"))
    lines = [x for x in raw.split(b"\n") if x.strip()] if b"\n" in raw else [raw]
    repeated = 0
    if len(words) > 3:
        first: dict[bytes, int] = {}
        ids, k = np.array(list(map(first.setdefault, words, range(len(words)))), dtype=np.int64), len(words)
        if k > 1 << 21:  # three numbers below 2 ** 21 fit in 64 bits
            ids, k = np.unique(ids, return_inverse=True)[1], len(first)
        grams = (ids[:-2] * k + ids[1:-1]) * k + ids[2:]
        in_order = np.sort(grams)
        twice = in_order[1:][in_order[1:] == in_order[:-1]]
        if len(twice):
            again = np.isin(grams, twice)
            mask = np.zeros(len(ids), dtype=bool)
            for j in range(3):
                mask[j:len(ids) - 2 + j] |= again
            repeated = int(mask.sum())
    return len(words), len(text) - blanks, len(raw) - len(raw.translate(None, SYMBOLS)), len(lines) - len(set(lines)), repeated


def _pieces(batches, rows: int = PIECE):
    """Batches of at most ``rows`` rows: a task holds the texts of one piece as Python strings."""
    for batch in batches:
        for at in range(0, batch.num_rows, rows):
            yield batch.slice(at, rows)


def _count(batches):
    """(lang, gram, n) of a task's texts."""
    totals: dict[str | None, list] = {}

    def add(lang, codes):
        grams, counts = np.unique(codes, return_counts=True)
        if lang in totals:
            old = totals[lang]
            grams, where = np.unique(np.concatenate((old[0], grams)), return_inverse=True)
            both = np.zeros(len(grams), dtype=np.int64)
            np.add.at(both, where, np.concatenate((old[1], counts)))
            counts = both
        totals[lang] = (grams, counts)

    for batch in _pieces(batches):
        held: dict[str | None, list] = {}
        sizes: dict[str | None, int] = {}
        for text, lang in zip(batch.column("text").to_pylist(), batch.column("lang").to_pylist()):
            if text:
                held.setdefault(lang, []).append(trigrams(text).astype(np.uint32))
                sizes[lang] = sizes.get(lang, 0) + len(text)
                if sizes[lang] > 2_000_000:
                    add(lang, np.concatenate(held.pop(lang)))
                    sizes[lang] = 0
        for lang, codes in held.items():
            add(lang, np.concatenate(codes))
    for lang, (grams, counts) in totals.items():
        for at in range(0, len(grams), 100_000):
            part = slice(at, at + 100_000)
            yield pa.RecordBatch.from_arrays(
                [pa.array([lang] * len(grams[part]), pa.string()), pa.array(grams[part].astype(np.int32)), pa.array(counts[part].astype(np.int64))],
                names=["lang", "gram", "n"])


def kneser_ney(counts: DataFrame) -> DataFrame:
    """(lang, gram_order, gram, log_p, back_off) from trigram counts (lang, gram, n).

    The code of a lower order is the trigram's code without its first characters.
    ``back_off`` is the log weight of the shorter history after this n-gram used
    as a history, or null if it is none.
    """
    def of_order(table: DataFrame, order: int) -> DataFrame:
        """p's own part and the history's weight for one order."""
        count_of = lambda k: F.sum(F.when(F.col("n") == k, 1).otherwise(0)).cast("double")
        n = table.groupBy(F.col("lang").alias("_l")).agg(*[count_of(k).alias(f"n{k}") for k in (1, 2, 3, 4)])
        y = F.coalesce(F.try_divide(F.col("n1"), F.col("n1") + 2 * F.col("n2")), F.lit(0.0))
        discount = [F.greatest(F.lit(0.0), k - (k + 1) * y * F.coalesce(F.try_divide(F.col(f"n{k + 1}"), F.col(f"n{k}")), F.lit(0.0))) for k in (1, 2, 3)]
        n = n.select("_l", *[d.alias(f"d{k}") for k, d in enumerate(discount, 1)])
        of_n = F.when(F.col("n") == 1, F.col("d1")).when(F.col("n") == 2, F.col("d2")).otherwise(F.col("d3"))
        rows = table.join(F.broadcast(n), F.col("lang").eqNullSafe(F.col("_l"))).drop("_l")  # one row per language
        rows = rows.withColumn("history", F.shiftright("gram", 8)).withColumn("d", F.least(of_n, F.col("n").cast("double")))
        per = rows.groupBy("lang", "history").agg(F.sum("n").alias("total"), F.sum("d").alias("held"))
        rows = (rows.join(per.select(F.col("lang").alias("_l"), F.col("history").alias("_h"), "total", "held"),
                          F.col("lang").eqNullSafe(F.col("_l")) & (F.col("history") == F.col("_h"))))
        return rows.select("lang", "gram", "history", ((F.col("n") - F.col("d")) / F.col("total")).alias(f"own{order}"),
                           (F.col("held") / F.col("total")).alias(f"weight{order}"))

    def shorter(table: DataFrame, mask: int) -> DataFrame:
        return table.groupBy("lang", F.col("gram").bitwiseAND(F.lit(mask)).alias("gram")).agg(F.count("*").alias("n"))

    bi = shorter(counts, 0xFFFF)
    uni = shorter(bi, 0xFF)
    one, two, three = of_order(uni, 1), of_order(bi, 2), of_order(counts, 3)
    p1 = one.select("lang", "gram", (F.col("own1") + F.col("weight1") / 256).alias("p"))

    def extend(rows: DataFrame, order: int, mask: int, lower: DataFrame) -> DataFrame:
        low = lower.select(F.col("lang").alias("_l"), F.col("gram").alias("_g"), F.col("p").alias("_p"))
        return rows.join(low, F.col("lang").eqNullSafe(F.col("_l")) & (F.col("gram").bitwiseAND(F.lit(mask)) == F.col("_g"))).select(
            "lang", "gram", (F.col(f"own{order}") + F.col(f"weight{order}") * F.col("_p")).alias("p"))

    p2 = extend(two, 2, 0xFF, p1)
    p3 = extend(three, 3, 0xFFFF, p2)
    grams = None
    for order, p in ((1, p1), (2, p2), (3, p3)):
        part = p.select("lang", F.lit(order).alias("gram_order"), "gram", F.log("p").alias("log_p"), F.lit(None).cast("double").alias("back_off"))
        grams = part if grams is None else grams.union(part)
    for order, rows in ((0, one), (1, two), (2, three)):  # weights of histories
        part = rows.select("lang", F.lit(order).alias("gram_order"), F.col("history").alias("gram"), F.lit(None).cast("double").alias("log_p"),
                           F.log(f"weight{order + 1}").alias("back_off")).distinct()
        grams = grams.union(part)
    return grams.groupBy("lang", "gram_order", "gram").agg(F.max("log_p").alias("log_p"), F.max("back_off").alias("back_off"))


class Model:
    """Sorted hash arrays of the n-grams of some languages."""

    def __init__(self, languages: list, table: pa.Table):
        self.languages = {lang: k for k, lang in enumerate(languages)}
        langs = table.column("lang").to_pylist()
        number = np.array([self.languages[x] for x in langs], dtype=np.uint64)
        code = table.column("gram").to_numpy().astype(np.uint64)
        order = table.column("gram_order").to_numpy().astype(np.uint64)
        hashes = (number << np.uint64(32) | order << np.uint64(28) | code) * _MUL
        hashes ^= hashes >> np.uint64(31)
        by_hash = np.argsort(hashes)
        self.hashes = hashes[by_hash]
        self.log_p = table.column("log_p").to_numpy().astype(np.float32)[by_hash]
        self.back_off = table.column("back_off").to_numpy().astype(np.float32)[by_hash]
        self.slots = np.empty(0, dtype=np.int32)

    def find(self, language: int, order: int, code: np.ndarray, values: np.ndarray) -> np.ndarray:
        """``values`` at the n-grams; nan for those that are not in the model."""
        h = gram_hash(language, order, code)
        at = np.minimum(np.searchsorted(self.hashes, h), len(self.hashes) - 1)
        return np.where(self.hashes[at] == h, values[at], np.float32(np.nan))

    def distinct(self, codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The distinct trigrams, and where each code stands among them; without sorting.
        A place for each trigram of the classes that occur: few in a text, 256 ** 3 at most."""
        classes = codes >> 16, codes >> 8 & 255, codes & 255
        used = np.zeros(256, dtype=bool)
        for c in classes:
            used[c] = True
        rank, n = np.cumsum(used) - 1, int(used.sum())
        if len(self.slots) < n ** 3:
            self.slots = np.empty(n ** 3, dtype=np.int32)
        place = (rank[classes[0]] * n + rank[classes[1]]) * n + rank[classes[2]]
        index = np.arange(len(codes), dtype=np.int32)
        self.slots[place] = index
        one = self.slots[place] == index
        self.slots[place[one]] = index[:one.sum()]
        return codes[one], self.slots[place]

    def log_probabilities(self, lang, codes: np.ndarray) -> np.ndarray:
        """Log probability of the last character of each trigram, with back-off."""
        number = self.languages[lang]
        grams, which = self.distinct(codes)
        out = self.find(number, 3, grams, self.log_p)
        lost = np.zeros(len(grams), dtype=np.float32)
        for order, bits in ((2, 16), (1, 8)):
            miss = np.flatnonzero(np.isnan(out))
            if not len(miss):
                break
            history = grams[miss] >> 8 & (1 << bits) - 1
            lost[miss] += np.nan_to_num(self.find(number, order, history, self.back_off))
            out[miss] = self.find(number, order, grams[miss] & (1 << bits) - 1, self.log_p) + lost[miss]
        out[np.isnan(out)] = math.log(1 / 256)
        return out[which]


def _score(shared):
    names = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")

    def rows(batches):
        model = Model(*shared.value)
        for batch in _pieces(batches):
            base, level, windows = [], [], []
            for text, lang in zip(batch.column("text").to_pylist(), batch.column("lang").to_pylist()):
                base.append(base_rules(text))
                if not text:
                    level.append(None)
                    windows.append(0)
                    continue
                log_p = model.log_probabilities(lang, trigrams(text))
                n = max(1, len(log_p) // WINDOW)
                edges = np.arange(n) * len(log_p) // n
                sums = np.add.reduceat(log_p.astype(np.float64), edges)
                level.append(float(np.median(-sums / np.diff(edges, append=len(log_p)))))
                windows.append(n)
            columns = [pa.array(c, pa.int64()) for c in zip(*base)] if base else [pa.array([], pa.int64())] * len(names)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("lang"), batch.column("key"), *columns, pa.array(level, pa.float64()), pa.array(windows, pa.int64())],
                names=["doc_id", "lang", "key", *names, "level", "windows"])
    return rows


def _medians(rows: DataFrame, values: dict[str, Column]) -> dict[str, dict]:
    """For each value and language (median, number of rows), in steps of 1 / 1000, and under the
    key ``ALL`` of all rows. Histograms are summed by Spark; the driver gets a row per
    language, value and step that occurs."""
    bins = F.array(*[F.struct(F.lit(k).alias("kind"), F.round(v * _STEP).cast("long").alias("bin")) for k, v in values.items()])
    counts = rows.select("lang", F.explode(bins).alias("b")).where("b.bin is not null").groupBy("lang", "b.kind", "b.bin").agg(F.count("*").alias("n"))
    held: dict[str, dict] = {k: {} for k in values}
    for lang, kind, at, n in counts.collect():
        for key in (lang, ALL):
            histogram = held[kind].setdefault(key, Counter())
            histogram[at] += n
    out: dict[str, dict] = {k: {} for k in values}
    for kind, by_language in held.items():
        for lang, histogram in by_language.items():
            total, up = sum(histogram.values()), 0
            for at in sorted(histogram):
                up += histogram[at]
                if 2 * up >= total:
                    out[kind][lang] = (at / _STEP, total)
                    break
    return out


def words_of(text: str) -> list[str]:
    return (text if text.isascii() else _IDEOGRAPHS.sub(r" \g<0> ", text)).split()


class WordKeys:
    """64-bit hashes of a language's words."""

    def __init__(self, lang: str | None):
        self.seed = xxhash.xxh3_64_intdigest(b"" if lang is None else b"+" + lang.encode())

    def of(self, words) -> np.ndarray:
        key, seed = xxhash.xxh3_64_intdigest, self.seed
        return np.array([key(w, seed) for w in words], dtype=np.uint64).view(np.int64)

    def __getitem__(self, word: str) -> int:
        return int(self.of([word])[0])


def _count_words(batches):
    """(lang, word, n) of a task's texts."""
    held: dict[str | None, Counter] = {}

    def rows(lang):
        counts = held.pop(lang)
        words = pa.array(WordKeys(lang).of(counts))
        return pa.RecordBatch.from_arrays([pa.array([lang] * len(counts), pa.string()), words, pa.array(list(counts.values()), pa.int64())],
                                          names=["lang", "word", "n"])

    for batch in _pieces(batches):
        for text, lang in zip(batch.column("text").to_pylist(), batch.column("lang").to_pylist()):
            if text:
                held.setdefault(lang, Counter()).update(words_of(text))
                if len(held[lang]) > 100_000:
                    yield rows(lang)
    for lang in list(held):
        yield rows(lang)


def _text_words(shared):
    """(key, word, own, part, size) of texts: a row for each word to look up.

    ``part`` is what the text has without these words, ``size`` its number of
    words; both stand in its first row and are 0 in others. A text without rare
    words has a row of its rarest one with ``own`` 0.
    """
    def rows(batches):
        head, n_head, totals = shared.value
        if not len(head):
            head, n_head = np.zeros(1, dtype=np.int64), np.zeros(1, dtype=np.int64)
        keys: dict[str | None, WordKeys] = {}
        for batch in _pieces(batches):
            out, held = [], 0
            for text, lang, key in zip(*(batch.column(c).to_pylist() for c in ("text", "lang", "key"))):
                counts = Counter(words_of(text)) if text else None
                if not counts:
                    continue
                if lang not in keys:
                    keys[lang] = WordKeys(lang)
                word = keys[lang].of(counts)
                own = np.array(list(counts.values()), dtype=np.int64)
                at = np.minimum(np.searchsorted(head, word), len(head) - 1)
                known = (head[at] == word) & (n_head[at] > 0)
                size, (total, kinds) = int(own.sum()), totals[lang]
                n, o = n_head[at][known], own[known]
                part = float((o * np.log(n - o + 0.5)).sum()) - size * math.log(total - size + 0.5 * kinds)
                rare = ~known
                if rare.any():
                    word, own = word[rare], own[rare]
                else:
                    word, own = word[[n.argmin()]], np.zeros(1, dtype=np.int64)
                first = np.zeros(len(word), dtype=np.int64)
                first[0] = 1
                out.append((np.full(len(word), key), word, own, first * part, first * size))
                held += len(word)
                if held > 50_000:
                    yield _row_batch(out)
                    out, held = [], 0
            if out:
                yield _row_batch(out)
    return rows


def _row_batch(out):
    return pa.RecordBatch.from_arrays([pa.array(np.concatenate(c)) for c in zip(*out)], names=["key", "word", "own", "part", "size"])


def word_model(texts) -> DataFrame:
    """(lang, word, n): how often each word stands in the texts, stored."""
    counts = texts.mapInArrow(_count_words, "lang string, word long, n long")
    return stored(counts.groupBy("lang", "word").agg(F.sum("n").alias("n")), "perplexity-words")


def word_levels(texts, model: DataFrame) -> DataFrame:
    """(key, word_level, word_size) of distinct texts (key, text, lang): the mean
    negative log probability of a text's words, with 1 / 2 added to each count and
    the text's own words taken off."""
    sc = model.sparkSession.sparkContext
    totals = model.groupBy("lang").agg(F.sum("n").alias("total"), F.count("*").alias("kinds"))
    of = {r.lang: (r.total, r.kinds) for r in totals.collect()}  # one row per language
    head = _with(model, totals).where(F.col("n") * HEAD >= F.col("total")).select("word", "n").toArrow().sort_by("word")
    shared = sc.broadcast((head.column("word").to_numpy(), head.column("n").to_numpy(), of))
    rows = texts.mapInArrow(_text_words(shared), "key long, word long, own long, part double, size long")
    rows = rows.join(model.select("word", "n"), "word")
    found = F.when(F.col("own") > 0, F.col("own") * F.log(F.col("n") - F.col("own") + 0.5)).otherwise(0.0)
    return rows.groupBy("key").agg(F.sum(found + F.col("part")).alias("_sum"), F.sum("size").alias("word_size")).select(
        "key", (-F.col("_sum") / F.col("word_size")).alias("word_level"), "word_size")


def _picked(shared, copied: bool):
    """Rows whose key is, or is not, among the keys of the shared bitmap."""
    def rows(batches):
        bits, raw = shared.value
        bitmap = np.frombuffer(raw, dtype=np.int64)
        for batch in _pieces(batches):
            low = batch.column("key").to_numpy() & (bits - 1)
            yield batch.filter(pa.array((bitmap[low >> 6] >> (low & 63) & 1 == 1) == copied))
    return rows


class Texts:
    """(key, text, lang), a text of a language once. Only those whose key may stand
    for several rows are moved; one Python worker a task picks and maps the others."""

    def __init__(self, docs: DataFrame):
        self.docs = docs.select("key", "text", "lang")
        copies = self.docs.groupBy("key").agg(F.count("*").alias("n")).where("n > 1")
        self.shared = docs.sparkSession.sparkContext.broadcast(bitmap_of(copies, "key"))
        self.once = stored(self.docs.mapInArrow(_picked(self.shared, True), "key long, text string, lang string").dropDuplicates(["key"]),
                           "perplexity-copied")

    def mapInArrow(self, function, schema: str) -> DataFrame:
        pick = _picked(self.shared, False)
        return self.docs.mapInArrow(lambda batches: function(pick(batches)), schema).union(self.once.mapInArrow(function, schema))


#: Levels that a text is judged by: its size, from when its own sampling noise is small, and the least spread.
_LEVELS = {"level": ("windows", LONG_TEXT, FLOOR), "word_level": ("word_size", LONG_WORDS, WORD_FLOOR)}


def _per_language(spark, rows: dict, columns: list[str]) -> DataFrame:
    """A table with a row per language from {language: values}."""
    schema = "lang string" + "".join(f", {c} double" for c in columns)
    return spark.createDataFrame([(lang, *map(float, values)) for lang, values in rows.items()], schema)


def _bands(judged: DataFrame) -> DataFrame:
    """Per language and level: the median and the squares of its noise (for size 1), of
    the spread between long texts, and of the median's own error.

    A language's noise and spread are at least what they are when the pooled
    spread of all languages counts as ``POOLED`` more texts, so that few texts
    do not make a point of a band; they have a wider median.
    """
    spark = judged.sparkSession
    middles = _medians(judged, {k: F.col(k) for k in _LEVELS})
    languages = {lang for m in middles.values() for lang in m if lang is not ALL}
    nothing = (math.nan, 0)
    table = _per_language(spark, {lang: [middles[k].get(lang, nothing)[0] for k in _LEVELS] for lang in languages}, [f"{k}_middle" for k in _LEVELS])
    rows = _with(judged, table)
    apart = {}
    for level, (size, long, _) in _LEVELS.items():
        distance = F.abs(F.col(level) - F.col(f"{level}_middle"))
        apart[f"{level}_noise"] = F.when(~F.isnan(distance), distance * F.sqrt(size))
        apart[f"{level}_own"] = F.when((F.col(size) > long) & ~F.isnan(distance), distance)
    spreads = _medians(rows, apart)

    def squared(kind, lang):
        mine, n = spreads[kind].get(lang, (0.0, 0))
        all_ = spreads[kind].get(ALL, (0.0, 0))[0]
        # 1.4826 times the median absolute deviation estimates a standard deviation
        return 1.4826 ** 2 * max(mine ** 2, (n * mine ** 2 + POOLED * all_ ** 2) / (n + POOLED))

    found = {}
    for lang in languages:
        found[lang] = []
        for level, (_, _, floor) in _LEVELS.items():
            middle, n = middles[level].get(lang, nothing)
            found[lang] += [middle, squared(f"{level}_noise", lang), squared(f"{level}_own", lang) / 4 + floor ** 2, math.pi / 2 / n if n else math.nan]
    return _per_language(spark, found, [f"{k}_{x}" for k in _LEVELS for x in ("middle", "noise2", "own2", "error")])


def _spread(level: str, size: str) -> Column:
    """Standard deviation of a text's distance from its language's median."""
    return F.sqrt((F.col(f"{level}_noise2") / F.greatest(F.col(size), F.lit(1)) + F.col(f"{level}_own2")) * (1 + F.col(f"{level}_error")))


def _with(rows: DataFrame, per_language: DataFrame) -> DataFrame:
    table = F.broadcast(per_language.withColumnRenamed("lang", "_l"))  # one row per language
    return rows.join(table, F.col("lang").eqNullSafe(F.col("_l")), "left").drop("_l")


def language_model(docs) -> DataFrame:
    """The model of all languages of ``docs`` (columns text, lang), stored."""
    if isinstance(docs, DataFrame):
        docs = docs.select("text", F.col("lang").cast("string").alias("lang"))
    counts = docs.mapInArrow(_count, "lang string, gram int, n long").groupBy("lang", "gram").agg(F.sum("n").alias("n"))
    return stored(kneser_ney(stored(counts, "perplexity-counts")), "perplexity-model")


def _blocks(model: DataFrame, block: int):
    """Languages in groups of at most ``block`` model entries, or one language."""
    sizes = sorted(model.groupBy("lang").count().collect(), key=lambda r: (r[0] is not None, r[0]))
    group, held = [], 0
    for lang, n in sizes:
        if group and held + n > block:
            yield group
            group, held = [], 0
        group.append(lang)
        held += n
    if group:
        yield group


def perplexity_rules(docs: DataFrame, width: float = WIDTH, block: int = BLOCK) -> DataFrame:
    """One row per document: doc_id, n_words, word_chars, n_symbols, n_dup_lines,
    n_repeat_words, base_failed, kept, lang, perplexity, band_low, band_high.

    A null or empty text has no words, no perplexity and fails the base rules.
    Null languages form a language of their own. Every language has a band; with
    few texts its width is mostly the pooled one of all languages, and a text that
    is the only one of its language is its median.
    Ties and repeated rows are scored alike; an empty table gives an empty
    result. Other columns are ignored.
    """
    spark = ship(docs.sparkSession)
    id_type = docs.schema["doc_id"].dataType.simpleString()
    docs = docs.select("doc_id", "text", F.col("lang").cast("string").alias("lang")).withColumn("key", F.xxhash64("lang", "text"))
    texts = Texts(docs)
    model = language_model(texts)
    levels = word_levels(texts, word_model(texts))
    schema = (f"doc_id {id_type}, lang string, key long, n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, "
              "level double, windows long")
    # texts without a model (no text at all in that language) go with the first group
    groups = list(_blocks(model, block)) or [[]]
    scored = None
    for k, group in enumerate(groups):
        inside = F.lit(False)
        for lang in group:
            inside = inside | F.col("lang").eqNullSafe(F.lit(lang))
        if k == 0:
            others = [x for g in groups[1:] for x in g]
            inside = F.lit(True)
            for lang in others:
                inside = inside & ~F.col("lang").eqNullSafe(F.lit(lang))
        of_group = F.lit(False)
        for lang in group:
            of_group = of_group | F.col("lang").eqNullSafe(F.lit(lang))
        table = model.where(of_group).toArrow()
        part = docs.where(inside).mapInArrow(_score(spark.sparkContext.broadcast((group, table))), schema)
        scored = part if scored is None else scored.union(part)
    failed = (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEATED * F.col("n_words"))
    scored = stored(scored.withColumn("base_failed", failed).join(levels, "key", "left"), "perplexity-scored")

    judged = scored.where("not base_failed").select("key", "lang", *[c for k, v in _LEVELS.items() for c in (k, v[0])])
    judged = stored(judged.dropDuplicates(["key"]), "perplexity-judged")  # a text and its copies count once
    out = _with(scored, _bands(judged))
    low, high = (F.exp(F.col("level_middle") + sign * width * _spread("level", "windows")) for sign in (-1, 1))
    out = out.withColumn("perplexity", F.exp("level")).withColumn("band_low", low).withColumn("band_high", high)
    of_text, of_words = ((F.col(level) - F.col(f"{level}_middle")) / _spread(level, size) for level, size in (("level", "windows"), ("word_level", "word_size")))
    # common words between odd characters, or rare words of common ones, show in the difference
    inside = (F.abs(of_text) <= width) & (F.abs(of_words) <= width) & (F.abs(of_text - of_words) <= width * math.sqrt(2))
    unjudged = F.isnan(of_text) | F.isnan(of_words)
    inside = F.coalesce(unjudged | inside, F.lit(True))
    return out.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed",
                      (~F.col("base_failed") & inside).alias("kept"), "lang", "perplexity", "band_low", "band_high")


def op2_perplexity(spark, sf_dir: str) -> DataFrame:
    return perplexity_rules(spark.read.parquet(f"{sf_dir}/documents.parquet"))

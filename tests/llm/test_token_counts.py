import random

import public_tokenizers
from tokenizers import Tokenizer

from retentio.llm.token_counts import PrefixCounter, token_counts

PATH = public_tokenizers.path("byte_bpe_50k.json")


def test_every_prefix_equals_the_library():
    library = Tokenizer.from_file(PATH)
    with open(PATH, "rb") as f:
        counter = PrefixCounter(f.read())
    n = lambda s: len(library.encode(s, add_special_tokens=False).ids)
    rng = random.Random(5)
    chars = "ab 'relvstdm!?1é漢\n\t\r\x1c\x85\xa0 🙂<|>endoftx"
    parts = ["  ", "'re", "'ll", "<|endoftext|>", " \n\n ", "the ", "internationalisation"]
    for _ in range(400):
        text = "".join(rng.choice(chars) if rng.random() < 0.8 else rng.choice(parts) for _ in range(rng.randrange(25)))
        want = [n(text[:i]) for i in range(len(text) + 1)]
        assert list(counter.prefix_counts(text)) == want and counter.count(text) == want[-1]
        limit = rng.randrange(1, 9)
        assert counter.cut(text, limit) == max(i for i, k in enumerate(want) if k <= limit)


def test_documents(edges, edge_rows, nothing):
    library = Tokenizer.from_file(PATH)
    want = sorted((str(i), len((t or "").encode()), len(library.encode(t or "", add_special_tokens=False).ids)) for i, t, *_ in edge_rows)
    rows = token_counts(edges, PATH).collect()
    assert sorted((str(r.doc_id), r.n_bytes, r.n_tokens) for r in rows) == want
    assert all(r.over_limit == (r.n_tokens > 512) for r in rows)
    assert token_counts(nothing, PATH).collect() == []


def test_cut_equals_the_prefix_table():
    """The one walk over the pieces finds the same cut as the table of all prefixes, at every limit."""
    with open(PATH, "rb") as f:
        counter = PrefixCounter(f.read())
    rng = random.Random(11)
    bits = [" ", "  ", "\n", "\n \t", "a", "the", " quick", "'re", "'ll", "'s", "123", " 4", "é", "漢", "🙂", "aaaa", "!!", "<|endoftext|>", "<|endo", "don't"]
    for _ in range(400):
        text = "".join(rng.choice(bits) for _ in range(rng.randrange(1, 40)))
        table = counter.prefix_counts(text)
        for limit in {1, 2, rng.randrange(1, 30), int(table[-1])}:
            n, cut = counter.count_and_cut(text, limit)
            assert n == table[-1] and cut == [i for i, k in enumerate(table) if k <= limit][-1]

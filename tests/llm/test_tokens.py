import hashlib
import random
from functools import cache

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from llm.conftest import clashing
from panelcast.llm import bpe, queries

public = pytest.importorskip("public_tokenizers")
PATH = public.path("byte_bpe_50k.tiktoken")


@cache
def library():
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(public.path("byte_bpe_50k.json"))
    t.no_truncation()
    t.no_padding()
    return t


def plain(text):
    ids = library().encode(text or "", add_special_tokens=False).ids
    return (len(ids), hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest(),
            hashlib.sha256(library().decode(ids, skip_special_tokens=False).encode()).hexdigest())


@pytest.mark.parametrize("table", ["odd", "small", "empty"])
@pytest.mark.parametrize("leaf", [bpe.LEAF, 50])
def test_encode_equals_library(request, table, leaf):
    docs = request.getfixturevalue(table)
    out = bpe.encode(clashing(docs, ["n_tokens", "ids_sha256", "ids", "key", "part"]), PATH, queries.SPECIAL, leaf)
    want = sorted(str((r.doc_id, *plain(r.text))) for r in docs.collect())
    assert sorted(str((r.doc_id, r.n_tokens, r.ids_sha256, r.decoded_sha256)) for r in out.collect()) == want


def by_tree(text, leaf, window=4):
    c = bpe.codec(PATH, tuple(queries.SPECIAL.items()))
    parts = bpe.leaves(len(text), leaf)

    def tree(a, b):
        if (a, b) in parts:
            return c.encode(text[a:b])
        m = (a + b) // 2
        return bpe.join(c, text[a:b], m - a, tree(a, m), tree(m, b), window)
    return tree(0, len(text))


PIECES = ["a", "th", "the", "Ring", "é", "ß", "ñandú", "'s", "'", "'ll", " ", "  ", "\n", "\t ", "1", "2024", "!", "..", "<|endoftext|>", "<|end", "日本",
          "🙂", "aaaa", "xyzzy", " ", "\r\n", "-", "__", "tion", "Straße"]


@settings(max_examples=400, deadline=None)
@given(st.lists(st.sampled_from(PIECES), max_size=60), st.integers(3, 17), st.integers(1, 6))
def test_joins_are_exact(pieces, leaf, window):
    text = "".join(pieces)
    assert by_tree(text, leaf, window) == library().encode(text, add_special_tokens=False).ids


@pytest.mark.parametrize("seed", range(6))
def test_joins_of_unsplit_runs_are_exact(seed):
    rng = random.Random(seed)
    text = "".join(rng.choice(["e", "t", "a", "o", "n", "er", "ing", "un", "é", "ß"]) for _ in range(3000))
    assert by_tree(text, 200, 8) == library().encode(text, add_special_tokens=False).ids


def test_every_code_point_is_encoded_like_the_library():
    c = bpe.codec(PATH, tuple(queries.SPECIAL.items()))
    points = [chr(i) for i in range(0x110000) if not 0xD800 <= i < 0xE000]
    for at in range(0, len(points), 4096):
        text = "".join(f"a{p}b {p}{p} 1{p}'s\n" for p in points[at:at + 4096])
        assert c.encode(text) == library().encode(text, add_special_tokens=False).ids, hex(ord(points[at]))


def test_decode_is_a_round_trip():
    c = bpe.codec(PATH, tuple(queries.SPECIAL.items()))
    for text in ["", "plain", "é🙂\u0000\n<|endoftext|>"]:
        assert c.decode(c.encode(text)) == text

import hashlib

import public_tokenizers
import pytest
from cases import frame, rows
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from contestlab.llm.bpe import Bpe, bpe_encode, load

PATH = public_tokenizers.path("word_bpe_49k.json")


@pytest.fixture(scope="module")
def both():
    return Bpe(load(PATH), cache_words=50), Tokenizer.from_file(PATH)


def check(both, text):
    ours, theirs = both
    ids = theirs.encode(text, add_special_tokens=False).ids
    assert ours.encode(text) == ids, repr(text)
    assert ours.decode(ids) == theirs.decode(ids, skip_special_tokens=False)
    assert ours.digests(text) == (len(ids), *(hashlib.sha256(x.encode()).hexdigest() for x in (" ".join(map(str, ids)), ours.decode(ids))))


TEXTS = [
    "", " ", "Hello, World!! it's we'LL 'S 's'd", "ÀÉ naïve café ΣΑΣ ΟΔΟΣ İstanbul ﬁ Ⅳ ½ 12345", "a<|endoftext|>b <|startoftext|><|endoftext|",
    "<|ENDOFTEXT|> x", "\0 \0a \x1c\x1d\x85​ 　z", "👍🏽 日本語 한국어 עברית ภาษาไทย", "x" * 3000, "don't'tt''s ___ --- *** $$$", "\n\tA\r\nB\x0bC\x0cD",
]


@pytest.mark.parametrize("text", TEXTS)
def test_fixed_texts(both, text):
    check(both, text)


@settings(max_examples=400, deadline=None)
@given(st.text(max_size=60))
def test_any_text(both, text):
    check(both, text)


@settings(max_examples=300, deadline=None)
@given(st.text(alphabet="abestohinr' ,.S1<|>", max_size=60))
def test_plain_text(both, text):
    check(both, text)


def test_on_a_table(spark, both):
    got = {}
    for r in bpe_encode(frame(spark), PATH, texts=True).collect():
        got.setdefault(r.doc_id, []).append(r)
    data = rows()
    assert sum(map(len, got.values())) == len(data)
    for d in data:
        ids = both[1].encode(d[1] or "", add_special_tokens=False).ids
        assert any(list(r.ids) == ids and r.n_tokens == len(ids) and r.decoded == both[1].decode(ids, skip_special_tokens=False) for r in got[d[0]])
    assert bpe_encode(frame(spark, []), PATH).count() == 0

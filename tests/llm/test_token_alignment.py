import hashlib
import random
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from cases import frame, rows
from tokenizers import Tokenizer

from contestlab.llm import token_alignment as T

A, B = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")
COLUMNS = ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]


@pytest.fixture(scope="module")
def libraries():
    a = Tokenizer.from_file(A)
    a.encode_special_tokens = True
    b = sentencepiece.SentencePieceProcessor(model_file=B)
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    letter = {chr(x): x for x in plain} | {chr(256 + i): x for i, x in enumerate(x for x in range(256) if x not in plain)}

    def of_b(i):
        p = b.id_to_piece(i)
        return bytes([int(p[3:5], 16)]) if len(p) == 6 and p.startswith("<0x") else p.replace("▁", " ").encode()

    def tokens(text):
        """Both libraries on the whole text, as (id, bytes)."""
        x = [(i, bytes(letter[c] for c in a.id_to_token(i))) for i in a.encode(" " + text, add_special_tokens=False).ids]
        y = [(i, of_b(i)) for i in b.encode(text)]
        same = all(b"".join(w for _, w in z) == (" " + text).encode() for z in (x, y))
        return (x, y) if same and text else ([], [])

    return tokens


def ends(tokens):
    at, out = 0, []
    for _, w in tokens:
        at += len(w)
        out.append(at)
    return out


def brute(tokens, data):
    """By the libraries on whole texts; links are all pairs that end together."""
    found, count = [], Counter()
    for doc, text in data:
        a, b = tokens(text or "")
        ea, eb = ends(a), ends(b)
        common = sorted(set(ea) & set(eb))
        links, groups, p, q = [], [], 0, 0
        for e in common:
            i, j = ea.index(e, p) + 1, eb.index(e, q) + 1
            groups.append(",".join(str(t) for t, _ in a[p:i]) + "|" + ",".join(str(t) for t, _ in b[q:j]))
            links.append((a[i - 1][0], b[j - 1][0]))
            p, q = i, j
        count.update(links)
        found.append((doc, len(a), len(b), len(common), links, ";".join(groups)))
    best = {}
    for (_, y), n in count.items():
        best[y] = max(best.get(y, 0), n)
    return sorted(
        (
            (i, na, nb, ng, len(links), sum(count[x] == best[x[1]] for x in links), sum(count[x] for x in links), hashlib.sha256(g.encode()).hexdigest() if na else "")
            for i, na, nb, ng, links, g in found
        ),
        key=str,
    )


ODD = [
    "", None, " ", "  ", "   x", "x   ", " a  b   c ", "a\tb \n c\r\n  d", " x   y", "x 　y   z", "a ▁b", "▁", "x▁ y", "it's we'll 'S ' s",
    "<|endoftext|> <s> </s> <unk> <0x41>", "日本語 テキスト です", "emoji 👩‍👩‍👧 🇫🇷 x", "\x00 \x01 a\x00b", "é ﬁ ² Ⅷ ㎏ Å", "x" * 5000, "ab" * 3000 + " " + "1" * 400, "!" * 300 + " ?" * 100,
    "tab\u0085nel   sep", "١٢٣ 四五 12345678901 1,000.5", "​ zero ‍ width ﻿", "mixed\u0000", "Ünï çödé  ñ", "\U00010348 \U0001d518 x",
]


@pytest.mark.parametrize("options", [{}, {"bucket_pairs": 50, "shard_pairs": 1500, "leaves": 4, "cache": 5}])
def test_matches_the_libraries(spark, libraries, options):
    """Also with many buckets, several shards and leaves, and a cache that is emptied again and again."""
    r = random.Random(4)
    chars = " " * 9 + "\n\t 　▁" + "abcdeXYZ019éüß日本.,!?'-_<>|&" * 2
    data = [(1000 + i, "".join(r.choice(chars) for _ in range(r.randrange(0, 60)))) for i in range(150)]
    data += [(i, t) for i, t in enumerate(ODD)] + [x[:2] for x in rows()] * 2
    got = T.align_tokenizers(spark.createDataFrame(data, "doc_id long, text string").repartition(6), A, B, **options)
    assert got.columns == COLUMNS
    assert sorted(map(tuple, got.collect()), key=str) == brute(libraries, data)


def test_texts_and_other_columns(spark, libraries):
    """Clashing names are ignored; the groups themselves come back with ``texts``."""
    data = [(1, "one two", "g", 5), (None, None, None, None), (2, "", "x", 0)]
    docs = spark.createDataFrame(data, "doc_id long, text string, groups string, n_best long")
    got = {r.doc_id: r for r in T.align_tokenizers(docs, A, B, texts=True).collect()}
    a, b = libraries("one two")
    assert got[1].groups == ";".join(f"{x[0]}|{y[0]}" for x, y in zip(a, b, strict=True))
    assert got[1].groups_sha256 == hashlib.sha256(got[1].groups.encode()).hexdigest()
    assert tuple(got[None])[1:] == tuple(got[2])[1:] == (0, 0, 0, 0, 0, 0, "", "")


def test_empty_tables(spark):
    assert T.align_tokenizers(frame(spark, []), A, B).count() == 0
    assert [tuple(r) for r in T.align_tokenizers(frame(spark, [(7, None, *[None] * 7)]), A, B).collect()] == [(7, 0, 0, 0, 0, 0, 0, "")]


def test_every_code_point(libraries):
    """Segments give the same tokens as the libraries whatever character stands in them or around their space."""
    from contestlab.llm.bpe import load

    with open(B, "rb") as f:
        pair = T.Pair(load(A), f.read())
    points = [c for c in range(0x3100) if not 0xD800 <= c < 0xE000] + list(range(0x3100, 0x110000, 997))
    for c in (c for c in points if not 0xD800 <= c < 0xE000):
        text = f"x{chr(c)} {chr(c)}1 {chr(c)}{chr(c)} y"
        data = np.frombuffer(text.encode(), np.uint8)
        start, end, _ = T.segments(data, np.array([0, len(data)]))
        table, found, _ = pair.align([data[i:j].tobytes() for i, j in zip(start, end, strict=True)])
        a, b = libraries(text)
        if not a:
            assert not table[:, 0].all()
            continue
        groups = [g.split("|") for f in found for g in f.decode().split(";")]
        assert ",".join(x for x, _ in groups) == ",".join(str(i) for i, _ in a), hex(c)
        assert ",".join(y for _, y in groups) == ",".join(str(i) for i, _ in b), hex(c)


def test_perfect_hash():
    """Minimal, perfect and verified: different slots from 0 on, -1 for strangers."""
    from types import SimpleNamespace as Row

    rng = np.random.default_rng(0)
    pairs = np.unique(rng.integers(0, 1 << 48, 20_000))
    of = T.bucket_of(pairs, 9)
    made = []
    for x in range(9):
        sizes, bits, order = T.perfect_hash(pairs[of == x])
        made.append(Row(bucket=x, sizes=sizes.tolist(), bits=np.packbits(bits).tobytes(), pairs=order.tobytes()))
    h = T.PairHash(made[::-1], 9)
    slot = h(pairs)
    assert sorted(slot.tolist()) == list(range(len(pairs)))
    assert (h.pairs[slot] == pairs).all()
    strange = np.setdiff1d(rng.integers(0, 1 << 48, 5000), pairs)
    assert (h(strange) == -1).all()
    assert (T.PairHash(made[:4], 9)(pairs[of >= 4]) == -1).all()

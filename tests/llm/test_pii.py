import hashlib
import re

import pytest
from cases import frame, rows
from hypothesis import given, settings
from hypothesis import strategies as st

from contestlab.llm.pii import KINDS, all_spans, base_spans, find_pii

PATTERNS = [
    r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    r"[0-9]([\x20-]?[0-9])+",
    r"\+[0-9][\x20().0-9-]+[0-9]",
]


def plain(text):
    out = []
    for k, p in enumerate(PATTERNS):
        for m in re.finditer(p, text):
            d = re.sub("[^0-9]", "", m[0])
            s = sum(sum(divmod(int(c) * (1 + i % 2), 10)) for i, c in enumerate(d[::-1]))
            if (True, k == 1 and all(int(x) <= 255 for x in m[0].split(".")), 12 <= len(d) <= 19 and s % 10 == 0, 9 <= len(d) <= 15)[k]:
                out.append((m.start(), k, m.end()))
    return sorted(out)


@settings(max_examples=1500, deadline=None)
@given(st.text(alphabet="a0149.@+-( )é%2", max_size=60))
def test_base_is_the_patterns(text):
    assert base_spans(text) == plain(text)


@settings(max_examples=300, deadline=None)
@given(st.text(max_size=40), st.sampled_from([" one two three four five", "a at b dot c", "x (at) y [dot] z", "4111 1111 1111 1111", "е@х.сom", "​"]))
def test_base_stays(text, more):
    base, every = all_spans(text + more + text)
    assert base == plain(text + more + text) and set(base) <= set(every) and every == sorted(every)
    assert all(0 <= s < e <= len(text + more + text) for s, _, e in every)


def found(text):
    return [(KINDS[k], text[s:e]) for s, k, e in all_spans(text)[1]]


@pytest.mark.parametrize(
    "text,want",
    [
        ("write to bob [at] mail (dot) example {dot} com now", [("email", "bob [at] mail (dot) example {dot} com")]),
        ("write to bob at mail dot example dot com now", [("email", "bob at mail dot example dot com")]),
        ("é bоb@exаmple.cоm é", [("email", "bоb@exаmple.cоm")]),  # Cyrillic o and a
        ("ｂｏｂ＠ｅｘａｍｐｌｅ．ｃｏｍ", [("email", "ｂｏｂ＠ｅｘａｍｐｌｅ．ｃｏｍ")]),
        ("call plus one five five five two three four five six seven please", [("phone", "plus one five five five two three four five six seven")]),
        ("card four one one one one one one one one one one one one one one one.", [("card", "four one one one one one one one one one one one one one one one")]),
        ("host one nine two dot one six eight dot one dot seven up", [("ip", "one nine two dot one six eight dot one dot seven")]),
        ("4111​1111 1111–1111", [("card", "4111​1111 1111–1111")]),
        ("١٩٢.١٦٨.١.١", [("ip", "١٩٢.١٦٨.١.١")]),
        ("meet me at noon dot the i, one two three", []),
        ("see x[1] (at) home", []),
        ("a.b@c.d and e at f dot g dot org", [("email", "a.b@c.d"), ("email", "e at f dot g dot org")]),
    ],
)
def test_disguises(text, want):
    assert found(text) == want


@pytest.mark.parametrize(
    "text,kind,base,whole",
    [
        ("é bоb@example.com é", "email", "b@example.com", "bоb@example.com"),  # Cyrillic o in the local part only
        ("to bob@example.co[dot]uk now", "email", "bob@example.co", "bob@example.co[dot]uk"),
        ("ip ９2.168.1.10 up", "ip", "2.168.1.10", "９2.168.1.10"),
    ],
)
def test_partly_disguised(text, kind, base, whole):
    assert sorted(found(text)) == sorted([(kind, base), (kind, whole)])
    assert [text[s:e] for s, _, e in all_spans(text)[0]] == [base]


@pytest.mark.parametrize(
    "text,want",
    [
        ("ip 10[.]0[.]0[.]1 is down", [("ip", "10[.]0[.]0[.]1")]),
        ("ip 10(dot)0(dot)0(dot)1 is down", [("ip", "10(dot)0(dot)0(dot)1")]),
        ("bob at example.com", [("email", "bob at example.com")]),
        ("192 dot 168 dot 1 dot 1", [("ip", "192 dot 168 dot 1 dot 1")]),
        ("host 192.168 dot one.1 up", [("ip", "192.168 dot one.1")]),
        ("plus one 415 five five five 2671", [("phone", "plus one 415 five five five 2671")]),
        ("plus 1 (415) five five five 2671.", [("phone", "plus 1 (415) five five five 2671")]),
        ("call +one 415 555 2671", [("phone", "+one 415 555 2671")]),
        ("card 4111 1111 1111 one one one one", [("card", "4111 1111 1111 one one one one")]),
        *((f"bob at mail dot example dot {e}", [("email", f"bob at mail dot example dot {e}")]) for e in ["it", "us", "me", "at", "no", "be", "info"]),
        ("one of 3 data, two at home, plus 4 dots", []),
    ],
)
def test_each_disguise_stands_alone(text, want):
    assert found(text) == want


def test_blank_runs_are_quick():
    for text in (" " * 200_000 + "[.] at", "one" + " " * 200_000 + "x", "1 dot" + " " * 200_000 + "x one", "one 1 " * 50_000, "1a" * 100_000 + " one", "a at b." * 50_000):
        all_spans(text)


def test_long_texts_are_quick():
    for text in ("a" * 300_000, "1" * 300_000, "1." * 100_000, "+1" + "-" * 200_000, "@" * 100_000, "one " * 50_000, "a at " * 50_000 + "dot", "( " * 100_000 + "at"):
        all_spans(text)


def test_on_a_table(spark):
    data = [*rows(), (77, "mail a@b.c or x (at) y (dot) z, +1 (555) 123-4567", "", "", 0, 0, 0, "", "")]
    got = find_pii(frame(spark, data)).collect()
    assert len(got) == len(data)
    r = next(r for r in got if r.doc_id == 77)
    assert (r.n_email, r.n_ip, r.n_card, r.n_phone, r.n_added) == (1, 0, 0, 1, 1)
    assert r.base_sha256 == hashlib.sha256(b"email:5:10,phone:32:49").hexdigest()
    assert r.spans == "email:5:10,email:14:30,phone:32:49"
    assert find_pii(frame(spark, [])).count() == 0

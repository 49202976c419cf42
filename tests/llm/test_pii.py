import itertools
import re
import time

import pytest

from tapeline.llm import pii

from conftest_llm import SF_DIR


def base(text):
    found = []
    for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", text):
        found.append((m.start(), 0, m.end()))
    for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", text):
        if all(int(p) <= 255 for p in m[0].split(".")):
            found.append((m.start(), 1, m.end()))
    for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", text):
        digits = re.sub("[^0-9]", "", m[0])
        doubled = [int(d) * (1 + i % 2) for i, d in enumerate(reversed(digits))]
        if 12 <= len(digits) <= 19 and sum(d // 10 + d % 10 for d in doubled) % 10 == 0:
            found.append((m.start(), 2, m.end()))
    for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", text):
        if 9 <= len(re.sub("[^0-9]", "", m[0])) <= 15:
            found.append((m.start(), 3, m.end()))
    return [(pii.KINDS[k], a, b) for a, k, b in sorted(found)]


HARD = [
    "a@b@c.de x@y z@.de q@r.s.t, a.b+c%d@e-f.g-h..", "1.2.3.4.5.6.7.8 256.1.1.1 0255.1.1.1 01.02.03.0004 1.2.3",
    "4111 1111 1111 1111, 4111-1111-1111-1112 4111  1111 4242424242424242424242 5",
    "+49 (0)30 1234-567 +1 +12345678 +1 555 0100 +123456789012345678 +1.2.3.4.5.6.7.8.9",
    "é@b.de ß1.2.3.4 字+49 151 234567字 a@b.dea@b.de", "0" * 3000 + ".1.1.1", "a" * 3000, "@@a@b.c@d.e", "",
]


@pytest.mark.parametrize("text", HARD)
def test_plain_spans_are_those_of_the_patterns(text):
    assert [(k, a, b) for k, a, b, plain, _ in pii.spans(text) if plain] == base(text)


def test_whole_table(spark, clashing):
    docs = clashing(spark.read.parquet(f"{SF_DIR}/documents.parquet"))
    rows = pii.with_spans(docs, "found").collect()
    assert len(rows) == docs.count()
    for row in rows:
        assert [(s.kind, s.start, s.end) for s in row.found if s.base] == base(row.text)


@pytest.mark.parametrize(
    ("text", "kind", "source", "value"),
    [
        ("write to jo (at) site (dot) org now", "email", "jo (at) site (dot) org", "jo@site.org"),
        ("write to jo at site dot org now", "email", "jo at site dot org", "jo@site.org"),
        ("jo[at]site.org", "email", "jo[at]site.org", "jo@site.org"),
        ("mail јое@ѕite.org", "email", "јое@ѕite.org", "joe@site.org"),
        ("mail ｊｏ＠ｓｉｔｅ．ｏｒｇ!", "email", "ｊｏ＠ｓｉｔｅ．ｏｒｇ", "jo@site.org"),
        ("j\u200bo@site.org", "email", "j\u200bo@site.org", "jo@site.org"),
        ("at 192 dot 168 dot 0 dot 1, ok", "ip", "192 dot 168 dot 0 dot 1", "192.168.0.1"),
        ("call plus four nine one five one two three four five six", "phone",
         "plus four nine one five one two three four five six", "+49151" + "23456"),
        ("card ４１１１ １１１１ １１１１ １１１１ x", "card", "４１１１ １１１１ １１１１ １１１１", "4111 1111 1111 1111"),
        ("four one one one 1111 1111 1111", "card", "four one one one 1111 1111 1111", "4111" * 1 + "111111111111"),
    ],
)
def test_disguises_map_back_to_the_source(text, kind, source, value):
    found = [s for s in pii.spans(text) if not s[3]]
    assert [(k, text[a:b], v) for k, a, b, _, v in found if k == kind] == [(kind, source, value)]


@pytest.mark.parametrize(
    "text",
    ["meet at noon. then go", "one two three dot dot", "look at example.com", "été à la plage, 3 – 4 jours", "at one or two"],
)
def test_prose_is_left_alone(text):
    assert pii.spans(text) == []


def test_masking(docs_of, odd_texts, clashing):
    texts = [*odd_texts, "jo@site.org and 10.0.0.1!", "jo at site dot org"]
    docs = clashing(docs_of(texts))
    rows = {r.doc_id: r for r in pii.masked(docs).collect()}
    assert rows[len(odd_texts)].text == "<email> and <ip>!" and rows[len(odd_texts) + 1].text == "<email>"
    assert [rows[i].text for i in range(len(odd_texts))] == odd_texts
    assert pii.masked(docs).columns == docs.columns
    assert pii.with_spans(docs_of([])).count() == pii.masked(docs_of([])).count() == 0


@pytest.mark.parametrize(
    ("phone", "value"),
    [
        ("+44 20 seven 946 zero 958", "+442079460958"),
        ("+44 20 7946 09 five 8", "+4420794609" + "58"),
        ("+44 207 946 095 eight", "+442079460958"),
        ("+four 42079 46 0958", "+442079460958"),
    ],
)
def test_number_words_beside_long_runs_of_digits(phone, value):
    text = f"call {phone} now"
    assert ("phone", 5, 5 + len(phone), False, value) in pii.spans(text)
    assert pii.mask(text) == "call <phone> now"


def test_a_verdict_does_not_depend_on_other_text():
    parts = ("20", "four", "1234", "oh", "x", "plus")
    for chosen in itertools.product(parts, repeat=3):
        for gap in (" ", "-"):
            text = gap.join(chosen)
            alone = pii.spelled_digits(pii.Mapped.of(text))
            assert alone == pii.spelled_digits(pii.Mapped.of(f"{text}, or one two"))[: len(alone)]
            assert bool(alone) == any(
                any(w in m[0].split(gap) for w in ("four", "oh")) for m in pii._SPELLED.finditer(text)
            )


@pytest.mark.parametrize(
    ("address", "value"),
    [
        ("one nine two dot one six eight dot zero dot one", "192.168.0.1"),
        ("1 point 2 point 3 point 2 five 5", "1.2.3.255"),
        ("one.two.three.four", "1.2.3.4"),
        ("10 dot zero dot Zero dot one", "10.0.0.1"),
        ("10.0.0.one", "10.0.0.1"),
        ("eight point eight point four point four", "8.8.4.4"),
        ("one-two-seven-dot-zero-dot-zero-dot-one", "127.0.0.1"),
        ("one 27 dot oh dot 0 dot 2 five 5", "127.0.0.255"),
        ("nine nine nine dot one dot one dot one", None),
        ("one.two.three", None),
        ("one. two. three. four", None),
    ],
)
def test_spelled_addresses(address, value):
    text = f"host {address}, ok"
    expected = [("ip", 5, 5 + len(address), False, value)] if value else []
    assert pii.spans(text) == expected


def test_an_address_beside_other_numbers():
    assert pii.mask("rows 1 2 3 at room seven one nine two dot one six eight dot zero dot one") == "rows 1 2 3 at room seven <ip>"
    assert pii.mask("one.two.three.four and five.six.seven.eight") == "<ip> and <ip>"
    assert pii.mask("call plus four nine dot one five one dot two three dot five six") == "call <phone>"
    assert pii.mask("one.two.three.four 4111 1111 1111 1111") == "<ip> <card>"
    assert pii.mask("5551234 one.two.three.four") == "5551234 <ip>"
    assert pii.mask("one.two.three, 1 2 " * 3000) == "one.two.three, 1 2 " * 3000


WIDE = " " * 40


@pytest.mark.parametrize(
    ("text", "kind", "value"),
    [
        (f"write to jo{WIDE}(at){WIDE}site{WIDE}({WIDE}dot{WIDE}){WIDE}org now", "email", "jo@site.org"),
        (f"host 192{WIDE}dot{WIDE}168 dot 0 dot 1", "ip", "192.168.0.1"),
        (f"one{WIDE}nine two{WIDE}dot{WIDE}one six eight dot zero dot one", "ip", "192.168.0.1"),
        (f"plus four{WIDE}nine one five one two three four five six", "phone", "+4915123456"),
        ("plus vier neun eins fünf eins zwei drei vier fünf sechs", "phone", "+4915123456"),
        ("plus quatre neuf un cinq un deux trois quatre cinq six", "phone", "+4915123456"),
        ("plus cuatro nueve uno cinco uno dos tres cuatro cinco seis", "phone", "+4915123456"),
        ("+44 20 double four 946 zero 958", "phone", "+4420449460958"),
        ("+44 twenty 79 46 09 58 1", "phone", "+4420794609581"),
        ("+44 twenty one 79 46 09 58", "phone", "+442179460958"),
        ("plus four nine, one five one, two three four five six", "phone", "+4915123456"),
        ("plus four nine\none five one\ntwo three four five six", "phone", "+4915123456"),
        ("jo arroba site punto es", "email", "jo@site.es"),
        ("jean arobase site point fr", "email", "jean@site.fr"),
        ("+৪৯ ১৫১ ২৩৪৫৬৭", "phone", "+49 151 234567"),
        ("+49 l51 23456O", "phone", "+49 151 234560"),
        ("call 192 . 168 . 0 . 1 now", "ip", "192.168.0.1"),
        ("mail jo_at_site_dot_org", "email", "jo@site.org"),
        ("jo77 at site dot org", "email", "jo77@site.org"),
        ("see jo.b at site dot org", "email", "jo.b@site.org"),
        ("contact: jo at site (dot) org!", "email", "jo@site.org"),
        ("Smith, jo at site dot org, London", "email", "jo@site.org"),
    ],
)
def test_wider_disguises(text, kind, value):
    found = pii.spans(text)
    assert [(k, v) for k, _, _, base_, v in found if not base_] == [(kind, value)]
    ((_, start, end, _, _),) = [s for s in found if not s[3]]
    assert not text[start].isspace() and not text[end - 1].isspace()


PROSE = [
    "meet us at example dot com", "we looked at acme dot org", "She laughed at every dot com boom.",
    "list 1. 2. 3. 4. ok", "one, two, three, four", "dix, six, huit et neuf", "in 2019. 5 people", "zero point un",
    "Ol O1l l0 IO", "a black_dot_size look_at_me", "six at the table, seven at home", "version 1 . 2 . 3",
    "uno dos tres", "double trouble twenty", "the null dot product one dot two",
]


def test_prose_gives_no_false_positives():
    found = {text: pii.spans(text) for text in PROSE}
    assert sum(map(bool, found.values())) == 0, found


@pytest.mark.parametrize(
    "unit", ["jo.b@site.org, ", "jo77 (at) site (dot) org, ", "one dot one ", "one two, ", "( at ", "1" + " " * 30, "O1", "a_at_"]
)
def test_time_in_proportion_to_the_length(unit):
    def took(count):
        times = []
        for _ in range(3):
            start = time.perf_counter()
            pii.spans(unit * count)
            times.append(time.perf_counter() - start)
        return min(times)

    assert took(16_000) < 12 * max(took(4_000), 0.002)  # four times as long; a square would take sixteen


def test_three_megabytes_of_addresses():
    text = "jo.bo@site.org, one nine two dot one six eight dot zero dot one; " * 46_000
    start = time.perf_counter()
    assert len(pii.spans(text)) == 92_000
    assert time.perf_counter() - start < 30  # 8 s; a square took a quarter of an hour

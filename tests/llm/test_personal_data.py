"""Base spans against the plain patterns; contexts on a planted corpus."""

import random
import re
import time

from tabwright.llm.personal_data import Settings, base_spans, luhn, mentions, personal_data
from tests.llm.cases import TEXTS, documents, empty, messy

MAIL = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
ADDRESS = re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")


def plain(text):
    def digits(m):
        return re.sub("[^0-9]", "", m.group())

    out = [("email", *m.span()) for m in MAIL.finditer(text)]
    out += [("ip", *m.span()) for m in ADDRESS.finditer(text) if all(int(x) <= 255 for x in m.group().split("."))]
    out += [("card", *m.span()) for m in CARD.finditer(text) if 16 <= len(digits(m)) <= 19 and luhn(digits(m))]
    return out + [("phone", *m.span()) for m in PHONE.finditer(text) if 8 <= len(digits(m)) <= 15]


def test_luhn():
    assert luhn("4111111111111111") and not luhn("4111111111111112") and luhn("0" * 16)


def test_random_texts():
    rng = random.Random(2)
    letters = [*"ab@@..--+ 0123456789()é_%\n", "4111 1111 1111 1111", "10.0.0.1", "+1 (555) 010-9999"]
    for _ in range(20000):
        text = "".join(rng.choices(letters, k=rng.randint(0, 30)))
        assert base_spans(text) == plain(text), repr(text)


def test_documents(spark, sf_dir):
    for _, text in documents(spark, sf_dir):
        assert base_spans(text) == plain(text)


def test_long_texts_take_linear_time():
    start = time.time()
    for text in ("a" * 10**6, "1" * 10**6, "1." * 10**6, "@" * 10**6, "a@" * 10**6, "+1 " * 10**6, "a." * 10**6 + "@"):
        mentions(text)
    assert time.time() - start < 60


def planted():
    rng = random.Random(3)
    filler = [f"w{chr(97 + k % 26)}{chr(97 + k // 26)}" for k in range(300)]

    def around(left, value, right):
        return " ".join([*rng.choices(filler, k=6), left, value, right, *rng.choices(filler, k=6)])

    rows = [(k, around("call me on", f"+1 555 010 {1000 + k}", "after work")) for k in range(12)]
    rows += [(20 + k, around("call me on", f"555-77{10 + k}", "after work")) for k in range(3)]  # no plus sign: not a base phone
    rows += [(30 + k, around("order number", f"99-{k}-17", "was shipped")) for k in range(5)]
    return rows


def test_contexts_find_unseen_identifiers(spark):
    rows = planted()
    found = {r.id: r.spans for r in personal_data(messy(spark, rows)).collect()}
    for i, text in rows:
        added = [(s.kind, text[s.start : s.end]) for s in found[i] if s.added]
        assert [(s.kind, s.start, s.end) for s in found[i] if not s.added] == plain(text)
        assert added == ([("phone", re.search(r"555-77\d\d", text).group())] if 20 <= i < 30 else []), text


def test_spaced_identifiers_are_one_candidate(spark):
    rows = [r for r in planted() if not 20 <= r[0] < 30]
    numbers = {60: "(017) 555-7713", 61: "017 555 7714", 62: "01.7 (555) 7715", 63: "37 828 224 631"}
    rows += [(i, f"wxa wxb call me on {number} after work wxc") for i, number in numbers.items()]
    found = {r.id: r.spans for r in personal_data(messy(spark, rows)).collect()}
    for i, text in rows:
        if i in numbers:
            assert [(s.kind, text[s.start : s.end]) for s in found[i]] == [("phone", numbers[i])], text


def test_one_word_labels(spark):
    """Only the word before, or only the word after, repeats; some identifiers begin or end their text."""
    rng = random.Random(9)

    def other():
        return "w" + "".join(rng.choices("abcdefghijklmnop", k=9))

    rows = [(k, f"{other()} {other()} phone: +1 555 010 {1000 + k} {other()} {other()}") for k in range(12)]
    rows += [(20 + k, f"{other()} {other()} {other()}{k}@mail.org writes {other()}") for k in range(12)]
    unseen = {40: ("phone", "555-7710"), 41: ("phone", "(017) 555-7711"), 42: ("phone", "555-7712"), 43: ("email", "jo.at@intern")}
    rows += [(40, f"{other()} phone: 555-7710 {other()}"), (41, f"{other()} {other()} Phone: (017) 555-7711 {other()}")]
    rows += [(42, "phone: 555-7712"), (43, f"jo.at@intern writes {other()}")]
    rows += [(50 + k, f"{other()} {other()} {100 + k} {other()}") for k in range(8)]
    found = {r.id: r.spans for r in personal_data(messy(spark, rows)).collect()}
    for i, text in rows:
        added = [(s.kind, text[s.start : s.end]) for s in found[i] if s.added]
        assert added == ([unseen[i]] if i in unseen else []), text


def test_a_number_that_mostly_stands_elsewhere_is_refused(spark):
    rng = random.Random(4)

    def other():
        return "w" + "".join(rng.choices("abcdefghijklmnop", k=9))

    rows = [(k, f"{other()} call +1555010{1000 + k} now {other()}") for k in range(20)]
    rows += [(100 + k, f"{other()} page 12 {other()} {other()}") for k in range(50)]
    rows += [(200, f"please call 12 times {other()}"), (201, f"{other()} call 555-7710 now {other()}"), (202, f"{other()} call 555-7711 now {other()} call 555-7711 {other()}")]
    found = {r.id: r.spans for r in personal_data(messy(spark, rows)).collect()}
    added = {i: [text[s.start : s.end] for s in found[i] if s.added] for i, text in rows}
    assert {i: v for i, v in added.items() if v} == {201: ["555-7710"], 202: ["555-7711", "555-7711"]}


def test_runs():
    def values(text):
        return [m["value"] for m in mentions(text) if m["kind"] is None]

    assert values("on (555 7713), or 555 77a 12. 13 (14") == ["555 7713", "555", "77a", "12", "13 (14"]
    assert values("(1) 2 a@b 3 4 1.2.3.4 5 6") == ["(1) 2", "a@b", "3 4", "5 6"]
    assert values("12 " * 40) == ["12"] * 40  # too long for one identifier: each group by itself


def test_few_seeds_prove_nothing(spark):
    found = personal_data(messy(spark, planted()), Settings(support=13)).collect()
    assert not any(s.added for r in found for s in r.spans)


def test_messy_rows(spark):
    rows = [*TEXTS, (40, "mail a.b@c.de or a.b@c.de"), (40, "mail a.b@c.de or a.b@c.de"), (None, "ip 1.2.3.4")]
    found = sorted(((r.id, [(s.kind, s.start, s.end) for s in r.spans]) for r in personal_data(messy(spark, rows)).collect()), key=repr)
    assert found == sorted(((i, plain(t or "")) for i, t in rows), key=repr)
    assert personal_data(empty(spark)).collect() == []

import re

import pytest
from pyspark.sql import functions as F

from tallybrook.llm import surrogates as s
from tests.llm.cases import COLUMNS, awkward, documents, empty

KEY = "test"


def found(text):
    return [(e.kind, text[e.start : e.end]) for e in s.entities(text)]


def test_what_is_found():
    text = (
        "Mail J.Doe@Mail7.example.com, call +1 (017) 555-7713, see 97.51.17.173. Pay 4539 1488 0343 6467 "
        "or GB82WEST12345698765432; 123-45-6789. Not 4539148803436468, 1.2.3.4.5, 300.1.1.1 or v1.2."
    )
    assert [k for k, _ in found(text)] == ["email", "phone", "ip", "card", "iban", "ssn"]


def test_permutation():
    for size in (1, 2, 7, 100):
        assert sorted(s.permuted(i, size, KEY, "t") for i in range(size)) == list(range(size))


def test_types_and_formats_stay():
    text = "a.b@mail7.example.com 97.51.17.173 192.168.0.7 4539-1488-0343-6467 GB82WEST12345698765432 +1 (017) 555-7713"
    new = s.replaced(text, KEY)
    assert [k for k, _ in found(new)] == [k for k, _ in found(text)]
    assert re.sub(r"[a-z]", "x", re.sub(r"\d", "9", new[:21])) == re.sub(r"[a-z]", "x", re.sub(r"\d", "9", text[:21])) or "@" in new
    assert not {v for _, v in found(text)} & {v for _, v in found(new)}
    assert "192.168." in new and re.search(r"\d{4}-\d{4}-\d{4}-\d{4}", new)
    assert s.replaced(text, KEY) == new != s.replaced(text, "other key")


def test_one_entity_has_one_surrogate():
    new = s.replaced("A.B@x.example.com a.b@x.example.com +1 (017) 555-7713 +1 017 5557713", KEY)
    first, second, *numbers = new.split(" ", 2)
    assert first.lower() == second and first[0].isupper()
    digits = re.sub(r"\D", "", numbers[0])
    assert digits[:11] == digits[11:]


def test_names_keep_gender_script_and_person():
    new = s.replaced("Mrs. Anna Miller and Mr. Miller met Иван Петров. Miller left.", KEY)
    title, given, family = new.split(" ")[:3]
    assert title == "Mrs." and given in s.GIVEN["latin", "f"] and family != "Miller"
    assert new.count(family) == 3
    assert re.search(r"met [А-ЯЁ]\w+ [А-ЯЁ]\w+\.", new)


def test_different_entities_stay_different():
    values = [f"u{i}@mail.example.com" for i in range(300)]
    assert len({s.surrogate("email", v, KEY) for v in values}) == 300
    cards = [d + str(-s.luhn(d + "0") % 10) for d in (f"4{i:014d}" for i in range(300))]
    new = [s.surrogate("card", v, KEY) for v in cards]
    assert len(set(new)) == 300 and all(s.luhn(v) % 10 == 0 for v in new)


def test_values_drawn_again_avoid_originals(spark):
    # All names of two letters: every first surrogate is someone's original.
    names = [c + v for c in "BCDFG" for v in "aeiou"]
    everyone = [("name-m", n, 1) for n in names] + [("name-m", s.surrogate("name-m", "Bodo", KEY), 1), ("name-m", "Bodo", 1)]
    table = spark.createDataFrame(everyone, "kind string, value string, at long")
    again = {(r["kind"], r["value"]): r["draw"] for r in s.drawn_again(table, KEY).collect()}
    assert again[("name-m", "Bodo")] >= 1
    new = [s.surrogate(k, v, KEY, again.get((k, v), 0)) for k, v, _ in everyone]
    assert len(set(new)) == len(everyone)


def test_nothing_drawn_again_without_a_clash(spark):
    table = spark.createDataFrame([("ssn", "123456789", 1)], "kind string, value string, at long")
    assert s.drawn_again(table, KEY) is None


def test_texts_of_values_drawn_again(spark):
    taken = s.surrogate("ssn", "123456789", KEY)
    other = f"{taken[:3]}-{taken[3:5]}-{taken[5:]}"
    docs = spark.createDataFrame([(1, "Is 123-45-6789."), (2, f"Has {other}."), (3, "None.")], "doc_id long, text string")
    rows = {r["doc_id"]: r["text"] for r in s.with_surrogates(docs, KEY).collect()}
    assert rows[3] == "None." and other not in rows[1] + rows[2]
    assert re.fullmatch(r"Is \d{3}-\d\d-\d{4}\.", rows[1]) and rows[1][3:-1] != rows[2][4:-1]


def test_documents(spark):
    docs = documents(spark)
    old = {r["doc_id"]: r["text"] for r in docs.collect()}
    out = s.with_surrogates(docs)
    assert out.columns == COLUMNS
    originals = {v for t in old.values() for _, v in found(t)}
    changed = 0
    for r in out.collect():
        assert r["n_chars"] == len(r["text"])
        if found(old[r["doc_id"]]):
            changed += 1
            assert not any(v in r["text"] for v in originals)
            assert [k for k, _ in found(r["text"])] == [k for k, _ in found(old[r["doc_id"]])]
        else:
            assert r["text"] == old[r["doc_id"]]
    assert changed


def test_awkward_rows(spark):
    docs = awkward(spark, ["at", "_at", "draws", "new"])
    out = s.with_surrogates(docs)
    assert out.columns == docs.columns and out.count() == docs.count()
    assert out.where(F.col("text").isNull()).count() == docs.where(F.col("text").isNull()).count()
    assert s.with_surrogates(empty(spark)).collect() == []


@pytest.mark.parametrize("text", ["@" * 10_000, "a." * 10_000, "1-" * 10_000, "9" * 20_000, "a@" * 5_000])
def test_long_junk_is_quick(text):
    assert s.entities(text) == []


def test_letters_whose_lower_case_is_longer():
    for text in ("write to ALİ.kaya@mail.com", "Mr AİBC Öz called", "İİ@İİ.com"):
        new = s.replaced(text, "k")
        assert len(new) == len(text)
    assert s.reshaped("AİBC", "k", "t")[1] == "İ"


@pytest.mark.parametrize("key", ["a", "b", "c"])
def test_no_listed_name_stays(key):
    for names in s.GIVEN.values():
        for draw in range(4):
            new = [s._name_part(n, key, draw) for n in names]
            assert sorted(new) == sorted(names)
            assert all(a != b for a, b in zip(names, new, strict=True))


def test_long_and_foreign_addresses():
    for mail in ("a.b.c.d.e.f.g.h.i.j.k@mail.com", "foo@bücher.de", "x@a.b.c.d.e.f.g.h.com", "y@shop.xn--p1ai", "q" * 80 + "@mail.com"):
        assert found(f"write to {mail} now") == [("email", mail)]
        assert mail not in s.replaced(f"write to {mail} now", KEY)


# What is written into the texts below, by kind; nothing here is taken from the module.
PLANTED = {
    "phone": [
        "+33 1 23 45 67 89", "+91 98765 43210", "555 123 4567", "555-123-4567", "(555) 123-4567", "0171 1234567",
        "13800138000", "+49 (0)30 1234567", "+1 (017) 555-7713", "+1.212.555.0198", "٠١٧١ ١٢٣٤٥٦٧",
    ],
    "iban": ["GB82 WEST 1234 5698 7654 32", "GB82WEST12345698765432", "DE89 3704 0044 0532 0130 00"],
    "card": ["3782 822463 10005", "4539 1488 0343 6467", "4539-1488-0343-6467", "378282246310005"],
    "ip6": ["2001:db8:85a3::8a2e:370:7334", "2001:0DB8:0000:0000:0008:0800:200C:417A", "fe80::1ff:fe23:4567:890a"],
    "ip": ["97.51.17.173"],
    "email": ["foo@bücher.de", "名前@会社.example.com", "ALİ.kaya@mail.com"],
}


@pytest.mark.parametrize("kind, value", [(k, v) for k, vs in PLANTED.items() for v in vs])
def test_planted_forms(kind, value):
    text = f"Before it AND {value} NOW then."
    assert found(text) == [(kind, value)]
    new = s.replaced(text, KEY)
    start, end = "Before it AND ", " NOW then."
    assert new.startswith(start) and new.endswith(end) and value not in new
    shown = new[len(start) : -len(end)]
    if kind != "ip":
        assert [re.sub(r"\w", "x", c) for c in shown] == [re.sub(r"\w", "x", c) for c in value] or kind == "ip6"
    assert found(new) == [(kind, shown)]


def test_ways_to_write_one_value_stay_one():
    pairs = [("GB82 WEST 1234 5698 7654 32", "GB82WEST12345698765432"), ("3782 822463 10005", "378282246310005"),
             ("2001:db8::8:800:200c:417a", "2001:0db8:0000:0000:0008:0800:200c:417a")]
    for a, b in pairs:
        one, other = s.replaced(f"{a} | {b}", KEY).split(" | ")
        if ":" in a:
            import ipaddress

            assert ipaddress.ip_address(one) == ipaddress.ip_address(other) != ipaddress.ip_address(a)
        else:
            assert one.replace(" ", "") == other != b


@pytest.mark.parametrize(
    "text",
    ["At 12:30:45 or 1:2:3 std::vector a::b ratio 4:3.", "In 2019 10 20 and 100 200 300 of 1 234 567 890 items.",
     "Version 1.2.3.4.5, pages 123-4567, 2024-05-17, ISBN 978-3-16-148410-0.", "ID AB12 WORD THIS IS NOT ONE",
     "Order 4539148803436468 and 20240517123045."],
)
def test_other_numbers_stay(text):
    assert s.replaced(text, KEY) == text


def test_names_with_marks():
    for name in ("Mr O'Brien", "Ms Smith-Jones", "Dr Núñez", "Mr Łukasz Żak", "Herr Çelik"):
        title, rest = name.split(" ", 1)
        new = s.replaced(f"Then {name} left.", KEY)
        assert new.startswith(f"Then {title} ") and rest not in new
        assert re.sub(r"\w", "x", new) == re.sub(r"\w", "x", f"Then {name} left.")


def test_a_family_name_drawn_again_is_one(spark):
    # "Smith" is drawn again since its first surrogate is someone's name; with it go all its uses.
    taken = s.surrogate("name", "Smith", KEY)
    texts = ["Mr John Smith wrote.", "Dr Smith wrote.", f"Ms {taken} wrote.", "Mrs Anna Smith wrote. Smith did."]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    rows = {r["doc_id"]: r["text"] for r in s.with_surrogates(docs, KEY).collect()}
    family = re.fullmatch(r"Dr (\w+) wrote\.", rows[1])[1]
    assert family not in ("Smith", taken) and rows[0].split()[2] == family
    assert rows[3].split()[2] == family == rows[3].split()[4]
    assert taken not in " ".join(rows.values()) and rows[2].split()[1] != family


def test_a_full_format_ends(spark):
    # Every name of the form consonant, vowel: none is free, so the first draws stay, all different.
    names = [c.upper() + v for c in s.LETTERS[1] for v in s.LETTERS[0]]
    everyone = [("name", n, 1) for n in names] + [("name", "John", 1), ("ssn", "123456789", 1)]
    table = spark.createDataFrame(everyone, "kind string, value string, at long")
    again = s.drawn_again(table, KEY)
    assert again is None or not set(names) & {r["value"] for r in again.collect()}
    assert sorted(s.surrogate("name", n, KEY) for n in names) == sorted(names)


def test_formats_of_surrogates_are_those_of_originals():
    values = [("email", "a.b@mail.example.com"), ("card", "4539148803436467"), ("ip", "97.51.17.173"), ("ssn", "123456789"),
              ("ip6", "2001:0db8:0000:0000:0008:0800:200c:417a"), ("iban", "GB82WEST12345698765432"),
              ("phone", "33+123456789"), ("name", "Smith")]
    for kind, value in values:
        for draw in range(3):
            assert s.format_of(kind, s.surrogate(kind, value, KEY, draw)) == s.format_of(kind, value)


def test_numbers_beside_each_other():
    assert found("+1 (826) 555-4081 190.137.2.7 x") == [("phone", "+1 (826) 555-4081"), ("ip", "190.137.2.7")]
    assert found("+33 1 23 45 67 89 4539 1488 0343 6467") == [("phone", "+33 1 23 45 67 89"), ("card", "4539 1488 0343 6467")]
    assert found("+1 212 555 0198 77 people") == [("phone", "+1 212 555 0198")]

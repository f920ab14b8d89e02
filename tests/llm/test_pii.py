from __future__ import annotations

import re

import pytest

from sluice.llm.pii import FIRST_NAMES, Surrogates, collisions, iban, luhn, pseudonymise, replaced, spans
from sluice.llm.queries import DEMO_KEY

from .cases import awkward, awkward_rows, nothing

KEY = b"a key of enough bytes"
ONE = Surrogates(KEY)


def test_types_and_forms():
    cases = {
        "email": ("Joe.Doe-77@mail5.example.com", r"[A-Z][a-z]{2}\.[A-Z][a-z]{2}-\d\d@[a-z]{4}\d\.[a-z]{7}\.com"),
        "phone": ("+1 (743) 555-3824", r"\+1 \(\d{3}\) \d{3}-\d{4}"),
        "ip": ("233.233.171.252", r"(?:\d{1,3}\.){3}\d{1,3}"),
        "card": ("4111 1111 1111 1111", r"(?:\d{4} ){3}\d{4}"),
        "ssn": ("123-45-6789", r"\d{3}-\d\d-\d{4}"),
        "iban": ("DE89 3704 0044 0532 0130 00", r"DE\d\d (?:\d{4} ){4}\d\d"),
        "secret": ("333d5d5b767fa42c7d1f6b009b99b44ac76c0fe2", r"[0-9a-f]{40}"),
    }
    for kind, (value, form) in cases.items():
        text = f"before {value}, after {value}"
        found = spans(text, ONE)
        assert [f[2] for f in found] == [kind, kind], kind
        assert {f[3] for f in found} == {value} and len({f[4] for f in found}) == 1
        new = found[0][4]
        assert re.fullmatch(form, new) and new != value
        assert replaced(text, found) == f"before {new}, after {new}"
    assert luhn(ONE.of("card", "4111 1111 1111 1111")) and not luhn(ONE.of("card", "4111 1111 1111 1112"))
    assert iban(ONE.of("iban", "DE89 3704 0044 0532 0130 00").replace(" ", ""))


def test_coreference_over_forms_and_documents():
    digits = {re.sub(r"\D", "", ONE.of("phone", p))[-10:] for p in ("+1 (743) 555-3824", "+1 743 555 3824", "743-555-3824")}
    assert len(digits) == 1
    assert ONE.of("card", "4111 1111 1111 1111").replace(" ", "") == ONE.of("card", "4111111111111111")
    assert Surrogates(KEY).of("email", "a.b@c.de") == ONE.of("email", "a.b@c.de")
    assert Surrogates(b"another key, also long").of("email", "abc.def@ghij.de") != ONE.of("email", "abc.def@ghij.de")
    text = "Mr. John Smith wrote. Dr. Smith and Anna Müller answered Frau Müller."
    found = spans(text, ONE)
    names = {}
    for _, _, kind, old, new in found:
        assert kind == "name" and names.setdefault(old, new) == new
    assert set(names) == {"John", "Smith", "Anna", "Müller"} and len(set(names.values())) == 4


def test_names_keep_gender_script_and_case():
    for (script, gender), names in FIRST_NAMES.items():
        new = [ONE.of("name", n) for n in names]
        assert sorted(new) == sorted(names), (script, gender)
    new = ONE.of("name", "Иванова")
    assert new != "Иванова" and re.fullmatch("[А-Я][а-я]{5}а", new)
    assert re.fullmatch("[A-Z][a-z]+", ONE.of("name", "Smith"))


@pytest.mark.parametrize("key", [KEY, DEMO_KEY, *(bytes([i]) * 16 for i in range(20))])
def test_no_known_name_stays(key):
    surrogates = Surrogates(key)
    for names in FIRST_NAMES.values():
        new = [surrogates.of("name", n) for n in names]
        assert all(a != b for a, b in zip(names, new)) and sorted(new) == sorted(names)


def test_the_query_tells_of_collisions_and_goes_on(spark, monkeypatch, caplog):
    from sluice.llm.queries import QUERIES

    assert QUERIES["op5_pii"](spark, "/root/testdata/sf0.01").filter("n_entities > 0").count() > 0
    kind = "doc_id long, text string, n_entities long, entities array<struct<type:string,original:string,surrogate:string>>"
    mixed = spark.createDataFrame([(1, "9", 2, [("ssn", "1", "9"), ("ssn", "2", "9")])], kind)
    monkeypatch.setattr("sluice.llm.queries.pseudonymise", lambda *_: mixed)
    assert QUERIES["op5_pii"](spark, "/root/testdata/sf0.01").count() == 1
    assert "several originals" in caplog.text
    same = spark.createDataFrame([(1, "9", 1, [("ssn", "9", "9")])], kind)
    monkeypatch.setattr("sluice.llm.queries.pseudonymise", lambda *_: same)
    with pytest.raises(RuntimeError, match="its own surrogate"):
        QUERIES["op5_pii"](spark, "/root/testdata/sf0.01")


def test_the_query_against_a_plain_reading(spark):
    """What a reader of the results alone can tell: the text around entities, their forms, who is who."""
    from sluice.llm.queries import QUERIES

    sf = "/root/testdata/sf0.01"
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    results = {r.doc_id: r for r in QUERIES["op5_pii"](spark, sf).collect()}
    assert set(results) == set(texts)
    mail, address = re.compile(r"[\w.+-]+@[\w-]+(?:\.[\w-]+)*\.[a-z]+"), re.compile(r"\b\d{1,3}(?:\.\d{1,3}){3}\b")
    ssn, titled = re.compile(r"\b\d{3}-\d\d-\d{4}\b"), re.compile(r"\b(?:Dr|Mr|Mrs|Frau|Herr)\.? ([A-Z]\w+)")
    new_of: dict[str, set] = {}
    seen = 0
    for doc, text in texts.items():
        text, new = text or "", results[doc].text or ""
        for pattern in (mail, address, ssn, titled):
            old = [m[pattern.groups] for m in pattern.finditer(text)]
            now = [m[pattern.groups] for m in pattern.finditer(new)]
            assert len(old) == len(now)
            for a, b in zip(old, now):
                assert a != b and a not in new
                new_of.setdefault(a, set()).add(b)
            seen += len(old)
        if results[doc].n_entities == 0:
            assert new == text
        # letters and digits may change, all other signs stay in their order
        assert re.sub(r"\w", "", new) == re.sub(r"\w", "", text)
    assert seen > 30 and all(len(v) == 1 for v in new_of.values())
    assert len({next(iter(v)) for v in new_of.values()}) == len(new_of)


KEYS = [DEMO_KEY, *(bytes([i]) * 16 for i in range(20))]


@pytest.mark.parametrize("key", KEYS)
def test_no_short_name_or_local_part_stays(key):
    surrogates = Surrogates(key)
    letters = "abcdefghijklmnopqrstuvwxyz"
    for names in ([a.upper() + b for a in letters for b in letters], [a.upper() + b + "r" for a in letters for b in letters]):
        names = [n for n in names if n not in ("Mr", "Dr")]
        new = [surrogates.of("name", n) for n in names]
        assert all(a.lower() != b.lower() for a, b in zip(names, new)) and len(set(new)) == len(new)
    for local in (*letters, "0", "7"):
        assert surrogates.of("email", f"{local}@x.com")[0] != local
    assert surrogates.of("email", "w@x.com").split("@")[1] != "x.com"


def test_every_letter_of_a_local_part_may_change():
    new = ONE.of("email", "иван.петров@mail.ru").split("@")[0]
    assert new != "иван.петров" and re.fullmatch("[а-яё]{4}[.][а-яё]{6}", new)
    for local in ("żółć", "đorđe", "東京", "عمر"):
        new = ONE.of("email", f"{local}@mail.ru").split("@")[0]
        assert new != local and len(new) == len(local)
    assert "Har" not in replaced("Dr. Har wrote.", spans("Dr. Har wrote.", Surrogates(DEMO_KEY)))


@pytest.mark.parametrize("key", KEYS)
def test_names_in_capitals_and_known_names_do_not_meet(spark, key):
    surrogates = Surrogates(key)
    words = [f"{a}{b}{c}A" for a in "HJKLMNR" for b in "AEIO" for c in "ZSTLN"] + [n.upper() for n in FIRST_NAMES["latin", "f"]]
    new = [surrogates.of("name", w) for w in words] + [surrogates.of("name", n) for n in FIRST_NAMES["latin", "f"]]
    old = [w.lower() for w in words] + [n.lower() for n in FIRST_NAMES["latin", "f"]]
    of: dict[str, set] = {}
    for a, b in zip(old, new):
        of.setdefault(b.lower(), set()).add(a)
    assert all(len(v) == 1 for v in of.values())
    assert surrogates.of("name", "JULIA") == surrogates.of("name", "Julia").upper()


def test_one_pair_does_not_stop_a_corpus(spark):
    from sluice.llm.pii import checked

    docs = spark.createDataFrame([(1, "Dr. HEZA wrote."), (2, "Julia Smith came.")], "doc_id int, text string")
    rows = checked(pseudonymise(docs, DEMO_KEY)).collect()
    assert sorted(r.n_entities for r in rows) == [1, 2]


@pytest.mark.parametrize("size", [2, 3, 10, 1000])
def test_permutations(size):
    new = [ONE.permuted("x", i, size) for i in range(size)]
    assert sorted(new) == list(range(size)) and [ONE.permuted("x", n, size, back=True) for n in new] == list(range(size))
    for start in range(min(size, 20)):
        order = list(ONE.following("x", start, size))
        assert sorted(order) == list(range(size)) and order[-1] == start


def test_distinct_entities_stay_distinct():
    kinds = {
        "ssn": [f"{i:03d}-{j:02d}-0001" for i in range(100, 140) for j in range(50)],
        "email": [f"{a}{b}.{i}@x.org" for a in "abcdefg" for b in "hijklmn" for i in range(10, 50)],
        "ip": [f"10.{i}.{j}.1" for i in range(40) for j in range(40)],
        "name": [f"{a}{b}{c}n" for a in "BCDFG" for b in "aeiou" for c in "bcdfghklmn"],
    }
    for kind, values in kinds.items():
        assert len({ONE.of(kind, v) for v in values}) == len(values), kind
        assert not {ONE.of(kind, v) for v in values} & {v for v in values if ONE.of(kind, v) == v}


@pytest.mark.parametrize(
    "number",
    "030 1234567|01 23 45 67 89|01.23.45.67.89|91 123 45 67|612 34 56 78|612 345 678|212 555 1234|1-800-555-0199|"
    "1 (800) 555-0199|(020) 7946 0958|020 7946 0958|0049 30 1234567|0049301234567|+33 1 23 45 67 89|030/1234567|"
    "0171-1234567|0612345678|(030) 123 45 67".split("|"),
)
def test_national_phone_numbers(number):
    text = f"Call {number}, or {number}."
    found = spans(text, ONE)
    assert [f[2:4] for f in found] == [("phone", number)] * 2
    new = found[0][4]
    assert new != number and re.sub(r"\d", "0", new) == re.sub(r"\d", "0", number) == re.sub(r"\d", "0", found[1][4])


def test_a_phone_number_is_the_same_with_either_prefix():
    forms = ["+49 30 1234567", "0049 30 1234567", "+49301234567", "0049301234567"]
    assert len({re.sub(r"\D", "", ONE.of("phone", f))[-9:] for f in forms}) == 1
    assert spans("0054994038693466", ONE)[0][2] == "card"
    assert len({re.sub(r"\D", "", ONE.of("phone", f))[-10:] for f in ("1-800-555-0199", "+1 800 555 0199")}) == 1


@pytest.mark.parametrize(
    "address", ["2001:db8::8a2e:370:7334", "2001:0db8:85a3:0000:0000:8a2e:0370:7334", "2001:DB8:0:0:8:800:200C:417A", "fe80::1"]
)
def test_ipv6(address):
    from ipaddress import IPv6Address

    found = spans(f"from {address}, to [{address}]:80", ONE)
    assert [f[2:4] for f in found] == [("ip", address)] * 2
    new = found[0][4]
    assert IPv6Address(new) != IPv6Address(address) and ("::" in new) == ("::" in address)
    assert IPv6Address(ONE.of("ip", IPv6Address(address).exploded)) == IPv6Address(new)
    assert spans("at 10:30:15 x[1::2] abc::def std::a ::1 12:30", ONE) == []


def test_every_mention_of_a_found_name_goes():
    text = "Smith-Jones met Dr. Smith. Later Smith agreed, SMITH's and (Smith) too; Smithers did not. Anna Müller: Anna."
    found = spans(text, ONE)
    new = replaced(text, found)
    assert not re.search(r"(?i)\bSmith\b|\bMüller\b|\bAnna\b", new) and "Smithers" in new and "Jones" in new
    assert len({f[4].lower() for f in found if f[3].lower() == "smith"}) == 1
    assert sum(f[3].lower() == "smith" for f in found) == 5 and found == sorted(found)
    mail = "Dr. Smith <Smith@x.org> Smith"
    assert [f[2] for f in spans(mail, ONE)] == ["name", "email", "name"]


@pytest.mark.parametrize(
    "text",
    ["on 01.02.2020 10:30", "01/02/2020", "01-02-2020 at 12", "1 234 567 890", "0.12 34 56 78 90", "12 345 678", "2020 10 12", "000123"],
)
def test_numbers_that_are_no_phone_numbers(text):
    assert spans(text, ONE) == []


@pytest.mark.parametrize(
    "text",
    ["version 1.2.3.4.5", "on 2020-01-02 at 10:30", "call 12 34", "The Ines of", "a@b", "1,234,567.89", "room 555-1234", ""],
)
def test_clean_texts_are_left_alone(text):
    assert spans(text, ONE) == []


def test_pseudonymise(spark):
    docs = awkward(spark)
    done = pseudonymise(docs, KEY)
    assert done.columns == [*docs.columns, "n_entities", "entities"]
    rows = done.collect()
    assert len(rows) == len(awkward_rows()) and all(r.n_entities == len(r.entities) for r in rows)
    assert sum(r.text is None for r in rows) == sum(t[1] is None for t in awkward_rows())
    assert pseudonymise(nothing(spark), KEY).count() == 0
    with pytest.raises(ValueError):
        pseudonymise(docs, b"short")


def test_given_documents_keep_nothing_and_mix_up_nothing(spark):
    docs = spark.read.parquet("/root/testdata/sf0.1/documents.parquet")
    done = pseudonymise(docs, KEY).filter("n_entities > 0")
    assert collisions(done).count() == 0
    rows = done.select("text", "entities").collect()
    assert len(rows) > 500
    for row in rows:
        for e in row.entities:
            assert e.original not in row.text and e.surrogate in row.text


def test_collisions_are_seen(spark):
    rows = [([("ssn", "1", "9"), ("ssn", "2", "9"), ("ip", "1", "9")],), ([("ssn", "3", "8"), ("ssn", "3", "8")],)]
    table = spark.createDataFrame(rows, "entities array<struct<type:string,original:string,surrogate:string>>")
    assert [tuple(r) for r in collisions(table).collect()] == [("ssn", "9", 2)]

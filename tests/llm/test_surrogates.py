import random
import re

import pytest

from shruti.llm import surrogates as s

from .corpora import clashing, documents, plain, unharmed

KEY = b"test key"


def luhn_ok(number):
    digits = [int(c) for c in number if c.isdigit()]
    return s.luhn(digits[:-1]) == digits[-1]


def person(seed):
    r = random.Random(seed)
    d = lambda n: "".join(r.choice("0123456789") for _ in range(n))
    body = "4" + d(14)
    return {
        "email": f"{''.join(r.choice('abcdefgh') for _ in range(r.randrange(1, 9)))}.{d(2)}@mail{d(1)}.{r.choice(['example.com', 'web.org', 'foo.co'])}",
        "phone": f"+1 ({r.randrange(2, 10)}{d(2)}) 555-{d(4)}", "ip": f"{r.randrange(1, 224)}.{r.randrange(256)}.{r.randrange(256)}.{r.randrange(1, 255)}",
        "card": body + str(s.luhn([int(c) for c in body])), "ssn": f"{d(3)}-{d(2)}-{d(4)}",
    }


def test_everything_planted_goes_and_nothing_else_changes():
    z = s.Surrogates(KEY)
    for seed in range(300):
        p = person(seed)
        text = "Before " + ", then ".join(p.values()) + " after. Wh ndle the 12 of 3.5."
        new, spans, _ = z.replace(text)
        for v in p.values():
            assert v not in new, (v, new)
        assert sorted(k for *_, k in spans) == sorted(p)
        shape = lambda t: re.sub(r"[a-z]", "a", re.sub(r"\d+", "0", t))
        assert shape(new.split("then")[0]) == shape(text.split("then")[0]) and new.endswith(" after. Wh ndle the 12 of 3.5.") and new.startswith("Before ")


def test_formats_are_kept():
    z = s.Surrogates(KEY)
    for seed in range(300):
        p = person(seed)
        card = z.of("card", p["card"])
        assert luhn_ok(card) and card[0] == "4" and len(card) == 16
        assert re.fullmatch(r"\+1 \([2-9]\d\d\) \d{3}-\d{4}", z.of("phone", p["phone"]))
        assert all(0 <= int(x) <= 255 for x in z.of("ip", p["ip"]).split("."))
    iban = z.of("iban", "DE89 3704 0044 0532 0130 00")
    assert re.fullmatch(r"DE\d\d( \d{4}){4} \d\d", iban) and s._valid("iban", iban) and iban != "DE89 3704 0044 0532 0130 00"
    assert z.of("ip", "192.168.1.7").startswith("192.168.") and z.of("ip", "10.1.2.3").startswith("10.1.")


def test_coreference():
    z = s.Surrogates(KEY)
    assert z.of("email", "Bob.Fry@Mail.org").lower() == z.of("email", "bob.fry@mail.org")
    a, b = z.of("phone", "+1 (988) 555-2485"), z.of("phone", "988-555-2485")
    assert s.canonical("phone", a) == s.canonical("phone", b)
    new, *_ = z.replace("Mrs. Anna Schmidt met John Miller. Schmidt smiled; Miller did not.")
    m = re.fullmatch(r"Mrs\. (\w+) (\w+) met (\w+) (\w+)\. (\w+) smiled; (\w+) did not\.", new)
    assert m[2] == m[5] and m[4] == m[6] and m[1] in s.FIRST_NAMES["latin", "f"] and m[3] in s.FIRST_NAMES["latin", "m"]
    assert {m[1], m[2], m[3], m[4]}.isdisjoint({"Anna", "Schmidt", "John", "Miller"})
    assert s.Surrogates(b"other key").of("email", "bob.fry@mail.org") != z.of("email", "bob.fry@mail.org")


def test_first_names_alone_and_phones_however_written():
    z = s.Surrogates(KEY)
    new, spans, _ = z.replace("John Miller met us. John left; Johnson and Mary stayed. Miller, John")
    m = re.fullmatch(r"(\w+) (\w+) met us\. (\w+) left; Johnson and Mary stayed\. (\w+), (\w+)", new)
    assert m[1] == m[3] == m[5] != "John" and m[2] == m[4] != "Miller" and len(spans) == 5
    for code, ways in {"1": ["+15551234567", "+1 555 123 4567", "+1 (555) 123-4567", "+1-555-123-4567", "555-123-4567"], "44": ["+442079460958", "+44 20 7946 0958", "+44 (0)20 7946 0958", "+4420 7946 0958"]}.items():
        images = [z.replace(f"call {w} now")[0][5:-4] for w in ways]
        assert len({s.canonical("phone", i) for i in images}) == 1, images
        assert len({s.canonical("phone", w) for w in ways}) == 1 and set(images).isdisjoint(ways)
        assert all(i.startswith("+" + code) for i, w in zip(images, ways) if w[0] == "+")


def test_script_and_gender():
    new, spans, _ = s.Surrogates(KEY).replace("Госпожа Иванова и Анна Петрова")
    assert len(spans) == 3 and all(0x400 <= ord(c) < 0x500 or c == " " for c in new)
    for group, names in s.FIRST_NAMES.items():
        images = {s.Surrogates(KEY).first_name(n) for n in names}
        assert images == set(names), group


@pytest.mark.parametrize("radices", [[10], [2], [3, 5], [10] * 3, [8, 10, 10], [26, 10, 5, 1]])
def test_permutations_have_no_fixed_point(radices):
    from itertools import product

    p = s.Permutation(KEY)
    images = {x: tuple(p("t", list(x), radices)) for x in product(*map(range, radices))}
    assert len(set(images.values())) == len(images) and all(a != b for a, b in images.items())


def test_numbers_are_injective():
    z = s.Surrogates(KEY)
    cards = {body + str(s.luhn([int(c) for c in body])) for body in (f"4{i:014d}" for i in range(3000))}
    assert len({z.of("card", c) for c in cards}) == len(cards)
    emails = {f"{a}{b}@x.org" for a in "abcdefghijklmnopqrstuvwxyz" for b in range(100)}
    assert len({z.of("email", e) for e in emails}) == len(emails)


def test_what_is_left_alone():
    z = s.Surrogates(KEY)
    for text in ("Version 1.2.3 of 2024-01-02", "4041894974608796 has a wrong check digit", "token=7f4041894974608795ab", "999.1.1.1", "a @ b", "1.2.3.4.5", "", "___@___", "10000000"):
        assert z.replace(text)[0] == text, text


def test_columns_pass_and_rows_stay(spark):
    df, rows = documents(spark)
    some = spark.createDataFrame([(7000 + i, "call " + " ".join(person(i).values()), "en", "s", 1) for i in range(40)], df.schema)
    all_rows = clashing(df.unionByName(some))
    out = s.pseudonymise(all_rows, KEY)
    assert out.columns == all_rows.columns and unharmed(out)
    before, after = {r.doc_id: r for r in some.collect()}, {r.doc_id: r for r in out.collect()}
    assert plain(out.where("doc_id < 7000"), "doc_id", "text", "lang") == plain(df.where("doc_id < 7000"), "doc_id", "text", "lang")
    assert all(after[i].text != before[i].text for i in before)
    assert after[9001].text is None
    digest = {r.doc_id: r for r in s.digest(all_rows, KEY).collect()}
    assert digest[9001].text == "" and digest[9001].n_entities == 0 and digest[7000].n_entities == 5 and digest[7000].text == after[7000].text
    assert s.collisions(all_rows, KEY).count() == 0
    assert s.pseudonymise(df.limit(0), KEY).count() == 0


def test_collisions_stop_the_operator(spark, monkeypatch):
    pair = spark.createDataFrame([("email", "x@y.org", 2)], "kind string, surrogate string, n long")
    df = spark.createDataFrame([(1, "a")], "doc_id long, text string")
    s.confirm(df, KEY)
    monkeypatch.setattr(s, "collisions", lambda *a: pair)
    with pytest.raises(ValueError, match="collide"):
        s.digest(df, KEY)

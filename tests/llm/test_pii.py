import datetime
import re

import pytest
from pyspark.sql import functions as F

from tillwise.llm import pii


def hide(make, texts, key="k"):
    rows = pii.pseudonymise(make(list(enumerate(texts)), extra=True), key).collect()
    return {r.doc_id: (r.text, r.found) for r in rows}


def luhn(digits):
    odd = [int(c) for c in digits[::-1]]
    return (sum(odd[::2]) + sum(sum(divmod(2 * d, 10)) for d in odd[1::2])) % 10


def iban_rest(text):
    plain = text.replace(" ", "")
    return int("".join(str(int(c, 36)) for c in plain[4:] + plain[:4])) % 97


def test_values_keep_their_form_and_checks(make):
    got = hide(make, [
        "card 4041894974608795 and 4041 8949 7460 8795 not 4041894974608796", "born 1984-02-29, 02/29/1984 or 29.02.1984 not 1985-02-29",
        "GB82WEST12345698765432 or GB82 WEST 1234 5698 7654 32 not GB83WEST12345698765432", "42.144.35.254 not 342.1.1.1 or 1.2.3 or 01.2.3.4",
        "ssn 123-45-6789 not 666-45-6789 or 123-00-6789", "Call +1 (988) 555-2485, (988) 555-2485.", "bosbt.42@mail8.example.com, Bosbt.42@mail8.example.com",
    ])
    card = re.fullmatch(r"card (4\d{15}) and (4\d{3} \d{4} \d{4} \d{4}) not 4041894974608796", got[0][0])
    assert card[1] == card[2].replace(" ", "") != "4041894974608795" and luhn(card[1]) == 0
    born = re.fullmatch(r"born (\d{4}-\d\d-\d\d), (\d\d/\d\d/\d{4}) or (\d\d\.\d\d\.\d{4}) not 1985-02-29", got[1][0])
    days = {datetime.datetime.strptime(born[i], f).date() for i, f in ((1, "%Y-%m-%d"), (2, "%m/%d/%Y"), (3, "%d.%m.%Y"))}
    assert len(days) == 1 and days != {datetime.date(1984, 2, 29)}
    account = re.fullmatch(r"(GB\d\d[A-Z]{4}\d{14}) or (GB\d\d [A-Z]{4} \d{4} \d{4} \d{4} \d\d) not GB83WEST12345698765432", got[2][0])
    assert account[1] == account[2].replace(" ", "") and iban_rest(account[1]) == 1
    address = re.fullmatch(r"(\S+) not 342.1.1.1 or 1.2.3 or 01.2.3.4", got[3][0])[1]
    assert address != "42.144.35.254" and all(0 <= int(o) <= 255 for o in address.split("."))
    assert re.fullmatch(r"ssn (?!123-45)\d{3}-\d\d-\d{4} not 666-45-6789 or 123-00-6789", got[4][0])
    phones = re.fullmatch(r"Call \+1 (\(\d{3}\) \d{3}-\d{4}), (\(\d{3}\) \d{3}-\d{4})\.", got[5][0])
    assert phones[1] == phones[2] != "(988) 555-2485"
    assert re.fullmatch(r"([a-z]{5}\.\d\d)@mail8.example.com, [A-Z][a-z]{4}\.\d\d@mail8.example.com", got[6][0])
    assert [found for _, found in got.values()] == [["card"] * 2, ["date"] * 3, ["iban"] * 2, ["ip"], ["ssn"], ["phone"] * 2, ["email"] * 2]


def test_equal_values_stay_linked_and_keys_differ(make):
    texts = [f"mail {i % 5}ann.b@x.org and {10 + i % 5}.0.0.1" for i in range(20)]
    one, two = hide(make, texts), hide(make, texts, "other")
    assert all(one[i][0] == one[i % 5][0] for i in one) and len({t for t, _ in one.values()}) == 5
    assert all(one[i][0] != two[i][0] for i in one)


@pytest.mark.parametrize("radices", [(10, 10, 10), (7, 13, 5), (26,), (2, 898)])
def test_feistel_is_a_permutation(spark, radices):
    columns = [F.explode(F.sequence(F.lit(0), F.lit(r - 1))).alias(f"v{i}") for i, r in enumerate(radices)]
    every = spark.range(1)
    for column in columns:
        every = every.select("*", column)
    vector = F.array(*[F.struct(F.col(f"v{i}").alias("v"), F.lit(r).alias("radix")) for i, r in enumerate(radices)])
    out = {tuple(r[0]) for r in every.select(pii.feistel(vector, F.lit("t"), "k")).collect()}
    size = 1
    for r in radices:
        size *= r
    assert len(out) == size and all(0 <= v < r for row in out for v, r in zip(row, radices))


def test_every_day_has_its_own_day(spark):
    days = spark.range(146097).select(F.expr("date_add(date'1800-01-01', cast(id as int))").cast("string").alias("text"), F.col("id").alias("doc_id"))
    got = pii.pseudonymise(days, "k")
    assert got.filter("size(found) = 1").select("text").distinct().count() == 146097


def test_messy_rows(messy, none):
    got = pii.pseudonymise(messy, "k").collect()
    texts = {r.doc_id: r.text for r in messy.collect()}
    assert len(got) == 12 and all(r.text == texts[r.doc_id] and r.found == [] for r in got)
    assert pii.pseudonymise(none, "k").count() == 0


def test_very_long_text(make):
    text = "x " * 100_000 + "a.b@c.de" + " y" * 100_000
    assert hide(make, [text])[0][0].count("@c.de") == 1 and "a.b@" not in hide(make, [text])[0][0]


def plain_feistel(values, radices, tweak, key):
    """Eight rounds over two halves, number by number."""
    import hashlib

    half = len(values) // 2
    left, right = list(zip(values, radices))[:half], list(zip(values, radices))[half:]
    for turn in range(1, 9):
        known = ",".join(str(v) for v, _ in right)
        stream = hashlib.sha256("|".join([key, tweak, str(turn), known]).encode()).hexdigest()
        left, right = right, [((v + int(stream[i % 16 * 4 : i % 16 * 4 + 4], 16)) % r, r) for i, (v, r) in enumerate(left)]
    return [v for v, _ in left + right]


def plain_text(kind, text, key):
    """Letters and digits of a text permuted among letters of their case and digits."""
    moving = [c for c in text if c.isalnum()]
    base = [48 if c.isdigit() else 97 if c.islower() else 65 for c in moving]
    radices = [10 if c.isdigit() else 26 for c in moving]
    new = iter(plain_feistel([ord(c) - b for c, b in zip(moving, base)], radices, f"{kind}{len(moving)}", key))
    written = iter(chr(b + n) for b, n in zip(base, new))
    return "".join(next(written) if c.isalnum() else c for c in text)


def test_values_are_those_of_a_plain_feistel_network(make):
    names = ["bosbt.42", "A", "ann_b.C-9", "x1y2z3"]
    days = [datetime.date(1800, 1, 1), datetime.date(1984, 2, 29), datetime.date(2199, 12, 31)]
    cards = ["4041894974608795", "5500005555555559", "340000000000009"]
    accounts = ["GB82WEST12345698765432", "DE89370400440532013000"]
    texts = [f"{n}@x.org" for n in names] + [str(d) for d in days] + cards + accounts
    hidden = hide(make, texts, "secret")
    got = [hidden[i][0] for i in range(len(texts))]
    want = [f"{plain_text('email', n, 'secret')}@x.org" for n in names]
    for day in days:
        a, b = plain_feistel(divmod((day - datetime.date(1800, 1, 1)).days, 773), (189, 773), "date2", "secret")
        want.append(str(datetime.date(1800, 1, 1) + datetime.timedelta(a * 773 + b)))
    for card in cards:
        body = card[0] + plain_text("card", card[1:-1], "secret")
        want.append(next(body + d for d in "0123456789" if luhn(body + d) == 0))
    for account in accounts:
        rest = plain_text("iban", account[4:], "secret")
        want.append(next(f"{account[:2]}{c:02}{rest}" for c in range(2, 99) if iban_rest(f"{account[:2]}{c:02}{rest}") == 1))
    assert got == want

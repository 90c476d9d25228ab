from __future__ import annotations

import datetime
import hashlib
import itertools
import re

import pytest
from pyspark.sql import functions as F

from lakeloom.llm import pseudonyms
from tests.llm.data import awkward, documents, nothing

KEY = "k"


def digest(kind, turn, half):
    return hashlib.sha256(f"{KEY}|{kind}|{turn}|{half}".encode()).hexdigest()


def slow_text(value, kind, classes):
    def shift(part, code):
        out = ""
        for j, c in enumerate(part):
            amount = int(code[(j % 32) * 2 : (j % 32) * 2 + 2], 16)
            for low, high in classes:
                if low <= c <= high:
                    size = ord(high) - ord(low) + 1
                    c = chr((ord(c) - ord(low) + amount) % size + ord(low))
                    break
            out += c
        return out

    half = len(value) // 2
    left, right = value[:half], value[half:]
    for turn in range(8):
        if turn % 2 == 0:
            left = shift(left, digest(kind, turn, right))
        else:
            right = shift(right, digest(kind, turn, left))
    return left + right


def slow_number(value, kind, a, b):
    left, right = divmod(value, b)
    for turn in range(8):
        if turn % 2 == 0:
            left = (left + int(digest(kind, turn, right)[:12], 16)) % a
        else:
            right = (right + int(digest(kind, turn, left)[:12], 16)) % b
    return left * b + right


def luhn(digits):
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = int(c) * (2 if i % 2 else 1)
        total += d - 9 if d > 9 else d
    return total % 10 == 0


def slow_value(value):
    if "@" in value:
        local, domain = value.split("@", 1)
        return slow_text(local, "email", pseudonyms.LETTERS) + "@" + domain
    if re.fullmatch(pseudonyms.IPV4, value):
        parts = list(map(int, value.split(".")))
        if max(parts) > 255:
            return value
        n = slow_number(int.from_bytes(bytes(parts)), "ipv4", 65536, 65536)
        return ".".join(map(str, n.to_bytes(4)))
    if re.fullmatch(pseudonyms.PHONE, value):
        code = re.match(r"(?:\+[0-9]{1,3}(?=[ .()-])|\+1|\+[0-9])?", value)[0]
        return code + slow_text(value[len(code) :], "phone", pseudonyms.PHONE_DIGITS)
    if re.fullmatch(pseudonyms.DATE, value):
        for layout in ("%Y-%m-%d", "%d.%m.%Y", "%Y/%m/%d", "%m/%d/%Y", "%d/%m/%Y"):
            try:
                old = datetime.datetime.strptime(value, layout).date()
            except ValueError:
                continue
            return slow_day(old).strftime(layout)
        return value
    if re.fullmatch(pseudonyms.SSN, value):
        area, group, serial = map(int, value.split("-"))
        if not (1 <= area <= 899 and area != 666 and group and serial):
            return value
        n = ((area - 1 - (area > 666)) * 99 + group - 1) * 9999 + serial - 1
        n = slow_number(n, "ssn", 898 * 99, 9999)
        place = n // (99 * 9999) + 1
        return f"{place + (place >= 666):03d}-{n // 9999 % 99 + 1:02d}-{n % 9999 + 1:04d}"
    return slow_cards(value)


def slow_day(day):
    first = datetime.date(1800, 1, 1)
    n = (day - first).days
    if not 0 <= n < 146097:
        return day
    while True:
        n = slow_number(n, "date", 189, 773)
        moved = first + datetime.timedelta(n)
        if (moved.day > 12) == (day.day > 12):
            return moved


def slow_card(digits):
    body = digits[0] + slow_text(digits[1:-1], "card", pseudonyms.DIGITS)
    return next(body + c for c in "0123456789" if luhn(body + c))


def slow_cards(run):
    """Cards between borders of digit groups, judged over all pairs of borders."""
    spans = [m.span() for m in re.finditer("[0-9]+", run)]
    found = {}
    for i, (start, end) in enumerate(spans):
        if end - start >= 4 and (i == 0 or run[start] in "3456"):
            for j in range(i, len(spans)):
                digits = re.sub("[^0-9]", "", run[start : spans[j][1]])
                if 13 <= len(digits) <= 19 and luhn(digits):
                    found[i] = j
    out = list(run)
    for i, j in found.items():
        if not any(r < i <= found[r] for r in found):
            places = [k for k in range(spans[i][0], spans[j][1]) if run[k].isdigit()]
            for k, c in zip(places, slow_card("".join(run[k] for k in places))):
                out[k] = c
    return "".join(out)


def slow(text):
    return re.sub(pseudonyms.ANY, lambda m: slow_value(m[0]), text)


CASES = [
    "mail bosbt.42@mail8.example.com, x",
    "+1 (988) 555-2485 in (212) 555-0199 or 212-555-0199.",
    "+49 30 1234567 and +4930123456789",
    "55.63.178.142 un 256.1.1.1 v1.2.3.4.5",
    "4387513035237269 4556737586899855 9807915762804490 4556-7375-8689-9855",
    "1999-02-28 1999-02-30 31.12.2024 02/29/2024 13/13/2024 1799-12-31 2199-12-31",
    "123-45-6789 000-11-2222 666-11-2222 665-01-0001 667-99-9999",
    "12345678901234567890123 1234 2024 no",
    "a@b a@b.c @b.c x@",
    "2024 4111 1111 1111 1111 and 12 34 5500 0055 5555 5559 99 4111-1111-1111-1111 4111111111111111",
    "4111 1111 1111 1111 2024-01-05 4111111111111111 123-45-6789 4111 1111 1111 1111 212-555-0199",
    "1999 2000 2001 2002 2003 2004 2005 2006 2007 2008 2009 2010 2011 2012 2013 2014 2015",
    "2024/12/25 12/25/2024 25/12/2024 25.12.2024 2024-12-25 2024/02/30 05/03/2024 2024-05-03",
    "3782 822463 10005 378282246310005 4 1 1 1 1 1 1 1 1 1 1 1 1 1 1 1",
    "7 " * 3000 + "4111 1111 1111 1111 " + "5 " * 3000 + "1" * 20000,
]


def test_values_match_brute_force(spark):
    docs = spark.createDataFrame(list(enumerate(CASES)), "doc_id bigint, text string")
    got = {r.doc_id: r for r in pseudonyms.pseudonymise(docs, KEY, count="n").collect()}
    for i, text in enumerate(CASES):
        assert got[i].text == slow(text)


def test_documents_match_brute_force(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    texts = {r.doc_id: r.text for r in docs.select("doc_id", "text").collect()}
    rows = pseudonyms.pseudonymise(docs, KEY, count="n").collect()
    assert len(rows) == len(texts)
    for r in rows:
        assert r.text == slow(texts[r.doc_id])
    assert sum(r.n for r in rows) > 20


def test_no_private_value_stays(spark):
    for r in pseudonyms.pseudonymise(documents(spark), KEY).join(
        documents(spark).select("doc_id", F.col("text").alias("old")), "doc_id"
    ).collect():
        for m in re.finditer(r"[\w.]+@[\w.]+|\+1 \(\d{3}\) \d{3}-\d{4}|(?<!\d)\d{16}(?!\d)", r.old):
            if m[0].isdigit() and not luhn(m[0]):
                assert m[0] in r.text
            else:
                assert m[0] not in r.text


def test_account_numbers(spark):
    docs = spark.createDataFrame(
        [(1, "DE89370400440532013000 DE89370400440532013001")], "doc_id bigint, text string"
    )
    first, second = pseudonyms.pseudonymise(docs, KEY).first().text.split(" ")
    assert second == "DE89370400440532013001" and first != "DE89370400440532013000"
    turned = first[4:] + first[:4]
    assert first[:2] == "DE" and len(first) == 22
    assert int("".join(str(int(c, 36)) for c in turned)) % 97 == 1


@pytest.mark.parametrize(("a", "b"), [(7, 11), (16, 4)])
def test_numbers_are_permuted(spark, a, b):
    moved = spark.range(a * b).select(pseudonyms.permute_number(F.col("id"), KEY, "t", a, b).alias("x"))
    assert sorted(r.x for r in moved.collect()) == list(range(a * b))


def test_texts_are_permuted(spark):
    values = ["".join(p) for p in itertools.product("019", "az", "-", "AZ", "05")]
    values += [f"{i:03d}" for i in range(1000)]
    df = spark.createDataFrame([(v,) for v in values], "v string")
    moved = [r.x for r in df.select(pseudonyms.permute_text(F.col("v"), KEY, "t").alias("x")).collect()]
    assert len(set(moved)) == len(values)
    assert sorted(m for m in moved if len(m) == 3) == [f"{i:03d}" for i in range(1000)]


def test_keys_differ(spark):
    docs = spark.createDataFrame([(1, CASES[0])], "doc_id bigint, text string")
    assert pseudonyms.pseudonymise(docs, "a").first() != pseudonyms.pseudonymise(docs, "b").first()


def test_awkward_rows(spark):
    docs = awkward(spark)
    out = pseudonyms.pseudonymise(docs, KEY, count="n")
    assert out.columns == [*docs.columns, "n"]
    assert sorted(map(tuple, out.drop("n").collect()), key=repr) == sorted(map(tuple, docs.collect()), key=repr)
    assert {r.n for r in out.collect()} == {0}
    assert pseudonyms.pseudonymise(nothing(spark), KEY).count() == 0
    assert pseudonyms.with_length(docs).columns == docs.columns


def test_plan_is_native(spark):
    plan = pseudonyms.pseudonymise(documents(spark), KEY)._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Arrow|Pandas|Exchange", plan)


def test_cards_accounts_and_dates_as_they_are_printed(spark):
    texts = [
        "4111 1111 1111 1111 12/27",
        "4111111111111111 123",
        "DE89 3704 0044 0532 0130 00",
        "GB82 WEST 1234 5698 7654 32 USD",
        "AB12 4111 1111 1111 1111",
        "25/12/2024",
    ]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    got = [r.text for r in pseudonyms.pseudonymise(docs, KEY).orderBy("doc_id").collect()]
    for old, new in zip(texts, got):
        assert old != new and len(old) == len(new)
    for k, tail in ((0, " 12/27"), (1, " 123")):
        assert got[k].endswith(tail) and luhn(re.sub("[^0-9]", "", got[k][: -len(tail)]))
    for k in (2, 3):
        plain = got[k].removesuffix(" USD").replace(" ", "")
        assert int("".join(str(int(c, 36)) for c in plain[4:] + plain[:4])) % 97 == 1
    assert got[4].startswith("AB12 ") and luhn(got[4][5:].replace(" ", ""))
    assert datetime.datetime.strptime(got[5], "%d/%m/%Y").day > 12


def test_one_pseudonym_for_all_ways_to_write_a_value(spark):
    groups = [
        ["4111 1111 1111 1111", "4111-1111-1111-1111", "4111111111111111", "2024 4111 1111 1111 1111"],
        ["DE89 3704 0044 0532 0130 00", "DE89370400440532013000", "de89370400440532013000",
         "de89 3704 0044 0532 0130 00"],
    ]
    days = ["2024-12-25", "25.12.2024", "12/25/2024", "25/12/2024", "2024/12/25"]
    texts = [t for g in groups for t in g] + days
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    got = [r.text for r in pseudonyms.pseudonymise(docs, KEY).orderBy("doc_id").collect()]
    assert len({re.sub("[^0-9]", "", t)[-16:] for t in got[:4]}) == 1
    assert len({t.replace(" ", "").upper() for t in got[4:8]}) == 1 and got[6].islower()
    assert all(len(old) == len(new) and old != new for old, new in zip(texts, got))
    layouts = ["%Y-%m-%d", "%d.%m.%Y", "%m/%d/%Y", "%d/%m/%Y", "%Y/%m/%d"]
    assert len({datetime.datetime.strptime(t, x) for t, x in zip(got[8:], layouts)}) == 1

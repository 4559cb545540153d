"""Pseudonyms (op6) against a plain version of the whole operator, and each class as a true permutation."""

from __future__ import annotations

import calendar
import hashlib
import random
import re
from datetime import date

import pytest
from pyspark.sql import functions as F

from basketry.llm import pseudonyms as P

KEY = "k"


# --- the plain version: Python integers and strings ---------------------------------


def drawn(*parts):
    return int(hashlib.sha256("|".join(map(str, (KEY, *parts))).encode()).hexdigest()[:13], 16)


def feistel(a, b, size_a, size_b, kind):
    for r in range(8):
        if r % 2 == 0:
            a = (a + drawn(kind, size_a, size_b, r, b)) % size_a
        else:
            b = (b + drawn(kind, size_a, size_b, r, a)) % size_b
    return a, b


def digits_permuted(d, kind):
    u = len(d) // 2
    v = len(d) - u
    a, b = feistel(int(d[:u]), int(d[u:]), 10**u, 10**v, kind)
    return f"{a:0{u}d}{b:0{v}d}"


def refilled(m, digits):
    left = iter(digits)
    return re.sub("[0-9]", lambda _: next(left), m)


def luhn_sum(d):
    return sum(x - 9 * (x > 9) for i, c in enumerate(reversed(d)) for x in [int(c) * (1 + i % 2)])


def plain_card(m):
    d = re.sub("[^0-9]", "", m)
    if luhn_sum(d) % 10:
        return m
    body = d[0] + digits_permuted(d[1:-1], "card")
    return refilled(m, next(body + c for c in "0123456789" if luhn_sum(body + c) % 10 == 0))


def plain_ten(d):
    def in_plan(x):
        return re.match("[2-9][0-9]{2}[2-9]", x)

    if in_plan(d):
        a, b = feistel(int(d[:3]) - 200, int(d[3:]) - 2_000_000, 800, 8_000_000, "phone")
        return f"{a + 200}{b + 2_000_000}"
    d = digits_permuted(d, "phone")
    while in_plan(d):
        d = digits_permuted(d, "phone")
    return d


def plain_world(m):
    d = re.sub("[^0-9]", "", m)
    if len(d) == 11 and d[0] == "1":
        return refilled(m, "1" + plain_ten(d[1:]))
    return refilled(m, d[:2] + digits_permuted(d[2:], "world"))


def plain_phone(m):
    d = re.sub("[^0-9]", "", m)
    return refilled(m, d[:-10] + plain_ten(d[-10:]))


def plain_ssn(m):
    d = re.sub("[^0-9]", "", m)
    area, group, serial = int(d[:3]), int(d[3:5]), int(d[5:])
    if not 1 <= area <= 899 or area == 666 or not group or not serial:
        return m
    a, b = feistel(area - 1 - (area > 666), (group - 1) * 9999 + serial - 1, 898, 989901, "ssn")
    return refilled(m, f"{a + 1 + (a >= 665):03d}{b // 9999 + 1:02d}{b % 9999 + 1:04d}")


def plain_ip(m):
    o = [int(x) for x in m.split(".")]
    if max(o) > 255:
        return m
    a, b = feistel(o[0] * 256 + o[1], o[2] * 256 + o[3], 65536, 65536, "ip")
    return f"{a // 256}.{a % 256}.{b // 256}.{b % 256}"


def plain_iban(m):
    x = m.replace(" ", "")

    def check(body):
        return f"{98 - int(''.join(str(int(c, 36)) for c in body + x[:2] + '00')) % 97:02d}"

    digits = re.sub("[^0-9]", "", x[4:])
    if not 15 <= len(x) <= 34 or not 2 <= len(digits) <= 30 or x[2:4] != check(x[4:]):
        return m
    body = refilled(x[4:], digits_permuted(digits, "iban"))
    out = x[:2] + check(body) + body
    return " ".join(out[i : i + 4] for i in range(0, len(out), 4)) if " " in m else out


def plain_day(day):
    months = (day.year - 1900) * 12 + day.month - 1
    if day.day <= 12:
        n = months * 12 + day.day - 1
        a, b = feistel(n // 180, n % 180, 160, 180, "early")
        n = a * 180 + b
        return date(1900 + n // 144, n // 12 % 12 + 1, n % 12 + 1)
    n = months * 19 + day.day - 13
    while True:
        a, b = feistel(n // 240, n % 240, 190, 240, "late")
        n = a * 240 + b
        year, month, own = 1900 + n // 228, n // 19 % 12 + 1, 13 + n % 19
        if own <= calendar.monthrange(year, month)[1]:
            return date(year, month, own)


def plain_date(m):
    a, b, c = re.split("[-/.]", m)
    if len(a) == 4:
        fields = "ymd"
    elif "." in m:
        fields = "dmy"
    elif "-" in m:
        fields = "mdy" if 13 <= int(b) <= 39 else "dmy"
    else:
        fields = "dmy" if 13 <= int(a) <= 39 else "mdy"
    of = dict(zip(fields, (int(a), int(b), int(c))))
    try:
        day = date(of["y"], of["m"], of["d"])
    except ValueError:
        return m
    if not 1900 <= day.year <= 2099:
        return m
    new = plain_day(day)
    part = {"y": f"{new.year:04d}", "m": f"{new.month:02d}", "d": f"{new.day:02d}"}
    gap = re.search("[-/.]", m)[0]
    return gap.join(part[f] for f in fields)


def plain_redrawn(value, kind):
    seed = value if len(value) <= 256 else hashlib.sha256(value.encode()).hexdigest()
    out = []
    for i, c in enumerate(value):
        h = hashlib.sha256(f"{KEY}|{kind}|{seed}|{i // 32}".encode()).hexdigest()
        x = int(h[i % 32 * 2 : i % 32 * 2 + 2], 16)
        if c in "0123456789":
            c = str(x % 10)
        elif c in "abcdef":
            c = "abcdef"[x % 6]
        elif "g" <= c <= "z":
            c = chr(103 + x % 20)
        elif "A" <= c <= "Z":
            c = chr(65 + x % 26)
        out.append(c)
    return "".join(out)


def plain_mail(m):
    local, _, domain = m.partition("@")
    return plain_redrawn(local, "mail") + "@" + domain


def plain_secret(m):
    value = re.search("[A-Za-z0-9_-]+$", m)[0]
    return m[: -len(value)] + plain_redrawn(value, "secret")


KINDS = (
    (P.MAIL, plain_mail), (P.SECRET, plain_secret), (P.IBAN, plain_iban), (P.DATE, plain_date), (P.IP, plain_ip),
    (f"{P.SSN}|{P.KEYED_SSN}", plain_ssn), (P.WORLD, plain_world), (f"{P.PHONE}|{P.KEYED_PHONE}", plain_phone),
    (P.CARD, plain_card),
)


def plain(text):
    if text is None:
        return None

    def one(m):
        return next(f for p, f in KINDS if re.fullmatch(p, m[0], re.ASCII))(m[0])

    return re.sub(P.ANY, one, text, flags=re.ASCII)


def changed(spark, texts):
    table = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    return [r["text"] for r in P.pseudonymize(table, KEY).orderBy("doc_id").collect()]


# --- tests --------------------------------------------------------------------------

VALUES = [
    "12-25-1990", "25-12-1990", "1990-12-25", "1990-12-25T10:00", "25/12/1990", "12/25/1990", "25.12.1990", "03/04/2001",
    "04-03-2001", "2001-03-04", "30.02.2001", "31/04/1999", "1899-12-31", "2100-01-01", "+14155552671", "(415) 555-2671",
    "+1 415 555 2671", "415-555-2671", "4155552671", "phone: 4155552671", "Tel. 0155552671", "+44 20 7946 0958",
    "+442079460958", "+49 (30) 901820", "+1 234", "ssn 078051120", "SSN: 000051120", "078-05-1120", "078051120", "666-01-0001",
    "GB29 NWBK 6016 1331 9268 19", "GB29NWBK60161331926819", "DE89370400440532013000", "DE88370400440532013000",
    "FR1420041010050500013M02606", "011-555-1234", "(111) 155-1234", "4111 1111 1111 1111", "4111111111111111",
    "4111111111111112", "10.0.0.1", "256.1.1.1", "password=correct-horse-battery-staple", "a.b@mail.example.org",
    "token: " + "aB3" * 100, "api_key='0123456789abcdefXYZ'", "1234567890123", "v1.2.3.4.5", "2024", "",
]


def test_whole_operator_equals_the_plain_version(spark):
    rng = random.Random(4)
    texts = list(VALUES)
    for _ in range(300):
        kind = rng.randrange(7)
        n = "".join(rng.choice("0123456789") for _ in range(16))
        d = date.fromordinal(rng.randrange(date(1895, 1, 1).toordinal(), date(2105, 1, 1).toordinal()))
        texts.append([
            f"on {d:%Y-%m-%d}, {d:%d/%m/%Y} or {d:%m/%d/%Y}: {d:%d-%m-%Y} {d:%m-%d-%Y}", f"({n[:3]}) {n[3:6]}-{n[6:10]} x",
            f"{n[:3]}-{n[3:5]}-{n[5:9]}; +{n[:12]}", f"{int(n[:3])}.{int(n[3:6])}.{n[6]}.{n[7]}",
            f"card {n[:4]} {n[4:8]} {n[8:12]} {n[12:]}", f"fax {n[:10]} and ssn {n[:9]}", f"{n[:5]} words {n[5:9]}, {n}",
        ][kind])
    texts += ["  ".join(rng.sample(VALUES, 5)) for _ in range(100)]
    for text, new in zip(texts, changed(spark, texts)):
        assert new == plain(text), text


@pytest.mark.parametrize("form", ["yyyy-MM-dd", "yyyy/MM/dd", "dd.MM.yyyy", "dd/MM/yyyy", "MM/dd/yyyy", "dd-MM-yyyy", "MM-dd-yyyy"])
def test_no_two_days_collide_in_any_form(spark, form):
    days = spark.range(73049).select(F.expr("date_add(date'1900-01-01', cast(id as int))").alias("day"))
    texts = days.select(F.date_format("day", form).alias("text")).distinct()
    assert P.pseudonymize(texts, KEY).distinct().count() == texts.count() == 73049


def test_slash_and_dash_dates_of_both_orders_do_not_meet(spark):
    days = spark.range(73049).select(F.expr("date_add(date'1900-01-01', cast(id as int))").alias("day"))
    for sign in "/-":
        forms = [F.date_format("day", f"dd{sign}MM{sign}yyyy"), F.date_format("day", f"MM{sign}dd{sign}yyyy")]
        texts = days.select(F.explode(F.array(*forms)).alias("text")).distinct()
        assert P.pseudonymize(texts, KEY).distinct().count() == texts.count() > 73049


def test_equal_values_stay_linked_across_forms(spark):
    phones = changed(spark, ["+14155552671", "(415) 555-2671", "+1 415 555 2671", "415.555.2671", "phone: 4155552671"])
    assert len({re.sub("[^0-9]", "", p)[-10:] for p in phones}) == 1
    ssn = changed(spark, ["078-05-1120", "ssn 078051120"])
    assert re.sub("[^0-9]", "", ssn[0]) == re.sub("[^0-9]", "", ssn[1]) != "078051120"
    iban = changed(spark, ["GB29 NWBK 6016 1331 9268 19", "GB29NWBK60161331926819"])
    assert iban[0].replace(" ", "") == iban[1] != "GB29NWBK60161331926819"


def test_phone_classes_are_permuted_each_in_itself(spark):
    rng = random.Random(6)
    numbers = sorted({f"{rng.randrange(1000):03d}-{rng.randrange(1000):03d}-{rng.randrange(10000):04d}" for _ in range(4000)})
    new = changed(spark, numbers)
    in_plan = re.compile("[2-9][0-9]{2}-[2-9]")
    assert len(set(new)) == len(numbers)
    assert all(bool(in_plan.match(a)) == bool(in_plan.match(b)) for a, b in zip(numbers, new))


def test_bare_runs_without_a_key_word_stay(spark):
    texts = ["order 4155552671 shipped", "part 078051120 in stock", "0123456789", "+12", "AB12 not an account"]
    assert changed(spark, texts) == texts

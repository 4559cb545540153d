"""Format-preserving pseudonyms for personal numbers and dates, in SQL expressions only.

Candidates are found by one pattern, validated by kind and replaced by a keyed
permutation of the kind's own domain, so that equal values get equal pseudonyms
in every document and different values stay different:

=========  ==============================================  ===========================================
kind       validated by                                    permuted
=========  ==============================================  ===========================================
iban       15 to 34 characters, both check digits          the digits after them; new check digits
card       13 to 19 digits, check digit                    all digits but the first; new check digit
phone      7-digit number with area code; ten digits       area code, exchange and line, numbers of the
           after a key word                                plan and all others each among themselves
           ``+`` and 8 to 15 digits                        all but the first two; ``+1`` and ten
                                                           digits as above
ssn        area, group and serial rules; nine digits       the 898 * 99 * 9999 valid numbers
           after a key word
ip         four octets up to 255                           all 2^32 addresses
date       calendar, years 1900 to 2099                    days up to the 12th and later days, each
                                                           among themselves, written alike
=========  ==============================================  ===========================================

A date is the same day in all its forms and gets the same pseudonym day in all.  In
``25/12/1990`` and ``25-12-1990`` only a day beyond the 12th tells the order of the
fields; since such days stay beyond the 12th, a pseudonym is read in the order it was
written in.  Where both fields are at most 12, the slash form is month first and the dash
form day first.  ``12-25-1990`` is month first.  Of a date-time the date is replaced.

The permutation is a Feistel network over pairs (a, b) with a < A, b < B:
rounds add a keyed SHA-256 of one half to the other, modulo its size, which any
holder of the key can undo.  A domain that is no rectangle is permuted by walking the
cycles of a larger one until they return to it; a walk ends after ``WALK`` steps, which
no value needs but with a chance below 10^-20.  Mail addresses and the values of
``password=`` or ``token=`` assignments have no number to permute; their letters and
digits are drawn from a keyed hash of the whole value, class by class, which keeps their
form and links equal values as well.

Texts without a digit, an ``@`` or a secret's key word before ``=`` or ``:`` are
passed through unread by the large pattern.

Defined results: null stays null, empty stays empty; candidates that fail their
validation are left alone, bare runs of nine or ten digits without a key word before them
among them; other columns are kept as they are; ``n_chars``, if there is one, follows the
text.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .support import prepare

ROUNDS = 8
WALK = 128
#: 2,400 months from 1900 to 2099: 12 early days each, and places for 19 later ones, 13 to 31.
FIRST_YEAR, MONTHS = 1900, 2400
EARLY, LATE = (160, 180), (190, 240)

# One pattern for each kind, fixed values; repetitions are bounded or possessive, so that long texts cannot exhaust
# the matcher.
MAIL = r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]{1,64}+@(?:[A-Za-z0-9-]{1,63}\.){1,8}[A-Za-z]{2,24}"
SECRET = r"(?i:token|password|passwd|secret|api[_-]?key)[ ]{0,3}[=:][ ]{0,3}[\"']?[A-Za-z0-9_-]{16,}+"
IBAN = r"(?<!\w)[A-Z]{2}\d{2}(?:(?: [A-Z0-9]{4}){2,7}(?: [A-Z0-9]{1,3})?|[A-Z0-9]{11,30})(?!\w)"
DATE = (
    r"(?<![\w./-])(?:\d{4}-\d\d-\d\d|\d{4}/\d\d/\d\d|\d\d\.\d\d\.\d{4}|\d\d/\d\d/\d{4}|\d\d-\d\d-\d{4})"
    r"(?:(?=T\d\d:\d\d)|(?!\w|[./-]\d))"
)
IP = r"(?<![\w.])\d{1,3}(?:\.\d{1,3}){3}(?!\w|\.\d)"
SSN = r"(?<![\w-])\d{3}-\d\d-\d{4}(?!\w|-\d)"
KEYED_SSN = r"(?<!\w)(?i:ssn|social security(?: number| no)?)[ .:#=]{0,3}\d{9}(?!\w)"
KEYED_PHONE = r"(?<!\w)(?i:phone|tel|telephone|mobile|cell|fax)(?i: number| no)?[ .:#=]{0,3}\d{10}(?!\w)"
WORLD = r"(?<![\w+])\+[1-9](?:[ .()-]{0,2}\d){7,14}+(?!\w|-\d)"
PHONE = r"(?<![\w+])(?:\+?\d{1,3}[ .-]?)?(?:\(\d{3}\)[ .-]?|\d{3}[ .-])\d{3}[ .-]\d{4}(?!\w|-\d)"
CARD = r"(?<!\w)(?:\d{4}-\d{4}-\d{4}-\d{4}|\d{4} \d{4} \d{4} \d{4}|\d{4}[ -]\d{6}[ -]\d{5}|\d{13,19})(?!\w)"
#: What a text must hold for any of them to match; a secret may be of letters only.
ANY_SIGN = r"[0-9@]|(?i:token|password|passwd|secret|api[_-]?key)[ ]{0,3}[=:]"
ANY = "|".join((MAIL, SECRET, IBAN, DATE, IP, SSN, KEYED_SSN, KEYED_PHONE, WORLD, PHONE, CARD))


def quoted(text: str) -> str:
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"


def whole(pattern: str) -> str:
    return quoted(f"^(?:{pattern})$")


def feistel(a: str, b: str, size_a: str, size_b: str, kind: str, key: str) -> str:
    """SQL of struct(a, b) after all rounds."""

    def drawn(half: str) -> str:
        return (
            f"cast(conv(substring(sha2(concat_ws('|', {quoted(key)}, '{kind}', {size_a}, {size_b}, r, {half}), 256), "
            "1, 13), 16, 10) as bigint)"
        )

    return (
        f"aggregate(sequence(0, {ROUNDS - 1}), named_struct('a', cast({a} as bigint), 'b', cast({b} as bigint)), "
        f"(s, r) -> if(r % 2 = 0, named_struct('a', (s.a + {drawn('s.b')}) % {size_a}, 'b', s.b), "
        f"named_struct('a', s.a, 'b', (s.b + {drawn('s.a')}) % {size_b})))"
    )


def with_value(value: str, name: str, body: str) -> str:
    """SQL of ``body`` with ``name`` bound to ``value``, which is worked out once."""
    return f"element_at(transform(array({value}), {name} -> {body}), 1)"


def digits_of(m: str) -> str:
    return f"regexp_replace({m}, '[^0-9]', '')"


def refill(m: str, digits: str) -> str:
    """``m`` with its digits replaced, in order, by those of ``digits``."""
    return (
        f"aggregate(split({m}, ''), named_struct('o', '', 'i', 1), (s, c) -> if(c rlike '^[0-9]$', "
        f"named_struct('o', concat(s.o, substring({digits}, s.i, 1)), 'i', s.i + 1), "
        "named_struct('o', concat(s.o, c), 'i', s.i)), s -> s.o)"
    )


def luhn_sum(digits: str, doubled_first: str) -> str:
    """Luhn sum; ``doubled_first``: SQL for 1 if the first digit counts double, else 0."""
    return (
        f"aggregate(sequence(1, length({digits})), 0, (t, i) -> t + "
        f"if((i + {doubled_first}) % 2 = 0, "
        f"cast(substring('0246813579', cast(substring({digits}, i, 1) as int) + 1, 1) as int), "
        f"cast(substring({digits}, i, 1) as int)))"
    )


def permuted_digits(d: str, kind: str, key: str) -> str:
    """A string of 2 to 30 digits, permuted among those of its length."""
    u, v = f"(length({d}) div 2)", f"(length({d}) - length({d}) div 2)"
    power = lambda n: f"cast(rpad('1', {n} + 1, '0') as bigint)"
    mixed = feistel(f"substring({d}, 1, {u})", f"substring({d}, {u} + 1)", power(u), power(v), kind, key)
    return with_value(mixed, "w", f"concat(lpad(cast(w.a as string), {u}, '0'), lpad(cast(w.b as string), {v}, '0'))")


def card(m: str, key: str) -> str:
    """Null unless the check digit is right."""
    n = "length(d)"
    body = f"concat(substring(d, 1, 1), {permuted_digits(f'substring(d, 2, {n} - 2)', 'card', key)})"
    # The check digit makes the sum a multiple of ten; the digit before it counts double.
    check = f"cast((10 - {luhn_sum('p', f'(length(p) % 2)')} % 10) % 10 as string)"
    replaced = with_value(body, "p", refill(m, f"concat(p, {check})"))
    # In a whole number of n digits, the last but one counts double.
    valid = f"{luhn_sum('d', f'((length(d) + 1) % 2)')} % 10 = 0"
    return with_value(digits_of(m), "d", f"if({valid}, {replaced}, {m})")


def walked(start: str, step, valid) -> str:
    """SQL of the first valid value on the cycle of ``start``; ``step`` and ``valid`` make SQL of SQL."""
    moved = with_value(step("z.v"), "y", f"named_struct('v', y, 'ok', {valid('y')})")
    return (
        f"aggregate(sequence(1, {WALK}), named_struct('v', {start}, 'ok', false), (z, i) -> if(z.ok, z, {moved}), z -> z.v)"
    )


def ten_digits(last: str, key: str) -> str:
    """A phone number of ten digits: those of the plan among themselves, and so the others."""

    def in_plan(number: str) -> str:
        return f"{number} rlike '^[2-9][0-9]{{2}}[2-9]'"

    a = f"(cast(substring({last}, 1, 3) as bigint) - 200)"
    b = f"(cast(substring({last}, 4, 7) as bigint) - 2000000)"
    mixed = with_value(
        feistel(a, b, "800", "8000000", "phone", key),
        "w",
        "concat(cast(w.a + 200 as string), cast(w.b + 2000000 as string))",
    )
    other = walked(last, lambda v: permuted_digits(v, "phone", key), lambda v: f"not {in_plan(v)}")
    return f"if({in_plan(last)}, {mixed}, {other})"


def phone(m: str, key: str) -> str:
    digits = f"concat(substring(d, 1, length(d) - 10), {ten_digits('substring(d, -10)', key)})"
    return with_value(digits_of(m), "d", with_value(digits, "q", refill(m, "q")))


def world_phone(m: str, key: str) -> str:
    """With a country code; its length is not known, so that the first two digits stay."""
    own = f"concat('1', {ten_digits('substring(d, 2)', key)})"
    other = f"concat(substring(d, 1, 2), {permuted_digits('substring(d, 3)', 'world', key)})"
    digits = f"if(length(d) = 11 and d like '1%', {own}, {other})"
    return with_value(digits_of(m), "d", with_value(digits, "q", refill(m, "q")))


def ssn(m: str, key: str) -> str:
    area, group, serial = (f"cast(substring(d, {i}, {n}) as bigint)" for i, n in ((1, 3), (4, 2), (6, 4)))
    a = f"({area} - 1 - if({area} > 666, 1, 0))"
    b = f"(({group} - 1) * 9999 + {serial} - 1)"
    out = (
        "concat(lpad(cast(w.a + 1 + if(w.a >= 665, 1, 0) as string), 3, '0'), "
        "lpad(cast(w.b div 9999 + 1 as string), 2, '0'), lpad(cast(w.b % 9999 + 1 as string), 4, '0'))"
    )
    valid = f"{area} between 1 and 899 and {area} <> 666 and {group} > 0 and {serial} > 0"
    replaced = with_value(with_value(feistel(a, b, "898", "989901", "ssn", key), "w", out), "q", refill(m, "q"))
    return with_value(digits_of(m), "d", f"if({valid}, {replaced}, {m})")


def remainder_97(text: str) -> str:
    """Of the number that digits and letters (A is 10) spell."""
    return (
        f"aggregate(split({text}, ''), 0, (t, c) -> case when c = '' then t when c rlike '^[0-9]$' "
        "then (t * 10 + cast(c as int)) % 97 else (t * 100 + ascii(c) - 55) % 97 end)"
    )


def iban(m: str, key: str) -> str:
    """Null unless the check digits are those that the rest asks for."""

    def check(body: str) -> str:
        return f"lpad(cast(98 - {remainder_97(f"concat({body}, substring(x, 1, 2), '00')")} as string), 2, '0')"

    body = "substring(x, 5)"
    mixed = with_value(with_value(digits_of(body), "d", permuted_digits("d", "iban", key)), "q", refill(body, "q"))
    whole_text = with_value(mixed, "e", f"concat(substring(x, 1, 2), {check('e')}, e)")
    # Back into the groups it was written in.
    spaced = f"if(instr({m}, ' ') > 0, trim(regexp_replace(o, '(.{{4}})', '$1 ')), o)"
    replaced = with_value(whole_text, "o", spaced)
    valid = f"length(x) between 15 and 34 and length({digits_of(body)}) between 2 and 30 and substring(x, 3, 2) = {check(body)}"
    return with_value(f"replace({m}, ' ', '')", "x", f"if({valid}, {replaced}, {m})")


def ip(m: str, key: str) -> str:
    octet = [f"cast(split({m}, '[.]')[{i}] as bigint)" for i in range(4)]
    valid = " and ".join(f"{o} <= 255" for o in octet)
    mixed = feistel(f"({octet[0]} * 256 + {octet[1]})", f"({octet[2]} * 256 + {octet[3]})", "65536", "65536", "ip", key)
    out = "concat_ws('.', w.a div 256, w.a % 256, w.b div 256, w.b % 256)"
    return f"if({valid}, {with_value(mixed, 'w', out)}, {m})"


def day_permuted(day: str, key: str) -> str:
    """SQL of the pseudonym of a date; days up to the 12th and later ones stay apart."""
    months = f"((year({day}) - {FIRST_YEAR}) * 12 + month({day}) - 1)"

    def date_of(number: str, per_month: int, first: int) -> str:
        month = f"({number} div {per_month})"
        return (
            f"make_date(cast({FIRST_YEAR} + {month} div 12 as int), cast({month} % 12 + 1 as int), "
            f"cast({first} + {number} % {per_month} as int))"
        )

    def mixed(number: str, sizes: tuple[int, int], kind: str) -> str:
        a, b = sizes
        pair = feistel(f"({number} div {b})", f"({number} % {b})", str(a), str(b), kind, key)
        return with_value(pair, "w", f"w.a * {b} + w.b")

    def exists(number: str) -> str:
        month = f"({number} div 19)"
        first = f"make_date(cast({FIRST_YEAR} + {month} div 12 as int), cast({month} % 12 + 1 as int), 1)"
        return f"13 + {number} % 19 <= day(last_day({first}))"

    early = with_value(mixed(f"cast({months} * 12 + day({day}) - 1 as bigint)", EARLY, "early"), "n", date_of("n", 12, 1))
    start = f"cast({months} * 19 + day({day}) - 13 as bigint)"
    late = with_value(walked(start, lambda v: mixed(v, LATE, "late"), exists), "n", date_of("n", 19, 13))
    return f"if(day({day}) <= 12, {early}, {late})"


def date(m: str, key: str) -> str:
    late = "(?:1[3-9]|[23][0-9])"
    forms = (("^[0-9]{4}-", "yyyy-MM-dd"), ("^[0-9]{4}/", "yyyy/MM/dd"), ("^[0-9]{2}[.]", "dd.MM.yyyy"),
             (f"^[0-9]{{2}}-{late}-", "MM-dd-yyyy"), ("^[0-9]{2}-", "dd-MM-yyyy"), (f"^{late}/", "dd/MM/yyyy"),
             ("", "MM/dd/yyyy"))
    form = "case " + " ".join(f"when {m} rlike '{p}' then '{f}'" for p, f in forms) + " end"
    day = f"cast(try_to_timestamp({m}, f) as date)"
    out = f"if(year(g) between {FIRST_YEAR} and {FIRST_YEAR + MONTHS // 12 - 1}, date_format({day_permuted('g', key)}, f), {m})"
    return with_value(form, "f", with_value(day, "g", f"coalesce({out}, {m})"))


def redrawn(value: str, kind: str, key: str) -> str:
    """Every letter and digit drawn anew from a keyed hash of the value, inside its class."""
    # A long value is hashed once, not anew for each of its characters.
    source = f"if(length({value}) > 256, sha2({value}, 256), {value})"
    h = f"sha2(concat_ws('|', {quoted(key)}, '{kind}', seed, i div 32), 256)"
    draw = f"cast(conv(substring({h}, (i % 32) * 2 + 1, 2), 16, 10) as int)"
    drawn = (
        f"array_join(transform(split({value}, ''), (c, i) -> case when c rlike '^[0-9]$' then cast({draw} % 10 as string) "
        f"when c rlike '^[a-f]$' then substring('abcdef', {draw} % 6 + 1, 1) "
        f"when c rlike '^[g-z]$' then char(103 + {draw} % 20) when c rlike '^[A-Z]$' then char(65 + {draw} % 26) "
        "else c end), '')"
    )
    return with_value(source, "seed", drawn)


def mail(m: str, key: str) -> str:
    local = redrawn(f"substring_index({m}, '@', 1)", "mail", key)
    return f"concat({local}, '@', substring_index({m}, '@', -1))"


def secret(m: str, key: str) -> str:
    value = f"regexp_extract({m}, '[A-Za-z0-9_-]+$', 0)"
    return f"concat(substring({m}, 1, length({m}) - length({value})), {redrawn(value, 'secret', key)})"


def pseudonym(m: str, key: str) -> str:
    """SQL of the replacement of one match."""
    return (
        f"case when {m} rlike {whole(MAIL)} then {mail(m, key)} when {m} rlike {whole(SECRET)} then {secret(m, key)} "
        f"when {m} rlike {whole(IBAN)} then {iban(m, key)} "
        f"when {m} rlike {whole(DATE)} then {date(m, key)} when {m} rlike {whole(IP)} then {ip(m, key)} "
        f"when {m} rlike {whole(f'{SSN}|{KEYED_SSN}')} then {ssn(m, key)} "
        f"when {m} rlike {whole(WORLD)} then {world_phone(m, key)} "
        f"when {m} rlike {whole(f'{PHONE}|{KEYED_PHONE}')} then {phone(m, key)} "
        f"else {card(m, key)} end"
    )


def pseudonymized(text: str, key: str) -> Column:
    """The text with every validated value replaced."""
    found = f"regexp_extract_all({text}, {quoted(ANY)}, 0)"
    between = f"split({text}, {quoted(ANY)}, -1)"
    changed = f"transform({found}, m -> {pseudonym('m', key)})"
    joined = f"array_join(zip_with({between}, {changed}, (p, q) -> concat(p, coalesce(q, ''))), '')"
    return F.expr(f"case when {text} rlike {quoted(ANY_SIGN)} then if(size({found}) > 0, {joined}, {text}) else {text} end")


def pseudonymize(docs: DataFrame, key: str, column: str = "text") -> DataFrame:
    """The same rows and columns with ``column`` pseudonymized."""
    prepare(docs.sparkSession)
    quoted_name = "`" + column.replace("`", "``") + "`"
    names = [c for c in docs.columns]
    out = docs.withColumn(column, pseudonymized(quoted_name, key))
    if "n_chars" in names:
        kind = dict(docs.dtypes)["n_chars"]
        # A null count stays null.
        counted = F.when(F.col("n_chars").isNotNull(), F.length(F.col(quoted_name)).cast(kind))
        out = out.withColumn("n_chars", F.coalesce(counted, F.col("n_chars")))
    return out

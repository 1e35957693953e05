"""Format-preserving pseudonyms for personal data (operator 2), in built-in functions only.

One pattern finds the candidates; the text is split at them, each candidate is validated and
replaced, and the parts are joined again. Validated numbers and dates go through a keyed Feistel
network over exactly their own domain, so the result has the same format, passes the same
validation, and equal values get equal pseudonyms in every document:

=========  =================================================  ===========================
kind       validated by                                       domain that is permuted
=========  =================================================  ===========================
card       13 to 19 digits, Luhn sum                          all digits but first and check
phone      North American number, area and exchange >= 200    800 x 800 x 10,000
ssn        area, group and serial not among the unused ones   898 x 99 x 9,999
ipv4       four numbers up to 255                             2 ** 32
date       calendar date from 1900-01-01 to 2100-02-20        73,100 days
=========  =================================================  ===========================

Separators stay as they are. E-mail addresses and named secrets have no numeric domain: they get
keyed SHA-256 pseudonyms of the same kind of form, linked alike. Candidates that fail their
validation stay as they are.

Defined cases: a null text stays null; an empty one stays empty; whole texts are searched, however long;
other columns are untouched, whatever their names;
repeated rows are treated alike; an empty table gives an empty result. Give a key of your own:
whoever has it can undo the permutations.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

KEY = "change-me"
ROUNDS = 8
FIRST_DAY = "1900-01-01"
#: 73,100 days from FIRST_DAY, as 340 x 215.
DAYS = (340, 215)

#: Fixed patterns of the candidates. Groups that may repeat without end are possessive: the matcher would recurse once for each repetition.
EMAIL = r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]{1,64}+@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++"
CLOUD_KEY = r"AKIA[0-9A-Z]{16}"
SECRET_NAME = r"""(?i:token|password|secret|api_key)[ ]{0,3}[=:][ ]{0,3}["']?"""
#: The whole value, however long, without the dots that end a sentence; an address is an address.
SECRET = f"{SECRET_NAME}(?!{EMAIL})[A-Za-z0-9_.+/=~-]{{7,}}[A-Za-z0-9_+/=~-]"
DATE = r"(?<![\d-])\d{4}-\d{2}-\d{2}(?![\d-])|(?<![\d/])\d{2}/\d{2}/\d{4}(?![\d/])|(?<![\d.])\d{2}\.\d{2}\.\d{4}(?!\.?\d)"
IPV4 = r"(?<![\d.])(?:\d{1,3}\.){3}\d{1,3}(?!\.?\d)"
SSN = r"(?<![\d-])\d{3}-\d{2}-\d{4}(?![\d-])"
PHONE = r"(?<![\d.-])(?:\+?1[ .-]?)?(?:\(\d{3}\) ?|\d{3}[ .-])\d{3}[ .-]\d{4}(?![\d-])"
CARD = r"(?<![\d.-])\d(?:[ -]?\d){12,18}(?![\d-])"
CANDIDATE = "|".join((EMAIL, CLOUD_KEY, SECRET, DATE, IPV4, SSN, PHONE, CARD))


def _let(value: Column, body) -> Column:
    return F.transform(F.array(value), body)[0]


def _prf(key: str, kind: str, *parts: Column) -> Column:
    return F.sha2(F.concat_ws("|", F.lit(key), F.lit(kind), *(p.cast("string") for p in parts)), 256)


def feistel(key: str, kind: str, x: Column, y: Column, mx: Column, my: Column) -> Column:
    """``struct(x, y)``: a keyed permutation of the pairs with 0 <= x < mx, 0 <= y < my (up to 2**55).

    Each round adds a keyed hash of one half to the other, modulo that one's size, and swaps."""
    start = F.struct(x.cast("long").alias("x"), y.cast("long").alias("y"), mx.cast("long").alias("mx"), my.cast("long").alias("my"))

    def step(s: Column, r: Column) -> Column:
        noise = F.conv(F.substring(_prf(key, kind, r, s["y"], s["mx"]), 1, 14), 16, 10).cast("long")
        return F.struct(s["y"].alias("x"), ((s["x"] + noise % s["mx"]) % s["mx"]).alias("y"), s["my"].alias("mx"), s["mx"].alias("my"))

    return F.aggregate(F.sequence(F.lit(1), F.lit(ROUNDS)), start, step)


def _digits(c: Column) -> Column:
    return F.regexp_replace(c, "[^0-9]", "")


def _refill(template: Column, digits: Column) -> Column:
    """``template`` with its digits replaced in order."""
    def one(c: Column, i: Column) -> Column:
        nth = F.length(_digits(F.substring(template, F.lit(1), i + 1)))
        return F.when(c.rlike("[0-9]"), F.substring(digits, nth, F.lit(1))).otherwise(c)

    return F.array_join(F.transform(F.split(template, ""), one), "")


def _luhn_sum(digits: Column, doubled_first: Column) -> Column:
    """Luhn sum from the right; ``doubled_first``: whether the last digit counts double (0 or 1)."""
    values = F.transform(F.reverse(F.split(digits, "")), lambda c, i: _luhn_digit(c.cast("int"), (i + doubled_first) % 2))
    return F.aggregate(values, F.lit(0), lambda a, v: a + F.coalesce(v, F.lit(0)))


def _luhn_digit(v: Column, double: Column) -> Column:
    return F.when(double == 1, F.when(v >= 5, v * 2 - 9).otherwise(v * 2)).otherwise(v)


def _card(key: str, m: Column) -> Column:
    def new(d: Column) -> Column:
        n = F.length(d) - 2
        left = F.floor(n / 2).cast("int")
        right = (n - left).cast("int")
        ten = lambda k: F.pow(F.lit(10.0), k).cast("long")
        mixed = feistel(key, "card", F.substring(d, F.lit(2), left).cast("long"), F.substring(d, left + 2, right).cast("long"), ten(left), ten(right))
        body = _let(mixed, lambda s: F.concat(F.substring(d, 1, 1), F.lpad(s["x"].cast("string"), left, F.lit("0")), F.lpad(s["y"].cast("string"), right, F.lit("0"))))
        return _let(body, lambda b: F.concat(b, ((10 - _luhn_sum(b, F.lit(1)) % 10) % 10).cast("string")))

    return _let(_digits(m), lambda d: F.when(_luhn_sum(d, F.lit(0)) % 10 == 0, _refill(m, new(d))).otherwise(m))


def _phone(key: str, m: Column) -> Column:
    def new(d: Column) -> Column:
        num = lambda i, n: F.substring(d, i, n).cast("long")
        code = ((num(1, 3) - 200) * 800 + num(4, 3) - 200) * 10_000 + num(7, 4)
        mixed = _let(code, lambda v: feistel(key, "phone", F.floor(v / 80_000), v % 80_000, F.lit(80_000), F.lit(80_000)))
        value = _let(mixed, lambda s: s["x"] * 80_000 + s["y"])
        return _let(value, lambda v: F.concat((F.floor(v / 8_000_000) + 200).cast("string"), (F.floor(v / 10_000) % 800 + 200).cast("string"), F.lpad((v % 10_000).cast("string"), 4, "0")))

    ten = F.substring(_digits(m), -10, 10)
    ahead = lambda d: F.concat(F.substring(_digits(m), F.lit(1), F.length(_digits(m)) - 10), d)
    return _let(ten, lambda d: F.when(d.rlike("^[2-9][0-9]{2}[2-9]"), _refill(m, ahead(new(d)))).otherwise(m))


def _ssn(key: str, m: Column) -> Column:
    part = lambda i, n: F.substring(m, i, n).cast("long")
    area = part(1, 3) - F.when(part(1, 3) > 666, 2).otherwise(1)
    mixed = feistel(key, "ssn", area * 99 + part(5, 2) - 1, part(8, 4) - 1, F.lit(898 * 99), F.lit(9999))

    def write(s: Column) -> Column:
        a = F.floor(s["x"] / 99)
        a = a + F.when(a >= 665, 2).otherwise(1)
        return F.concat(F.lpad(a.cast("string"), 3, "0"), F.lit("-"), F.lpad((s["x"] % 99 + 1).cast("string"), 2, "0"), F.lit("-"), F.lpad((s["y"] + 1).cast("string"), 4, "0"))

    return F.when(m.rlike("^(?!000|666|9)[0-9]{3}-(?!00)[0-9]{2}-(?!0000)[0-9]{4}$"), _let(mixed, write)).otherwise(m)


def _ipv4(key: str, m: Column) -> Column:
    def new(o: Column) -> Column:
        mixed = feistel(key, "ipv4", o[0] * 256 + o[1], o[2] * 256 + o[3], F.lit(65_536), F.lit(65_536))
        byte = lambda v, d: (F.floor(v / d) % 256).cast("string")
        return _let(mixed, lambda s: F.concat_ws(".", byte(s["x"], 256), byte(s["x"], 1), byte(s["y"], 256), byte(s["y"], 1)))

    return _let(F.transform(F.split(m, r"\."), lambda x: x.cast("long")), lambda o: F.when(F.array_max(o) <= 255, new(o)).otherwise(m))


def _date(key: str, m: Column) -> Column:
    a, b = DAYS

    def new(day: Column, form: str) -> Column:
        mixed = feistel(key, "date", F.floor(day / b), day % b, F.lit(a), F.lit(b))
        return _let(mixed, lambda s: F.date_format(F.date_add(F.lit(FIRST_DAY).cast("date"), (s["x"] * b + s["y"]).cast("int")), form))

    def by(form: str) -> Column:
        day = F.datediff(F.try_to_timestamp(m, F.lit(form)).cast("date"), F.lit(FIRST_DAY).cast("date"))
        return _let(day, lambda d: F.when((d >= 0) & (d < a * b), new(d, form)).otherwise(m))

    first = F.substring(m, 1, 2).cast("int")
    return (
        F.when(m.rlike("^[0-9]{4}-"), by("yyyy-MM-dd")).when(m.contains("."), by("dd.MM.yyyy"))
        .when(first > 12, by("dd/MM/yyyy")).otherwise(by("MM/dd/yyyy"))
    )


def _secret(key: str, value: Column) -> Column:
    """As many hexadecimal digits as ``value`` has characters, a keyed hash for each 64 of them."""
    def nth(i: Column) -> Column:
        return F.when(i == 0, _prf(key, "secret", value)).otherwise(_prf(key, "secret", value, i))

    parts = F.transform(F.sequence(F.lit(0), F.floor(F.length(value) / 64).cast("int")), nth)
    return F.substring(F.array_join(parts, ""), F.lit(1), F.length(value))


def pseudonym(m: Column, key: str = KEY) -> Column:
    """The pseudonym of one candidate, or the candidate itself where it is not valid."""
    email = F.concat(F.substring(_prf(key, "email", F.lower(m)), 1, 16), F.lit("@example.com"))
    head = F.regexp_extract(m, f"^{SECRET_NAME}", 0)
    value = F.substring(m, F.length(head) + 1, F.length(m))
    is_like = lambda p: m.rlike(f"^(?:{p})$")
    return (
        F.when(m.contains("@"), email)
        .when(is_like(CLOUD_KEY), F.concat(F.lit("AKIA"), F.upper(F.substring(_prf(key, "cloud", m), 1, 16))))
        .when(head != "", F.concat(head, _secret(key, value)))
        .when(is_like(DATE), _date(key, m)).when(is_like(IPV4), _ipv4(key, m)).when(is_like(SSN), _ssn(key, m))
        .when(is_like(PHONE), _phone(key, m)).when(is_like(CARD), _card(key, m)).otherwise(m)
    )


def pseudonymised(text: Column, key: str = KEY) -> Column:
    """``struct(text, n_replaced)`` of a text."""
    found = F.regexp_extract_all(text, F.lit(CANDIDATE), F.lit(0))

    def rebuild(f: Column) -> Column:
        def join(new: Column) -> Column:
            parts = F.zip_with(F.split(text, CANDIDATE, -1), new, lambda gap, n: F.concat(gap, F.coalesce(n, F.lit(""))))
            changed = F.size(F.filter(F.zip_with(f, new, lambda o, n: o != n), lambda c: c))
            return F.struct(F.array_join(parts, "").alias("text"), changed.cast("long").alias("n_replaced"))

        return F.when(F.size(f) == 0, F.struct(text.alias("text"), F.lit(0).cast("long").alias("n_replaced"))).otherwise(_let(F.transform(f, lambda m: pseudonym(m, key)), join))

    return F.when(text.rlike(f"[0-9@]|{SECRET_NAME}"), _let(found, rebuild)).otherwise(F.struct(text.alias("text"), F.lit(0).cast("long").alias("n_replaced")))


def pseudonymise(docs: DataFrame, text_col: str = "text", key: str = KEY, count_col: str | None = None) -> DataFrame:
    """``docs`` with the text column replaced (and the number of replacements); no row moves."""
    done = docs.select(F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("own"), pseudonymised(F.col(f"`{text_col}`"), key).alias("pii"))
    out = [(F.col("pii.text") if c == text_col else F.col("own")[c]).alias(c) for c in docs.columns]
    return done.select(*out, *([F.col("pii.n_replaced").alias(count_col)] if count_col else []))

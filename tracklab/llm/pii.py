"""Format-preserving pseudonyms for private values, by keyed Feistel networks in SQL functions.

Numbers and dates are validated, mapped into the set of valid values of their format, and
permuted there: a card stays a valid card, a date a date, and equal values get equal
pseudonyms in all documents.  Values that fail validation stay as they are.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tracklab.llm.common import free_name

ROUNDS = 8
KEY = "replace-this-key"

# The formats, in the order in which they are tried.
# An address starts where a run of its characters does, dots and dashes before it aside, or after two marks.
EMAIL = (r"(?:(?<![A-Za-z0-9._%+-])[.-]*+|(?<=[._%+-]{2})(?=[A-Za-z0-9]))"
         r"[A-Za-z0-9._%+-]{1,64}@[A-Za-z0-9-]{1,63}(?:\.[A-Za-z0-9-]{1,63}){0,6}\.[A-Za-z]{2,24}")
SECRET = r"(?<![A-Za-z0-9])(?=[a-fA-F]{0,63}[0-9])(?=[0-9]{0,63}[a-fA-F])[0-9a-fA-F]{32,64}(?![A-Za-z0-9])"
ISO_DATE = r"(?<![0-9-])[0-9]{4}-[0-9]{2}-[0-9]{2}(?![0-9]|-[0-9])"
DAY_DATE = r"(?<![0-9./])[0-9]{1,2}([./])[0-9]{1,2}\1[0-9]{4}(?![0-9]|[./][0-9])"
IP = r"(?<![0-9.])(?:[0-9]{1,3}\.){3}[0-9]{1,3}(?![0-9]|\.[0-9])"
SSN = r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9]|-[0-9])"
PHONE = (r"\+[0-9]{1,3}[ .-]?(?:\([0-9]{1,4}\)|[0-9]{1,4})(?:[ .-]?[0-9]{2,4}){2,4}(?![0-9])"
         r"|(?<![0-9)])(?:1[ .-]?)?\([0-9]{3}\) ?[0-9]{3}[ .-][0-9]{4}(?![0-9])"
         r"|(?<![0-9.-])(?:1[ .-])?[0-9]{3}([ .-])[0-9]{3}\2[0-9]{4}(?![0-9]|[.-][0-9])")
CARD = (r"(?<![0-9])(?:[0-9]{13,19}|[0-9]{4}([ -])[0-9]{4}\3[0-9]{4}\3[0-9]{4}|[0-9]{4}([ -])[0-9]{6}\4[0-9]{5})(?![0-9])")
ANY = "|".join([EMAIL, SECRET, ISO_DATE, DAY_DATE, IP, SSN, PHONE, CARD])
POWERS = [10 ** i for i in range(19)]

# Dates are permuted among these days; others are not taken for personal dates.
FIRST_DAY, DAYS_A, DAYS_B = "1900-01-01", 270, 270
SSN_AREAS = 898  # 001 to 899 without 666


def _hash(key: str, kind: str, n: Column, value: Column) -> Column:
    """60 bits of a keyed hash as long."""
    text = F.concat_ws("|", F.lit(key), F.lit(kind), n.cast("string"), value.cast("string"))
    return F.conv(F.substring(F.sha2(text, 256), 1, 15), 16, 10).cast("long")


def feistel(x: Column, y: Column, a: Column, b: Column, key: str, kind: str) -> Column:
    """Struct (x, y): a permutation of pairs with 0 <= x < a and 0 <= y < b.

    Rounds add a keyed hash of one half to the other by turns, modulo its size.
    """
    def turn(s: Column, n: Column) -> Column:
        even = n % 2 == 0
        return F.struct(
            F.when(even, F.pmod(s["x"] + F.pmod(_hash(key, kind, n, s["y"]), a), a)).otherwise(s["x"]).alias("x"),
            F.when(even, s["y"]).otherwise(F.pmod(s["y"] + F.pmod(_hash(key, kind, n, s["x"]), b), b)).alias("y"),
        )

    start = F.struct(x.cast("long").alias("x"), y.cast("long").alias("y"))
    return F.aggregate(F.array(*[F.lit(i) for i in range(ROUNDS)]), start, turn)


def _digits(m: Column) -> Column:
    return F.regexp_replace(m, "[^0-9]", "")


def _power(n: Column) -> Column:
    return F.element_at(F.array(*[F.lit(p).cast("long") for p in POWERS]), n + 1)


def _cut(s: Column, start, length) -> Column:
    return F.substring(s, F.lit(start) if isinstance(start, int) else start, F.lit(length) if isinstance(length, int) else length)


def _permuted_digits(digits: Column, key: str, kind: str) -> Column:
    """A permutation of the strings of as many digits (2 to 36)."""
    n = F.length(digits)
    left = F.floor(n / 2).cast("int")
    right = n - left
    out = feistel(_cut(digits, 1, left), _cut(digits, left + 1, right), _power(left), _power(right), key, kind)
    # One struct is used twice: bind it once by a transform over a single element.
    return F.element_at(F.transform(F.array(out), lambda s: F.concat(
        F.lpad(s["x"].cast("string"), left, "0"), F.lpad(s["y"].cast("string"), right, "0"))), 1)


def _fill(layout: Column, digits: Column) -> Column:
    """``layout`` with its digits replaced, in order, by ``digits``."""
    start = F.struct(F.lit("").alias("t"), F.lit(1).alias("k"))
    return F.aggregate(F.split(layout, ""), start, lambda s, c: F.when(
        c.between("0", "9"), F.struct(F.concat(s["t"], F.substring(digits, s["k"], F.lit(1))).alias("t"), (s["k"] + 1).alias("k"))
    ).otherwise(F.struct(F.concat(s["t"], c).alias("t"), s["k"].alias("k"))), lambda s: s["t"])


def _luhn(digits: Column) -> Column:
    """Luhn sum of a digit string, its last digit counted once."""
    chars = F.reverse(F.split(digits, ""))
    parts = F.transform(chars, lambda c, i: F.when(i % 2 == 0, c.cast("int")).otherwise(
        c.cast("int") * 2 - F.when(c.cast("int") > 4, 9).otherwise(0)))
    return F.aggregate(parts, F.lit(0), lambda s, v: s + v)


def is_card(m: Column) -> Column:
    """13 to 19 digits, not all the same, with a valid check digit."""
    d = _digits(m)
    return F.length(d).between(13, 19) & (_luhn(d) % 10 == 0) & (F.translate(d, "0", "") != "")


def card(m: Column, key: str) -> Column:
    """The digits but the last are permuted, the last is the check digit of the result."""
    body = _digits(m)
    body = _permuted_digits(_cut(body, 1, F.length(body) - 1), key, "card")
    whole = F.element_at(F.transform(F.array(body), lambda d: F.concat(
        d, F.pmod(-_luhn(F.concat(d, F.lit("0"))), F.lit(10)).cast("string"))), 1)
    return _fill(m, whole)


def phone(m: Column, key: str) -> Column:
    """The last ten digits, or all but the first, are permuted."""
    d = _digits(m)
    n = F.length(d)
    keep = F.when(n > 10, n - 10).when(m.startswith("+"), 1).otherwise(0)
    return _fill(m, F.concat(_cut(d, 1, keep), _permuted_digits(_cut(d, keep + 1, n - keep), key, "phone")))


def _octets(m: Column) -> Column:
    return F.transform(F.split(m, r"\."), lambda s: s.cast("long"))


def is_ip(m: Column) -> Column:
    return F.forall(_octets(m), lambda o: o <= 255)


def ip(m: Column, key: str) -> Column:
    o = _octets(m)
    size = F.lit(1 << 16).cast("long")
    out = feistel(F.get(o, F.lit(0)) * 256 + F.get(o, F.lit(1)), F.get(o, F.lit(2)) * 256 + F.get(o, F.lit(3)), size, size, key, "ip")
    return F.element_at(F.transform(F.array(out), lambda s: F.concat_ws(
        ".", F.floor(s["x"] / 256), s["x"] % 256, F.floor(s["y"] / 256), s["y"] % 256)), 1)


def is_ssn(m: Column) -> Column:
    area, group, serial = (F.get(F.split(m, "-"), F.lit(i)).cast("int") for i in range(3))
    return area.between(1, 899) & (area != 666) & (group > 0) & (serial > 0)


def ssn(m: Column, key: str) -> Column:
    area, group, serial = (F.get(F.split(m, "-"), F.lit(i)).cast("long") for i in range(3))
    x = (area - F.when(area > 666, 2).otherwise(1)) * 99 + group - 1
    out = feistel(x, serial - 1, F.lit(SSN_AREAS * 99).cast("long"), F.lit(9999).cast("long"), key, "ssn")

    def written(s: Column) -> Column:
        number = F.floor(s["x"] / 99)
        number = number + F.when(number >= 665, 2).otherwise(1)
        return F.concat_ws("-", F.lpad(number.cast("string"), 3, "0"), F.lpad((s["x"] % 99 + 1).cast("string"), 2, "0"),
                           F.lpad((s["y"] + 1).cast("string"), 4, "0"))

    return F.element_at(F.transform(F.array(out), written), 1)


def _days(year: Column, month: Column, day: Column) -> Column:
    """Days since ``FIRST_DAY``; null if it is no date or not among the permuted days."""
    date = F.concat_ws("-", year, F.lpad(month, 2, "0"), F.lpad(day, 2, "0")).try_cast("date")
    n = F.datediff(date, F.lit(FIRST_DAY).cast("date")).cast("long")
    return F.when(n.between(0, DAYS_A * DAYS_B - 1), n)


def _day_first(m: Column) -> Column:
    parts = F.split(m, "[./]")
    return _days(F.get(parts, F.lit(2)), F.get(parts, F.lit(1)), F.get(parts, F.lit(0)))


def day_number(m: Column) -> Column:
    """Days since ``FIRST_DAY`` of a yyyy-mm-dd, dd.mm.yyyy or dd/mm/yyyy date, or of a mm/dd/yyyy date that is no
    dd/mm/yyyy date; null if it is none."""
    parts = F.split(m, "/")
    month_first = _days(F.get(parts, F.lit(2)), F.get(parts, F.lit(0)), F.get(parts, F.lit(1)))
    return F.when(m.substr(5, 1) == "-", _days(m.substr(1, 4), m.substr(6, 2), m.substr(9, 2))).otherwise(
        F.coalesce(_day_first(m), month_first))


def is_date(m: Column) -> Column:
    return day_number(m).isNotNull()


def date(m: Column, key: str) -> Column:
    n = day_number(m)
    a, b = F.lit(DAYS_A).cast("long"), F.lit(DAYS_B).cast("long")
    out = feistel(F.floor(n / DAYS_B), n % DAYS_B, a, b, key, "date")

    def written(s: Column) -> Column:
        d = F.date_add(F.lit(FIRST_DAY).cast("date"), (s["x"] * DAYS_B + s["y"]).cast("int"))
        # without leading zeros where the match has none
        short = F.rlike(m, F.lit("^[0-9][./]|[./][0-9][./]"))
        day = F.when(short, F.date_format(d, "d")).otherwise(F.date_format(d, "dd"))
        month = F.when(short, F.date_format(d, "M")).otherwise(F.date_format(d, "MM"))
        mark, day_first = F.regexp_extract(m, "[./]", 0), _day_first(m).isNotNull()
        return F.when(m.substr(5, 1) == "-", F.date_format(d, "yyyy-MM-dd")).otherwise(F.concat(
            F.when(day_first, day).otherwise(month), mark, F.when(day_first, month).otherwise(day), mark, F.date_format(d, "yyyy")))

    return F.element_at(F.transform(F.array(out), written), 1)


def email(m: Column, key: str) -> Column:
    """Keyed names for the local part and the domain, which both stay linked; the top level and dots and dashes before the address stay."""
    marks = F.regexp_extract(m, "^[.-]*", 0)
    low = F.lower(F.regexp_replace(m, "^[.-]+", ""))
    domain = F.regexp_extract(low, "@(.*)$", 1)
    name = lambda kind, v, n: F.substring(F.sha2(F.concat_ws("|", F.lit(key), F.lit(kind), v), 256), 1, n)
    return F.concat(marks, F.lit("u"), name("email", low, 12), F.lit("@d"), name("domain", domain, 8), F.regexp_extract(low, r"\.[a-z]+$", 0))


def secret(m: Column, key: str) -> Column:
    """As many hex digits of a keyed hash."""
    return F.substring(F.sha2(F.concat_ws("|", F.lit(key), F.lit("secret"), F.lower(m)), 512), F.lit(1), F.length(m))


def _is(m: Column, pattern: str) -> Column:
    return F.rlike(m, F.lit(f"^(?:{pattern})$"))


def pseudonym(m: Column, key: str) -> Column:
    """The pseudonym of a match of ``ANY``; the match itself where it is not valid."""
    d = _digits(m)
    kinds = [
        (F.contains(m, F.lit("@")), email(m, key)),
        (_is(m, "[0-9a-fA-F]{32,64}"), secret(m, key)),
        (_is(m, r"[0-9]{4}-[0-9]{2}-[0-9]{2}|[0-9]{1,2}[./][0-9]{1,2}[./][0-9]{4}"), F.when(is_date(m), date(m, key))),
        (_is(m, r"(?:[0-9]{1,3}\.){3}[0-9]{1,3}"), F.when(is_ip(m), ip(m, key))),
        (_is(m, "[0-9]{3}-[0-9]{2}-[0-9]{4}"), F.when(is_ssn(m), ssn(m, key))),
        (F.rlike(m, F.lit(r"^[+(]|^1[ .-]?\(|^(?:1[ .-])?[0-9]{3}([ .-])[0-9]{3}\1[0-9]{4}$")), F.when(F.length(d).between(7, 15), phone(m, key))),
    ]
    out = F.when(kinds[0][0], kinds[0][1])
    for condition, value in kinds[1:]:
        out = out.when(condition, value)
    return F.coalesce(out.otherwise(F.when(is_card(m), card(m, key))), m)


def pseudonymised(df: DataFrame, text: str = "text", key: str = KEY, count: str = "n_private") -> DataFrame:
    """``df`` with private values of ``text`` replaced and ``count``, their number.

    A null text stays null, with 0; other columns stay (one of the name of ``count`` is replaced).  The text
    is cut at the matches, only these are rewritten, and the parts are joined again: the
    cost is linear in the text.  ``key`` must be kept secret outside tests.
    """
    body, found, new = F.col(text), free_name(df, "_found"), free_name(df, "_new")
    names = df.columns
    # Texts without digits and @ hold nothing of any format.
    out = df.withColumn(found, F.when(F.rlike(body, F.lit("[0-9@]")), F.regexp_extract_all(body, F.lit(ANY), F.lit(0))))
    out = out.withColumn(new, F.when(F.size(found) > 0, F.transform(found, lambda m: pseudonym(m, key))))
    parts = F.zip_with(F.split(body, ANY, -1), F.concat(new, F.array(F.lit(""))), lambda gap, m: F.concat(gap, m))
    changed = F.size(F.filter(F.arrays_zip(F.col(found).alias("a"), F.col(new).alias("b")), lambda p: p["a"] != p["b"]))
    written = F.when(F.col(new).isNull(), body).otherwise(F.array_join(parts, ""))
    kept = [written.alias(c) if c == text else F.col(f"`{c}`") for c in names if c.lower() != count]
    number = F.when(F.col(new).isNull(), 0).otherwise(changed).cast("long").alias(count)
    return out.select(*kept, number)

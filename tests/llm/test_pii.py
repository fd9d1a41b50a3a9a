"""Pseudonyms against a plain Feistel network, their validity, and that equal values stay equal."""

import datetime
import hashlib
import re

from pyspark.sql import functions as F

from tracklab.llm import pii

KEY = "k1"


def plain_hash(kind, n, value):
    return int(hashlib.sha256(f"{KEY}|{kind}|{n}|{value}".encode()).hexdigest()[:15], 16)


def plain_feistel(x, y, a, b, kind):
    for n in range(pii.ROUNDS):
        if n % 2 == 0:
            x = (x + plain_hash(kind, n, y) % a) % a
        else:
            y = (y + plain_hash(kind, n, x) % b) % b
    return x, y


def plain_digits(digits, kind):
    left = len(digits) // 2
    right = len(digits) - left
    x, y = plain_feistel(int(digits[:left]), int(digits[left:]), 10 ** left, 10 ** right, kind)
    return f"{x:0{left}d}{y:0{right}d}"


def luhn_ok(digits):
    return sum(int(c) if i % 2 == 0 else sum(divmod(2 * int(c), 10)) for i, c in enumerate(reversed(digits))) % 10 == 0


def valid_card(body):
    return next(body + str(c) for c in range(10) if luhn_ok(body + str(c)))


def laid_out(layout, digits):
    it = iter(digits)
    return "".join(next(it) if c.isdigit() else c for c in layout)


def rewritten(frame, texts, **kw):
    df = frame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string")
    rows = sorted(pii.pseudonymised(df, key=KEY, **kw).collect(), key=lambda r: r.doc_id)
    return [(r.text, r.n_private) for r in rows]


def test_cards_phones_dates_ips_ssns_equal_a_plain_network(frame):
    cards = [valid_card("411111111111111"), valid_card("37828224631000"), valid_card("6011000990139424"[:15]), valid_card("497010000000"), valid_card("123456789012345678")]
    grouped = f"{cards[0][:4]} {cards[0][4:8]} {cards[0][8:12]} {cards[0][12:]}"
    values, want = [], []
    for c in [*cards, grouped]:
        values.append(c)
        want.append(laid_out(c, valid_card(plain_digits(re.sub(r"\D", "", c)[:-1], "card"))))
    for p, keep in (("+1 (017) 555-7713", 1), ("+49 170 1234567", 2), ("(212) 555-0199", 0), ("212-555-0199", 0)):
        d = re.sub(r"\D", "", p)
        values.append(p)
        want.append(laid_out(p, d[:keep] + plain_digits(d[keep:], "phone")))
    first = datetime.date(1900, 1, 1)
    for day in ("1987-03-14", "1900-01-01", "2000-02-29"):
        n = (datetime.date.fromisoformat(day) - first).days
        x, y = plain_feistel(n // 270, n % 270, 270, 270, "date")
        new = first + datetime.timedelta(days=x * 270 + y)
        for form in ("%Y-%m-%d", "%d.%m.%Y", "%d/%m/%Y"):
            values.append(datetime.date.fromisoformat(day).strftime(form))
            want.append(new.strftime(form))
    for ip in ("97.51.17.173", "0.0.0.0", "255.255.255.255"):
        a, b, c, d = map(int, ip.split("."))
        x, y = plain_feistel(a * 256 + b, c * 256 + d, 65536, 65536, "ip")
        values.append(ip)
        want.append(f"{x // 256}.{x % 256}.{y // 256}.{y % 256}")
    for s in ("123-45-6789", "667-01-0001", "899-99-9999", "001-01-0001"):
        a, g, n = map(int, s.split("-"))
        x, y = plain_feistel((a - (2 if a > 666 else 1)) * 99 + g - 1, n - 1, 898 * 99, 9999, "ssn")
        area = x // 99 + 1
        values.append(s)
        want.append(f"{area + (area >= 666):03d}-{x % 99 + 1:02d}-{y + 1:04d}")
    got = rewritten(frame, [f"see {v}, or {v}!" for v in values])
    assert got == [(f"see {w}, or {w}!", 2) for w in want]


def test_invalid_values_stay(frame):
    texts = ["4111111111111112", "1234567890123456", "999.1.1.1", "1.2.3.4.5", "31/02/1999", "2023-13-01", "666-12-1234", "000-12-1234", "123-00-1234",
             "x@y", "a1b2c3", "2023-01-011", "10000000000000000000000", "deadbeef" * 3, "a" * 40, "1" * 40, "v1.2.3", "3.14 and 12-34"]
    assert rewritten(frame, texts) == [(t, 0) for t in texts]


def test_emails_and_secrets_are_linked(frame):
    secret = "39dbebab99ab99999d99eeaaf9ac999e9999f999"
    (a, n), (b, _), (c, _), (d, m) = rewritten(frame, ["A.B+c@Mail7.example.com x", "to a.b+c@mail7.example.com.", "z@mail7.example.com", f'"{secret}" {secret}'])
    first, second, third = (re.search(r"u\w+@(d\w+)\.com", x) for x in (a, b, c))
    assert n == 1 and first[0] == second[0] and first[1] == third[1] and first[0] != third[0] and "mail7" not in a + b + c
    one, two = re.findall(r"[0-9a-f]{40}", d)
    assert m == 2 and one == two != secret


def test_permutation_of_a_whole_domain(spark):
    pairs = spark.range(30 * 7).select(pii.feistel(F.floor(F.col("id") / 7), F.col("id") % 7, F.lit(30).cast("long"), F.lit(7).cast("long"), KEY, "t").alias("s"))
    out = [(r.s.x, r.s.y) for r in pairs.collect()]
    assert sorted(out) == [(x, y) for x in range(30) for y in range(7)]
    days = spark.range(0, 72_900, 9).select(pii.date(F.date_format(F.date_add(F.lit("1900-01-01").cast("date"), F.col("id").cast("int")), "yyyy-MM-dd"), KEY).alias("d"))
    seen = [r.d for r in days.collect()]
    assert len(set(seen)) == len(seen) and all(datetime.date.fromisoformat(d) for d in seen)


def test_key_matters_and_nulls_and_clashes(frame):
    df = frame([(1, None, 5), (1, None, 5), (2, "", 6), (None, "ip 1.2.3.4 " + "word " * 60_000 + "+1 (017) 555-7713", 7)], "doc_id long, text string, n_private long")
    rows = pii.pseudonymised(df, key="a").collect()
    other = pii.pseudonymised(df, key="b").collect()
    assert sorted((r.n_private, r.text is None) for r in rows) == [(0, False), (0, True), (0, True), (2, False)]
    long = [next(r.text for r in x if r.n_private) for x in (rows, other)]
    assert long[0] != long[1] and all(len(t) > 300_000 and "1.2.3.4 " not in t[:12] for t in long)
    clash = frame([(1, "1.2.3.4", "keep", "me")], "doc_id long, text string, _found string, _new string", 1)
    out = pii.pseudonymised(clash).collect()[0]
    assert (out["_found"], out["_new"], out["n_private"]) == ("keep", "me", 1)
    assert pii.pseudonymised(frame([], "doc_id long, text string", 1)).count() == 0


def test_common_written_forms(frame):
    phones = [("1-800-555-1234", 1), ("555 123 4567", 0), ("1 (800) 555-1234", 1), ("1(800) 555-1234", 1), ("1 800.555.1234", 1), ("212-555-0199", 0)]
    values = [p for p, _ in phones]
    want = [laid_out(p, (d := re.sub(r"\D", "", p))[:keep] + plain_digits(d[keep:], "phone")) for p, keep in phones]
    first = datetime.date(1900, 1, 1)
    for text, day, form in (("12/25/1980", (1980, 12, 25), "{m:02}/{d:02}/{y}"), ("5/7/1990", (1990, 7, 5), "{d}/{m}/{y}"), ("5.7.1990", (1990, 7, 5), "{d}.{m}.{y}"),
                            ("1/31/2001", (2001, 1, 31), "{m}/{d}/{y}"), ("05/07/1990", (1990, 7, 5), "{d:02}/{m:02}/{y}")):
        n = (datetime.date(*day) - first).days
        x, y = plain_feistel(n // 270, n % 270, 270, 270, "date")
        new = first + datetime.timedelta(days=x * 270 + y)
        values.append(text)
        want.append(form.format(d=new.day, m=new.month, y=new.year))
    assert rewritten(frame, [f"see {v}, or {v}!" for v in values]) == [(f"see {w}, or {w}!", 2) for w in want]
    stay = ["12.25.1980", "13/32/1980", "0/5/1990", "1/1/1899", "1-2/1990"]
    assert rewritten(frame, stay) == [(t, 0) for t in stay]


def test_marks_around_emails(frame):
    texts = ["jo@x.com", "_jo@x.com", "--jo@x.com", "...jo@x.com", "+jo@x.com", "a" + "-" * 90 + "jo@x.com", "-" * 200 + "jo@x.com", "--@x.com"]
    got = rewritten(frame, texts)
    assert [n for _, n in got] == [1] * 7 + [0] and all("jo@" not in t for t, _ in got)
    assert got[2][0] == "--" + got[0][0] and got[3][0] == "..." + got[0][0] and got[5][0].endswith("--" + got[0][0])

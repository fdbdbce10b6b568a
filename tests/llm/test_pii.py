"""Personal data against a plain statement of the rules in Python's re, by row."""

import hashlib
import random
import re

from placeflow.llm.pii import pii_report

EMAIL, IP, CARD, PHONE = r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", r"[0-9]([\x20-]?[0-9])+", r"\+[0-9][\x20().0-9-]+[0-9]"


def luhn(digits):
    total = 0
    for i, d in enumerate(map(int, reversed(digits))):
        total += d if i % 2 == 0 else (d * 2 if d < 5 else d * 2 - 9)
    return total % 10 == 0


def brute(text):
    found = []
    for kind, (name, pattern) in enumerate([("email", EMAIL), ("ip", IP), ("card", CARD), ("phone", PHONE)]):
        for m in re.finditer(pattern, text or ""):
            digits = re.sub("[^0-9]", "", m[0])
            ok = {"email": True, "ip": all(int(p) <= 255 for p in m[0].split(".")) if name == "ip" else True, "card": 14 <= len(digits) <= 19 and luhn(digits), "phone": 10 <= len(digits) <= 15}[name]
            if ok:
                found.append((m.start(), kind, m.end(), name))
    base = ",".join(f"{n}:{s}:{e}" for s, _, e, n in sorted(found))
    return [sum(f[3] == n for f in found) for n in ("email", "ip", "card", "phone")], hashlib.sha256(base.encode()).hexdigest(), base


def check(spark, rows):
    df = spark.createDataFrame([(i, t, "x") for i, t in enumerate(rows)], "doc_id long, text string, spans string")
    got = {r.doc_id: r for r in pii_report(df).collect()}
    assert len(got) == len(rows)
    for i, t in enumerate(rows):
        counts, digest, base = brute(t)
        r = got[i]
        assert ([r.n_email, r.n_ip, r.n_card, r.n_phone], r.base_sha256) == (counts, digest), (t[:200] if t else t, r.spans, base)
    return got


def test_random_texts(spark):
    rnd = random.Random(3)
    bits = ["a@b.co", "@", ".", "..", "-", " ", "  ", "1.2.3.4", "999.1.2.3", "007.08.9.1", "4111 1111 1111 1111", "4111-1111-1111-1111", "5500005555555559", "+1 (555) 010-9999", "+44", "12", "3", "0", "_e@f.g", "x", "é", "😀", "\n", "\t", "a%b+c@d-e.f.g", "1.2.3.4.5.6.7.8", "+1.2.3.4.5.6.7.8.9.10"]
    check(spark, ["".join(rnd.choice(bits) for _ in range(rnd.randint(0, 14))) for _ in range(3000)])


def test_edges(spark):
    long = ["a" * 4000, "1" * 4000, "1 " * 4000, "+1 " * 4000, "a.b" * 1500 + "@x.y", "1." * 4000, "a@" + "b." * 800 + "c"]
    got = check(spark, [None, "", "a@b.c-d_e@f.g", "a@b.c..d@e.f", "1  4111111111111111", *long])
    assert got[0].spans == "" and got[0].risk == 0


def test_method_adds_ibans_and_context(spark):
    rows = [(1, "iban DE89 3704 0044 0532 0130 00 end"), (2, "DE89 3704 0044 0532 0130 01 end"), (3, "call +1 555 010 9999"), (4, "zzzz +1 555 010 9999")]
    got = {r.doc_id: r for r in pii_report(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert "iban:5:32" in got[1].spans and "iban" not in got[2].spans
    assert got[3].risk > got[4].risk
    assert got[1].base_sha256 == brute(rows[0][1])[1]


def test_ibans_against_the_checksum(spark):
    """An IBAN is a span if and only if its number, letters as 10 to 35, leaves 1 modulo 97."""
    rnd = random.Random(8)
    rows, want = [], {}
    for i in range(300):
        country, body = rnd.choice(["DE", "GB", "FR"]), "".join(rnd.choice("0123456789ABCXYZ") for _ in range(rnd.randint(11, 30)))
        number = lambda s: int("".join(str(int(c, 36)) for c in s))
        check = 98 - number(body + country + "00") % 97 if i % 2 else rnd.randint(2, 98)
        iban = f"{country}{check:02d}{body}"
        want[i] = number(body + iban[:4]) % 97 == 1
        rows.append((i, f"é {iban}."))
    got = {r.doc_id: f"iban:2:{len(t) - 1}" in r.spans for r, (_, t) in zip(sorted(pii_report(spark.createDataFrame(rows, "doc_id long, text string")).collect()), rows, strict=True)}
    assert got == want and 140 < sum(want.values()) < 170


def test_many_spans_in_one_text(spark):
    text = "mail a@b.co or 1.2.3.4 " * 3000
    got = pii_report(spark.createDataFrame([(1, text)], "doc_id long, text string")).first()
    assert (got.n_email, got.n_ip, got.base_sha256) == (3000, 3000, brute(text)[1])


def test_empty_table(spark):
    assert pii_report(spark.createDataFrame([], "doc_id long, text string")).count() == 0

"""Personal data in texts, with built-in SQL functions only.

Regular expressions propose spans, checksums (Luhn for cards, mod-97 for IBANs) and value ranges
confirm them, and words near a span move its score. All patterns run in time linear in the text:
runs are entered at their first character only, and no group repeats without a bound, but for the
labels of a mail domain.

Null texts count as empty. Documents are taken row by row, so repeated rows give repeated results; a very long text
takes memory of a few times its size.
Other columns of the input, whatever their names, are ignored. An empty table gives an empty table.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from placeflow.llm._common import texts

#: Fixed patterns. Each finds what the plain form beside it finds from left to right.
EMAIL = r"(?:(?<![A-Za-z0-9._%+-])|\G)[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++"  # [A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+
IP = r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++"  # [0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)
CARD = r"(?<![0-9])(?<![0-9][\x20-])[0-9](?:[\x20-]?[0-9]){13,18}+(?![\x20-]?[0-9])"  # [0-9]([\x20-]?[0-9])+ of 14 to 19 digits
PHONE = r"\+[0-9][\x20().0-9-]+[0-9]"
IBAN = r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?:\x20?[A-Z0-9]){11,30}+(?![A-Za-z0-9])"
OCTETS = r"^0*(?:25[0-5]|2[0-4][0-9]|1?[0-9]?[0-9])(?:\.0*(?:25[0-5]|2[0-4][0-9]|1?[0-9]?[0-9])){3}$"
#: Kinds in the order that settles equal starts; the first four are the base kinds.
KINDS = ("email", "ip", "card", "phone", "iban")
BASE = KINDS[:4]
#: Score of a confirmed span, and words that raise it when they stand within CONTEXT characters before it.
PRIOR = {"email": 0.8, "ip": 0.5, "card": 0.8, "phone": 0.6, "iban": 0.9}
NEAR = {"email": "mail|contact|write", "ip": "ip|host|server|address", "card": "card|visa|credit|payment", "phone": "phone|tel|call|mobile|fax", "iban": "iban|bank|account|konto"}
CONTEXT, BOOST = 40, 0.15
#: Spans carried in one array.
CHUNK = 256


def luhn(span: Column) -> Column:
    """Whether the digits of the span pass Luhn's test."""
    digits = F.split(F.reverse(F.regexp_replace(span, "[^0-9]", "")), "")
    doubled = F.transform(digits, lambda x, i: F.when(i % 2 == 1, (x.cast("int") * 2).cast("int")).otherwise(x.cast("int")))
    return F.aggregate(doubled, F.lit(0), lambda a, x: a + F.when(x > 9, x - 9).otherwise(x)) % 10 == 0


def mod97(span: Column) -> Column:
    """Whether an IBAN's check digits hold: its first four characters moved to the end, letters as 10 to 35, remainder 1."""
    code = F.replace(span, F.lit(" "), F.lit(""))
    turned = F.concat(F.substring(code, 5, 40), F.substring(code, 1, 4))
    value = lambda c: F.when(c.between("0", "9"), F.ascii(c) - 48).otherwise(F.ascii(c) - 55)
    return F.aggregate(F.split(turned, ""), F.lit(0), lambda a, c: (F.when(value(c) > 9, a * 100).otherwise(a * 10) + value(c)) % 97) == 1


def _confirmed(kind: str, span: Column) -> Column:
    if kind == "ip":
        return span.rlike(OCTETS)
    if kind == "card":
        return luhn(span)
    if kind == "phone":
        return F.length(F.regexp_replace(span, "[^0-9]", "")).between(10, 15)
    return mod97(span) if kind == "iban" else F.lit(True)


def _spans(kind: str, text: Column) -> Column:
    """Array of (start, end, kind number, score) of the confirmed spans of a kind, in code points."""
    pattern = {"email": EMAIL, "ip": IP, "card": CARD, "phone": PHONE, "iban": IBAN}[kind]
    found = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    # What stands between the matches; with the lengths of both, each start is a sum.
    gaps = F.split(text, pattern, -1)
    pieces = F.arrays_zip(F.slice(gaps, 1, F.size(found)).alias("gap"), found.alias("hit"))
    empty = F.expr("cast(array() as array<struct<gap:string,hit:string,start:int>>)")
    # Only confirmed spans are carried, in short arrays that are put by when full, so that long lists aren't copied again and again.
    begin = F.struct(F.lit(0).alias("at"), empty.alias("out"), F.array().cast("array<array<struct<gap:string,hit:string,start:int>>>").alias("full"))

    def step(acc, p):
        start = acc["at"] + F.length(p["gap"])
        is_full = F.size(acc["out"]) >= CHUNK
        before = F.when(is_full, empty).otherwise(acc["out"])
        kept = F.when(_confirmed(kind, p["hit"]), F.concat(before, F.array(F.struct(p["gap"].alias("gap"), p["hit"].alias("hit"), start.alias("start"))))).otherwise(before)
        return F.struct((start + F.length(p["hit"])).alias("at"), kept.alias("out"), F.when(is_full, F.concat(acc["full"], F.array(acc["out"]))).otherwise(acc["full"]).alias("full"))

    confirmed = F.aggregate(pieces, begin, step, lambda acc: F.flatten(F.concat(acc["full"], F.array(acc["out"]))))
    near = lambda p: F.lower(F.right(p["gap"], F.lit(CONTEXT))).rlike(rf"(?:^|[^a-z])(?:{NEAR[kind]})")
    return F.transform(
        confirmed,
        lambda p: F.struct(p["start"].alias("start"), F.lit(KINDS.index(kind)).alias("kind"), (p["start"] + F.length(p["hit"])).alias("end"), (F.lit(PRIOR[kind]) + F.when(near(p), BOOST).otherwise(0.0)).alias("score")),
    )


#: Cheap tests that a text must pass before a kind's spans are worked out.
_MAY = {
    "email": lambda t: t.contains("@"),
    "ip": lambda t: t.rlike(r"[0-9]\.[0-9]++\.[0-9]++\.[0-9]"),
    "card": lambda t: t.rlike(r"[0-9](?:[\x20-]?[0-9]){13}"),
    "phone": lambda t: t.contains("+"),
    "iban": lambda t: t.rlike(r"[A-Z]{2}[0-9]{2}(?:\x20?[A-Z0-9]){11}"),
}
_NONE = "cast(array() as array<struct<start:int,kind:int,end:int,score:double>>)"


def find_pii(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, pii: array of (start, kind number in KINDS, end, score) by start, then kind. No shuffle, no Python."""
    text = F.col("text")
    lists = [F.when(_MAY[k](text), _spans(k, text)).otherwise(F.expr(_NONE)) for k in KINDS]
    return texts(docs, id_col, text_col).select("doc_id", F.array_sort(F.concat(*lists)).alias("pii"))


def _named(spans: Column) -> Column:
    names = F.array(*(F.lit(k) for k in KINDS))
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", F.element_at(names, s["kind"] + 1), s["start"], s["end"])), ",")


def _count(spans: Column, kind: int) -> Column:
    return F.size(F.filter(spans, lambda s: s["kind"] == kind)).cast("long")


def pii_report(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Counts of the base kinds, a digest of the base spans, all spans and the highest score, for each document."""
    found = find_pii(docs, id_col, text_col)
    pii = F.col("pii")
    counts = [_count(pii, k).alias(f"n_{name}") for k, name in enumerate(BASE)]
    base = F.filter(pii, lambda s: s["kind"] < len(BASE))
    return found.select(
        "doc_id",
        *counts,
        F.sha2(_named(base), 256).alias("base_sha256"),
        _named(pii).alias("spans"),
        F.coalesce(F.array_max(F.transform(pii, lambda s: s["score"])), F.lit(0.0)).alias("risk"),
    )

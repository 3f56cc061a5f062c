"""Personal data: patterns propose spans, checksums confirm them, words nearby adjust the score.

Everything is built from SQL functions. The patterns give the matches that the plain ones in
``PLAIN`` give, left to right, but take time in proportion to the text: runs are taken whole
(possessive), and a match may begin inside a run only where the last match ended (``\\G``).
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# The plain patterns of the four base kinds.
PLAIN = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
LINEAR = {
    "email": r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9](?:[\x20-]?[0-9])++",
    "phone": PLAIN["phone"],
    "iban": r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]{4}){2,7}(?: ?[A-Z0-9]{1,3})?(?![A-Za-z0-9])",
    "ssn": r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])",
    "local_phone": r"(?<![0-9+])\(?[0-9]{3}\)?[-. ][0-9]{3}[-. ][0-9]{4}(?![0-9])",
}
# What a text must contain for the kind's pattern to be tried at all.
NEEDED = {
    "email": r"[A-Za-z0-9._%+-]@[A-Za-z0-9-]",
    "ip": r"[0-9]\.[0-9]++\.[0-9]++\.[0-9]",
    "card": r"[0-9](?:[\x20-]?[0-9]){11}",
    "phone": r"\+[0-9]",
    "iban": r"[A-Z]{2}[0-9]{2} ?[A-Z0-9]{4}",
    "ssn": r"[0-9]{3}-[0-9]{2}-[0-9]{4}",
    "local_phone": r"[0-9]{3}\)?[-. ][0-9]{3}[-. ][0-9]{4}",
}
KINDS = list(LINEAR)
BASE = list(PLAIN)
# Score of a confirmed span alone, and the words that raise it.
ALONE = {"email": 0.9, "ip": 0.6, "card": 0.8, "phone": 0.7, "iban": 0.9, "ssn": 0.4, "local_phone": 0.3}
CONTEXT = {
    "email": "mail|contact|write",
    "ip": "ip|host|server|address",
    "card": "card|visa|credit|debit|payment",
    "phone": "phone|tel|call|mobile|fax",
    "iban": "iban|bank|account|konto",
    "ssn": "ssn|social security|taxpayer",
    "local_phone": "phone|tel|call|mobile|fax",
}
RAISED, REACH, ENOUGH = 0.4, 40, 0.6

# Matches, or spans, that are folded over or compared at once: time stays in proportion to the text.
BLOCK = 256
# Matches and the gaps before them that reach back, or on, REACH characters: each pair has three at least.
NEAR = -(-REACH // 3)


def once(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is worked out once, however often the body uses it."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def matches_of(text: Column, pattern: str) -> Column:
    """Each match ``m`` with the text since the last one, as far as it is looked at; the last has no match.

    ``head`` and ``tail`` are the first and last characters of gap and match together, ``near`` the last of the gap.
    """
    found = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))

    def pair(m: Column, gap: Column) -> Column:
        both = F.concat(gap, F.coalesce(m, F.lit("")))
        return F.struct(
            m.alias("m"),
            F.length(gap).alias("gap"),
            F.length(m).alias("length"),
            F.left(both, F.lit(REACH)).alias("head"),
            F.right(both, F.lit(REACH)).alias("tail"),
            F.right(gap, F.lit(REACH)).alias("near"),
        )

    return F.zip_with(found, F.split(text, pattern, -1), pair)


def blocks_of(items: Column, count: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of each run of BLOCK items; for a count of 1 or more."""

    def block(b: Column) -> Column:
        return body(F.slice(items, b * BLOCK + 1, F.least(F.lit(BLOCK), count - b * BLOCK)))

    return F.transform(F.sequence(F.lit(0), F.floor((count - 1) / BLOCK).cast("int")), block)


def places_of(matches: Column) -> Column:
    """(start, end) of each match in code points: inside blocks of matches first, then of the blocks."""

    def onward(s: Column, p: Column) -> Column:
        start = s["at"] + p["gap"]
        end = start + p["length"]
        return F.struct(end.alias("at"), F.concat(s["out"], F.array(F.struct(start.alias("start"), end.alias("end")))).alias("out"))

    def next_block(s: Column, b: Column) -> Column:
        return F.struct((s["at"] + b["at"]).alias("at"), F.concat(s["out"], F.array(s["at"])).alias("out"))

    def moved(b: Column, by: Column) -> Column:
        return F.transform(b["out"], lambda x: F.struct((x["start"] + by).alias("start"), (x["end"] + by).alias("end")))

    def start(kind: str) -> Column:
        return F.struct(F.lit(0).alias("at"), F.array().cast(kind).alias("out"))

    def joined(blocks: Column) -> Column:
        offsets = F.aggregate(blocks, start("array<int>"), next_block, lambda s: s["out"])
        return F.flatten(F.zip_with(blocks, offsets, moved))

    places = "array<struct<start:int,end:int>>"
    count = F.size(matches) - 1
    blocks = blocks_of(matches, count, lambda part: F.aggregate(part, start(places), onward))
    return F.when(count > 0, once(blocks, joined)).otherwise(F.array().cast(places))


def luhn(digits: Column) -> Column:
    doubled = F.array(*(F.lit(v) for v in (0, 2, 4, 6, 8, 1, 3, 5, 7, 9)))
    marks = F.transform(F.split(F.reverse(digits), ""), lambda c: F.when(c == "", 0).otherwise(c.cast("int")))
    values = F.transform(marks, lambda d, i: F.when(i % 2 == 1, F.get(doubled, d)).otherwise(d))
    return F.aggregate(values, F.lit(0), lambda a, v: a + v) % 10 == 0


def mod_97(value: Column) -> Column:
    """Account number checksum: the first four characters go last, letters count from 10."""
    body = F.replace(value, F.lit(" "), F.lit(""))
    turned = F.concat(F.substr(body, F.lit(5)), F.substr(body, F.lit(1), F.lit(4)))

    def onward(a: Column, c: Column) -> Column:
        code = F.ascii(c)
        return F.when(code >= 65, a * 100 + code - 55).otherwise(a * 10 + code - 48) % 97

    chars = F.filter(F.split(turned, ""), lambda c: c != "")
    return F.aggregate(chars, F.lit(0), onward) == 1


def confirmed(kind: str, value: Column) -> Column:
    digits = F.regexp_replace(value, "[^0-9]", "")
    if kind == "ip":
        part = r"0*(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[0-9]{1,2})"
        return value.rlike(rf"^{part}(?:\.{part}){{3}}$")
    if kind == "card":
        return F.when(F.length(digits).between(12, 19), luhn(digits)).otherwise(F.lit(False))
    if kind == "phone":
        return F.length(digits).between(9, 15)
    if kind == "iban":
        return F.length(F.replace(value, F.lit(" "), F.lit(""))).between(15, 34) & mod_97(value)
    if kind == "ssn":
        return ~value.rlike(r"^(?:000|666|9)|-00-|-0000$")
    return F.lit(True)


def spans_of(text: Column, kind: str) -> Column:
    """Confirmed spans of a kind, scored."""
    word = rf"(?:^|[^a-z])(?:{CONTEXT[kind]})"

    def scored(s: Column, matches: Column) -> Column:
        i = s["i"]
        back = F.transform(F.slice(matches, F.greatest(F.lit(1), i - NEAR + 1), F.least(i, F.lit(NEAR))), lambda p: p["tail"])
        before = F.right(F.concat(F.array_join(back, ""), F.get(matches, i)["near"]), F.lit(REACH))
        after = F.left(F.array_join(F.transform(F.slice(matches, i + 2, F.lit(NEAR + 1)), lambda p: p["head"]), ""), F.lit(REACH))
        near = F.lower(before).rlike(word) | F.lower(after).rlike(word)
        return F.struct(
            s["start"].alias("start"),
            F.lit(KINDS.index(kind)).alias("rank"),
            s["end"].alias("end"),
            F.lit(kind).alias("kind"),
            s["value"].alias("value"),
            F.least(F.lit(1.0), F.lit(ALONE[kind]) + F.when(near, RAISED).otherwise(0.0)).alias("score"),
        )

    def spans(matches: Column) -> Column:
        placed = F.transform(
            places_of(matches),
            lambda x, i: F.struct(x["start"].alias("start"), x["end"].alias("end"), F.get(matches, i)["m"].alias("value"), i.alias("i")),
        )
        return F.transform(F.filter(placed, lambda s: confirmed(kind, s["value"])), lambda s: scored(s, matches))

    empty = F.array().cast("array<struct<start:int,rank:int,end:int,kind:string,value:string,score:double>>")
    return F.when(text.rlike(NEEDED[kind]), once(matches_of(text, LINEAR[kind]), spans)).otherwise(empty)


def find_pii(docs: DataFrame) -> DataFrame:
    """Spans of personal data in documents (doc_id, text): ``doc_id, text, base, spans``, row for row.

    ``base`` holds all confirmed spans of the base kinds; ``spans`` adds account numbers, and social
    security and local phone numbers that words nearby support, where they overlap no base span.
    Both are sorted by start, then by kind as listed in ``KINDS``; places count code points from 0 and
    ends are exclusive. NULL text counts as empty and has no spans. Further columns are not looked at.
    """
    text = F.coalesce(F.col("text"), F.lit(""))
    found = docs.select("doc_id", "text").select("doc_id", text.alias("text"))
    found = found.select("*", *(spans_of(F.col("text"), kind).alias(kind) for kind in KINDS))
    base = F.sort_array(reduce(F.concat, (F.col(k) for k in BASE)))
    found = found.withColumn("base", base)

    def reach(part: Column) -> Column:
        ends = F.transform(part, lambda b: b["end"])
        return F.struct(F.get(part, F.lit(0))["start"].alias("start"), F.array_max(ends).alias("end"), part.alias("spans"))

    def meets(a: Column, b: Column) -> Column:
        return (b["start"] < a["end"]) & (a["start"] < b["end"])

    count = F.size("base")
    blocks = F.when(count > 0, blocks_of(F.col("base"), count, reach)).otherwise(F.array())
    added = reduce(F.concat, (F.col(k) for k in KINDS if k not in BASE))
    added = F.filter(added, lambda s: s["score"] >= ENOUGH)

    def apart(blocks: Column) -> Column:
        return F.filter(added, lambda s: ~F.exists(blocks, lambda b: meets(s, b) & F.exists(b["spans"], lambda x: meets(s, x))))

    added = F.when(F.size(added) == 0, added).otherwise(once(blocks, apart))
    return found.select("doc_id", "text", "base", F.sort_array(F.concat("base", added)).alias("spans"))


def redact(found: DataFrame) -> DataFrame:
    """Add ``clean_text``: each span becomes ``[kind]``; where spans overlap, the first to start counts."""

    def onward(s: Column, x: Column) -> Column:
        taken = F.concat(s["out"], F.substr(F.col("text"), s["at"] + 1, x["start"] - s["at"]), F.lit("["), x["kind"], F.lit("]"))
        fits = x["start"] >= s["at"]
        return F.struct(
            F.when(fits, x["end"]).otherwise(s["at"]).alias("at"), F.when(fits, taken).otherwise(s["out"]).alias("out")
        )

    first = F.struct(F.lit(0).alias("at"), F.lit("").alias("out"))
    clean = F.aggregate("spans", first, onward, lambda s: F.concat(s["out"], F.substr(F.col("text"), s["at"] + 1)))
    return found.withColumn("clean_text", clean)


def as_text(spans: Column) -> Column:
    places = F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string")))
    return F.concat_ws(",", places)


def digest(found: DataFrame) -> DataFrame:
    """Counts of the base kinds, a hash of the base spans, and all spans as text."""
    kinds = F.transform("base", lambda s: s["kind"])
    return found.select(
        "doc_id",
        *((F.size(kinds) - F.size(F.array_remove(kinds, kind))).cast("long").alias(f"n_{kind}") for kind in BASE),
        F.sha2(as_text(F.col("base")).cast("binary"), 256).alias("base_sha256"),
        as_text(F.col("spans")).alias("spans"),
    )

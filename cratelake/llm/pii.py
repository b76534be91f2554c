"""Personal data: expressions propose spans, checksums confirm them, words nearby weigh in."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# The contract's base kinds in its order. They are its expressions, written so that no text takes
# more than linear time: no backing up, and no start where an earlier start has failed.
EMAIL = r"(?:(?<![A-Za-z0-9._%+-])|\G)[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++"
IP = r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++"
CARD = r"(?<![0-9])(?<![0-9][ -])[0-9](?:[ -]?[0-9]){12,18}+(?![ -]?[0-9])"
PHONE = r"\+[0-9][ ().0-9-]+[0-9]"
BASE = ["email", "ip", "card", "phone"]

# Kinds of this method: account numbers with a checksum, and numbers that only context confirms.
IBAN = r"\b[A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]{4}){2,7}(?: ?[A-Z0-9]{1,3})?\b"
SSN = r"\b[0-9]{3}-[0-9]{2}-[0-9]{4}\b"
ADDED = ["iban", "ssn"]

# Words that make a kind likelier when they stand within REACH characters of it.
CONTEXT = {
    "email": "mail|contact|write|reply",
    "ip": "ip|address|server|host",
    "card": "card|visa|credit|payment|pay",
    "phone": "phone|call|tel|mobile|fax",
    "iban": "iban|bank|account|transfer",
    "ssn": "ssn|social|security|insurance",
}
REACH = 40
# Score of an expression alone, what a checksum and a word nearby add, and the least score of an added kind.
PROPOSED, CONFIRMED, NEARBY = 0.4, 0.4, 0.2
LEAST_SCORE = 0.6

_BLOCK = 256


def _starts(hits: Column, text: Column, pattern: str) -> Column:
    """Where each hit begins: lengths of what lies between hits, and of hits, added up.

    Sums run in blocks, then over blocks, so a text with very many hits takes no square of them.
    """
    parts = F.split(text, pattern, -1)
    steps = F.zip_with(F.slice(parts, 1, F.size(hits)), hits, lambda p, h: (F.length(p) + F.length(h)).cast("long"))

    def sums(x: Column, of) -> Column:
        return F.aggregate(
            x, F.array(F.lit(0).cast("long")), lambda done, v: F.array_append(done, F.element_at(done, -1) + of(v))
        )

    blocks = F.transform(
        F.sequence(F.lit(0), F.floor((F.size(hits) - 1) / _BLOCK).cast("int")),
        lambda b: sums(F.slice(steps, b * _BLOCK + 1, F.lit(_BLOCK)), lambda v: v),
    )
    offsets = sums(blocks, lambda b: F.element_at(b, -1))
    ends = F.flatten(F.zip_with(
        blocks, F.slice(offsets, 1, F.size(blocks)),
        lambda block, before: F.transform(F.slice(block, 2, F.size(block) - 1), lambda v: v + before),
    ))
    return F.zip_with(ends, hits, lambda end, h: end - F.length(h))


def _digits(x: Column) -> Column:
    return F.regexp_replace(x, "[^0-9]", "")


def _luhn(value: Column) -> Column:
    """Every second digit from the right doubled, less 9 above 9; all add up to tens."""
    numbers = F.transform(F.reverse(F.filter(F.split(_digits(value), ""), lambda c: c != "")), lambda c: c.cast("int"))
    weighed = F.transform(
        numbers,
        lambda d, i: F.when(i % 2 == 0, d).otherwise(F.when(d > 4, 2 * d - 9).otherwise(2 * d)),
    )
    return F.aggregate(weighed, F.lit(0), lambda total, d: total + d) % 10 == 0


def _mod97(value: Column) -> Column:
    """The first four characters put last, letters as 10 to 35: the number leaves 1."""
    plain = F.regexp_replace(value, " ", "")
    turned = F.concat(F.substring(plain, 5, 100), F.substring(plain, 1, 4))
    rest = F.aggregate(
        F.filter(F.split(turned, ""), lambda c: c != ""), F.lit(0),
        lambda m, c: F.when(c.between("0", "9"), (m * 10 + F.ascii(c) - 48) % 97).otherwise((m * 100 + F.ascii(c) - 55) % 97),
    )
    return rest == 1


def _octets(value: Column) -> Column:
    """No part above 255, leading zeros aside."""
    return F.forall(
        F.split(value, r"\."),
        lambda p: F.length(F.ltrim(p, F.lit("0"))).between(0, 3) & (F.concat(F.lit("0"), F.right(p, F.lit(3))).cast("int") <= 255),
    )


# What confirms a hit: a condition that failing hits are dropped by, and whether it is a checksum.
_CHECKS = {
    "email": (lambda v: F.lit(True), False),
    "ip": (_octets, False),
    "card": (_luhn, True),
    "phone": (lambda v: F.length(_digits(v)).between(9, 15), False),
    "iban": (_mod97, True),
    "ssn": (lambda v: F.lit(True), False),
}
_PATTERNS = {"email": EMAIL, "ip": IP, "card": CARD, "phone": PHONE, "iban": IBAN, "ssn": SSN}
_SPAN = "array<struct<kind:string,start:long,end:long,score:double>>"


def _spans(kind: str, hits: Column, text: Column) -> Column:
    check, checksum = _CHECKS[kind]
    found = F.zip_with(
        hits, _starts(hits, text, _PATTERNS[kind]),
        lambda h, s: F.struct(h.alias("value"), s.alias("start")),
    )
    near = lambda s: F.lower(F.substring(
        text, (F.greatest(F.lit(0), s["start"] - REACH) + 1).cast("int"), (F.length(s["value"]) + 2 * REACH).cast("int")
    )).rlike(rf"\b(?:{CONTEXT[kind]})")
    scored = F.transform(
        F.filter(found, lambda s: check(s["value"])),
        lambda s: F.struct(
            F.lit(kind).alias("kind"), s["start"].alias("start"),
            (s["start"] + F.length(s["value"])).alias("end"),
            (F.lit(PROPOSED + CONFIRMED * checksum) + F.when(near(s), NEARBY).otherwise(0.0)).alias("score"),
        ),
    )
    if kind in ADDED:
        scored = F.filter(scored, lambda s: s["score"] >= LEAST_SCORE - 1e-9)
    return F.when(F.size(hits) > 0, scored).otherwise(F.expr(f"cast(array() as {_SPAN})"))


def find(docs: DataFrame, name: str = "spans") -> DataFrame:
    """``docs`` with a column ``name``: kind, first character, end and score of all personal data in ``text``.

    Spans come by kind (email, ip, card, phone, iban, ssn), then by start. Hits of one kind do not
    overlap, those of different kinds may. A hit that fails its check is dropped and not tried again.
    The first four kinds stay whatever their score; the others need a checksum or a word nearby.
    Null and empty texts have no span. Rows and other columns stay as they are, whatever their names; only a
    column of that ``name`` is replaced.
    """
    given = F.struct(*[F.col(_quoted(c)) for c in docs.columns if c != name]).alias("given")
    found = _found(docs.select(given, F.col("text").alias("text")))
    return found.select("given.*", F.col("spans").alias(name))


def _quoted(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def _found(rows: DataFrame) -> DataFrame:
    """``given, text, spans`` from ``rows(given, text)``."""
    text = F.coalesce(F.col("text"), F.lit(""))
    kinds = [*BASE, *ADDED]
    hits = rows.select(
        "given", "text", *[F.regexp_extract_all(text, F.lit(_PATTERNS[k]), F.lit(0)).alias(k) for k in kinds]
    )
    return hits.select("given", "text", F.concat(*[_spans(k, F.col(k), text) for k in kinds]).alias("spans"))


def listed(spans: Column) -> Column:
    """``kind:start:end`` of each span, joined by commas."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")


def report(docs: DataFrame) -> DataFrame:
    """``doc_id``, the number of spans of each base kind, the digest of the base ones, and all spans."""
    found = find(docs.select("doc_id", "text"))
    of = lambda kind: F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long")
    base = F.filter("spans", lambda s: s["kind"].isin(BASE))
    return found.select(
        "doc_id", *[of(k).alias(f"n_{k}") for k in BASE],
        F.sha2(listed(base).cast("binary"), 256).alias("base_sha256"), listed(F.col("spans")).alias("spans"),
    )


def mask(docs: DataFrame) -> DataFrame:
    """``docs`` with each span in ``text`` replaced by its kind in angle brackets.

    Of spans that overlap the one that begins first, or is longer, counts, and the others are
    covered by it. Null texts stay null, and so do texts without a span. Rows that repeat are masked alike; other
    columns stay, whatever their names; an empty table gives an empty result.
    """
    found = _found(docs.select(F.struct("*").alias("given"), F.col("text").alias("text")))
    order = F.array_sort(F.transform("spans", lambda s: F.struct(s["start"], (-s["end"]).alias("turn"), s["end"], s["kind"])))
    cut = F.aggregate(
        order,
        F.struct(F.lit(0).cast("long").alias("at"), F.array().cast("array<string>").alias("parts")),
        lambda done, s: F.when(s["start"] < done["at"], F.struct(F.greatest(done["at"], s["end"]).alias("at"), done["parts"].alias("parts")))
        .otherwise(F.struct(
            s["end"].alias("at"),
            F.array_append(
                done["parts"],
                F.concat(
                    F.substring(F.col("text"), (done["at"] + 1).cast("int"), (s["start"] - done["at"]).cast("int")),
                    F.lit("<"), s["kind"], F.lit(">"),
                ),
            ).alias("parts"),
        )),
    )
    masked = found.withColumn("cut", F.when(F.size("spans") > 0, cut))
    text = F.when(
        F.col("cut").isNotNull(),
        F.concat(
            F.array_join("cut.parts", ""),
            F.substring(F.col("text"), (F.col("cut.at") + 1).cast("int"), F.length("text")),
        ),
    ).otherwise(F.col("text"))
    kept = [text.alias("text") if c == "text" else F.col("given").getField(c).alias(c) for c in docs.columns]
    return masked.select(*kept)

"""Personal data in texts: regular expressions propose, checksums confirm, nearby words adjust the score.

All of it is DataFrame expressions, a row at a time. Matches of a pattern are marked in the text, the text
is split at the marks, and places follow from the lengths of the parts, so offsets are code points.

Patterns are written without backtracking over what cannot match otherwise, so their cost does not
grow with the square of a text's length. Base kinds are ``email``, ``ip``, ``card`` and ``phone``; added kinds
are ``iban`` (mod-97) and ``imei`` (15 digits, Luhn), which count only if a word nearby speaks for them or, for
``iban``, by their checksum alone.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Code points before and after a match in which context words count.
NEARBY = 40
#: A span is reported from this score.
THRESHOLD = 0.5

_LOCAL = "A-Za-z0-9._%+-"
_MARK, _END = "\x01", "\x02"


@dataclass(frozen=True)
class Kind:
    """A kind of personal data.

    ``pattern`` finds candidates, ``quick`` is cheaper and holds for every text with one; ``score`` is what a
    confirmed candidate has by itself, ``context`` the words nearby that add 0.3 (or, for the words in
    ``against``, take 0.3 away) where the kind isn't a base kind.
    """

    name: str
    pattern: str
    quick: str
    score: float
    context: tuple[str, ...]
    against: tuple[str, ...] = field(default=())
    base: bool = True


KINDS = (
    Kind(
        "email",
        rf"(?:(?<![{_LOCAL}])|\G)[{_LOCAL}]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
        "@[A-Za-z0-9-]++[.]",
        0.9,
        ("mail", "contact", "write"),
    ),
    Kind("ip", r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}", r"[0-9][.][0-9]++[.][0-9]++[.][0-9]", 0.7, ("ip", "address", "host")),
    Kind("card", r"[0-9](?:[\x20-]?[0-9])++", r"[0-9](?:[\x20-]?[0-9]){15}", 0.8, ("card", "visa", "credit", "payment")),
    Kind("phone", r"\+[0-9][\x20().0-9-]+[0-9]", r"\+[0-9]", 0.7, ("phone", "call", "tel", "mobile", "fax")),
    Kind(
        "iban",
        r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?:\x20?[A-Z0-9]{4}){2,7}(?:\x20?[A-Z0-9]{1,3})?(?![A-Za-z0-9])",
        "[A-Z]{2}[0-9]{2}[\\x20A-Z0-9]{8}",
        0.6,
        ("iban", "account", "bank", "konto", "cuenta", "compte"),
        ("key", "token", "serial"),
        False,
    ),
    Kind(
        "imei",
        r"(?<![0-9A-Za-z])[0-9]{15}(?![0-9A-Za-z])",
        "[0-9]{15}",
        0.3,
        ("imei", "device", "handset"),
        ("order", "invoice"),
        False,
    ),
)


def _digits(value: Column) -> Column:
    return F.regexp_replace(value, "[^0-9]", "")


def luhn(digits: Column) -> Column:
    """Whether a string of digits passes the Luhn check."""
    ordered = F.transform(F.split(F.reverse(digits), ""), lambda d: F.ascii(d) - 48)
    total = F.aggregate(
        F.transform(
            ordered,
            lambda d, i: F.when(i % 2 == 0, d).when(d * 2 > 9, d * 2 - 9).otherwise(d * 2),
        ),
        F.lit(0),
        lambda a, d: a + d,
    )
    return total % 10 == 0


def mod97(value: Column) -> Column:
    """Whether an account number passes the mod-97 check: first four signs last, letters as 10 to 35."""
    plain = F.regexp_replace(value, " ", "")
    turned = F.concat(F.substr(plain, F.lit(5)), F.substring(plain, 1, 4))
    rest = F.aggregate(
        F.split(turned, ""),
        F.lit(0),
        lambda a, c: F.when(c == "", a)
        .when(c.between("0", "9"), (a * 10 + F.ascii(c) - 48) % 97)
        .otherwise((a * 100 + F.ascii(c) - 55) % 97),
    )
    return rest == 1


def _confirmed(kind: str, value: Column) -> Column:
    if kind == "ip":
        part = F.split(value, "[.]")
        return F.forall(part, lambda p: F.length(F.regexp_replace(p, "^0+(?=[0-9])", "")) <= 3) & F.forall(
            part, lambda p: F.coalesce(F.substring(F.regexp_replace(p, "^0+(?=[0-9])", ""), 1, 4).try_cast("int"), F.lit(999)) <= 255
        )
    if kind == "card":
        size = F.length(_digits(value))
        return F.when(size.between(16, 19), luhn(_digits(value))).otherwise(False)
    if kind == "phone":
        return F.length(_digits(value)).between(8, 15)
    if kind == "iban":
        return mod97(value)
    if kind == "imei":
        return luhn(value)
    return F.lit(True)


def _spans(kind: Kind, text: Column) -> Column:
    """The confirmed matches of a kind in document order, each with its score.

    The text has no mark signs in it. Parts after the first begin with a match; a part's place is the sum
    of the lengths before it, less the end marks.
    """
    parts = F.split(F.regexp_replace(text, kind.pattern, f"{_MARK}$0{_END}"), _MARK)
    start = F.struct(
        F.lit(0).cast("long").alias("at"),
        F.array().cast("array<struct<start:bigint,end:bigint,value:string>>").alias("found"),
    )

    def step(state: Column, part: Column) -> Column:
        at = state["at"]
        value = F.substring_index(part, _END, 1)
        size = F.length(part).cast("long")
        match = part.contains(_END)
        kept = F.when(match, _confirmed(kind.name, value)).otherwise(False)
        one = F.struct(at.alias("start"), (at + F.length(value)).alias("end"), value.alias("value"))
        return F.struct(
            (at + size - match.cast("long")).alias("at"),
            F.when(kept, F.array_append(state["found"], one)).otherwise(state["found"]).alias("found"),
        )

    found = F.aggregate(parts, start, step, lambda state: state["found"])
    words = "|".join(kind.context)

    def scored(span: Column) -> Column:
        begin = F.greatest(F.lit(0), span["start"] - NEARBY)
        before = F.substr(text, (begin + 1).cast("int"), (span["start"] - begin).cast("int"))
        after = F.substr(text, (span["end"] + 1).cast("int"), F.lit(NEARBY))
        near = F.concat(before, F.lit(" "), after)
        score = F.lit(kind.score) + F.when(near.rlike(f"(?i)\\b(?:{words})"), 0.3).otherwise(0.0)
        if kind.against:
            score = score - F.when(near.rlike(f"(?i)\\b(?:{'|'.join(kind.against)})"), 0.3).otherwise(0.0)
        return F.struct(
            F.lit(kind.name).alias("kind"),
            span["start"].alias("start"),
            span["end"].alias("end"),
            span["value"].alias("value"),
            F.least(F.lit(1.0), score).alias("score"),
        )

    spans = F.transform(found, scored)
    if not kind.base:
        spans = F.filter(spans, lambda s: s["score"] >= THRESHOLD)
    none = F.array().cast("array<struct<kind:string,start:bigint,end:bigint,value:string,score:double>>")
    return F.when(text.rlike(kind.quick), spans).otherwise(none)


def find_personal_data(documents: DataFrame, *keep: str) -> DataFrame:
    """The columns ``keep`` and ``spans``: kind, start, end (code points, end exclusive), value and score.

    Spans come by kind in the order of ``KINDS``, then by start. Matches of one kind do not overlap; a match
    that a checksum or limit refuses is dropped without another try. Base kinds are reported whatever their
    score, added kinds from ``THRESHOLD``. NULL text counts as empty, rows are independent of each other, no
    rows give an empty result. An added span that overlaps a base span is left out.
    """
    marks = F.translate(F.coalesce(F.col("text").cast("string"), F.lit("")), _MARK + _END, "\x03\x03")
    rows = documents.select(*[F.col(f"`{c}`").alias(f"__llm_keep_{i}") for i, c in enumerate(keep)], marks.alias("t"))
    names = [f"__llm_keep_{i}" for i in range(len(keep))]
    found = rows.select(*names, *[_spans(k, F.col("t")).alias(k.name) for k in KINDS])
    base = F.concat(*[F.col(k.name) for k in KINDS if k.base])
    with_base = found.withColumn("base", base)
    added = [
        F.filter(
            k.name, lambda s: ~F.exists("base", lambda b: (b["start"] < s["end"]) & (s["start"] < b["end"]))
        )
        for k in KINDS
        if not k.base
    ]
    return with_base.select(
        *[F.col(n).alias(c) for n, c in zip(names, keep, strict=True)], F.concat("base", *added).alias("spans")
    )


def _listed(spans: Column) -> Column:
    return F.array_join(
        F.transform(
            spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))
        ),
        ",",
    )


def digest(found: DataFrame) -> DataFrame:
    """Counts per base kind, a hash of the base spans, and all spans as text."""
    names = [k.name for k in KINDS if k.base]
    of_base = F.filter("spans", lambda s: s["kind"].isin(names))

    def count(name: str) -> Column:
        return F.size(F.filter("spans", lambda s: s["kind"] == name)).cast("long").alias(f"n_{name}")

    counts = [count(n) for n in names]
    return found.select("doc_id", *counts, F.sha2(_listed(of_base), 256).alias("base_sha256"), _listed(F.col("spans")).alias("spans"))

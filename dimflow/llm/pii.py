"""Personal data in texts: patterns propose, checksums confirm, context scores. DataFrame operations only.

* Patterns propose spans of five kinds (:mod:`dimflow.llm.spans`).
* Validators confirm them: Luhn for card numbers, mod-97 for bank account
  numbers, number ranges for addresses, digit counts for telephone numbers.
* Words within ``CONTEXT`` characters before a span raise its score.

Everything is row by row over the whole text: nothing is shuffled.
The patterns avoid repeated groups with choices inside, which would recurse, and
open each run of characters once, so a long run costs time in proportion to its
length; each matches what the plain pattern beside it matches.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from dimflow.llm.common import ascii_lower, text_of
from dimflow.llm.spans import with_matches

KINDS = ("email", "ip", "card", "phone", "iban")
CONTEXT = 40  # code points looked at before a span

# [A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+ : no local part can start inside a run that has just failed
EMAIL = r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]+)++"
# [0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+) : only the first digit of a run can open a match
IP = r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]+"
# [0-9]([\x20-]?[0-9])+ : runs of digits with single separators (a lone digit fails the digit count)
CARD = r"[0-9]+(?:[\x20-][0-9]+)*+"
PHONE = r"\+[0-9][\x20().0-9-]+[0-9]"
IBAN = r"[A-Z]{2}[0-9]{2}(?:(?:\x20[A-Z0-9]{4}){2,7}(?:\x20[A-Z0-9]{1,3})?|[A-Z0-9]{11,30})"
CONTEXT_WORDS = (r"mail|contact|phone|tel|call|fax|mobile|card|visa|payment|account|iban|bank|server|host|address|login")

HINTS = {
    "email": lambda text: F.contains(text, F.lit("@")),
    "ip": lambda text: text.rlike(r"[0-9]\.[0-9]+\.[0-9]+\.[0-9]"),
    "card": lambda text: text.rlike(r"[0-9](?:[\x20-]?[0-9]){12}"),
    "phone": lambda text: F.contains(text, F.lit("+")),
    "iban": lambda text: text.rlike(r"[A-Z]{2}[0-9]{2}[A-Z0-9\x20]"),
}
PATTERNS = {"email": EMAIL, "ip": IP, "card": CARD, "phone": PHONE, "iban": IBAN}
# Score of a confirmed span without context, and what a context word adds, in hundredths.
SCORES = {"email": 70, "ip": 40, "card": 80, "phone": 50, "iban": 90}
CONTEXT_ADDS = 20
CONFIDENT = 60


def digits_of(hit: Column) -> Column:
    return F.regexp_replace(hit, "[^0-9]", "")


def luhn(digits: Column) -> Column:
    """True when the digit string passes the Luhn checksum."""
    def weigh(d: Column, i: Column) -> Column:
        twice = d.cast("int") * 2
        return F.when(i % 2 == 0, d.cast("int")).otherwise(F.when(twice > 9, twice - 9).otherwise(twice))
    total = F.aggregate(F.transform(F.split(F.reverse(digits), ""), weigh), F.lit(0), lambda a, x: a + x)
    return total % 10 == 0


def mod97(hit: Column) -> Column:
    """True when the account number (letters as 10 to 35, first four characters moved to the end) is 1 mod 97."""
    bare = F.replace(hit, F.lit(" "), F.lit(""))
    turned = F.concat(F.substring(bare, 5, 40), F.substring(bare, 1, 4))

    def step(rest: Column, c: Column) -> Column:
        code = F.ascii(c)
        return F.when(code >= 65, (rest * 100 + code - 55) % 97).otherwise((rest * 10 + code - 48) % 97)
    return F.aggregate(F.split(turned, ""), F.lit(0), step) == 1


def _confirmed(kind: str, hit: Column) -> Column:
    if kind == "ip":
        part = r"0*(?:[0-9]{1,2}|1[0-9]{2}|2[0-4][0-9]|25[0-5])"
        return hit.rlike(rf"^{part}(?:\.{part}){{3}}$")
    if kind == "card":
        return F.length(digits_of(hit)).between(13, 19) & luhn(digits_of(hit))
    if kind == "phone":
        return F.length(digits_of(hit)).between(9, 15)
    if kind == "iban":
        return mod97(hit)
    return F.lit(True)


def find_spans(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of ``docs``: ``id`` and ``spans``, by kind as listed in ``KINDS``, then start.

    A span has ``kind, start, end`` (code points, end exclusive) and ``score`` in
    hundredths. Null and empty texts have no spans; repeated rows and null ids
    keep their rows.
    """
    rows = docs.select(F.col(id_col).alias("id"), text_of(text_col).alias("__text"))
    for kind in KINDS:
        rows = with_matches(rows, "__text", PATTERNS[kind], HINTS[kind](F.col("__text")), kind, lead=CONTEXT)

    def score(kind: str, span: Column) -> Column:
        before = ascii_lower(F.right(span["lead"], F.lit(CONTEXT)))
        return F.lit(SCORES[kind]) + F.when(before.rlike(CONTEXT_WORDS), F.lit(CONTEXT_ADDS)).otherwise(F.lit(0))

    def scored(kind: str) -> Column:
        return F.transform(F.filter(kind, lambda s: _confirmed(kind, s["hit"])),
                           lambda s: F.struct(F.lit(kind).alias("kind"), s["start"].alias("start"),
                                              s["end"].alias("end"), score(kind, s).alias("score")))

    return rows.select("id", F.concat(*[scored(kind) for kind in KINDS]).alias("spans"))

"""Personal data: patterns propose, checksums confirm, context scores [native].

Every document is handled within its own row, so nothing is shuffled.

The base kinds (email, ip, card, phone) are the leftmost non-overlapping
matches of their patterns that pass their check.  Their expressions are
written so that the matcher neither recurses per repetition nor rescans a
long run: what may stand between two digits of a card, or between two labels
of a mail host, is marked first by an equally long text.  Further kinds
(iban by mod-97, national ids by context) are added when their score reaches
``threshold``; base spans always stay.

Odd input: a null text counts as empty; an empty text has no spans; repeated
rows and null ids are returned as they come; further columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from terrace.llm.spans import blocks, cut, joined, let, no_spans, spans, spans_where, tagged
from terrace.llm.tables import text_or_empty

MARK = "\x01"

# Words that make a kind more likely when they stand close to a span.
CONTEXT = {
    "email": ("mail", "email", "e-mail", "contact", "write to"),
    "ip": ("ip", "address", "host", "server", "login"),
    "card": ("card", "visa", "mastercard", "amex", "credit", "debit", "payment"),
    "phone": ("phone", "tel", "call", "mobile", "fax", "whatsapp"),
    "iban": ("iban", "account", "bank", "konto", "compte", "cuenta"),
    "ssn": ("ssn", "social security", "social", "tax id", "taxpayer"),
    "nhs": ("nhs", "patient", "health number"),
}
PRIOR = {"email": 0.9, "ip": 0.6, "card": 0.8, "phone": 0.6, "iban": 0.8, "ssn": 0.4, "nhs": 0.3}
CONTEXT_BONUS = 0.3
CONTEXT_CHARS = 40
BASE = ("email", "ip", "card", "phone")
KINDS = (*BASE, "iban", "ssn", "nhs")


def _digits(match: Column) -> Column:
    return F.regexp_replace(match, "[^0-9]", "")


def luhn(number: Column) -> Column:
    """Whether a string of digits passes the Luhn check (from the right, every
    second digit doubled, digits of the products summed)."""
    values = F.transform(F.split(F.reverse(number), ""), lambda c, i: F.when(
        i % 2 == 0, c.cast("int")).otherwise(
        F.when(c.cast("int") >= 5, c.cast("int") * 2 - 9).otherwise(c.cast("int") * 2)))
    return F.aggregate(values, F.lit(0), lambda a, x: a + x) % 10 == 0


def mod97(text: Column) -> Column:
    """Remainder by 97 of letters (A is 10) and digits read as one number."""
    def step(rest: Column, char: Column) -> Column:
        code = F.ascii(char)
        return F.when(code < 65, (rest * 10 + code - 48) % 97).otherwise((rest * 100 + code - 55) % 97).cast("int")
    return F.aggregate(F.split(text, ""), F.lit(0), step)


def iban_valid(match: Column) -> Column:
    plain = F.translate(match, " ", "")
    turned = F.concat(F.substring(plain, 5, 64), F.substring(plain, 1, 4))
    return F.length(plain).between(15, 34) & (mod97(turned) == 1)


def _byte_parts(match: Column) -> Column:
    return F.rlike(match, F.lit(r"^0*(25[0-5]|2[0-4][0-9]|1?[0-9]?[0-9])(\.0*(25[0-5]|2[0-4][0-9]|1?[0-9]?[0-9])){3}$"))


def _nhs_valid(match: Column) -> Column:
    """Ten digits, weights 10 to 2, remainder by 11."""
    chars = F.split(_digits(match), "")
    total = F.aggregate(F.transform(F.slice(chars, 1, 9), lambda c, i: c.cast("int") * (10 - i)), F.lit(0),
                        lambda a, x: a + x)
    return (11 - total % 11) % 11 == F.get(chars, F.lit(9)).cast("int")


def _emails(text: Column) -> Column:
    # A dot between two host characters becomes MARK (a MARK of the text,
    # which no part of the pattern takes, a line break first).
    marked = F.regexp_replace(F.translate(text, MARK, "\n"), r"(?<=[A-Za-z0-9-])\.(?=[A-Za-z0-9-])", MARK)
    local = rf"[A-Za-z0-9._%+{MARK}-]"
    found = spans(marked, rf"(?:\G|(?<!{local})){local}++@[A-Za-z0-9-]+{MARK}[A-Za-z0-9{MARK}-]++")
    return F.when(F.contains(text, F.lit("@")), found).otherwise(no_spans())


def _ips(text: Column) -> Column:
    pattern = r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++"
    return F.filter(spans_where(F.rlike(text, F.lit(pattern)), text, pattern), lambda s: _byte_parts(s["match"]))


def _cards(text: Column) -> Column:
    # A separator between two digits becomes MARK, so a card is one run.
    marked = F.regexp_replace(F.translate(text, MARK, "\n"), r"(?<=[0-9])[\x20-](?=[0-9])", MARK)
    found = spans(marked, f"[0-9][0-9{MARK}]++")
    found = F.when(F.rlike(text, F.lit(r"[0-9](?:[\x20-]?[0-9]){11}")), found).otherwise(no_spans())
    return F.filter(found, lambda s: F.length(_digits(s["match"])).between(12, 19) & luhn(_digits(s["match"])))


def _phones(text: Column) -> Column:
    found = spans_where(F.contains(text, F.lit("+")), text, r"\+[0-9][\x20().0-9-]+[0-9]")
    return F.filter(found, lambda s: F.length(_digits(s["match"])).between(9, 15))


def _ibans(text: Column) -> Column:
    pattern = r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?:\x20?[A-Z0-9]{4}){2,7}(?:\x20?[A-Z0-9]{1,3})?(?![A-Za-z0-9])"
    return F.filter(spans_where(F.rlike(text, F.lit(pattern)), text, pattern), lambda s: iban_valid(s["match"]))


def _ssns(text: Column) -> Column:
    pattern = r"(?<![0-9-])(?!000|666|9)[0-9]{3}-(?!00)[0-9]{2}-(?!0000)[0-9]{4}(?![0-9-])"
    return spans_where(F.rlike(text, F.lit(pattern)), text, pattern)


def _nhs(text: Column) -> Column:
    pattern = r"(?<![0-9+-])[0-9]{3}\x20[0-9]{3}\x20[0-9]{4}(?![0-9-])"
    return F.filter(spans_where(F.rlike(text, F.lit(pattern)), text, pattern), lambda s: _nhs_valid(s["match"]))


PROPOSERS = {"email": _emails, "ip": _ips, "card": _cards, "phone": _phones,
             "iban": _ibans, "ssn": _ssns, "nhs": _nhs}


def _score(span: Column, pieces: Column) -> Column:
    """Prior of the span's kind, raised when one of its words stands close by."""
    left = F.greatest(span["start"] - CONTEXT_CHARS, F.lit(0))
    near = F.lower(F.concat_ws(" ", cut(pieces, left, span["start"]),
                               cut(pieces, span["end"], span["end"] + CONTEXT_CHARS)))

    def of_kind(kind: str, near: Column) -> Column:
        words = "|".join(CONTEXT[kind])
        return F.when(F.rlike(near, F.lit(rf"(?<![a-z])(?:{words})(?![a-z])")),
                      F.least(F.lit(1.0), F.lit(PRIOR[kind] + CONTEXT_BONUS))).otherwise(F.lit(PRIOR[kind]))

    return let(near, lambda n: F.coalesce(*[F.when(span["kind"] == k, of_kind(k, n)) for k in KINDS]))


def detect(docs: DataFrame, threshold: float = 0.6) -> DataFrame:
    """``docs`` with ``pii_spans``: sorted (start, rank, end, kind, match, score)."""
    text = text_or_empty()
    found = F.concat(*[tagged(kind, rank, PROPOSERS[kind](text)) for rank, kind in enumerate(KINDS)])

    def scored(all_: Column) -> Column:
        # Blocks are cut only where there is something to score.
        pieces = F.when(F.size(all_) > 0, blocks(text))
        return let(pieces, lambda b: F.transform(all_, lambda s: F.struct(
            s["start"].alias("start"), s["rank"].alias("rank"), s["end"].alias("end"), s["kind"].alias("kind"),
            s["match"].alias("match"), _score(s, b).alias("score"))))

    kept = F.filter(let(found, scored), lambda s: s["kind"].isin(*BASE) | (s["score"] >= threshold))
    return docs.drop("pii_spans").withColumn("pii_spans", F.sort_array(kept))


def digest(docs: DataFrame, threshold: float = 0.6) -> DataFrame:
    """Per document: counts of the base kinds, digest of base spans, all spans."""
    rows = detect(docs.select("doc_id", "text"), threshold)

    def count(kind: str) -> Column:
        return F.size(F.filter("pii_spans", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")

    base_spans = F.filter("pii_spans", lambda s: s["kind"].isin(*BASE))
    return rows.select("doc_id", *[count(k) for k in BASE],
                       F.sha2(joined(base_spans), 256).alias("base_sha256"),
                       joined(F.col("pii_spans")).alias("spans"))

"""Licence scan: ordered signature rules with a keyword prefilter [native].

The text becomes lower-case words parted by one space.  A rule's expression
runs only on texts that hold all its keywords; each detection is an interval
of words.  A detection inside the interval of a better one (higher priority,
else longer, else the earlier rule) is suppressed; base detections always
stay.  Everything happens within a document's row: nothing is shuffled.

Odd input: a null text counts as empty (no words, no labels, score 0); texts
of separators only likewise; repeated rows and null ids are returned as they
come; further columns are ignored.
"""

from __future__ import annotations

import json
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from terrace.llm.license_rules import SIGNATURES
from terrace.llm.spans import let, running, spans
from terrace.llm.tables import text_or_empty

SEPARATORS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
PRIORITIES = (1, 2, 3)
# Score of the best detection that is kept, by priority.
CONFIDENCE = {1: 1.0, 2: 0.8, 3: 0.4}


@dataclass(frozen=True)
class Signature:
    label: str
    priority: int
    keywords: tuple[str, ...]
    pattern: str
    base: bool = False


def parse_signatures(text: str) -> tuple[Signature, ...]:
    out = []
    for line in text.strip().splitlines():
        label, priority, keywords, pattern, *flags = (x.strip() for x in line.split(" ; "))
        out.append(Signature(label, int(priority), tuple(keywords.split()), pattern, "base" in flags))
    return tuple(out)


RULES = parse_signatures(SIGNATURES)

RULE_ROWS = "array<struct<order:int,priority:int,base:boolean,label:string,keywords:array<string>,pattern:string>>"
DETECTION = "struct<start:int,end:int,order:int,priority:int,base:boolean,label:string>"


def words_text(text: Column) -> Column:
    """Lower-case words parted by one space.  (``lower`` also folds letters
    beyond ASCII; that moves no word boundary and meets no base phrase.)"""
    return F.trim(F.regexp_replace(F.regexp_replace(F.lower(text), "̇", "̇"), SEPARATORS, " "))


def _spaces(text: Column) -> Column:
    return F.length(text) - F.length(F.replace(text, F.lit(" "), F.lit("")))


def _rule_table(rules: Sequence[Signature]) -> Column:
    """The rules as one constant: parsed while planning, not built of thousands of literals."""
    rows = [{"order": i, "priority": r.priority, "base": r.base, "label": r.label, "keywords": r.keywords,
             "pattern": rf"(?<![^ ])(?:{r.pattern})(?![^ ])"} for i, r in enumerate(rules)]
    return F.from_json(F.lit(json.dumps(rows)), RULE_ROWS)


def _detections(norm: Column, rule: Column) -> Column:
    """Word intervals of one rule's matches, counted from the spaces passed."""
    return F.transform(spans(norm, rule["pattern"], _spaces), lambda s: F.struct(
        s["start"].alias("start"), (s["end"] + 1).alias("end"), rule["order"].alias("order"),
        rule["priority"].alias("priority"), rule["base"].alias("base"), rule["label"].alias("label")))


def _suppress(found: Column) -> Column:
    """Detections that no better one contains.

    In order of start, then longest first, then rank, every container of a
    detection stands before it; so the furthest end seen so far among
    detections of its priority or a higher one decides.
    """
    ordered = F.sort_array(F.transform(found, lambda d: F.struct(
        d["start"].alias("start"), (-d["end"]).alias("back"), d["priority"].alias("priority"),
        d["order"].alias("order"), d["base"].alias("base"), d["label"].alias("label"))))

    def reaches(ds: Column, priority: int) -> Column:
        ends = F.transform(ds, lambda d: F.when(d["priority"] <= priority, -d["back"]).otherwise(F.lit(-1)))
        return running(ends, F.lit(-1), lambda a, x: F.greatest(a, x))

    def judged(ds: Column) -> Column:
        reach = F.arrays_zip(*[reaches(ds, p).alias(f"reach{p}") for p in PRIORITIES])
        return F.zip_with(ds, reach, lambda d, r: F.struct(
            d["start"].alias("start"), (-d["back"]).alias("end"), d["order"].alias("order"),
            d["priority"].alias("priority"), d["base"].alias("base"), d["label"].alias("label"),
            (d["base"] | (F.coalesce(*[F.when(d["priority"] == p, r[f"reach{p}"]) for p in PRIORITIES])
                          < -d["back"])).alias("stays")))

    return F.transform(F.filter(let(ordered, judged), lambda d: d["stays"]), lambda d: d.dropFields("stays"))


def scan(docs: DataFrame, rules: Sequence[Signature] = RULES) -> DataFrame:
    """``docs`` with ``n_words`` and ``licenses``, the detections that are kept
    (start, end, order, priority, base, label), sorted by place."""
    vocabulary = sorted({k for r in rules for k in r.keywords})
    table = _rule_table(rules)
    words = F.split("_norm", " ")
    due = F.filter(table, lambda r: F.forall(r["keywords"], lambda k: F.array_contains(F.col("_held"), k)))
    none = F.expr(f"cast(array() as array<{DETECTION}>)")
    found = F.flatten(F.transform(F.col("_due"), lambda r: _detections(F.col("_norm"), r)))
    return (docs.drop("n_words", "licenses")
            .withColumn("_norm", words_text(text_or_empty()))
            .withColumn("n_words", F.when(F.col("_norm") == "", F.lit(0)).otherwise(F.size(words)).cast("long"))
            .withColumn("_held", F.array_intersect(words, F.array(*map(F.lit, vocabulary))))
            .withColumn("_due", F.when(F.size("_held") > 0, due))
            .withColumn("licenses", F.when(F.size("_due") > 0, _suppress(found)).otherwise(none))
            .drop("_norm", "_held", "_due"))


def digest(docs: DataFrame, rules: Sequence[Signature] = RULES) -> DataFrame:
    """Per document: words, base places, labels and the best confidence."""
    rows = scan(docs.select("doc_id", "text"), rules)
    base = F.filter("licenses", lambda d: d["base"])
    starts = F.transform(base, lambda d: d["start"].cast("long"))
    labels = lambda found: F.array_join(F.array_sort(F.array_distinct(F.transform(found, lambda d: d["label"]))), ",")
    confidence = F.create_map(*[x for p, c in CONFIDENCE.items() for x in (F.lit(p), F.lit(c))])
    best = F.array_min(F.transform("licenses", lambda d: d["priority"]))
    return rows.select(
        "doc_id", "n_words", F.size(base).cast("long").alias("n_base"),
        F.array_min(starts).alias("first_word"), F.array_max(starts).alias("last_word"),
        labels(base).alias("base_labels"), labels(F.col("licenses")).alias("labels"),
        F.coalesce(confidence[best], F.lit(0.0)).alias("score"))

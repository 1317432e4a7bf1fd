"""Quality rules with risk-controlled thresholds [native].

Each rule rejects documents whose feature lies beyond a cutoff.  Cutoffs are
taken from a fixed list per rule, mildest first.  Over the labelled good
documents of a stratum (its language) the number that a cutoff would reject
is Binomial; a cutoff is certified when, were the true rate above ``limit``,
a count as low as the observed one would have probability ``alpha`` or less
(the exact one-sided Clopper-Pearson test).  ``alpha`` is shared out over all
strata and rules (Bonferroni); the cutoffs of one rule are tested in order
and only as far as they pass, which needs no further share.  The strictest
certified cutoff is used; a rule without one rejects nothing there.  Strata
with too few labels for any certificate use the pooled stratum's cutoffs.

So in every certified stratum all rules together reject at most
``limit * len(RULES)`` of the good documents, at confidence ``1 - alpha``.

Odd input: a null text has no words (and fails the base rule); a null
language is a stratum of its own; several labels of one document count as
good only if all are; repeated rows are judged one by one; without labels no
cutoff is certified and only the base rule rejects.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from terrace.llm import tables
from terrace.llm.tables import text_or_empty

BLANK = "\x20\x09\x0a\x0b\x0c\x0d"
BLANKS = r"[\x20\x09-\x0D]"
WINDOW = 8
MIN_WORDS = 20
MAX_REPEAT_PERCENT = 30

FEATURES = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")


@dataclass(frozen=True)
class Rule:
    """Rejects a share above a cutoff (below it, if ``low``)."""

    name: str
    cutoffs: tuple[float, ...]
    low: bool = False


RULES = (
    Rule("symbol_share", (0.3, 0.2, 0.1, 0.05, 0.02)),
    Rule("upper_share", (0.7, 0.6, 0.5, 0.45)),
    Rule("dup_line_share", (0.9, 0.8, 0.7, 0.6, 0.5)),
    Rule("repeat_share", (0.29, 0.27, 0.25)),
    Rule("distinct_share", (0.05, 0.1, 0.2, 0.3, 0.35), low=True),
)


def features(docs: DataFrame) -> DataFrame:
    """``docs`` with the struct ``_quality`` of counts and shares of its text.

    Windows are compared by hash first; only texts in which two hashes agree
    compare the windows themselves.
    """
    text = text_or_empty()
    at = F.sequence(F.lit(0), F.size("_w") - WINDOW)
    window = lambda i: F.slice("_w", i + 1, WINDOW)
    long_enough = F.size("_w") > WINDOW
    hashes = F.when(long_enough, F.transform(at, lambda i: F.xxhash64(window(i))))
    grams = F.when(F.size("_h") > F.size(F.array_distinct("_h")), F.array_sort(F.transform(
        F.col("_h"), lambda h, i: F.struct(h.alias("h"), F.array_join(window(i), " ").alias("g"), i.alias("i")))))

    def same(x: Column, j: Column) -> Column:
        return F.coalesce(F.get(F.col("_g"), j)["g"] == x["g"], F.lit(False))

    places = F.array_sort(F.transform(
        F.filter("_g", lambda x, j: same(x, j - 1) | same(x, j + 1)), lambda x: x["i"]))
    covered = F.aggregate(
        places, F.struct(F.lit(0).alias("end"), F.lit(0).alias("n")),
        lambda s, i: F.struct((i + WINDOW).cast("int").alias("end"),
                              (s["n"] + i + WINDOW - F.greatest(s["end"], i)).cast("int").alias("n")),
        lambda s: s["n"])
    lines = F.filter(F.split(text, "\n"), lambda line: F.btrim(line, F.lit(BLANK)) != "")
    counts = F.struct(
        F.size("_w").cast("long").alias("n_words"),
        F.length(F.regexp_replace(text, f"{BLANKS}+", "")).cast("long").alias("word_chars"),
        (F.length(text) - F.length(F.regexp_replace(text, r"[#*$%&|<>]+", ""))).cast("long").alias("n_symbols"),
        (F.size("_l") - F.size(F.array_distinct("_l"))).cast("long").alias("n_dup_lines"),
        F.coalesce(F.when(F.size("_g") > 0, covered), F.lit(0)).cast("long").alias("n_repeat_words"),
        (F.length(text) - F.length(F.regexp_replace(text, r"\p{Lu}+", ""))).cast("long").alias("n_upper"),
        F.size("_l").cast("long").alias("n_lines"),
        F.size(F.array_distinct("_w")).cast("long").alias("n_distinct"))
    share = lambda part, whole: F.coalesce(F.try_divide(F.col(f"_c.{part}").cast("double"), F.col(f"_c.{whole}")), F.lit(0.0))
    shares = F.struct(
        share("n_symbols", "word_chars").alias("symbol_share"), share("n_upper", "word_chars").alias("upper_share"),
        share("n_dup_lines", "n_lines").alias("dup_line_share"),
        share("n_repeat_words", "n_words").alias("repeat_share"),
        F.when(F.col("_c.n_words") > 0, share("n_distinct", "n_words")).otherwise(F.lit(1.0)).alias("distinct_share"))
    empty = F.expr("cast(array() as array<string>)")
    return (docs
            .withColumn("_t", F.btrim(text, F.lit(BLANK)))
            .withColumn("_w", F.when(F.col("_t") == "", empty).otherwise(F.split("_t", f"{BLANKS}+")))
            .withColumn("_l", lines)
            .withColumn("_h", hashes)
            .withColumn("_g", grams)
            .withColumn("_c", counts)
            .withColumn("_quality", F.struct("_c.*", shares.alias("shares")))
            .drop("_t", "_w", "_l", "_h", "_g", "_c"))


def base_failed() -> Column:
    q = F.col("_quality")
    return (q["n_words"] < MIN_WORDS) | (100 * q["n_repeat_words"] > MAX_REPEAT_PERCENT * q["n_words"])


def _beyond(rule: Rule, cutoff: Column) -> Column:
    value = F.col("_quality.shares")[rule.name]
    return (value < cutoff) if rule.low else (value > cutoff)


def most_allowed(n: Column, limit: float, alpha: Column) -> Column:
    """Largest count k with P(Binomial(n, limit) <= k) <= alpha; -1 if none.

    The terms are summed in logarithms, so any n works; the sum passes
    ``alpha`` before the mean, which bounds the steps.
    """
    odds = math.log(limit / (1 - limit))

    def step(s: Column, k: Column) -> Column:
        term = F.when(k == 0, n * math.log1p(-limit)).otherwise(
            s["term"] + F.log((n - k + 1) / F.greatest(k, F.lit(1))) + odds)
        high, low = F.greatest(s["total"], term), F.least(s["total"], term)
        total = high + F.log1p(F.exp(low - high))
        return F.struct(term.alias("term"), total.alias("total"),
                        F.when(total <= F.log(alpha), k).otherwise(s["best"]).cast("long").alias("best"))

    zero = F.struct(F.lit(0.0).alias("term"), F.lit(-1e300).alias("total"), F.lit(-1).cast("long").alias("best"))
    return F.aggregate(F.sequence(F.lit(0).cast("long"), F.ceil(n * limit)), zero, step, lambda s: s["best"])


def calibrate(featured: DataFrame, labels: DataFrame, limit: float = 0.01, alpha: float = 0.05) -> DataFrame:
    """One row per stratum: ``stratum``, ``pooled`` (true for the row of all
    strata), ``n_good``, ``allowed`` and per rule its cutoff or null.

    ``featured`` holds ``doc_id``, ``lang`` and ``_quality``.
    """
    good = (labels.where(F.col("doc_id").isNotNull()).groupBy("doc_id")
            .agg(F.min(F.coalesce("quality", F.lit(0))).alias("_good")).where("_good = 1").drop("_good"))
    held = featured.select("doc_id", "lang", "_quality").join(good, "doc_id", "left_semi")
    counts = [F.sum(F.when(_beyond(r, F.lit(c)), 1).otherwise(0)).alias(f"{r.name}_{j}")
              for r in RULES for j, c in enumerate(r.cutoffs)]
    grouped = held.withColumn("s", F.struct("lang")).rollup("s").agg(
        F.grouping("s").alias("pooled"), F.count("*").alias("n_good"), *counts)
    # One test per stratum (the pooled one included) and rule.
    tests = grouped.agg(F.greatest(F.count("*"), F.lit(1)).alias("tests"))
    cut = []
    for r in RULES:
        best = F.lit(None).cast("double")
        for j, c in enumerate(r.cutoffs):
            best = F.when(F.col(f"{r.name}_{j}") <= F.col("allowed"), F.lit(c)).otherwise(best)
        cut.append(best.alias(r.name))
    return (grouped.crossJoin(F.broadcast(tests))  # one row
            .withColumn("allowed", most_allowed(F.col("n_good"), limit, F.lit(alpha) / (F.col("tests") * len(RULES))))
            .select(F.col("s.lang").alias("stratum"), (F.col("pooled") == 1).alias("pooled"),
                    "n_good", "allowed", *cut))


def judge(featured: DataFrame, cutoffs: DataFrame) -> DataFrame:
    """``featured`` with ``_base_failed`` and ``_kept``.

    A stratum without a certificate of its own (too few labels, or none) is
    judged by the base rule only: cutoffs of other strata bound nothing there.
    ``cutoffs`` has a row per language; Spark broadcasts it while it is small.
    """
    names = [r.name for r in RULES]
    own = cutoffs.where(~F.col("pooled") & (F.col("allowed") >= 0)).select(
        F.col("stratum").alias("_stratum"), *[F.col(n).alias(f"_own_{n}") for n in names])
    rows = featured.join(own, F.col("lang").eqNullSafe(F.col("_stratum")), "left")
    rejected = F.lit(False)
    for r in RULES:
        rejected = rejected | F.coalesce(_beyond(r, F.col(f"_own_{r.name}")), F.lit(False))
    return (rows.withColumn("_base_failed", base_failed())
            .withColumn("_kept", F.when(F.col("_base_failed"), F.lit(False)).otherwise(~rejected))
            .drop("_stratum", *[f"_own_{n}" for n in names]))


def digest(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Per document: the base counts, the base verdict and the final one."""
    featured = tables.materialize(features(docs.select("doc_id", "lang", "text")).drop("text"), "quality")
    rows = judge(featured, calibrate(featured, labels))
    return rows.select("doc_id", *[F.col(f"_quality.{c}").alias(c) for c in FEATURES],
                       F.col("_base_failed").alias("base_failed"), F.col("_kept").alias("kept"))


def keep(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The documents that are kept, with their columns unchanged."""
    # Only documents labelled good count for the cutoffs; the others' features are taken once, below.
    labelled = docs.select("doc_id", "lang", "text").join(
        labels.where("quality = 1").select("doc_id"), "doc_id", "left_semi")
    cutoffs = tables.materialize(calibrate(features(labelled), labels), "cutoffs")
    featured = features(tables.packed(docs, "lang", "text")).drop("text")
    return judge(featured, cutoffs).where("_kept").select("_doc.*")


def oracle(limit: float = 0.01, alpha: float = 0.05) -> str:
    """The same in DuckDB's SQL; the binomial terms come from ``lgamma``."""
    rules = [(r.name, c, r.low) for r in RULES for c in r.cutoffs]
    beyond = lambda name, c, low: f"{name} {'<' if low else '>'} {c}"
    counts = ", ".join(f"count(*) FILTER ({beyond(*x)}) AS c{n}" for n, x in enumerate(rules))
    picked = []
    for r in RULES:
        steps = [(n, c) for n, (name, c, _) in enumerate(rules) if name == r.name]
        cases = " ".join(f"WHEN c{n} <= allowed THEN {c}" for n, c in reversed(steps))
        picked.append(f"CASE {cases} END AS cut_{r.name}")
    fails = " OR ".join(
        f"coalesce({r.name} {'<' if r.low else '>'} own.cut_{r.name}, FALSE)"
        for r in RULES)
    blank = r"[\x20\x09-\x0D]"
    return rf"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, lang, coalesce(text, '') AS x FROM documents),
w AS MATERIALIZED (SELECT r, doc_id, lang, x, regexp_extract_all(x, '[^\x20\x09-\x0D]+') AS ws,
                          list_filter(string_split(x, chr(10)), lambda l: regexp_matches(l, '[^\x20\x09-\x0D]')) AS ls FROM d),
g AS (SELECT r, i, array_to_string(ws[i:i + {WINDOW - 1}], ' ') AS k
      FROM (SELECT r, ws, unnest(range(1, len(ws) - {WINDOW - 2})) AS i FROM w WHERE len(ws) > {WINDOW}) t),
h AS (SELECT r, i FROM g QUALIFY count(*) OVER (PARTITION BY r, k) > 1),
v AS (SELECT r, sum(least({WINDOW}, coalesce(lead_i - i, {WINDOW}))) AS n
      FROM (SELECT r, i, lead(i) OVER (PARTITION BY r ORDER BY i) AS lead_i FROM h) t GROUP BY r),
f AS (SELECT r, doc_id, lang, len(ws) AS n_words, length(regexp_replace(x, '{blank}+', '', 'g')) AS word_chars,
             length(x) - length(regexp_replace(x, '[#*$%&|<>]+', '', 'g')) AS n_symbols,
             len(ls) - len(list_distinct(ls)) AS n_dup_lines, coalesce(v.n, 0)::BIGINT AS n_repeat_words,
             length(x) - length(regexp_replace(x, '\p{{Lu}}+', '', 'g')) AS n_upper, len(ls) AS n_lines,
             len(list_distinct(ws)) AS n_distinct FROM w LEFT JOIN v USING (r)),
s AS MATERIALIZED (SELECT *, coalesce(n_symbols / nullif(word_chars, 0), 0) AS symbol_share,
             coalesce(n_upper / nullif(word_chars, 0), 0) AS upper_share,
             coalesce(n_dup_lines / nullif(n_lines, 0), 0) AS dup_line_share,
             coalesce(n_repeat_words / nullif(n_words, 0), 0) AS repeat_share,
             coalesce(n_distinct / nullif(n_words, 0), 1) AS distinct_share,
             n_words < {MIN_WORDS} OR 100 * n_repeat_words > {MAX_REPEAT_PERCENT} * n_words AS base_failed FROM f),
good AS (SELECT doc_id FROM labels WHERE doc_id IS NOT NULL GROUP BY doc_id HAVING min(coalesce(quality, 0)) = 1),
held AS (SELECT s.* FROM s SEMI JOIN good USING (doc_id)),
c AS (SELECT lang, FALSE AS pooled, count(*) AS n_good, {counts} FROM held GROUP BY lang
      UNION ALL SELECT NULL, TRUE, count(*), {counts} FROM held),
t AS (SELECT count(*) * {len(RULES)} AS tests FROM c),
b AS (SELECT lang, pooled, coalesce(max(k) FILTER (tail <= {alpha} / tests), -1) AS allowed
      FROM (SELECT lang, pooled, k, tests,
                   sum(exp(lgamma(n_good + 1) - lgamma(k + 1) - lgamma(n_good - k + 1) + k * ln({limit})
                           + (n_good - k) * ln(1 - {limit}))) OVER (PARTITION BY lang, pooled ORDER BY k) AS tail
            FROM (SELECT *, unnest(range(ceil(n_good * {limit})::BIGINT + 1)) AS k FROM c, t) u) p GROUP BY lang, pooled),
q AS (SELECT c.lang, c.pooled, allowed, {", ".join(picked)}
      FROM c JOIN b ON c.lang IS NOT DISTINCT FROM b.lang AND c.pooled = b.pooled)
SELECT s.doc_id, s.n_words, s.word_chars, s.n_symbols, s.n_dup_lines, s.n_repeat_words, s.base_failed,
       NOT (s.base_failed OR {fails}) AS kept
FROM s LEFT JOIN (SELECT * FROM q WHERE NOT pooled AND allowed >= 0) own ON own.lang IS NOT DISTINCT FROM s.lang
"""

"""Secret scan through a trigram inverted index [native].

1. From every rule's expression a Boolean query over trigrams is derived: an
   OR of clauses, each an AND of trigrams that every match must contain.
2. ``build_index`` makes posting rows (trigram, document key) of the rules'
   trigrams over all documents.
3. ``candidates`` intersects the postings of each clause.
4. ``scan`` verifies candidates with the expression itself.  Rules without
   mandatory trigrams (bare hex) are verified on every document.

Odd input: a null text counts as empty; an empty text has no spans; repeated
rows are each returned; a null ``doc_id`` is a key like any other; further
columns of the input are kept beside the found ones or ignored.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable
from dataclasses import dataclass
from itertools import product
from re import _constants as K
from re import _parser

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from terrace.llm import tables
from terrace.llm.spans import blocks, cut, joined, let, no_spans, running, spans, tagged
from terrace.llm.tables import text_or_empty

GAP = "\0"
MAX_ALTERNATIVES = 64


@dataclass(frozen=True)
class Rule:
    """``pattern`` proposes spans, ``keep`` drops failing ones (no retry);
    ``base`` marks the kinds that are counted and digested."""

    kind: str
    pattern: str
    keep: Callable[[Column], Column] | None = None
    base: bool = False


ASSIGN = (r"""(?i:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?"""
          r"""([A-Za-z0-9+/_.=-]+)""")


def _assigned_value_is_long(match: Column) -> Column:
    return F.length(F.regexp_extract(match, ASSIGN, 2)) >= 8


# A private key from its BEGIN line to its END line.  Without one: the header
# lines of an encrypted key and the base64 lines, the last of any length.  Five
# dashes end a key in any case, and the repeats are possessive, so markers
# without a partner cost one pass, however long the text.
_KEY = r"[A-Z0-9 ]{0,40}PRIVATE KEY-----"
PEM = (rf"-----BEGIN {_KEY}"
       rf"(?:(?:[^-]++|-(?!----))*+-----END {_KEY}"
       r"|(?:[\s\\nr]*+(?:Proc-Type|DEK-Info): [^\n\\]*+)*+"
       r"""(?:[\s"',>#*|]*+[A-Za-z0-9+/\\]{16,}+={0,2}+"""
       r"""|[\x20\t\r"',]*+\n[\x20\t"'>#*|]*+[A-Za-z0-9+/\\]++={0,2}+(?=[\x20\t\r"',]*+(?:\n|\Z)))*+)""")


# Base kinds first, in the order in which ties of place are listed.  A run of
# access or hex characters shorter than the limit holds no longer one, so the
# limit may stand in the expression.
RULES = (
    Rule("assign", ASSIGN, _assigned_value_is_long, base=True),
    Rule("access", r"AKIA[A-Z0-9]{12,}", base=True),
    Rule("hex", r"(?<![0-9a-f])[0-9a-f]{32,}", base=True),
    Rule("pem", PEM),
    Rule("github", r"(?<![A-Za-z0-9_])gh[pousr]_[A-Za-z0-9]{36,}"),
    Rule("github-pat", r"github_pat_[A-Za-z0-9_]{22,}"),
    Rule("gitlab", r"glpat-[A-Za-z0-9_-]{20,}"),
    Rule("slack", r"xox[abprs]-[A-Za-z0-9-]{10,}"),
    Rule("google", r"AIza[A-Za-z0-9_-]{35}"),
    Rule("stripe", r"(?<![A-Za-z0-9])[rs]k_live_[A-Za-z0-9]{16,}"),
    Rule("sendgrid", r"SG\.[A-Za-z0-9_-]{22}\.[A-Za-z0-9_-]{43}"),
    Rule("npm", r"(?<![A-Za-z0-9_])npm_[A-Za-z0-9]{36}"),
    Rule("jwt", r"eyJ[A-Za-z0-9_-]{10,}\.eyJ[A-Za-z0-9_-]{10,}\.[A-Za-z0-9_-]{10,}"),
    Rule("bearer", r"(?i:bearer) [A-Za-z0-9._~+/=-]{20,}"),
    Rule("basic-auth", r"://[^\s:@/]++:[^\s:@/]{3,}+@"),
)


# --- Boolean trigram queries ------------------------------------------------

def _class_members(items) -> set[str]:
    """The strings of a small character class; a gap for any other."""
    chars: set[str] = set()
    for op, value in items:
        if op is K.LITERAL:
            chars.add(chr(value).lower())
        elif op is K.RANGE and value[1] - value[0] < 8:
            chars |= {chr(c).lower() for c in range(value[0], value[1] + 1)}
        else:
            return {GAP}
    return chars if len(chars) <= 8 else {GAP}


def _alternatives(tree: Iterable) -> set[str]:
    """Strings that between them cover every match; a gap stands for any text."""
    found = {""}
    for op, value in tree:
        if op is K.LITERAL:
            more = {chr(value).lower()}
        elif op is K.IN:
            more = _class_members(value)
        elif op is K.BRANCH:
            more = set().union(*(_alternatives(b) for b in value[1]))
        elif op is K.SUBPATTERN:
            more = _alternatives(value[3])
        elif op in (K.AT, K.ASSERT, K.ASSERT_NOT):
            more = {""}
        elif op in (K.MAX_REPEAT, K.MIN_REPEAT, K.POSSESSIVE_REPEAT):
            least, most, body = value
            inner = _alternatives(body)
            if (least, most) == (0, 1):
                more = inner | {""}
            elif least == most and len(inner) ** least <= 8:
                more = {"".join(p) for p in product(inner, repeat=least)}
            else:
                more = {x + GAP for x in inner} if least else {GAP}
        else:
            more = {GAP}
        if len(found) * len(more) > MAX_ALTERNATIVES:
            more = {GAP}
        found = {a + b for a in found for b in more}
    return found


def trigram_query(pattern: str) -> list[frozenset[str]] | None:
    """Clauses (AND of trigrams) joined by OR; None if a match may hold none."""
    clauses = set()
    for text in _alternatives(_parser.parse(pattern)):
        grams = frozenset(run[i:i + 3] for run in text.split(GAP) for i in range(len(run) - 2))
        if not grams:
            return None
        clauses.add(grams)
    return sorted((c for c in clauses if not any(other < c for other in clauses)), key=sorted)


def _clauses(rules: Iterable[Rule]) -> list[tuple[str, int, frozenset[str]]]:
    return [(r.kind, i, grams) for r in rules for i, grams in enumerate(trigram_query(r.pattern) or ())]


# --- index, intersection, verification ---------------------------------------

def _with_key(docs: DataFrame) -> DataFrame:
    """Documents with the key that stands for them in postings.

    Rows that agree in ``doc_id`` and text share a key and all results.
    """
    return docs.withColumn("_key", F.struct(F.col("doc_id"), F.xxhash64(text_or_empty()).alias("hash")))


def build_index(docs: DataFrame, rules: Iterable[Rule] = RULES) -> DataFrame:
    """Posting rows (trigram, key) over all documents, for the rules' trigrams.

    Trigrams are taken from the lower-cased text, so they serve rules of either case.
    """
    vocabulary = sorted({g for _, _, grams in _clauses(rules) for g in grams})
    low = F.lower(text_or_empty())
    held = F.filter(F.array(*[F.lit(g) for g in vocabulary]), lambda g: F.contains(F.col("_low"), g))
    return (_with_key(docs).select("_key", low.alias("_low"))
            .select(F.explode(held).alias("trigram"), F.col("_key").alias("key")))


def candidates(postings: DataFrame, rules: Iterable[Rule] = RULES) -> DataFrame:
    """(key, kinds): the rules with a clause whose posting lists all hold the key."""
    clauses = _clauses(rules)
    uses = F.create_map(*[x for g in sorted({g for c in clauses for g in c[2]}) for x in (
        F.lit(g), F.array(*[F.lit(n) for n, c in enumerate(clauses) if g in c[2]]))])
    kind_of = F.array(*[F.lit(c[0]) for c in clauses])
    size_of = F.array(*[F.lit(len(c[2])) for c in clauses])
    return (postings.select("key", F.explode(uses[F.col("trigram")]).alias("clause"), "trigram")
            .groupBy("key", "clause").agg(F.size(F.collect_set("trigram")).alias("held"))
            .where(F.col("held") == F.get(size_of, F.col("clause")))
            .groupBy("key").agg(F.collect_set(F.get(kind_of, F.col("clause"))).alias("kinds")))


def scan(docs: DataFrame, rules: Iterable[Rule] = RULES) -> DataFrame:
    """``docs`` with ``secret_spans``, an array of (start, rank, end, kind, match)
    sorted by place.

    The join is on a key without hot values other than fully repeated rows.
    """
    rules = tuple(rules)
    keyed = _with_key(docs.drop("secret_spans"))
    found = candidates(build_index(docs, rules), rules).select(
        F.col("key.doc_id").alias("_k_doc"), F.col("key.hash").alias("_k_hash"), F.col("kinds").alias("_kinds"))
    rows = keyed.join(found, F.col("_key.doc_id").eqNullSafe(F.col("_k_doc"))
                      & (F.col("_key.hash") == F.col("_k_hash")), "left")
    parts = []
    for rank, rule in enumerate(rules):
        text = text_or_empty()
        gate = (F.rlike(text, F.lit(rule.pattern)) if trigram_query(rule.pattern) is None
                else F.coalesce(F.array_contains("_kinds", rule.kind), F.lit(False)))
        hits = F.when(gate, spans(text, rule.pattern)).otherwise(no_spans())
        if rule.keep is not None:
            hits = F.filter(hits, lambda s: rule.keep(s["match"]))  # noqa: B023 (built at once)
        parts.append(tagged(rule.kind, rank, hits))
    return (rows.withColumn("secret_spans", F.sort_array(F.concat(*parts)))
            .drop("_key", "_k_doc", "_k_hash", "_kinds"))


def redact(docs: DataFrame, rules: Iterable[Rule] = RULES, mark: str = "[SECRET]") -> DataFrame:
    """``docs`` with every found span replaced by ``mark``; overlapping spans
    become one mark.  Columns stay as they are, but for ``text``."""
    text = F.col("text")

    def clean(found: Column, pieces: Column) -> Column:
        ends = F.transform(found, lambda s: s["end"])
        # Up to where the spans before reach; a span that starts earlier joins their mark.
        reach = running(ends, F.lit(0), lambda a, x: F.greatest(a, x))
        parts = F.zip_with(found, reach, lambda s, r: F.when(
            s["start"] >= r, F.concat(cut(pieces, r, s["start"]), F.lit(mark))).otherwise(F.lit("")))
        return F.concat(F.array_join(parts, ""), cut(pieces, F.array_max(ends), F.length(text)))

    rows = scan(tables.packed(docs, "doc_id", "text"), rules)
    cleaned = let(F.col("secret_spans"), lambda found: let(blocks(text), lambda pieces: clean(found, pieces)))
    new = F.when(F.size("secret_spans") > 0, cleaned).otherwise(text)
    return rows.select(F.col("_doc").withField("text", new).alias("_doc")).select("_doc.*")


def digest(docs: DataFrame, rules: Iterable[Rule] = RULES) -> DataFrame:
    """Per document: counts of the base kinds, digest of base spans, all spans."""
    rules = tuple(rules)
    base = [r.kind for r in rules if r.base]
    rows = scan(docs.select("doc_id", "text"), rules)

    def count(kind: str) -> Column:
        return F.size(F.filter("secret_spans", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")

    base_spans = F.filter("secret_spans", lambda s: s["kind"].isin(base))
    return rows.select("doc_id", *[count(k) for k in base],
                       F.sha2(joined(base_spans), 256).alias("base_sha256"),
                       joined(F.col("secret_spans")).alias("spans"))

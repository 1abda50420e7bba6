"""Secret scan over a trigram inverted index: Boolean queries from each rule, postings intersected, candidates verified.

Columns and SQL functions only.
"""

from __future__ import annotations

import itertools
import re._parser as regex_parser
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

from palate.llm.common import sized_broadcast, written
from palate.llm.patterns import no_spans, replaced, spans_of

# Sets of literal strings and Boolean queries stay this small while a pattern is read.
MOST_STRINGS, MOST_CLAUSES = 64, 64


@dataclass(frozen=True)
class Rule:
    kind: str
    pattern: str
    keep: Callable[[Column], Column] | None = None
    group: int = 0


# The first three are the base kinds (fixed values).
RULES = (
    Rule("assign", r"""(?i)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
         lambda found: F.length(found) >= 6, 2),
    Rule("access", r"AKIA[A-Z0-9]+", lambda found: F.length(found) >= 20),
    Rule("hex", r"[0-9a-f]{24,}+"),
    Rule("private_key", r"-----BEGIN (?:[A-Z]{2,12} ){0,3}PRIVATE KEY(?: BLOCK)?-----"),
    Rule("github_token", r"gh[pousr]_[A-Za-z0-9]{36,}"),
    Rule("github_pat", r"github_pat_[A-Za-z0-9_]{22,}"),
    Rule("gitlab_token", r"glpat-[A-Za-z0-9_-]{20,}"),
    Rule("slack_token", r"xox[abposr]-[A-Za-z0-9-]{10,}"),
    Rule("slack_hook", r"hooks\.slack\.com/services/[A-Za-z0-9/]{20,}"),
    Rule("google_key", r"AIza[A-Za-z0-9_-]{35}"),
    Rule("google_oauth", r"ya29\.[A-Za-z0-9_-]{20,}"),
    Rule("stripe_key", r"[rs]k_(?:live|test)_[A-Za-z0-9]{16,}"),
    Rule("jwt", r"eyJ[A-Za-z0-9_-]{8,}\.eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}"),
    Rule("aws_session", r"ASIA[A-Z0-9]{16,}"),
    Rule("npm_token", r"npm_[A-Za-z0-9]{36}"),
    Rule("pypi_token", r"pypi-AgE[A-Za-z0-9_-]{50,}"),
    Rule("sendgrid_key", r"SG\.[A-Za-z0-9_-]{16,64}\.[A-Za-z0-9_-]{16,}"),
    Rule("api_secret", r"sk-[A-Za-z0-9_-]{32,}"),
    Rule("bot_token", r"[0-9]{8,10}:AA[A-Za-z0-9_-]{33}"),
    Rule("account_key", r"(?i)AccountKey=[A-Za-z0-9+/=]{40,}"),
    Rule("bearer", r"(?i)bearer\x20{1,4}[A-Za-z0-9_.=-]{16,}"),
    Rule("basic_auth", r"(?i)authorization:\x20{0,4}basic\x20{1,4}[A-Za-z0-9+/=]{8,}"),
    Rule("url_login", r"[a-z][a-z0-9+.-]{1,15}://[^\s/:@]{1,64}:[^\s/:@]{1,64}@"),
    Rule("sid_key", r"\bSK[0-9a-f]{32}\b"),
)

# A query is a set of clauses, each a set of trigrams: true if every trigram of some clause occurs. ANY asks for nothing.
ANY = frozenset({frozenset()})


def simplest(clauses) -> frozenset:
    """Clauses without those that another clause implies; too many count as ANY."""
    kept = []
    for clause in sorted(set(clauses), key=lambda c: (len(c), sorted(c))):
        if not any(k <= clause for k in kept):
            kept.append(clause)
    return frozenset(kept) if len(kept) <= MOST_CLAUSES else ANY


def both(first: frozenset, second: frozenset) -> frozenset:
    if ANY in (first, second):
        return second if first == ANY else first
    return simplest(a | b for a in first for b in second)


def from_strings(strings: set[str]) -> frozenset:
    """The query of a text that holds one of the strings; a string below three characters asks for nothing."""
    return simplest(frozenset(s[i:i + 3] for i in range(len(s) - 2)) for s in strings)


def analyse(items) -> tuple[set[str] | None, frozenset]:
    """(all strings the sequence can match, or None; the query that its other parts ask for), in lower case."""
    strings, query, whole = {""}, ANY, True

    def flush():
        nonlocal strings, query, whole
        query, strings, whole = both(query, from_strings(strings)), {""}, False

    for name, value in items:
        name = str(name)
        options, inner = None, ANY
        if name == "LITERAL":
            options = {chr(value).lower()}
        elif name == "IN":
            literals = {chr(v).lower() for n, v in value if str(n) == "LITERAL"}
            if all(str(n) == "LITERAL" for n, _ in value) and len(literals) <= 6:
                options = literals
        elif name == "BRANCH":
            parts = [analyse(part) for part in value[1]]
            if all(s is not None for s, _ in parts):
                options = set().union(*(s for s, _ in parts))
            else:
                inner = simplest(itertools.chain.from_iterable(q if s is None else both(q, from_strings(s)) for s, q in parts))
        elif name == "SUBPATTERN":
            options, inner = analyse(value[3])
        elif name in ("MAX_REPEAT", "MIN_REPEAT", "POSSESSIVE_REPEAT"):
            least, most, item = value
            found, asked = analyse(item)
            if found is not None and (least, most) == (0, 1):
                options = found | {""}
            elif least:
                inner = asked if found is None else from_strings(found)
                if found is not None and len(found) ** least <= MOST_STRINGS:
                    repeated = {"".join(c) for c in itertools.product(found, repeat=least)}
                    if len(strings) * len(repeated) > MOST_STRINGS:
                        flush()
                    strings = {a + b for a in strings for b in repeated}
                    if least == most:
                        continue
        elif name in ("AT", "ASSERT", "ASSERT_NOT"):
            continue
        if options is not None and len(options) * len(strings) <= MOST_STRINGS:
            strings = {a + b for a in strings for b in options}
            continue
        flush()
        if options is not None:
            strings = options if len(options) <= MOST_STRINGS else {""}
        query = both(query, inner)
    if whole:
        return strings, ANY
    flush()
    return None, query


def trigram_query(pattern: str) -> frozenset:
    """Clauses of lower-case trigrams, one of which any text with a match holds entirely; ANY: no mandatory trigram."""
    strings, query = analyse(regex_parser.parse(pattern))
    return from_strings(strings) if strings is not None else query


def postings(docs: DataFrame, key: str, text: str, vocabulary: list[str]) -> DataFrame:
    """(trigram, key) of every trigram of the vocabulary that the lower-cased text holds."""
    wanted = F.array(*map(F.lit, vocabulary))
    held = F.transform(F.array(F.lower(F.col(text))), lambda low: F.filter(wanted, lambda t: F.contains(low, t)))[0]
    return docs.select(F.explode(held).alias("trigram"), F.col(key))


def candidates(index: DataFrame, key: str, rules: tuple[Rule, ...]) -> DataFrame:
    """(key, rules): numbers of the rules whose query the postings satisfy."""
    rows = [
        (trigram, number, place, len(clause))
        for number, rule in enumerate(rules) for place, clause in enumerate(sorted(trigram_query(rule.pattern), key=sorted))
        for trigram in sorted(clause)]
    terms = index.sparkSession.createDataFrame(rows, "trigram string, rule int, clause int, size int")
    met = (
        index.join(F.broadcast(terms), "trigram")  # as large as the rules, not the data
        .groupBy(key, "rule", "clause", "size").agg(F.countDistinct("trigram").alias("held"))
    )
    return met.where("held = size").groupBy(key).agg(F.collect_set("rule").alias("rules"))


def scan_secrets(docs: DataFrame, columns: list[str], text: str = "text", rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """`columns` of every row plus `spans`: array of (start, order, kind, end, found), by start, then rule order.

    Places are code points, end exclusive; matches of a rule are leftmost and do not overlap, those its condition
    rejects are dropped. A rule with mandatory trigrams is tried only on rows whose postings satisfy its query, others
    on every row. Null texts count as empty and have no spans; repeated rows stay; an empty table gives no rows. A kept
    column named `spans` gives way to the result, other names cannot clash. A very long text is matched as a whole.
    """
    queries = [trigram_query(rule.pattern) for rule in rules]
    vocabulary = sorted({t for query in queries for clause in query for t in clause})
    kept = F.struct(*[docs[c] for c in columns if c != "spans"]).alias("_kept")
    rows = docs.select(kept, F.coalesce(docs[text], F.lit("")).alias("_text")).withColumn("_row", F.xxhash64("_text"))
    found = written(candidates(postings(rows, "_row", "_text", vocabulary), "_row", rules), "candidates")
    joined = rows.join(sized_broadcast(found), "_row", "left")
    arrays = []
    for number, (rule, query) in enumerate(zip(rules, queries)):
        spans = spans_of(F.col("_text"), rule.kind, number, rule.pattern, rule.keep, rule.group)
        arrays.append(spans if query == ANY else F.when(F.array_contains("rules", number), spans).otherwise(no_spans()))
    return joined.select("_kept.*", F.array_sort(F.concat(*arrays)).alias("spans"))


def redacted(text: Column, spans: Column) -> Column:
    """The text with every secret replaced by [SECRET:kind]."""
    return replaced(text, spans, lambda span, found: F.concat(F.lit("[SECRET:"), span["kind"], F.lit("]")))

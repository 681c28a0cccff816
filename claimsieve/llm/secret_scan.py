"""Secret scans through a trigram index.

1. Every rule is a regular expression. From its syntax follows a Boolean trigram query: trigrams that each match must
   contain, as alternatives (OR) of sets (AND). A rule without mandatory trigrams scans every text.
2. The index holds (trigram, document) for the trigrams that some query names; a document is its id and the MD5 of its
   text. Postings of an alternative are intersected by counting: documents that have all its trigrams are candidates.
3. Candidates of a rule are verified with the rule itself, over the whole text.

Postings stay small because only named trigrams are kept. The candidates mark a fixed number of bits by hash, which is
all that is broadcast; documents that hit no mark cannot be candidates and stay where they are, so that only the others
take part in the exact join. Everything is built-in expressions.
"""

from __future__ import annotations

import re
from dataclasses import dataclass
from itertools import product

try:
    from re import _constants as codes
    from re import _parser as parser
except ImportError:  # Python before 3.11
    import sre_constants as codes
    import sre_parse as parser

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from claimsieve.llm.shared import marked


@dataclass(frozen=True)
class Rule:
    """A kind of secret: a pattern for Java and Python alike; `group` must have at least `least` characters."""

    kind: str
    pattern: str
    group: int = 0
    least: int = 1
    base: bool = False


# The base kinds, then widely published token formats. The order is the order of kinds in results.
RULES = (
    Rule(
        "assign",
        r"((?:[Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd]|[Pp][Aa][Ss][Ss][Ww][Dd]|[Ss][Ee][Cc][Rr][Ee][Tt]|"
        r"[Tt][Oo][Kk][Ee][Nn]|[Aa][Pp][Ii]_?[Kk][Ee][Yy]))"
        r"""["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
        group=2,
        least=8,
        base=True,
    ),
    Rule("access", r"AKIA[A-Z0-9]+", least=16, base=True),
    # a run of 32 or more is the same as a longest run that has 32 or more
    Rule("hex", r"[0-9a-f]{32,}", base=True),
    Rule("private_key", r"-----BEGIN [A-Z ]*PRIVATE KEY-----"),
    Rule("hub_token", r"gh[pousr]_[A-Za-z0-9]{36,}"),
    Rule("chat_token", r"xox[abprs]-[A-Za-z0-9-]{10,}"),
    Rule("web_token", r"eyJ[A-Za-z0-9_-]{8,}\.eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}"),
)

MOST_EXACT = 64

Query = list[frozenset[str]]
ANYTHING: Query = [frozenset()]


def _grams(text: str) -> frozenset[str]:
    return frozenset(text[i : i + 3] for i in range(len(text) - 2))


def _and(left: Query, right: Query) -> Query:
    return _simple([a | b for a, b in product(left, right)])


def _simple(query: Query) -> Query:
    """Alternatives that ask for more than another one add nothing."""
    return [a for a in dict.fromkeys(query) if not any(b < a for b in query)]


def _flush(exact: set[str]) -> Query:
    return _simple([_grams(text) for text in exact])


def _expand(node) -> set[str] | None:
    """The few lower-case strings a syntax node stands for, or None."""
    kind, value = node
    if kind is codes.LITERAL:
        return {chr(value).lower()}
    if kind is codes.IN:
        found = set()
        for part, what in value:
            if part is not codes.LITERAL:
                return None
            found.add(chr(what).lower())
        return found if len(found) <= 8 else None
    if kind is codes.MAX_REPEAT and value[1] == 1 and len(value[2]) == 1:
        inner = _expand(value[2][0])
        return None if inner is None else inner | ({""} if value[0] == 0 else set())
    return None


def _query(nodes) -> tuple[set[str] | None, Query]:
    """(all strings if few, trigrams of every match) of a sequence."""
    query, exact, whole = ANYTHING, {""}, True
    for kind, value in nodes:
        inner = _expand((kind, value))
        asked = ANYTHING
        if kind is codes.SUBPATTERN:
            inner, asked = _query(value[3])
        elif kind is codes.BRANCH:
            options = [_query(option) for option in value[1]]
            inner = set().union(*(o[0] for o in options)) if all(o[0] is not None for o in options) else None
            asked = _simple([a for _, option in options for a in option])
        elif kind is codes.MAX_REPEAT and inner is None and value[0] > 0:
            asked = _query(value[2])[1]
        if inner is not None and len(exact) * len(inner) <= MOST_EXACT:
            exact = {a + b for a, b in product(exact, inner)}
        else:
            query, exact, whole = _and(_and(query, _flush(exact)), asked), {""} if inner is None else inner, False
    return (exact if whole else None), _and(query, _flush(exact))


def trigram_query(pattern: str) -> Query:
    """Alternatives of lower-case trigrams; an alternative without trigrams means that any text may match."""
    query = _query(parser.parse(pattern))[1]
    return ANYTHING if frozenset() in query else query


def indexed(rules=RULES) -> dict[str, Query]:
    return {rule.kind: q for rule in rules if (q := trigram_query(rule.pattern)) != ANYTHING}


def postings(texts: DataFrame, trigrams: list[str]) -> DataFrame:
    """(trigram, doc_id, text_key): one posting per document and named trigram."""
    held = F.array(*(F.when(F.contains("lower", F.lit(t)), F.lit(t)) for t in trigrams))
    lowered = texts.select("doc_id", F.md5("text").alias("text_key"), F.lower("text").alias("lower"))
    return lowered.select("doc_id", "text_key", F.explode(F.array_compact(held)).alias("trigram"))


def candidates(texts: DataFrame, queries: dict[str, Query]) -> DataFrame:
    """doc_id, text_key and the rules (`kinds`) whose query the document satisfies."""
    spark = texts.sparkSession
    asked = [
        (kind, f"{kind}{i}", len(alternative), trigram)
        for kind, query in queries.items()
        for i, alternative in enumerate(query)
        for trigram in sorted(alternative)
    ]
    table = spark.createDataFrame(asked, "kind string, alternative string, needed int, trigram string")
    held = postings(texts, sorted({row[3] for row in asked}))
    met = held.join(F.broadcast(table), "trigram").groupBy("doc_id", "text_key", "kind", "alternative", "needed")
    full = met.agg(F.count_distinct("trigram").alias("held")).filter(F.col("held") == F.col("needed"))
    return full.groupBy("doc_id", "text_key").agg(F.collect_set("kind").alias("kinds"))


def spans(text: Column, rule: Rule, rank: int) -> Column:
    """Array of (start, end, rank, kind) of the matches that pass, in code points, from the pieces between matches."""
    matches = F.regexp_extract_all(text, F.lit(rule.pattern if rule.group else f"({rule.pattern})"), F.lit(0))
    tested = F.regexp_extract_all(text, F.lit(rule.pattern), F.lit(rule.group)) if rule.group else matches
    entries = F.arrays_zip(
        F.split(text, rule.pattern).alias("gap"), matches.alias("match"), tested.alias("tested")
    )

    def step(done, entry):
        start = done["at"] + F.length(entry["gap"])
        end = start + F.coalesce(F.length(entry["match"]), F.lit(0))
        span = F.struct(
            start.alias("start"), end.alias("end"), F.lit(rank).alias("rank"), F.lit(rule.kind).alias("kind")
        )
        passed = F.coalesce(F.length(entry["tested"]) >= rule.least, F.lit(False))
        found = F.when(passed, F.concat(done["found"], F.array(span))).otherwise(done["found"])
        return F.struct(end.alias("at"), found.alias("found"))

    kind = "array<struct<start:int,end:int,rank:int,kind:string>>"
    begin = F.struct(F.lit(0).alias("at"), F.array().cast(kind).alias("found"))
    walked = F.aggregate(entries, begin, step, lambda done: done["found"])
    return F.when(text.rlike(rule.pattern), walked).otherwise(F.array().cast(kind))


def scan(docs: DataFrame, rules=RULES) -> DataFrame:
    """The columns of `docs` and `secret_spans`: array of (start, end, rank, kind), by start, then by rule.

    A null text has no spans. Repeated rows, null ids and texts of any length are scanned alike; the column names that
    this adds on the way are chosen so that they meet none of `docs`.
    """
    queries = indexed(rules)
    ranks = {rule.kind: i for i, rule in enumerate(rules)}
    text = F.coalesce(F.col("text"), F.lit(""))
    full = [spans(text, rule, ranks[rule.kind]) for rule in rules if rule.kind not in queries]
    texts = docs.select("doc_id", text.alias("text"))
    found = candidates(texts, queries)

    own = F.xxhash64("doc_id", F.md5(text))
    with_marks, hit = marked(docs, own, found, F.xxhash64("doc_id", "text_key"))
    columns = [F.col(f"`{name}`") for name in docs.columns]

    plain = with_marks.filter(~hit).select(*columns, F.sort_array(F.concat(*full)).alias("secret_spans"))
    named = found.select(
        F.col("doc_id").alias("secret doc"), F.col("text_key").alias("secret key"), F.col("kinds").alias("secret kinds")
    )
    same = F.col("doc_id").eqNullSafe(F.col("secret doc")) & (F.md5(text) == F.col("secret key"))
    near = with_marks.filter(hit).join(named, same, "left")
    none = F.array().cast("array<struct<start:int,end:int,rank:int,kind:string>>")
    verified = [
        F.when(F.array_contains("secret kinds", rule.kind), spans(text, rule, ranks[rule.kind])).otherwise(none)
        for rule in rules
        if rule.kind in queries
    ]
    checked = near.select(*columns, F.sort_array(F.concat(*full, *verified)).alias("secret_spans"))
    return plain.unionByName(checked)


def report(docs: DataFrame, rules=RULES) -> DataFrame:
    """doc_id, matches per base kind, the hash of the base spans, and all spans as text."""
    base = {rule.kind for rule in rules if rule.base}
    slim = scan(docs.select("doc_id", "text"), rules)

    def listed(entries: Column) -> Column:
        return F.array_join(F.transform(entries, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")

    own = F.filter("secret_spans", lambda s: s["kind"].isin(*base))

    def count(kind: str) -> Column:
        return F.size(F.filter("secret_spans", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")

    counts = [count(rule.kind) for rule in rules if rule.base]
    digest = F.sha2(F.encode(listed(own), "UTF-8"), 256).alias("base_sha256")
    return slim.select("doc_id", *counts, digest, listed(F.col("secret_spans")).alias("spans"))


def mask(docs: DataFrame, rules=RULES, with_text: str = "[SECRET]") -> DataFrame:
    """The columns of `docs` with every span replaced; overlapping spans are replaced as one. `n_chars` follows the text
    where a text changed; documents without a secret stay as they are."""

    def step(done, span):
        fresh = span["start"] >= done["at"]
        kept = F.substring(F.col("text"), done["at"] + 1, F.greatest(span["start"] - done["at"], F.lit(0)))
        out = F.concat(done["out"], kept, F.when(fresh, F.lit(with_text)).otherwise(F.lit("")))
        return F.struct(out.alias("out"), F.greatest(done["at"], span["end"]).alias("at"))

    begin = F.struct(F.lit("").alias("out"), F.lit(0).alias("at"))

    def finish(done):
        return F.concat(done["out"], F.substring(F.col("text"), done["at"] + 1, F.length("text")))

    masked = F.aggregate("secret_spans", begin, step, finish)
    any_span = F.size("secret_spans") > 0
    changed = {"text": F.when(any_span, masked).otherwise(F.col("text"))}
    if "n_chars" in docs.columns:
        size = F.length(masked).cast(docs.schema["n_chars"].dataType)
        changed["n_chars"] = F.when(any_span, size).otherwise(F.col("n_chars"))
    return scan(docs, rules).withColumns(changed).select(*(F.col(f"`{name}`") for name in docs.columns))

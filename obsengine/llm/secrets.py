"""Secret scans over a trigram inverted index, with built-in functions only.

Each rule's regular expression is turned into a Boolean query over trigrams
that any match must contain. Postings (trigram, document) are intersected per
rule, and only the candidates are searched with the rule's expression. A rule
from which no trigram follows searches every text.
"""

from __future__ import annotations

import re
from dataclasses import dataclass
from itertools import product

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from obsengine.llm.common import bitmap, let, possibly, whole_row
from obsengine.session import materialize


@dataclass(frozen=True)
class SecretRule:
    """Leftmost non-overlapping matches; with ``group``, only those whose group is long enough."""

    kind: str
    pattern: str
    group: int = 0
    least: int = 0


#: The base rules, then those for key formats with a fixed beginning.
#: ``{16,}`` and ``{24,}`` stand for runs filtered by length: a run is matched
#: whole from its start, and what is inside a run too short is shorter still.
RULES = (
    SecretRule(
        "assign",
        "((?i:password|passwd|secret|token|api_?key))[\"']?\\x20*[:=]\\x20*[\"']?([A-Za-z0-9+/_.=-]+)",
        2, 6,
    ),
    SecretRule("access", "AKIA[A-Z0-9]{16,}"),
    SecretRule("hex", "[0-9a-f]{24,}"),
    SecretRule("private_key", "-----BEGIN [A-Z ]*PRIVATE KEY-----"),
    SecretRule("github", "gh[pousr]_[A-Za-z0-9]{36,}"),
    SecretRule("slack", "xox[abprs]-[A-Za-z0-9-]{10,}"),
    SecretRule("google", "AIza[0-9A-Za-z_-]{35}"),
    SecretRule("jwt", "eyJ[A-Za-z0-9_-]{8,}[.][A-Za-z0-9_-]{8,}[.][A-Za-z0-9_-]{8,}"),
    SecretRule("stripe", "[sr]k_live_[0-9A-Za-z]{16,}"),
)

BASE = ("assign", "access", "hex")

# Trigram queries

_MANY = 64  # more strings than this are not spelled out


def _spelled(tree) -> tuple[set[str] | None, list[set[str]]]:
    """All strings that a parsed expression matches (None: too many), and sets one of which occurs."""
    whole: set[str] | None = {""}
    run: set[str] = {""}
    needed: list[set[str]] = []
    for op, arg in tree:
        strings, inner, ends = _spelled_one(str(op), arg)
        needed += inner
        if strings is not None and len(run) * len(strings) <= _MANY:
            run = {a + b for a, b in product(run, strings)}
            continue
        whole = None
        if ends is not None and len(run) * len(ends) <= _MANY:
            run = {a + b for a, b in product(run, ends)}
        needed.append(run)
        run = strings or ends or {""}
    if whole is not None:
        return run, needed
    return None, [*needed, run]


def _spelled_one(op: str, arg) -> tuple[set[str] | None, list[set[str]], set[str] | None]:
    """The same of one part, and strings with one of which it begins and with one of which it ends."""
    if op == "LITERAL":
        return {chr(arg).lower()}, [], None
    if op == "IN" and all(str(kind) == "LITERAL" for kind, _ in arg):
        return {chr(code).lower() for _, code in arg}, [], None
    if op == "SUBPATTERN":
        return *_spelled(arg[3]), None
    if op == "BRANCH":
        parts = [_spelled(branch) for branch in arg[1]]
        if all(strings is not None for strings, _ in parts):
            return set().union(*(strings for strings, _ in parts)), [], None
        # One branch holds, so one of the strings that each branch needs holds.
        each = [[strings] if strings is not None else inner for strings, inner in parts]
        best = [max(x, key=lambda s: min(map(len, s)), default={""}) for x in each]
        return None, [set().union(*best)], None
    if op in ("MAX_REPEAT", "MIN_REPEAT", "POSSESSIVE_REPEAT"):
        least, most, body = arg
        strings, inner = _spelled(body)
        if least == 0:
            return ({""} | strings, [], None) if most == 1 and strings is not None else (None, [], None)
        if strings is None:
            return None, inner, None
        copies = {""}
        for _ in range(int(least)):
            if len(copies) * len(strings) > _MANY:
                break
            copies = {a + b for a, b in product(copies, strings)}
        else:
            if least == most:
                return copies, inner, None
        # An open repeat begins and ends with that many copies.
        return None, [*inner, copies], copies
    if op == "AT":
        return {""}, [], None
    return None, [], None


def trigram_query(pattern: str) -> list[list[frozenset[str]]]:
    """A conjunction of clauses; a clause holds if all trigrams of one of its options occur.

    Trigrams are in lower case, for texts in lower case. An empty conjunction
    means that no trigram is mandatory.
    """
    whole, needed = _spelled(re._parser.parse(pattern))
    clauses = []
    for strings in [*needed, *([whole] if whole is not None else [])]:
        if min(map(len, strings)) < 3:
            continue
        options = {frozenset(s[i : i + 3] for i in range(len(s) - 2)) for s in strings}
        options = {o for o in options if not any(other < o for other in options)}
        clauses.append(sorted(options, key=sorted))
    return clauses


def postings(docs: DataFrame, trigrams: list[str]) -> DataFrame:
    """The inverted index (trigram, doc_id) of the trigrams that some query names."""
    low = docs.select("doc_id", F.lower(F.coalesce(F.col("text"), F.lit(""))).alias("_low"))
    found = F.array(*(F.when(F.contains("_low", F.lit(t)), F.lit(t)) for t in trigrams))
    return low.select("doc_id", F.explode(F.array_compact(found)).alias("trigram"))


def candidates(index: DataFrame, queries: dict[str, list[list[frozenset[str]]]]) -> DataFrame:
    """Documents whose postings meet a query: doc_id and the array of kinds.

    The joined table of queries is as large as the rules, and documents are
    grouped by id, so no posting list is gathered.
    """
    rows = [
        (kind, c, o, t, len(option), len(clauses))
        for kind, clauses in queries.items()
        for c, clause in enumerate(clauses)
        for o, option in enumerate(clause)
        for t in sorted(option)
    ]
    schema = "kind string, clause int, option int, trigram string, n_trigrams int, n_clauses int"
    wanted = F.broadcast(index.sparkSession.createDataFrame(rows, schema))
    options = (
        index.join(wanted, "trigram")
        .groupBy("doc_id", "kind", "n_clauses", "clause", "option", "n_trigrams")
        .agg(F.count_distinct("trigram").alias("n"))
        .filter(F.col("n") == F.col("n_trigrams"))
    )
    kinds = (
        options.groupBy("doc_id", "kind", "n_clauses")
        .agg(F.count_distinct("clause").alias("n"))
        .filter(F.col("n") == F.col("n_clauses"))
    )
    return kinds.groupBy("doc_id").agg(F.collect_set("kind").alias("_kinds"))


# Verification

_SPANS = "array<struct<start:int,kind:int,end:int>>"


def _spans(text: Column, number: int, rule: SecretRule) -> Column:
    """(start, kind, end) of each match, from the lengths of the matches and of what parts them."""

    def located(x: Column) -> Column:
        def step(acc: Column, m: Column) -> Column:
            start = acc["at"] + m["gap"]
            end = start + m["size"]
            span = F.struct(start.alias("start"), F.lit(number).alias("kind"), end.alias("end"))
            kept = F.when(m["value"] >= rule.least, F.array(span)).otherwise(F.array().cast(_SPANS))
            return F.struct(end.alias("at"), F.concat(acc["spans"], kept).alias("spans"))

        zero = F.struct(F.lit(0).alias("at"), F.array().cast(_SPANS).alias("spans"))
        return F.aggregate(x, zero, step, lambda acc: acc["spans"])

    pattern = F.lit(rule.pattern)
    matches = F.arrays_zip(
        F.regexp_extract_all(text, pattern, F.lit(0)).alias("m"),
        F.regexp_extract_all(text, pattern, F.lit(rule.group)).alias("g"),
        F.slice(F.split(text, rule.pattern, -1), 1, F.regexp_count(text, pattern)).alias("p"),
    )
    sizes = F.transform(
        matches,
        lambda m: F.struct(
            F.length(m["p"]).alias("gap"), F.length(m["m"]).alias("size"),
            F.length(m["g"]).alias("value"),
        ),
    )
    return F.when(text.rlike(rule.pattern), let(sizes, located)).otherwise(F.array().cast(_SPANS))


def find_secrets(docs: DataFrame, rules: tuple[SecretRule, ...] = RULES) -> DataFrame:
    """``docs`` as a struct column ``row``, ``_text`` (never null) and the sorted array ``spans``.

    Spans are (start, kind, end): code points, end exclusive, and the number of
    the rule. Null texts count as empty. Repeated ids share candidates, which
    costs only searches; a null id is an id like any other. All other columns
    stay inside ``row``.
    """
    queries = {rule.kind: trigram_query(rule.pattern) for rule in rules}
    indexed = {kind: query for kind, query in queries.items() if query}
    base = docs.select(
        whole_row(docs), F.col("doc_id").alias("_id"),
        F.coalesce(F.col("text"), F.lit("")).alias("_text"),
    )
    trigrams = sorted({t for q in indexed.values() for clause in q for o in clause for t in o})
    index = materialize(postings(docs.select("doc_id", "text"), trigrams), "postings")
    hits = materialize(candidates(index, indexed), "candidates")
    marked = possibly(base, F.col("_id"), bitmap(hits, "doc_id"))
    none = F.array().cast("array<string>")
    chosen = (
        marked.filter("_possible")
        .join(hits.withColumnRenamed("doc_id", "_cid"), F.col("_id").eqNullSafe(F.col("_cid")), "left")
        .select("row", "_text", F.coalesce("_kinds", none).alias("_kinds"))
    )
    rest = marked.filter(~F.col("_possible")).select("row", "_text")

    def search(number: int, rule: SecretRule) -> Column:
        spans = _spans(F.col("_text"), number, rule)
        if rule.kind not in indexed:
            return spans
        wanted = F.array_contains("_kinds", rule.kind)
        return F.when(wanted, spans).otherwise(F.array().cast(_SPANS))

    every = [search(n, rule) for n, rule in enumerate(rules)]
    scans = [search(n, rule) for n, rule in enumerate(rules) if rule.kind not in indexed]
    gather = lambda parts: F.sort_array(F.concat(F.array().cast(_SPANS), *parts)).alias("spans")
    return chosen.select("row", "_text", gather(every)).union(rest.select("row", "_text", gather(scans)))


def spelled(spans: Column, rules: tuple[SecretRule, ...] = RULES) -> Column:
    """Spans as ``kind:start:end``, joined by commas."""
    names = F.array(*(F.lit(rule.kind) for rule in rules))
    one = lambda s: F.concat_ws(":", F.get(names, s["kind"]), s["start"], s["end"])
    return F.concat_ws(",", F.transform(spans, one))


def redacted(text: Column, spans: Column, mark: str = "<SECRET>") -> Column:
    """``text`` with each span, or each run of overlapping spans, replaced by ``mark``."""

    def step(acc: Column, s: Column) -> Column:
        fresh = s["start"] >= acc["at"]
        gap = F.substring(text, acc["at"] + 1, s["start"] - acc["at"])
        return F.struct(
            F.greatest(acc["at"], s["end"]).alias("at"),
            F.when(fresh, F.concat(acc["out"], gap, F.lit(mark))).otherwise(acc["out"]).alias("out"),
        )

    zero = F.struct(F.lit(0).alias("at"), F.lit("").alias("out"))
    end = lambda acc: F.concat(acc["out"], F.substring(text, acc["at"] + 1, F.length(text)))
    return F.when(F.size(spans) == 0, text).otherwise(F.aggregate(spans, zero, step, end))


def scan_sql(rules: tuple[SecretRule, ...] = RULES) -> str:
    """DuckDB SQL for the digest of ``op4``: the same spans by a plain search of every text."""

    def found(n: int, rule: SecretRule) -> str:
        q = "'" + rule.pattern.replace("'", "''") + "'"
        lengths = lambda x: f"coalesce(list_sum(list_transform({x}, lambda y: length(y))), 0)"
        start = f"CAST({lengths('p[1:i]')} + {lengths('m[1:i-1]')} AS BIGINT)"
        return f"""(SELECT list_transform(list_filter(range(1, len(m) + 1),
          lambda i: length(g[i]) >= {rule.least}),
          lambda i: {{'s': {start}, 'k': {n}, 'e': {start} + length(m[i])}})
        FROM (SELECT regexp_extract_all(t, {q}, 0) AS m, regexp_extract_all(t, {q}, {rule.group}) AS g,
                     string_split_regex(t, {q}) AS p))"""

    names = "[" + ", ".join(f"'{rule.kind}'" for rule in rules) + "]"
    parts = ", ".join(f"{found(n, rule)} AS r{n}" for n, rule in enumerate(rules))
    joined = " || ".join(f"r{n}" for n in range(len(rules)))
    text = lambda x: f"""coalesce(list_aggregate(list_transform({x},
        lambda z: {names}[z.k + 1] || ':' || z.s || ':' || z.e), 'string_agg', ','), '')"""  # noqa: E731
    return f"""WITH docs AS (SELECT doc_id, coalesce(text, '') AS t FROM documents),
found AS (SELECT doc_id, {parts} FROM docs),
spans AS (SELECT doc_id, list_sort({joined}) AS x, CAST(len(r0) AS BIGINT) AS n_assign,
  CAST(len(r1) AS BIGINT) AS n_access, CAST(len(r2) AS BIGINT) AS n_hex FROM found)
SELECT doc_id, n_assign, n_access, n_hex,
  sha256({text("list_filter(x, lambda z: z.k < 3)")}) AS base_sha256, {text("x")} AS spans
FROM spans"""

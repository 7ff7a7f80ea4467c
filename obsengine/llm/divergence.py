"""Divergence audit of sources: which sources of a language differ, and by which terms.

Every term of a language that is kept has an exact integer frequency in each
source and in the language, and two frequencies p and q differ by
``f = floor((p - q)^2 / (p + q))``. Frequencies depend on counts only, so f is
evaluated once per cell of counts and weighted by the number of terms in it:

* terms of a source: cells (count in the source, count in the language). Cells
  of equal f are merged, the values that fill the first ranks are found by
  cumulative multiplicity, and only their cells are expanded to terms.
* pairs of sources: cells (count in one, count in the other). Terms with the
  same counts in all sources are folded first. Terms that one side lacks are
  taken from the histogram of the other, so absent terms make no rows.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from obsengine.llm.common import field
from obsengine.session import materialize

#: Terms of texts as bytes in lower case: no byte of a longer character is below 0x80.
_TERMS = re.compile(rb"[a-z\x80-\xff]+").findall
#: Terms that a task holds before it hands them on.
HELD = 1_000_000
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
SCALE = 1_000_000_000
#: Sources whose counts of a term are held in one array.
BLOCK = 32

_GROUP = ("lang", "source")


def frequency(count: Column, total: Column, terms: Column) -> Column:
    """``1 + floor(SCALE * (count + 2) / (total + 2 * terms))``; null without terms."""
    wide = "decimal(19,0)"
    of = F.nullif(total.cast(wide) + terms.cast(wide) * 2, F.lit(0).cast(wide))
    scaled = F.lit(SCALE).cast("decimal(10,0)") * (count.cast(wide) + 2)
    return F.call_function("div", scaled, of) + 1


def divergence(p: Column, q: Column) -> Column:
    """``floor((p - q)^2 / (p + q))``; both are below 2^31, so nothing overflows."""
    return F.call_function("div", (p - q) * (p - q), p + q)


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(lang, source, term, n, docs) folded within a task, handed on whenever :data:`HELD` terms are held."""
    held: dict[tuple[str, str], tuple[Counter, Counter]] = {}

    def folded() -> Iterator[pa.RecordBatch]:
        for (lang, source), (n, docs) in held.items():
            terms = pa.array([b"", *n], pa.binary()).cast(pa.string())  # the empty term stands for the group
            size = len(terms)
            yield pa.RecordBatch.from_pydict({
                "lang": pa.repeat(lang, size), "source": pa.repeat(source, size), "term": terms,
                "n": pa.array([0, *n.values()], pa.int64()), "docs": pa.array([0, *map(docs.__getitem__, n)], pa.int64()),
            })
        held.clear()

    for batch in batches:
        for lang, source, text in zip(*(column.to_pylist() for column in batch.columns), strict=True):
            n, docs = held.setdefault((lang, source), (Counter(), Counter()))
            terms = _TERMS(text.lower())  # of bytes: only A-Z change
            n.update(terms)
            docs.update(set(terms))
        if sum(len(n) for n, _ in held.values()) > HELD:
            yield from folded()
    yield from folded()


def term_counts(docs: DataFrame) -> DataFrame:
    """(lang, source, term, n, docs): occurrences of a term and documents with it.

    Each group also has a row of the empty term with zero counts, so groups
    without terms are there. Null text, lang and source count as ''. Rows are
    folded within tasks before they move.
    """
    known = {c: F.coalesce(field(docs, c).cast("string"), F.lit("")) for c in (*_GROUP, "text")}
    known["text"] = known["text"].cast("binary")
    read = docs.select(*(column.alias(c) for c, column in known.items()))
    parts = read.mapInArrow(_counted, "lang string, source string, term string, n bigint, docs bigint")
    return parts.groupBy(*_GROUP, "term").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"))


def _profile(counts: DataFrame, min_docs: int) -> tuple[DataFrame, DataFrame]:
    """Stored (lang, source, term, n, lang_n) of kept terms, and one row of totals per group."""
    langs = (
        counts.filter(F.col("term") != "")
        .groupBy("lang", "term")
        .agg(F.sum("n").alias("lang_n"), F.sum("docs").alias("lang_docs"))
        .filter(F.col("lang_docs") >= min_docs)
        .drop("lang_docs")
    )
    langs = materialize(langs, "lang-terms")
    kept = materialize(counts.drop("docs").join(langs, ["lang", "term"]), "kept-terms")
    totals = langs.groupBy("lang").agg(F.count("*").alias("terms"), F.sum("lang_n").alias("lang_total"))
    known = kept.groupBy(*_GROUP).agg(F.sum("n").alias("total"))
    groups = (
        counts.filter(F.col("term") == "").select(*_GROUP)
        .join(known, [*_GROUP], "left")
        .join(totals, "lang", "left")
        .fillna(0, ["total", "terms", "lang_total"])
    )
    return kept, materialize(groups, "groups")


def term_part(kept: DataFrame, groups: DataFrame, top: int) -> DataFrame:
    """The ``top`` terms of each group that are more frequent there than in the language."""
    cell = (*_GROUP, "n", "lang_n")
    cells = materialize(
        kept.groupBy(*cell).agg(F.count("*").alias("m"))
        .join(groups, [*_GROUP])
        .withColumns({
            "p": frequency(F.col("n"), F.col("total"), F.col("terms")),
            "q": frequency(F.col("lang_n"), F.col("lang_total"), F.col("terms")),
        })
        .filter(F.col("p") > F.col("q"))
        .select(*cell, "m", divergence(F.col("p"), F.col("q")).alias("value")),
        "cells",
    )
    by_value = Window.partitionBy(*_GROUP).orderBy(F.desc("value"))
    # Every value has a term at least, so the first ``top`` values are enough.
    values = (
        cells.groupBy(*_GROUP, "value").agg(F.sum("m").alias("m"))
        .withColumn("place", F.row_number().over(by_value)).filter(F.col("place") <= top)
        .withColumn("through", F.sum("m").over(by_value.rowsBetween(Window.unboundedPreceding, 0)))
        .filter(F.col("through") - F.col("m") < top)
        .select(*_GROUP, "value")
    )
    chosen = cells.join(values, [*_GROUP, "value"]).select(*cell, "value")
    rank = F.row_number().over(Window.partitionBy(*_GROUP).orderBy(F.desc("value"), "term"))
    return (
        kept.join(chosen, [*cell])
        .withColumn("rank", rank)
        .filter(F.col("rank") <= top)
        .select(*_GROUP, F.lit("term").alias("part"), F.col("term").alias("item"), "value", "rank")
    )


def _joint_cells(kept: DataFrame, groups: DataFrame) -> DataFrame:
    """(lang, a, b, na, nb, m) for a < b: how many terms occur na times in a and nb in b.

    Counts of a term are held in arrays of about :data:`BLOCK` sources, and
    equal (pairs of) arrays are folded, so a row expands to a bounded number.
    """
    blocks = F.ceil(F.count("*").over(Window.partitionBy("lang")) / F.lit(BLOCK))
    dealt = groups.select(*_GROUP, F.pmod(F.xxhash64("source"), blocks).cast("int").alias("block"))
    side = F.sort_array(F.collect_list(F.struct("source", "n")))
    arrays = materialize(
        kept.join(dealt, [*_GROUP]).groupBy("lang", "term", "block").agg(side.alias("counts")), "arrays"
    )
    other = arrays.select("lang", "term", F.col("block").alias("to"), F.col("counts").alias("others"))
    met = arrays.join(other, ["lang", "term"]).filter(F.col("block") <= F.col("to"))
    folded = met.groupBy("lang", "block", "to", "counts", "others").agg(F.count("*").alias("m"))
    first = folded.select("lang", "block", "to", "others", "m", F.inline("counts").alias("a", "na"))
    second = first.select("lang", "block", "to", "m", "a", "na", F.inline("others").alias("b", "nb"))
    once = (F.col("block") < F.col("to")) | (F.col("a") < F.col("b"))
    return second.filter(once).groupBy("lang", "a", "b", "na", "nb").agg(F.sum("m").alias("m"))


def pair_part(kept: DataFrame, groups: DataFrame) -> DataFrame:
    """Every other source of the language, ranked by the sum of f over all kept terms."""
    side = lambda name: groups.select("lang", F.col("source").alias(name), F.col("total").alias(f"total_{name}"))
    pairs = (
        side("a").join(side("b"), "lang").filter(F.col("a") != F.col("b"))
        .join(groups.select("lang", "terms").distinct(), "lang")
    )
    p = lambda count, name: frequency(count, F.col(f"total_{name}"), F.col("terms"))
    zero, f = F.lit(0), divergence
    absent = pairs.withColumns({"pa0": p(zero, "a"), "pb0": p(zero, "b")})
    # All terms as if both lacked them, corrected where one side has them, then where both have.
    base = absent.select("lang", "a", "b", (F.col("terms") * f(F.col("pa0"), F.col("pb0"))).alias("v"))
    seen = kept.groupBy("lang", F.col("source").alias("a"), "n").agg(F.count("*").alias("m"))
    pa, pb = p(F.col("na"), "a"), p(F.col("nb"), "b")
    one = seen.withColumnRenamed("n", "na").join(absent, ["lang", "a"]).groupBy("lang", "a", "b").agg(
        F.sum(F.col("m") * (f(pa, F.col("pb0")) - f(F.col("pa0"), F.col("pb0")))).alias("v")
    )
    apart = f(pa, F.col("pb0")) + f(F.col("pa0"), pb) - f(F.col("pa0"), F.col("pb0"))
    both = _joint_cells(kept, groups).join(absent, ["lang", "a", "b"]).groupBy("lang", "a", "b").agg(
        F.sum(F.col("m") * (f(pa, pb) - apart)).alias("v")
    )
    turned = lambda df: df.union(df.select("lang", F.col("b"), F.col("a"), "v"))
    summed = base.union(turned(one)).union(turned(both)).groupBy("lang", "a", "b").agg(F.sum("v").alias("v"))
    value = F.coalesce("v", F.lit(0).cast("long"))  # without kept terms
    ranked = summed.select("lang", F.col("a").alias("source"), F.lit("pair").alias("part"), F.col("b").alias("item"), value.alias("value"))
    rank = F.row_number().over(Window.partitionBy(*_GROUP).orderBy(F.desc("value"), "item"))
    return ranked.withColumn("rank", rank)


def source_divergence(docs: DataFrame, *, min_docs: int = 10, top: int = 10) -> DataFrame:
    """(lang, source, part, item, value, rank) of every (lang, source) group of ``docs``.

    ``docs`` has columns text, lang and source; others are not read. A language
    keeps the terms that at least ``min_docs`` of its documents contain. Part
    ``pair`` ranks every other source of the language, part ``term`` the first
    ``top`` terms that are more frequent in the group than in the language.
    Ties go to the smaller item by UTF-8 bytes. Null values count as ''; repeated
    rows are documents of their own; a language without kept terms has pairs of
    value 0 and no terms; an empty table gives no row.
    """
    counts = materialize(term_counts(docs), "term-counts")
    kept, groups = _profile(counts, min_docs)
    return pair_part(kept, groups).union(term_part(kept, groups, top))


def divergence_sql() -> str:
    """The result of :func:`source_divergence` with its defaults, over every term and group."""
    p = lambda n, total, v: f"(1 + {SCALE}::HUGEINT * ({n} + 2) // ({total} + 2 * {v}))"
    f = "((x.p - y.p) * (x.p - y.p)) // (x.p + y.p)"
    return f"""
WITH d AS (
  SELECT row_number() OVER () AS row_id, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
         regexp_extract_all(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'), '[^\\x00-\\x40\\x5B-\\x60\\x7B-\\x7F]+') AS terms
  FROM documents),
g AS (SELECT DISTINCT lang, source FROM d),
w AS (SELECT row_id, lang, source, unnest(terms) AS term FROM d),
t AS (SELECT lang, term, count(*) AS n FROM w GROUP BY lang, term HAVING count(DISTINCT row_id) >= 10),
v AS (SELECT lang, count(*) AS v, sum(n) AS total FROM t GROUP BY lang),
c AS (SELECT w.lang, w.source, w.term, count(*) AS n FROM w JOIN t USING (lang, term) GROUP BY ALL),
s AS (SELECT lang, source, sum(n) AS total FROM c GROUP BY ALL),
dense AS (
  SELECT g.lang, g.source, t.term, coalesce(c.n, 0) AS n,
         {p("coalesce(c.n, 0)", "coalesce(s.total, 0)", "v.v")} AS p,
         {p("t.n", "v.total", "v.v")} AS q
  FROM g JOIN t USING (lang) JOIN v USING (lang) LEFT JOIN s USING (lang, source)
  LEFT JOIN c ON c.lang = g.lang AND c.source = g.source AND c.term = t.term),
sums AS (
  SELECT x.lang, x.source, y.source AS item, sum({f}) AS value
  FROM dense x JOIN dense y ON x.lang = y.lang AND x.term = y.term AND x.source <> y.source GROUP BY ALL),
parts AS (
  SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(sums.value, 0)::BIGINT AS value
  FROM g a JOIN g b ON a.lang = b.lang AND a.source <> b.source
  LEFT JOIN sums ON sums.lang = a.lang AND sums.source = a.source AND sums.item = b.source
  UNION ALL
  SELECT lang, source, 'term', term, ((p - q) * (p - q) // (p + q))::BIGINT FROM dense WHERE n > 0 AND p > q),
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item)::INTEGER AS rank FROM parts)
SELECT lang, source, part, item, value, rank FROM ranked WHERE part = 'pair' OR rank <= 10
"""

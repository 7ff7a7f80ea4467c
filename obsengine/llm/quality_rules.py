"""Quality rules: a decision list learned by sequential covering, run as Spark conditions.

Every statistic is a built-in column expression. Learning asks Spark for counts
only: each step of growing or pruning is one aggregation over all labelled
rows, and what reaches the driver is bounded by statistics x thresholds.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from obsengine.llm.common import SPACES, bitmap, discard, let, possibly, whole_row, words_of
from obsengine.session import materialize

SYMBOLS = "#*$%&|<>"

#: Statistics that rules may test, each a share in thousandths of words, lines or characters.
STATISTICS = (
    "symbols_per_word", "dup_line_share", "repeat_share", "upper_share", "digit_share",
    "mark_share", "mean_word",
)


def _count(text: Column, characters: str) -> Column:
    return (F.length(text) - F.length(F.translate(text, characters, ""))).cast("long")


def _windows(words: Column) -> Column:
    """Sorted (hash, position) of each window of three words."""

    def pairs(w: Column) -> Column:
        n = F.size(w)
        places = F.when(n >= 3, F.sequence(F.lit(1), n - 2)).otherwise(F.array().cast("array<int>"))
        window = lambda i: F.xxhash64(
            F.element_at(w, i), F.element_at(w, i + 1), F.element_at(w, i + 2)
        )
        return F.sort_array(
            F.transform(places, lambda i: F.struct(window(i).alias("h"), i.alias("at")))
        )

    return let(words, pairs)


def _repeated_words(words: Column) -> Column:
    """Words inside any window of three words that occurs again; windows overlap, words count once."""

    def covered(s: Column) -> Column:
        def starts(x: Column, i: Column) -> Column:
            again = (F.get(s, i - 1)["h"] == x["h"]) | (F.get(s, i + 1)["h"] == x["h"])
            return F.when(again, x["at"])

        at = F.array_sort(F.filter(F.transform(s, starts), lambda x: x.isNotNull()))
        # A window adds its three words less those that the window before it covers.
        step = lambda acc, x: F.struct(
            (acc["n"] + F.least(F.lit(3), x - acc["last"])).alias("n"), x.alias("last")
        )
        zero = F.struct(F.lit(0).alias("n"), F.lit(-9).alias("last"))
        return F.aggregate(at, zero, step, lambda acc: acc["n"])

    return let(_windows(words), covered).cast("long")


def statistics(docs: DataFrame, text: str = "text", carry: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """The carried columns, the base counts, ``base_failed`` and :data:`STATISTICS` of each row.

    A null text counts as empty: all counts are 0 and it fails the base rules.
    Windows of three words are compared by 64-bit hash.
    """
    source = docs.select(*carry, F.coalesce(F.col(text), F.lit("")).alias("_text"))
    body = F.col("_text")
    counted = source.select(
        *carry,
        let(
            words_of(body),
            lambda w: F.struct(
                F.size(w).cast("long").alias("n_words"), _repeated_words(w).alias("n_repeat_words")
            ),
        ).alias("_w"),
        F.length(F.translate(body, SPACES, "")).cast("long").alias("word_chars"),
        _count(body, SYMBOLS).alias("n_symbols"),
        let(
            F.filter(F.split(body, "\n"), lambda x: F.length(F.translate(x, SPACES, "")) > 0),
            lambda lines: F.struct(
                F.size(lines).cast("long").alias("n"),
                (F.size(lines) - F.size(F.array_distinct(lines))).cast("long").alias("again"),
            ),
        ).alias("_l"),
        _count(body, "ABCDEFGHIJKLMNOPQRSTUVWXYZ").alias("_upper"),
        _count(body, "0123456789").alias("_digits"),
        _count(body, "!?").alias("_marks"),
    ).select(
        *carry, F.col("_w.n_words").alias("n_words"), "word_chars", "n_symbols",
        F.col("_l.again").alias("n_dup_lines"), F.col("_w.n_repeat_words").alias("n_repeat_words"),
        F.col("_l.n").alias("_lines"), "_upper", "_digits", "_marks",
    )
    failed = (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))

    def share(part: str, whole: str) -> Column:
        return F.floor(1000 * F.col(part) / F.greatest(F.col(whole), F.lit(1))).cast("long")

    return counted.select(
        *carry, "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        failed.alias("base_failed"),
        share("n_symbols", "n_words").alias("symbols_per_word"),
        share("n_dup_lines", "_lines").alias("dup_line_share"),
        share("n_repeat_words", "n_words").alias("repeat_share"),
        share("_upper", "word_chars").alias("upper_share"),
        share("_digits", "word_chars").alias("digit_share"),
        share("_marks", "word_chars").alias("mark_share"),
        share("word_chars", "n_words").alias("mean_word"),
    )


@dataclass(frozen=True)
class Condition:
    """``statistic > threshold``, or ``<=`` where ``above`` is false."""

    statistic: str
    above: bool
    threshold: int

    def column(self) -> Column:
        value = F.col(self.statistic)
        return value > self.threshold if self.above else value <= self.threshold


@dataclass(frozen=True)
class Rule:
    """A conjunction that rejects the rows it covers."""

    conditions: tuple[Condition, ...]

    def column(self) -> Column:
        out = F.lit(True)
        for condition in self.conditions:
            out = out & condition.column()
        return out


@dataclass(frozen=True)
class DecisionList:
    """Rules in order; the first that covers a row decides, and the rest are kept."""

    rules: tuple[Rule, ...] = field(default=())

    def rule_number(self) -> Column:
        """Number of the deciding rule from 1, or 0 if none covers the row."""
        chain = None
        for number, rule in enumerate(self.rules, 1):
            chain = (F.when if chain is None else chain.when)(rule.column(), F.lit(number))
        return F.lit(0) if chain is None else chain.otherwise(F.lit(0))


def _thresholds(rows: DataFrame, bins: int) -> dict[str, list[int]]:
    """Cut points per statistic: quantiles of the bad rows and of the good rows."""
    steps = [i / bins for i in range(bins + 1)]
    found = rows.groupBy("_bad").agg(
        *(F.percentile_approx(s, steps, 10_000).alias(s) for s in STATISTICS)
    )
    cuts: dict[str, set[int]] = {s: set() for s in STATISTICS}
    for row in found.collect():  # two rows
        for s in STATISTICS:
            cuts[s] |= set(row[s])
    return {s: sorted(v) for s, v in cuts.items()}


def _tallies(rows: DataFrame, cuts: dict[str, list[int]]) -> dict[str, list[tuple[int, int]]]:
    """Per statistic, (bad, good) rows in each interval between cuts; one job, bounded output."""

    def interval(s: str) -> Column:
        return F.size(F.filter(F.array(*map(F.lit, cuts[s])), lambda c: c < F.col(s)))

    melted = rows.select(
        "_bad",
        F.explode(
            F.array(*(F.struct(F.lit(s).alias("s"), interval(s).alias("i")) for s in STATISTICS))
        ).alias("x"),
    )
    out = {s: [(0, 0)] * (len(cuts[s]) + 1) for s in STATISTICS}
    counts = melted.groupBy("x.s", "x.i").agg(
        F.count_if("_bad").alias("bad"), F.count_if(~F.col("_bad")).alias("good")
    )
    for s, i, bad, good in counts.collect():  # at most one row per interval
        out[s][i] = (bad, good)
    return out


def _best(tallies, cuts, barred, score) -> tuple[float, Condition | None, int, int]:
    best: tuple[float, Condition | None, int, int] = (float("-inf"), None, 0, 0)
    for s in STATISTICS:
        bad = good = 0
        total_bad = sum(b for b, _ in tallies[s])
        total_good = sum(g for _, g in tallies[s])
        for i, cut in enumerate(cuts[s]):
            bad, good = bad + tallies[s][i][0], good + tallies[s][i][1]
            for above, b, g in ((True, total_bad - bad, total_good - good), (False, bad, good)):
                if (s, above) not in barred and (value := score(b, g)) > best[0]:
                    best = (value, Condition(s, above, cut), b, g)
    return best


def _covered(rows: DataFrame, rule: Rule) -> tuple[int, int]:
    row = rows.filter(rule.column()).agg(F.count_if("_bad"), F.count_if(~F.col("_bad"))).first()
    return row[0], row[1]


def learn(
    labelled: DataFrame,
    label: str = "quality",
    *,
    max_rules: int = 8,
    max_conditions: int = 3,
    bins: int = 24,
    precision: float = 0.995,
    min_cover: int = 3,
) -> DecisionList:
    """Learn rules that reject rows whose label is 0.

    ``labelled`` has :data:`STATISTICS` and the label; rows without a label are
    left out. Growing adds the condition of highest information gain until the
    rule covers bad rows only; pruning on the other third of the rows drops the
    last conditions while precision there does not fall. Rows that a rule
    covers leave before the next rule is grown. A rule that is less precise
    than ``precision``, or covers fewer than ``min_cover`` bad rows, is thrown
    away, and no later rule may begin with its first test. No labels or only
    one kind give an empty list.
    """
    import math

    rows = labelled.filter(F.col(label).isin(0, 1)).select(
        *STATISTICS,
        (F.col(label) == 0).alias("_bad"),
        (F.pmod(F.xxhash64(*STATISTICS), F.lit(3)) == 0).alias("_prune"),
    )
    rows = materialize(rows, "labelled")
    cuts = _thresholds(rows, bins)
    rules: list[Rule] = []
    barred: set[tuple[str, bool]] = set()  # tests that no rule may begin with
    left = rows
    while len(rules) < max_rules:
        grow, prune = left.filter(~F.col("_prune")), left.filter("_prune")
        conditions: list[Condition] = []
        bad = good = None
        while len(conditions) < max_conditions:
            tallies = _tallies(grow.filter(Rule(tuple(conditions)).column()), cuts)
            if bad is None:
                bad = sum(b for b, _ in tallies[STATISTICS[0]])
                good = sum(g for _, g in tallies[STATISTICS[0]])
            if bad < min_cover or good == 0:
                break
            before = math.log2(bad / (bad + good))
            gain = lambda b, g: b * (math.log2(b / (b + g)) - before) if b else float("-inf")  # noqa: B023, E731
            value, condition, b, g = _best(
                tallies, cuts, set() if conditions else barred, gain
            )
            if condition is None or value <= 0:
                break
            conditions.append(condition)
            bad, good = b, g
        if not conditions:
            break
        measured = [
            (_covered(prune, Rule(tuple(conditions[:n]))), n) for n in range(1, len(conditions) + 1)
        ]
        worth = lambda x: (x[0][0] - x[0][1]) / max(1, sum(x[0]))
        best = max(measured, key=lambda x: (worth(x), -x[1]))
        rule = Rule(tuple(conditions[: best[1]]))
        (hit, miss), (grown, wrong) = best[0], _covered(grow, rule)
        if hit + grown < min_cover or hit + grown < precision * (hit + miss + grown + wrong):
            barred.add((conditions[0].statistic, conditions[0].above))
            continue
        rules.append(rule)
        left = left.filter(~rule.column())
    return DecisionList(tuple(rules))


def apply_rules(stats: DataFrame, rules: DecisionList) -> DataFrame:
    """Add ``rule`` (deciding rule, 0 if none) and ``kept``."""
    number = rules.rule_number()
    return stats.withColumn("rule", number.cast("int")).withColumn(
        "kept", ~F.col("base_failed") & (F.col("rule") == 0)
    )


def quality_rules(docs: DataFrame, labels: DataFrame, carry: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """Statistics, deciding rule and verdict of every row of ``docs``.

    ``docs`` has doc_id and text, ``labels`` doc_id and quality (0 or 1). Texts
    are measured once and stored. Null or repeated ids only matter for
    learning: a null id has no label, and a repeated one counts for each row
    that has it; several labels of one id count as its smallest. Every input
    row gives one output row.
    """
    stats = materialize(statistics(docs, carry=carry), "statistics")
    known = labels.filter(F.col("doc_id").isNotNull() & F.col("quality").isin(0, 1))
    known = known.groupBy("doc_id").agg(F.min("quality").alias("_label"))
    labelled = stats.select("doc_id", *STATISTICS).join(known, "doc_id")
    return apply_rules(stats, learn(labelled, "_label"))


def keep_good(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The rows of ``docs`` that :func:`quality_rules` keeps, with all their columns.

    Texts are measured once. Statistics are stored without the rows, which are
    read again without those rejected; where ids repeat or are null, they are
    stored together with the rows.
    """
    ids = docs.groupBy(F.col("doc_id").alias("id")).count()
    if not ids.filter("count > 1 OR id IS NULL").isEmpty():
        found = quality_rules(docs.select(whole_row(docs), "doc_id", "text"), labels, carry=("row", "doc_id"))
        kept = found.filter("kept")
    else:
        found = quality_rules(docs.select("doc_id", "text"), labels)
        rejected = ~F.coalesce("kept", F.lit(False))
        gone = materialize(found.filter(rejected).select(F.col("doc_id").alias("id")), "rejected")
        discard(found)  # the statistics
        marked = possibly(docs.select(F.col("doc_id").alias("id"), whole_row(docs)), F.col("id"), bitmap(gone, "id"))
        kept = marked.filter(~F.col("_possible")).select("row").union(
            marked.filter("_possible").join(gone, "id", "left_anti").select("row")
        )
    return kept.select(*(F.col("row").getField(c).alias(c) for c in docs.columns))

"""Quality rules: a decision list learned by sequential covering, emitted as an ordered Spark CASE expression.

A rule is a conjunction of threshold conditions on text statistics that says "low quality". Rules are
grown on two thirds of the labelled rows by FOIL gain, pruned on the other third to the prefix with the
best (p - n) / (p + n), and the rows they cover leave before the next rule. Every step is one grouping
by (statistic, bin) on the cluster; the driver sees statistics x bins counts, never rows.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from casefile.llm.common import staged
from casefile.llm.text_stats import STATS, text_stats

#: What rules may ask about, as SQL over the statistics.
FEATURES = {
    "mean_word": "word_chars / greatest(n_words, 1)",
    "symbol_rate": "n_symbols / greatest(n_words, 1)",
    "dup_line_share": "n_dup_lines / greatest(n_lines, 1)",
    "repeat_share": "n_repeat_words / greatest(n_words, 1)",
    "upper_share": "n_upper / greatest(word_chars, 1)",
    "mark_rate": "n_marks / greatest(n_words, 1)",
    "digit_share": "n_digits / greatest(word_chars, 1)",
    "words": "CAST(n_words AS DOUBLE)",
}


@dataclass(frozen=True)
class Condition:
    feature: str
    above: bool
    threshold: float

    def column(self) -> Column:
        value = F.expr(FEATURES[self.feature])
        return value > self.threshold if self.above else value <= self.threshold

    def __str__(self) -> str:
        return f"{self.feature} {'>' if self.above else '<='} {self.threshold:.6g}"


@dataclass(frozen=True)
class DecisionList:
    rules: tuple[tuple[Condition, ...], ...]

    def verdict(self) -> Column:
        """Number of the first rule that holds, from 1; 0 where none does."""
        chain = None
        for number, rule in enumerate(self.rules, 1):
            holds = conjunction(rule)
            chain = F.when(holds, number) if chain is None else chain.when(holds, number)
        return F.lit(0) if chain is None else chain.otherwise(0)

    def __str__(self) -> str:
        return "\n".join(f"{i}. {' and '.join(map(str, rule))} -> low" for i, rule in enumerate(self.rules, 1))


def conjunction(rule) -> Column:
    holds = F.lit(True)
    for condition in rule:
        holds = holds & condition.column()
    return holds


def base_failed() -> Column:
    return (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))


def _gain(p: int, n: int, p0: int, n0: int) -> float:
    if not p:
        return 0.0
    return p * (math.log2(p / (p + n)) - math.log2(p0 / (p0 + n0)))


def _best(counts, cuts: dict[str, list[float]], p0: int, n0: int) -> tuple[float, Condition | None]:
    """The condition of highest gain, from the rows (feature, bin, low, count) that the rule so far covers."""
    table: dict[str, list[list[int]]] = {name: [[0, 0] for _ in range(len(cuts[name]) + 1)] for name in cuts}
    for row in counts:
        table[row["feature"]][row["bin"]][row["low"]] += row["n"]
    best: tuple[float, Condition | None] = (0.0, None)
    for name, bins in table.items():
        p = n = 0
        for edge, (negative, positive) in zip(cuts[name], bins, strict=False):  # rows up to the edge
            p, n = p + positive, n + negative
            for above, (a, b) in ((False, (p, n)), (True, (p0 - p, n0 - n))):
                gain = _gain(a, b, p0, n0)
                if gain > best[0] + 1e-9:
                    best = gain, Condition(name, above, edge)
    return best


def learn(
    labelled: DataFrame,
    max_rules: int = 8,
    max_conditions: int = 3,
    n_cuts: int = 32,
    least: int = 5,
    precision: float = 0.9,
) -> DecisionList:
    """Learn from rows (STATS..., doc_id, low 0/1), which should be staged: each step reads them once.

    Cut points are `n_cuts` approximate quantiles of each statistic. A rule is accepted if it is right on
    `precision` of the rows it covers among those held back for pruning, and covers `least` rows there.
    No labelled row, or none of low quality, gives an empty list.
    """
    quantiles = [(i + 1) / (n_cuts + 1) for i in range(n_cuts)] + [0.995, 0.999]
    asked = [F.percentile_approx(F.expr(sql), quantiles, 10_000).alias(name) for name, sql in FEATURES.items()]
    edges = labelled.agg(*asked).first()
    cuts = {name: sorted(set(edges[name] or [])) for name in FEATURES}

    def bin_of(name: str) -> Column:
        value = F.expr(FEATURES[name])
        return sum((F.when(value > edge, 1).otherwise(0) for edge in cuts[name]), F.lit(0))

    held = F.pmod(F.xxhash64("doc_id", F.lit("prune")), F.lit(3)) == 0
    pairs = F.explode(F.array(*(F.struct(F.lit(name).alias("feature"), bin_of(name).alias("bin")) for name in FEATURES)))
    binned = labelled.withColumn("held", F.coalesce(held, F.lit(False)))
    rules: list[tuple[Condition, ...]] = []
    while len(rules) < max_rules:
        left = binned.where(F.coalesce(DecisionList(tuple(rules)).verdict(), F.lit(0)) == 0)
        rule: tuple[Condition, ...] = ()
        while len(rule) < max_conditions:
            covered = left.where(~F.col("held")).where(conjunction(rule))
            counts = (
                covered.select("low", pairs.alias("x"))
                .groupBy("x.feature", "x.bin", "low")
                .agg(F.count(F.lit(1)).alias("n"))
                .collect()
            )
            one = next(iter(FEATURES))
            p0 = sum(r["n"] for r in counts if r["low"] and r["feature"] == one)
            n0 = sum(r["n"] for r in counts if not r["low"] and r["feature"] == one)
            if p0 < least or not n0:
                break
            gain, condition = _best(counts, cuts, p0, n0)
            if condition is None or condition in rule:
                break
            rule += (condition,)
        if not rule:
            break
        prefixes = [conjunction(rule[: k + 1]) for k in range(len(rule))]
        low = F.col("low") == 1
        tried = left.where("held").agg(
            *(F.count_if(holds & low).alias(f"p{k}") for k, holds in enumerate(prefixes)),
            *(F.count_if(holds & ~low).alias(f"n{k}") for k, holds in enumerate(prefixes)),
        ).first()
        scored = [(tried[f"p{k}"], tried[f"n{k}"], k) for k in range(len(rule))]
        p, n, k = max(scored, key=lambda x: ((x[0] - x[1]) / max(x[0] + x[1], 1), x[0], -x[2]))
        if p < least or p < precision * (p + n):
            break
        rules.append(rule[: k + 1])
    return DecisionList(tuple(rules))


def quality_verdicts(documents: DataFrame, labels: DataFrame, fit_rows: int = 200_000, **learning) -> DataFrame:
    """doc_id, STATS, base_failed, rule, kept of every document.

    The statistics are written once to the shared folder; learning and verdicts read them there. Labels
    with a null id or quality are not used, several labels of a document count as the lowest; a document
    that occurs in several rows is used in each. The fit takes all labelled rows up to about `fit_rows`
    and beyond that a sample by a hash of the id. Null texts have no words and fail the base; an empty
    table gives no rows; a table without labels learns no rule. Other columns are not read.
    """
    stats = staged(text_stats(documents), "text-stats")
    known = labels.where("doc_id IS NOT NULL AND quality IS NOT NULL").groupBy("doc_id")
    known = known.agg((F.min("quality") == 0).cast("int").alias("low"))
    share = fit_rows / max(known.count(), fit_rows)
    sample = F.pmod(F.xxhash64("doc_id", F.lit("fit")), F.lit(1_000_000)) < F.lit(math.ceil(share * 1_000_000))
    labelled = staged(stats.join(known.where(sample), "doc_id"), "labelled-stats")
    learned = learn(labelled, **learning)
    rule = learned.verdict()
    judged = stats.select("doc_id", *STATS, base_failed().alias("base_failed"), rule.cast("int").alias("rule"))
    return judged.withColumn("kept", ~F.col("base_failed") & (F.col("rule") == 0))

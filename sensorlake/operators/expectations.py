"""Named data-quality rules: drop failing rows or only count them.

A rule is ``(name, boolean Column)``; a rule that evaluates to NULL fails. A row's
failures are one bit mask (bit i: rule i + 1), and all counts come from the histogram
of the masks: one scan and one small aggregate give the failures of each rule, the
rows that fail any, and those that fail several at once. ``observe_rules`` collects the same counts as a
side effect of whatever action writes the data, with no extra scan.
"""

from __future__ import annotations

from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F


def passes(rule: Column) -> Column:
    return F.coalesce(rule, F.lit(False))


def expect_all_or_drop(df: DataFrame, rules: list[tuple[str, Column]]) -> DataFrame:
    """Keep the rows for which every rule is true."""
    return df.filter(reduce(and_, [passes(r) for _, r in rules]))


def failing_rows(df: DataFrame, rules: list[tuple[str, Column]]) -> DataFrame:
    """The rows that ``expect_all_or_drop`` drops, with the names of the rules each fails."""
    names = F.array_compact(F.array(*[F.when(~passes(r), F.lit(n)) for n, r in rules]))
    return df.withColumn("failed_rules", F.array_join(names, "; ")).filter(F.col("failed_rules") != "")


def failure_mask(rules: list[tuple[str, Column]]) -> Column:
    """Bit i is set where rule i + 1 fails (63 rules at most); 0 passes all."""
    if len(rules) > 63:
        raise ValueError("a mask has room for 63 rules")
    return reduce(lambda a, b: a.bitwiseOR(b), [F.when(passes(r), F.lit(0)).otherwise(F.lit(1 << i)).cast("long")
                                                for i, (_, r) in enumerate(rules)])


def mask_histogram(masks: DataFrame, column: str = "mask") -> DataFrame:
    """(mask, records): as many rows as there are combinations of failures."""
    return masks.groupBy(F.col(column).alias("mask")).agg(F.count(F.lit(1)).alias("records"))


def _bit(i: int) -> Column:
    return F.col("mask").bitwiseAND(F.lit(1 << i)) != 0


def failure_masks(histogram: DataFrame, rules: list[tuple[str, Column]]) -> DataFrame:
    """The histogram with the names of the rules that fail together."""
    names = F.array_compact(F.array(*[F.when(_bit(i), F.lit(n)) for i, (n, _) in enumerate(rules)]))
    return histogram.select("mask", F.array_join(names, "; ").alias("failed_rules"),
                            F.bit_count("mask").cast("int").alias("rules_failed"), "records")


def rule_overlaps(histogram: DataFrame, rules: list[tuple[str, Column]]) -> DataFrame:
    """For each two rules, the rows that fail the first, the second, and both."""
    pairs = [(i, j) for i in range(len(rules)) for j in range(i + 1, len(rules))]

    def records(*bits: int) -> Column:
        return F.coalesce(F.sum(F.when(reduce(and_, [_bit(b) for b in bits]), F.col("records"))), F.lit(0))

    one = histogram.agg(*[records(i).alias(f"_f{i}") for i in range(len(rules))],
                        *[records(i, j).alias(f"_o{i}_{j}") for i, j in pairs])
    return one.select(F.inline(F.array(*[F.struct(
        F.lit(rules[i][0]).alias("rule_a"), F.lit(rules[j][0]).alias("rule_b"), F.col(f"_f{i}").alias("failed_a"),
        F.col(f"_f{j}").alias("failed_b"), F.col(f"_o{i}_{j}").alias("failed_both")) for i, j in pairs])))


def expectation_metrics(df: DataFrame, rules: list[tuple[str, Column]], dataset: str,
                        action: str = "drop") -> DataFrame:
    """One row per rule: (dataset, action, rule_index, rule, input_records,
    failed_records). ``dropped_records`` (rows failing any rule) rides along."""
    return mask_metrics(mask_histogram(df.select(failure_mask(rules).alias("mask"))), rules, dataset, action)


def mask_metrics(histogram: DataFrame, rules: list[tuple[str, Column]], dataset: str, action: str = "drop") -> DataFrame:
    """``expectation_metrics`` from a histogram of masks."""
    def records(cond: Column) -> Column:
        return F.coalesce(F.sum(F.when(cond, F.col("records"))), F.lit(0))

    agg = histogram.agg(records(F.lit(True)).alias("_n"), records(F.col("mask") != 0).alias("_any"),
                        *[records(_bit(i)).alias(f"_f{i}") for i in range(len(rules))])
    rows = F.array(*[F.struct(F.lit(i + 1).alias("rule_index"), F.lit(name).alias("rule"),
                              F.col(f"_f{i}").alias("failed_records"))
                     for i, (name, _) in enumerate(rules)])
    return agg.select(
        F.lit(dataset).alias("dataset"), F.lit(action).alias("action"),
        F.col("_n").alias("input_records"),
        (F.col("_any") if action == "drop" else F.lit(0).cast("long")).alias("dropped_records"),
        F.inline(rows))


def observe_rules(df: DataFrame, rules: list[tuple[str, Column]], name: str):
    """Attach rule failure counters to ``df``; read them from the returned
    ``Observation`` after the first action on the returned DataFrame."""
    obs = Observation(name)
    aggs = [F.count(F.lit(1)).alias("input_records")]
    aggs += [F.count_if(~passes(r)).alias(n) for n, r in rules]
    return df.observe(obs, *aggs), obs

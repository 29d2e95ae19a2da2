"""Coverage of sources per record and per entity.

Distinct counts under many masks are computed in two partial-aggregated
levels (per entity, then global) instead of one ``count(DISTINCT)`` per mask,
which Spark would expand into one copy of the data per mask.
"""

from __future__ import annotations

import itertools
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _per_entity(df: DataFrame, entity: str, present: Mapping[str, Column], current: Column) -> DataFrame:
    aggs = [F.count(F.lit(1)).alias("_records"),
            F.bool_or(F.coalesce(current, F.lit(False))).alias("_current")]
    for name, cond in present.items():
        aggs.append(F.count_if(F.coalesce(cond, F.lit(False))).alias(f"_rec_{name}"))
    return df.groupBy(entity).agg(*aggs)


def coverage_matrix(df: DataFrame, entity: str, present: Mapping[str, Column], current: Column) -> DataFrame:
    """For each source, records and entities having it, overall and for
    entities flagged current (all their records), with percentages."""
    per = _per_entity(df, entity, present, current)
    cur = F.col("_current")
    aggs = [F.sum("_records").alias("total_records"), F.count(F.lit(1)).alias("total_entities"),
            F.sum(F.when(cur, F.col("_records")).otherwise(0)).alias("cur_records"),
            F.count_if(cur).alias("cur_entities")]
    for name in present:
        r = F.col(f"_rec_{name}")
        aggs += [F.sum(r).alias(f"{name}__records"), F.count_if(r > 0).alias(f"{name}__entities"),
                 F.sum(F.when(cur, r).otherwise(0)).alias(f"{name}__cur_records"),
                 F.count_if(cur & (r > 0)).alias(f"{name}__cur_entities")]
    tot = per.agg(*aggs)
    rows = [F.struct(F.lit(n).alias("source"),
                     F.col(f"{n}__records").alias("records"), F.col(f"{n}__entities").alias("entities"),
                     F.col(f"{n}__cur_records").alias("current_records"),
                     F.col(f"{n}__cur_entities").alias("current_entities")) for n in present]
    long = tot.select("total_records", "total_entities", "cur_records", "cur_entities",
                      F.inline(F.array(*rows)))

    def pct(a, b):
        return F.coalesce(F.try_divide(F.col(a) * F.lit(100.0), F.col(b)), F.lit(0.0))

    return long.select(
        "source", F.col("records").cast("bigint").alias("records"),
        pct("records", "total_records").alias("records_pct"),
        F.col("entities").cast("bigint").alias("entities"), pct("entities", "total_entities").alias("entities_pct"),
        F.col("current_records").cast("bigint").alias("current_records"),
        pct("current_records", "cur_records").alias("current_records_pct"),
        F.col("current_entities").cast("bigint").alias("current_entities"),
        pct("current_entities", "cur_entities").alias("current_entities_pct"))


def combinations(event: str | None, others: Sequence[str]) -> list[tuple[str, list[str]]]:
    """Event + every non-empty subset of ``others`` (or every subset when no event)."""
    out = []
    for k in range(1, len(others) + 1):
        for combo in itertools.combinations(others, k):
            cols = ([event] if event else []) + list(combo)
            out.append((" + ".join(cols), cols))
    return out


def coverage_subsets(df: DataFrame, entity: str, present: Mapping[str, Column],
                     combos: Sequence[tuple[str, Sequence[str]]], current: Column | None = None) -> DataFrame:
    """Entities having, in one record, every source of each combination.

    Each record gets a bitmask of its sources; per entity the set of distinct
    masks (at most 2^k values) is kept; a combination is present for the
    entity when one mask covers it.  Bounded state, partial aggregation.
    """
    names = list(present)
    bit = {n: 1 << i for i, n in enumerate(names)}
    mask = F.lit(0)
    for n, cond in present.items():
        mask = mask + F.when(F.coalesce(cond, F.lit(False)), F.lit(bit[n])).otherwise(F.lit(0))
    cur = F.coalesce(current, F.lit(False)) if current is not None else F.lit(False)
    per = df.groupBy(entity).agg(F.collect_set(mask).alias("_masks"), F.bool_or(cur).alias("_cur"))
    def covers(need: int):
        return lambda m: m.bitwiseAND(F.lit(need)) == F.lit(need)

    aggs = []
    for i, (label, cols) in enumerate(combos):
        has = F.exists("_masks", covers(sum(bit[c] for c in cols)))
        aggs += [F.count_if(has).alias(f"c{i}_all"), F.count_if(has & F.col("_cur")).alias(f"c{i}_cur")]
    tot = per.agg(*aggs)
    rows = [F.struct(F.lit(i).alias("combo_id"), F.lit(label).alias("combination"),
                     F.lit(len(cols)).alias("n_sources"),
                     F.col(f"c{i}_all").alias("entities"), F.col(f"c{i}_cur").alias("current_entities"))
            for i, (label, cols) in enumerate(combos)]
    return tot.select(F.inline(F.array(*rows)))

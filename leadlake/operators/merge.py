"""Set-based upserts: one full outer join of a snapshot with a batch, and one rule per column.

Write the result as a new snapshot folder; a rerun of the same batch gives the same snapshot.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

OVERWRITE = "overwrite"      # the batch wins, also with NULL
COALESCE = "coalesce"        # the batch wins where it has a value
KEEP = "keep"                # the stored row wins, also with NULL; the batch fills new rows
FILL = "fill"                # the stored value wins where it has one
RULES = (OVERWRITE, COALESCE, KEEP, FILL)


def reduce_batch(updates: DataFrame, keys: Sequence[str], order: Sequence[str], rules: Mapping[str, str]) -> DataFrame:
    """One row per key, as if the batch rows had been applied one after another in `order`.

    Plain max_by/min_by aggregates: combined per task before the shuffle, so a hot key sends one row per task.
    """
    position = F.struct(*order)
    by_rule: dict[str, list[str]] = {rule: [] for rule in RULES}
    for name, rule in rules.items():
        by_rule[rule].append(name)
    aggregates: list[Column] = []
    if by_rule[OVERWRITE]:
        aggregates.append(F.max_by(F.struct(*by_rule[OVERWRITE]), position).alias("_last"))
    if by_rule[KEEP]:
        aggregates.append(F.min_by(F.struct(*by_rule[KEEP]), position).alias("_first"))
    for name in by_rule[COALESCE]:
        aggregates.append(F.max_by(name, F.when(F.col(name).isNotNull(), position)).alias(name))
    for name in by_rule[FILL]:
        aggregates.append(F.min_by(name, F.when(F.col(name).isNotNull(), position)).alias(name))
    reduced = updates.groupBy(*keys).agg(*aggregates)
    return reduced.select(*keys, *[
        F.col(f"_last.{name}") if rule == OVERWRITE else F.col(f"_first.{name}") if rule == KEEP else F.col(name)
        for name, rule in rules.items()
    ])


def merge(current: DataFrame, updates: DataFrame, keys: Sequence[str], rules: Mapping[str, str],
          order: Sequence[str] | None = None, defaults: Mapping[str, Column] | None = None,
          derived: Mapping[str, Column] | None = None) -> DataFrame:
    """Upsert `updates` into `current`.

    `rules` names the columns the batch may set; every other stored column is kept. Give `order` unless the batch already
    has one row per key. `defaults` fill columns of new rows that the batch does not set. NULL keys are not stored.
    """
    defaults = dict(defaults or {})
    known = updates.where(~F.greatest(*[F.col(k).isNull() for k in keys], F.lit(False)))
    batch = reduce_batch(known, keys, order, rules) if order else known.select(*keys, *rules)
    if derived:
        batch, rules = batch.withColumns(dict(derived)), {**rules, **dict.fromkeys(derived, OVERWRITE)}
    old = current.alias("old").withColumn("_stored", F.lit(True))
    new = batch.alias("new").withColumn("_sent", F.lit(True))
    joined = old.join(new, [F.col(f"old.{k}") == F.col(f"new.{k}") for k in keys], "full_outer")
    stored, sent = F.col("_stored").isNotNull(), F.col("_sent").isNotNull()
    columns = list(current.columns) + [name for name in rules if name not in current.columns]

    def value(name: str) -> Column:
        if name in keys:
            return F.coalesce(F.col(f"old.{name}"), F.col(f"new.{name}"))
        had = F.col(f"old.{name}") if name in current.columns else F.lit(None)
        if name not in rules:
            return F.when(stored, had).otherwise(defaults[name]) if name in defaults else had
        got = F.col(f"new.{name}")
        return {
            OVERWRITE: lambda: F.when(sent, got).otherwise(had),
            COALESCE: lambda: F.coalesce(got, had),
            KEEP: lambda: F.when(stored, had).otherwise(got),
            FILL: lambda: F.coalesce(had, got),
        }[rules[name]]()

    return joined.select(*[value(name).alias(name) for name in columns])


def update_columns(current: DataFrame, updates: DataFrame, keys: Sequence[str], columns: Sequence[str]) -> DataFrame:
    """Replace only the columns a stage owns, on rows it reports; rows it does not report are untouched."""
    new = updates.select(*[F.col(k).alias(f"_key_{k}") for k in keys],
                         *[F.col(c).alias(f"_new_{c}") for c in columns], F.lit(True).alias("_sent"))
    joined = current.join(new, [F.col(k) == F.col(f"_key_{k}") for k in keys], "left")
    return joined.select(*[
        F.when(F.col("_sent"), F.col(f"_new_{name}")).otherwise(F.col(name)).alias(name) if name in columns
        else F.col(name) for name in current.columns
    ])

"""Mix sources to target weights by iterative proportional fitting.

Token counts are summed into cells of source, language and topic.  The cells'
weights are raked to the target share of every source, language and topic in turn
until they fit, and each cell gets the probability with which its documents are
sampled, so that the expected tokens of the sample follow the fitted weights and
meet the budget.  A probability cannot pass 1: cells that are too scarce are kept
whole, and the others of the same source, language and topic make up for them.
"""

from __future__ import annotations

import warnings
from collections.abc import Callable, Mapping
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cdclake.session import materialized

DIMENSIONS = ("source", "lang", "topic")
#: Target shares are the observed ones to this power: below 1 raises what is rare.
TEMPER = {"source": 0.5, "lang": 0.7, "topic": 0.8}
#: Sweeps between two looks at the marginals, and in all.
SWEEPS = 8
MOST_SWEEPS = 400
#: Raking ends when no marginal is further from its target than this share of it.
TOLERANCE = 1e-4
KEEP = 0.5

#: Topics by tell-tale strings, the first that occurs; ``prose`` where none does.
TOPICS = (("legal", ("icense", "opyright")), ("secret", ("token =", "AKIA", "PRIVATE KEY")), ("contact", ("@",)), ("table", (" | ",)))


def topic_of(text: Column, topics: tuple = TOPICS) -> Column:
    """The topic of a text; null texts are ``prose``."""
    found = F.lit("prose")
    for name, marks in reversed(topics):
        hit = F.lit(False)
        for mark in marks:
            hit = hit | F.coalesce(F.contains(text, F.lit(mark)), F.lit(False))
        found = F.when(hit, F.lit(name)).otherwise(found)
    return found


def tokens_of(text: Column) -> Column:
    """Words of a text plus one for its end, so that no document weighs nothing."""
    return F.coalesce(F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("long") + 1


def chance_of(id_col: Column) -> Column:
    """A number in [0, 1) that depends on the id alone; null ids share one."""
    mark = F.coalesce(id_col.cast("string"), F.lit(""))
    return F.conv(F.substring(F.md5(mark), 1, 8), 16, 10).cast("double") / F.lit(float(2**32))


def rake(
    cells: DataFrame,
    temper: Mapping[str, float] = TEMPER,
    sweeps: int = SWEEPS,
    targets: Mapping[str, Mapping[str, float]] | None = None,
) -> DataFrame:
    """``cells`` (dimensions and ``tokens``) with ``weight``, the fitted share of tokens.

    A dimension in ``targets`` has the given shares (others get 0), the rest are
    tempered.  Null is a category like any other.  After every ``sweeps`` sweeps the
    marginals are looked at; raking goes on until they fit, and warns where they
    no longer come nearer, as with targets that contradict each other.
    """
    cells, goals = _with_goals(cells, temper, targets)
    return _fitted(cells, goals, _scaled, F.col("weight"), sweeps).drop(*goals.values())


def _scalar(rows: DataFrame, value: Column) -> float:
    return float(rows.agg(value).first()[0] or 0)


def _joined(cells: DataFrame, by_value: DataFrame, dim: str) -> DataFrame:
    """``cells`` with the columns that ``by_value`` has for their value of ``dim``; null is a value."""
    renamed = by_value.withColumnRenamed(dim, "__value")
    return cells.join(renamed, F.col(dim).eqNullSafe(F.col("__value")), "left").drop("__value")


def _with_goals(cells: DataFrame, temper: Mapping, targets: Mapping | None) -> tuple[DataFrame, dict[str, str]]:
    """``cells`` with ``weight``, their share of tokens, and for each dimension the column of its value's target share.

    No window spans all cells: totals are aggregates.
    """
    total = _scalar(cells, F.sum("tokens")) or 1.0
    goals = {dim: f"__{dim}" for dim in temper}
    out = cells.withColumn("weight", F.col("tokens") / F.lit(total))
    for dim, goal in goals.items():
        if targets and dim in targets:
            share = F.lit(0.0)
            for value, wanted in targets[dim].items():
                share = F.when(F.col(dim) == value, F.lit(float(wanted))).otherwise(share)
            out = out.withColumn(goal, share)
        else:
            powers = cells.groupBy(dim).agg(F.pow(F.sum("tokens").cast("double"), F.lit(temper[dim])).alias(goal))
            powers = materialized(powers, "powers")
            out = _joined(out, powers.withColumn(goal, F.col(goal) / F.lit(_scalar(powers, F.sum(goal)) or 1.0)), dim)
    return materialized(out, "goals"), goals


def _scaled(cells: DataFrame, dim: str, goal: str) -> DataFrame:
    """``cells`` with the weights of each value of ``dim`` scaled to its goal."""
    # A window per value of the dimension: joining sums back would read the sweeps before twice, each.
    now = F.sum("weight").over(Window.partitionBy(dim))
    return cells.withColumn("weight", F.when(now > 0, F.col("weight") * F.col(goal) / now).otherwise(F.lit(0.0)))


def _filled(cells: DataFrame, dim: str, goal: str) -> DataFrame:
    """``cells`` with ``__free`` scaled so that for each value of ``dim`` what is taken, at most ``__cap`` of a
    cell, comes to its goal, or to all caps if these are less."""
    group = Window.partitionBy(dim)
    ratio = F.col("__free") / F.col("__cap")
    upto = group.orderBy(ratio)  # the rows below their caps; rows of equal ratio count together
    capped = F.sum("__cap").over(group) - F.sum("__cap").over(upto)
    cells = cells.withColumn("__f", F.try_divide(F.col(goal) - capped, F.sum("__free").over(upto)))
    fits = F.max(F.when(F.col("__f") * ratio <= 1 + 1e-12, F.col("__f"))).over(group)
    most = F.max(F.when(ratio > 0, 1 / ratio)).over(group)
    factor = F.greatest(F.lit(0.0), F.coalesce(fits, most, F.lit(0.0)))
    return cells.withColumn("__f", factor).withColumn("__free", F.col("__free") * F.col("__f")).drop("__f")


def _fitted(cells: DataFrame, goals: dict[str, str], scale: Callable, weight: Column, sweeps: int) -> DataFrame:
    """``cells`` after as many sweeps of ``scale`` as the marginals of ``weight`` need to be the goals.

    Where a look finds the error no smaller than the one before, the targets contradict
    each other; slow raking still comes nearer each time and goes on, to ``MOST_SWEEPS``.
    """
    before, done = None, 0
    while True:
        for _ in range(sweeps):
            for dim, goal in goals.items():
                cells = scale(cells, dim, goal)
        done += sweeps
        cells = materialized(cells, "swept")
        off = [
            cells.groupBy(dim).agg(F.sum(weight).alias("now"), F.max(goal).alias("goal")).filter("goal > 0")
            .agg(F.max(F.abs(F.col("now") / F.col("goal") - 1)).alias("off"))
            for dim, goal in goals.items()
        ]
        error = reduce(DataFrame.union, off).agg(F.max("off")).first()[0]
        if error is None or error <= TOLERANCE:
            return cells
        if before is not None and error > before * (1 - 1e-4):
            warnings.warn(f"raking: a marginal stays off its target by {error:.2%}; the targets contradict each other", stacklevel=3)
            return cells
        if done >= MOST_SWEEPS:
            warnings.warn(f"raking: after {done} sweeps a marginal is still {error:.2e} off its target, and coming nearer", stacklevel=3)
            return cells
        before = error


def bounded(
    cells: DataFrame,
    keep: float = KEEP,
    temper: Mapping[str, float] = TEMPER,
    sweeps: int = SWEEPS,
    targets: Mapping[str, Mapping[str, float]] | None = None,
) -> DataFrame:
    """Raked cells with ``probability``, so that the expected tokens have the target marginals.

    A cell's expected share of the budget is at most its cap, all of its tokens.  A
    target above the caps of its cells is out of reach: these are kept whole, a
    warning says so, and the dimension's other targets rise in proportion.  Raking
    with the caps solves every marginal in turn, until all fit.
    """
    fitted = cells.withColumnRenamed("weight", "__weight")
    cells, goals = _with_goals(fitted, temper, targets)
    live = reduce(lambda a, b: a & b, [F.col(goal) > 0 for goal in goals.values()])
    budget = float(keep) * (_scalar(cells, F.sum("tokens")) or 1.0)
    cells = cells.withColumn("__cap", F.col("tokens") / F.lit(budget)).withColumn("__free", F.when(live, F.col("weight")).otherwise(F.lit(0.0)))
    for dim, goal in goals.items():
        cells = _joined(cells.drop(goal), _reachable(cells, dim, goal), dim).fillna(0.0, [goal])
    cells = _fitted(materialized(cells, "reachable"), goals, _filled, F.least("__free", "__cap"), sweeps)
    probability = F.least("__free", "__cap") / F.col("__cap")
    return cells.select(*fitted.drop("__weight").columns, F.col("__weight").alias("weight"), probability.alias("probability"))


def _reachable(cells: DataFrame, dim: str, goal: str) -> DataFrame:
    """``dim`` and ``goal``: the target shares, cut to what the values' cells can give, the others raised to make up for it."""
    most = F.sum(F.when(F.col("__free") > 0, F.col("__cap")).otherwise(F.lit(0.0)))
    shares = cells.groupBy(dim).agg(F.max(goal).alias("wanted"), most.alias("most")).filter("most > 0 AND wanted > 0")
    shares = materialized(shares, f"targets-{dim}")
    everything = min(1.0, _scalar(shares, F.sum("most")))
    factor, whole = 1.0, None
    while True:  # values that come to their most stay there, so each round finds more of them or ends
        full = F.col("wanted") * F.lit(factor) >= F.col("most")
        r = shares.agg(F.count_if(full), F.sum(F.when(full, F.col("most"))), F.sum(F.when(~full, F.col("wanted")))).first()
        if r[0] == whole or not r[2]:
            break
        whole, factor = r[0], max(factor, (everything - (r[1] or 0.0)) / r[2])
    for r in shares.filter("most < wanted * 0.999999").orderBy("most").limit(10).collect():
        warnings.warn(f"mixing: {dim} {r[0]} can have {r['most']:.4f} of the sample at most, not {r['wanted']:.4f}", stacklevel=4)
    return shares.select(dim, F.least("most", F.col("wanted") * F.lit(factor)).alias(goal))


def mix(
    docs: DataFrame,
    keep: float = KEEP,
    temper: Mapping[str, float] = TEMPER,
    sweeps: int = SWEEPS,
    targets: Mapping[str, Mapping[str, float]] | None = None,
) -> DataFrame:
    """``docs`` with ``topic``, ``tokens``, ``weight``, ``probability`` and ``sampled``.

    Columns of these names are replaced; ``doc_id``, ``text``, ``source`` and
    ``lang`` are read and may be null.  Repeated ids share their chance, so that
    equal rows are sampled together.  An empty table gives no rows.

    The table of cells holds one row per combination that occurs; Spark broadcasts
    it only if its files are below ``spark.sql.autoBroadcastJoinThreshold`` and
    otherwise joins by sorting, where adaptive execution splits a hot cell.
    """
    docs = docs.drop("topic", "tokens", "weight", "probability", "sampled").withColumns(
        {"topic": topic_of(F.col("text")), "tokens": tokens_of(F.col("text"))}
    )
    cells = docs.groupBy(*DIMENSIONS).agg(F.sum("tokens").alias("tokens"))
    # The sums are kept before they are raked: every sweep reads them again.
    cells = rake(materialized(cells, "cells"), temper, sweeps, targets)
    cells = materialized(bounded(cells, keep, temper, sweeps, targets), "raked")
    cells = cells.select(*(F.col(d).alias(f"__{d}") for d in DIMENSIONS), "weight", "probability")
    same = [F.col(d).eqNullSafe(F.col(f"__{d}")) for d in DIMENSIONS]
    return (
        docs.join(cells, same[0] & same[1] & same[2])
        .drop(*(f"__{d}" for d in DIMENSIONS))
        .withColumn("sampled", chance_of(F.col("doc_id")) < F.col("probability"))
    )


def sample(docs: DataFrame, **options) -> DataFrame:
    """The rows of ``docs``, unchanged, that :func:`mix` samples; takes its options."""
    packed = docs.select("doc_id", "text", "source", "lang", F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("__document"))
    return mix(packed, **options).filter("sampled").select("__document.*")

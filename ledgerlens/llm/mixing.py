"""Mixing sources to target weights by iterative proportional fitting.

Documents fall into cells of source, language and topic. The cells' token shares are scaled to each marginal's targets in
turn until all three agree; a cell's documents are then drawn with one probability. Only cells are fitted:
their number is that of the combinations seen, never of documents. Totals are partial sums before each shuffle, so a
source, language or topic with a third of all rows is summed where it lies. Built-in expressions throughout.

Defined results: a null source or language is a value of its own, written ``(none)``; a null text has no tokens and belongs to the topic
``prose``; documents without tokens are never drawn; the decision is a hash of the id, so equal rows share it, and rows that share an id but not a text
are drawn by the same number against the rate of each one's own cell; an empty table gives an empty result; further columns are ignored by :func:`plan` and
kept by :func:`sample`. Where targets are not met, as the rounds ended or they cannot hold together, a warning says so, and :func:`unmet` lists the values off their targets. Topics are
told by ``TOPICS``, three plain patterns, unless the caller gives a column of its own.
"""

from __future__ import annotations

import warnings
from collections.abc import Callable, Mapping
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerlens.llm.text import WORD, given
from ledgerlens.session import materialize

MARGINS = ("source", "lang", "topic")
#: The first pattern a text fits names its topic.
TOPICS = (
    ("legal", r"[Ll]icen[cs]e|[Cc]opyright|[Ww]arranty"),
    ("contact", r"[A-Za-z0-9]@[A-Za-z0-9]"),
    ("table", r" \| "),
)
OTHER_TOPIC = "prose"
#: Without given targets a value's weight is its token share to this power: below 1, rare values gain.
TEMPER = {"source": 0.5, "lang": 0.7, "topic": 0.8}
#: Tokens wanted, as a share of all.
FRACTION = 0.5
ROUNDS = 20
ENOUGH = 1e-10
#: The fit of a draw that repeats no row goes on to this change of a share.
BOUNDED_ROUNDS = 200
BOUNDED_ENOUGH = 1e-7
#: Rounds of one job, and cells of one of its tasks.
CHUNK = 5
TASK = 100_000
SEED = 42

Targets = Mapping[str, Mapping[str, float]]


class UnmetTargets(UserWarning):
    """Some value's part of the fitted mix is not its target."""


def topic(text: Column) -> Column:
    out = F.lit(OTHER_TOPIC)
    for name, pattern in reversed(TOPICS):
        out = F.when(given(text).rlike(pattern), F.lit(name)).otherwise(out)
    return out


def drawn(doc_id: Column, seed: int = SEED) -> Column:
    """Number in [0, 1) that depends on the id and the seed alone."""
    told = F.md5(F.concat(F.lit(f"{seed}|"), F.coalesce(doc_id.cast("string"), F.lit(""))))
    return F.conv(F.substring(told, 1, 8), 16, 10).cast("double") / 2.0**32


def _cell(docs: DataFrame, text: str, topics: Column | None) -> list[Column]:
    named = lambda c: F.coalesce(docs[c].cast("string"), F.lit("(none)")).alias(c)
    told = topic(docs[text]) if topics is None else F.coalesce(topics.cast("string"), F.lit("(none)"))
    return [named("source"), named("lang"), told.alias("topic")]


def measured(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", topics: Column | None = None) -> DataFrame:
    """Id, cell and tokens of each document, written once: the fit and the draw both read it."""
    return materialize(docs.select(
        docs[doc_id].alias("doc_id"), *_cell(docs, text, topics), F.regexp_count(given(docs[text]), F.lit(WORD)).cast("long").alias("tokens"),
    ), "mixing")


def _goals(cells: DataFrame, targets: Targets | None) -> tuple[DataFrame, float, int]:
    """Cells with ``goal_<margin>``, the target share of their value of each marginal, the tokens of all cells and their number.

    A value not named in ``targets`` keeps its token share. Each marginal's values are joined once; later steps are windows over the cells.
    """
    tokens, count = cells.agg(F.sum("tokens"), F.count("*")).first()
    total = float(tokens or 1)
    for m in MARGINS:
        shares = cells.groupBy(m).agg((F.sum("tokens") / F.lit(total)).alias("_share"))
        told = (targets or {}).get(m)
        if told is None:
            weighed = shares.select(m, F.pow("_share", F.lit(TEMPER[m])).alias("_weight"))
        else:
            table = cells.sparkSession.createDataFrame([(k, float(v)) for k, v in told.items()], f"{m} string, _told double")
            weighed = shares.join(table, m, "left").select(m, F.coalesce("_told", "_share").alias("_weight"))
        whole = float(weighed.agg(F.sum("_weight")).first()[0] or 1)
        cells = cells.join(weighed.select(m, (F.col("_weight") / F.lit(whole)).alias(f"goal_{m}")), m)
    return cells, total, count


def _fit(cells: DataFrame, step: Callable[[DataFrame, str], DataFrame], value: Column, rounds: int, enough: float) -> DataFrame:
    """Rounds of ``step`` over all marginals until ``value``, kept as ``share``, changes by less than ``enough``.

    Several rounds are one job, written once. The number of tasks follows the number of cells, so that few cells are scaled in place, without a shuffle.
    """
    cells = cells.withColumn("share", value)
    tasks = max(1, -(-cells.count() // TASK))
    for done in range(0, rounds, CHUNK):
        cells = cells.coalesce(tasks)
        for _ in range(min(CHUNK, rounds - done)):
            cells = cells.withColumn("_was", value)
            for m in MARGINS:
                cells = step(cells, m)
        cells = materialize(cells.withColumn("share", value), "cells")
        change = cells.agg(F.max(F.abs(F.col("share") - F.col("_was")))).first()[0]
        if change is None or change < enough:
            break
    missed = unmet(cells).agg(F.count("*"), F.max(F.abs(F.col("target") - F.col("share")))).first()
    if missed[0]:
        warnings.warn(f"{missed[0]} targets of the mix are not met, by a share of up to {missed[1]:.2g}; see mixing.unmet", UnmetTargets, stacklevel=3)
    return cells.drop("_was")


def rake(cells: DataFrame, targets: Targets | None = None, rounds: int = ROUNDS, enough: float = ENOUGH) -> DataFrame:
    """Cells with ``share``, their part of the mix: sums over each marginal meet its targets, which stand beside it as ``goal_<margin>``."""
    cells, _, _ = _goals(cells.where("tokens > 0"), targets)
    cells = materialize(cells.withColumn("share", F.col("tokens").cast("double")), "cells")

    def step(cells: DataFrame, m: str) -> DataFrame:
        return cells.withColumn("share", F.col("share") * F.col(f"goal_{m}") / F.sum("share").over(Window.partitionBy(m)))

    return _fit(cells, step, F.col("share"), rounds, enough)


def _reachable(cells: DataFrame, m: str) -> DataFrame:
    """``goal_<m>``, none above what the value's cells hold: what a value is short of goes to the others by their targets.

    The share of a value is the smaller of ``scale * goal`` and what it holds; the scale, one number, is solved for by one small aggregate a round,
    which ends as no further value is full.
    """
    goal = F.col(f"goal_{m}")
    values = materialize(cells.groupBy(m, goal).agg(F.sum("most").alias("_held")), "targets")
    held = float(values.agg(F.sum("_held")).first()[0] or 0.0)
    scale, whole = 1.0, min(1.0, held)
    while True:
        full = F.lit(scale) * goal >= F.col("_held")
        taken, rest = values.agg(F.sum(F.when(full, F.col("_held"))), F.sum(F.when(~full, goal))).first()
        better = (whole - (taken or 0.0)) / rest if rest else scale
        if better <= scale * (1 + BOUNDED_ENOUGH):
            break
        scale = better
    return cells.drop(f"goal_{m}").join(values.select(m, F.least(F.lit(scale) * goal, F.col("_held")).alias(f"goal_{m}")), m)


def rake_bounded(cells: DataFrame, targets: Targets | None = None, fraction: float = FRACTION, rounds: int = BOUNDED_ROUNDS) -> DataFrame:
    """As :func:`rake`, with no cell wanted more often than it exists: a full cell stays full while the rest is scaled to the targets.

    ``_free`` is a cell's product of factors, its share the smaller of that and ``most``. Each step solves a value's sum
    for its factor, by the cells that are not full (Newton); where no cell is full this is the plain step.
    """
    cells, total, _ = _goals(cells.where("tokens > 0"), targets)
    own = F.col("tokens").cast("double") / F.lit(total)
    cells = cells.withColumns({"most": own / F.lit(fraction), "_free": own})
    if fraction >= 1:
        return cells.withColumn("share", F.col("most")).drop("_free", "most")
    cells = materialize(cells, "cells")
    for m in MARGINS:
        cells = _reachable(cells, m)
    cells = materialize(cells, "cells")
    full = F.col("_free") >= F.col("most")

    def step(cells: DataFrame, m: str) -> DataFrame:
        value, goal = Window.partitionBy(m), F.col(f"goal_{m}")
        cells = cells.withColumns({
            "_full": F.sum(F.when(full, F.col("most")).otherwise(0.0)).over(value), "_rest": F.sum(F.when(full, 0.0).otherwise(F.col("_free"))).over(value),
        })
        held, rest = F.col("_full"), F.col("_rest")
        # A value whose cells are all full and meet the target is left as it is.
        ratio = (
            F.when((rest <= 0) & (goal >= held * (1 - BOUNDED_ENOUGH)), 1.0).when(goal <= held, goal / (held + rest))
            .when(rest > 0, (goal - held) / rest).otherwise(1.0)
        )
        return cells.withColumn("_free", F.col("_free") * ratio).drop("_full", "_rest")

    return _fit(cells, step, F.least("_free", "most"), rounds, BOUNDED_ENOUGH).drop("_free", "most")


def unmet(fitted: DataFrame, tolerance: float = 1e-6) -> DataFrame:
    """``margin, value, target, share`` of every value whose part of a fitted mix differs from its target by more than ``tolerance``.

    Of a bounded fit the targets
    are those that can be reached at all.
    """
    out = [
        fitted.groupBy(F.lit(m).alias("margin"), F.col(m).alias("value")).agg(F.max(f"goal_{m}").alias("target"), F.sum("share").alias("share"))
        for m in MARGINS
    ]
    return reduce(DataFrame.unionByName, out).where(F.abs(F.col("target") - F.col("share")) > tolerance)


def rates(docs_cells: DataFrame, targets: Targets | None, fraction: float, bounded: bool) -> DataFrame:
    """How often the tokens of each cell are wanted: ``source, lang, topic, rate``."""
    fitted = rake_bounded(docs_cells, targets, fraction) if bounded else rake(docs_cells, targets)
    total = fitted.agg(F.sum("tokens")).first()[0] or 1
    return fitted.select(*MARGINS, (F.col("share") * F.lit(float(total)) * fraction / F.col("tokens")).alias("rate"))


def plan(
    docs: DataFrame, targets: Targets | None = None, fraction: float = FRACTION, seed: int = SEED,
    doc_id: str = "doc_id", text: str = "text", bounded: bool = False, topics: Column | None = None,
) -> DataFrame:
    """One row per document: its cell, tokens, probability, weight and whether it is drawn.

    ``rate`` is how often a cell's tokens are wanted. A document is drawn with ``probability``, the rate up to 1, and counts
    ``weight`` times where the rate is above 1; so drawn tokens times weight meet the targets in expectation. With ``bounded``
    no rate is above 1, and drawn tokens alone meet them.
    """
    rows = measured(docs, doc_id, text, topics)
    cells = rows.groupBy(*MARGINS).agg(F.sum("tokens").alias("tokens"))
    out = rows.join(rates(cells, targets, fraction, bounded), list(MARGINS), "left")
    out = out.withColumn("rate", F.when(F.col("tokens") > 0, F.coalesce("rate", F.lit(0.0))).otherwise(0.0))
    chance = F.least(F.col("rate"), F.lit(1.0))
    return out.select(
        "doc_id", *MARGINS, "tokens", chance.alias("probability"), F.greatest(F.col("rate"), F.lit(1.0)).alias("weight"),
        (drawn(F.col("doc_id"), seed) < chance).alias("sampled"),
    )


def sample(
    docs: DataFrame, targets: Targets | None = None, fraction: float = FRACTION, seed: int = SEED, doc_id: str = "doc_id", text: str = "text",
    topics: Column | None = None,
) -> DataFrame:
    """The drawn rows of ``docs``, unchanged. They carry no weight, so the fit is bounded: none is wanted more than once.

    Each row is judged where it lies, by its own cell; only the cells' rates are joined.
    """
    rows = measured(docs, doc_id, text, topics)
    cells = rows.groupBy(*MARGINS).agg(F.sum("tokens").alias("tokens"))
    known = rates(cells, targets, fraction, True)
    full = docs.select(F.struct(*[docs[c] for c in docs.columns]).alias("_row"), *_cell(docs, text, topics)).where(given(F.col(f"_row.`{text}`")).rlike(WORD))
    return full.join(known, list(MARGINS)).where(drawn(F.col(f"_row.`{doc_id}`"), seed) < F.col("rate")).select("_row.*")

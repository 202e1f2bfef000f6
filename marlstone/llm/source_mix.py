"""Mixing sources to target weights by subset-sum budget fitting.

Each source's target follows from its weight. The budget is fitted from the counts of its
documents by exact length, each document counted as often as it may be taken. Of each length a
share in proportion goes in, and bounded-knapsack dynamic programming over the counts that are
left closes the gap to the budget. Then the documents of each length are selected by
a seeded order. The fit sees one row per (source, length); documents are ranked within
(source, length) without gathering one in a task.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import SPACE, materialise, salted_rank, text_or_empty


#: Up to so many sources their targets go to every task; beyond, they are joined by a shuffle.
MOST_BROADCAST = 20_000


def share_targets(sizes: list[tuple[str | None, int]], weights: tuple[float, ...] = (3, 1, 2), total_share: float = 1.5, most: float = 2.0) -> dict[str | None, float]:
    """Target words of each source.

    Sources take the weights in turn, by code point, null last. Together they share
    ``total_share`` of all sizes by weight; a target stops at ``most`` times its source's size
    and the excess is shared anew by weight among the others until none is above.
    """
    order = sorted(sizes, key=lambda s: (s[0] is None, (s[0] or "").encode("utf-32-be")))
    weight = {s: float(weights[i % len(weights)]) for i, (s, _) in enumerate(order)}
    size = dict(order)
    left, whole, target = total_share * sum(size.values()), sum(weight.values()), {}
    # words a unit of weight rise as full sources leave, so the smallest caps fill first, each once
    for s in sorted(size, key=lambda s: most * size[s] / weight[s]):
        if left * weight[s] / whole > most * size[s]:
            target[s] = float(most * size[s])
            left, whole = left - target[s], whole - weight[s]
        else:
            target[s] = left * weight[s] / whole
    return target


def fit_counts(lengths: np.ndarray, counts: np.ndarray, budget: int, window: int = 20_000, widest: int = 1_280_000) -> np.ndarray:
    """How many documents of each length to take so that their words come as near ``budget`` as fits.

    Fitted within ``window`` first. Where the sum then misses the budget by more than the common
    divisor of the lengths explains, as with documents longer than the window, the fit is tried
    in windows four times as wide, up to ``widest``, and the nearest sum stays. Budgets up to
    half of ``widest`` are thus fitted exactly.
    """
    lengths, counts = lengths.astype(np.int64), np.where(lengths > 0, counts, 0).astype(np.int64)
    total = int((lengths * counts).sum())
    budget = max(0, min(budget, total))
    if budget in (0, total):
        return counts if budget else np.zeros_like(counts)
    step = int(np.gcd.reduce(lengths[counts > 0]))
    least = min(budget % step, step - budget % step)  # no sum is nearer
    best, miss = None, None
    while True:
        taken = _fit_within(lengths, counts, budget, total, window)
        off = abs(int((lengths * taken).sum()) - budget)
        if best is None or off < miss:
            best, miss = taken, off
        if miss == least or window >= min(widest, 2 * budget):
            return best
        window = min(4 * window, max(window, widest))


def _fit_within(lengths: np.ndarray, counts: np.ndarray, budget: int, total: int, window: int) -> np.ndarray:
    """A share in proportion first, up to ``window / 2`` words short of the budget; then the
    longest that still fit, until at most ``window`` words are open; then dynamic programming
    over the counts left, which finds the reachable sum nearest to the gap. Budgets up to
    ``window / 2`` are fitted by dynamic programming alone. A wider gap stays open only where all
    documents left are longer than it; then the shortest of them goes in if that is nearer.
    """
    bulk = max(0, budget - window // 2)
    taken = np.array([int(c) * bulk // total for c in counts], np.int64)  # Python integers: no overflow
    gap = budget - int((lengths * taken).sum())
    order = np.argsort(-lengths, kind="stable")
    for i in order:
        if gap <= window:
            break
        if lengths[i]:
            n = min(int(counts[i] - taken[i]), -(-(gap - window) // int(lengths[i])), gap // int(lengths[i]))
            taken[i] += n
            gap -= n * int(lengths[i])
    items = [(int(lengths[i]), int(counts[i] - taken[i]), i) for i in order[::-1] if lengths[i] > 0 and counts[i] > taken[i]]
    if gap > window:
        if items and items[0][0] < 2 * gap:
            taken[items[0][2]] += 1
        return taken
    # sums beyond the gap count too; one of twice the gap is no nearer than none
    goal = min(2 * gap, gap + max((n for n, _, _ in items), default=0))
    came = np.full(goal + 1, -2, np.int32)  # the item by which a sum was first reached; -2 never, -1 start
    came[0] = -1
    for k, (n, have, _) in enumerate(items):
        if n > goal:
            break
        # sums of one remainder by n in a column: those up to ``have`` rows below a reached one
        rows = goal // n + 1
        held = np.zeros(rows * n, bool)
        held[: goal + 1] = came != -2
        held = held.reshape(rows, n)
        place = np.arange(rows, dtype=np.int32)[:, None]
        last = np.maximum.accumulate(np.where(held, place, np.int32(-goal - 2)), axis=0)
        fresh = ~held & (place - last <= min(have, goal))
        came[fresh.reshape(-1)[: goal + 1]] = k
        if came[gap] != -2:
            break
    reached = np.flatnonzero(came != -2)
    v = int(reached[np.abs(reached - gap).argmin()])
    while v > 0:
        n, _, i = items[came[v]]
        taken[i] += 1
        v -= n
    return taken


def mix_sources(docs: DataFrame, weights: tuple[float, ...] = (3, 1, 2), total_share: float = 1.5, most: int = 2, seed: int = 0) -> DataFrame:
    """One row per document: doc_id, row_key, size, source, source_size, target, taken.

    ``size``: words of the text (0 for null). ``taken``: words the mix takes of the document,
    0 to ``most`` times its size; copies of one length are spread evenly over its documents.
    Null sources are a source of their own. Repeated rows are documents of their own; among equal
    rows, and among rows of one length without an id, it does not matter which is taken. Extra
    columns are ignored; an empty table gives an empty result.
    """
    size = F.regexp_count(text_or_empty(F.col("text")), F.lit("[^" + SPACE[1:] + "+")).cast("long")
    rows = materialise(docs.select("doc_id", "source", size.alias("size"), _row_key(F.col("doc_id"), F.col("text")).alias("row_key"), F.monotonically_increasing_id().alias("row_no")), "mix-rows")
    lengths = rows.groupBy("source", "size").agg(F.count("*").alias("n"))
    totals = lengths.groupBy("source").agg(F.sum(F.col("size") * F.col("n")).alias("source_size"))
    spark = docs.sparkSession
    # one row per source; sources are a catalogue of named origins, as their weights by name presume
    found = [(r.source, r.source_size) for r in totals.collect()]
    target = share_targets(found, weights, total_share, most)
    sources = spark.createDataFrame([(s, n, target[s]) for s, n in found], "source string, source_size long, target double").withColumnRenamed("source", "_s")
    if len(found) <= MOST_BROADCAST:
        sources = F.broadcast(sources)

    def fitted(part: pd.DataFrame) -> pd.DataFrame:
        part = part.sort_values("size")
        copies = fit_counts(part["size"].to_numpy(), most * part.n.to_numpy(), int(round(part.target.iloc[0])))
        return part[["source", "size", "n"]].assign(copies=copies)

    fit_in = lengths.join(sources, F.col("source").eqNullSafe(F.col("_s"))).select("source", "size", "n", "target")
    fit = fit_in.groupBy("source").applyInPandas(lambda part: fitted(part), "source string, size long, n long, copies long")
    fit = materialise(fit.withColumnsRenamed({"source": "_fs", "size": "_fn"}), "mix-fit")

    # rows without an id may all be alike: their number keeps them from meeting in one slot
    alike = F.when(F.col("doc_id").isNull(), F.col("row_no"))
    order = rows.withColumn("_h", F.xxhash64(F.lit(seed), "doc_id", "row_key", alike))
    ranked = salted_rank(order, ["source", "size"], "_h", ["doc_id", "row_key", "row_no"], slot_bits=8)
    joined = ranked.join(sources, F.col("source").eqNullSafe(F.col("_s"))).join(fit, F.col("source").eqNullSafe(F.col("_fs")) & (F.col("size") == F.col("_fn")))
    times = F.expr("copies div n") + F.when(F.col("rank") < F.expr("copies % n"), 1).otherwise(0)
    return joined.select("doc_id", "row_key", "source", "size", "source_size", "target", (times * F.col("size")).alias("taken"))


def _row_key(doc_id: Column, text: Column) -> Column:
    return F.xxhash64(text, doc_id.isNull())


def repeat_mixed(docs: DataFrame, **options) -> DataFrame:
    """The documents, with all their columns, as the mix takes them: left out, once or twice.

    Documents without words (null, empty, blank) take no part of any budget and stay once.
    Repeated rows are documents of their own. Extra columns are kept, whatever their names; an
    empty table gives an empty result.
    """
    mixed = mix_sources(docs, **options)
    times = F.when(F.col("size") > 0, F.col("taken") / F.col("size")).otherwise(1).cast("int")
    taken = mixed.select(F.coalesce("doc_id", F.lit(0)).alias("t_id"), F.col("row_key").alias("t_key"), times.alias("times"))
    # repeated rows: number both sides, so that each row meets one decision
    place = Window.partitionBy("t_id", "t_key").orderBy(F.desc("times"))
    taken = taken.where("times > 0").withColumn("t_place", F.row_number().over(place))
    carried = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"))
    doc_id, text = F.col("row").getField("doc_id"), F.col("row").getField("text")
    keyed = carried.select("row", F.coalesce(doc_id, F.lit(0)).alias("id"), _row_key(doc_id, text).alias("key"))
    here = Window.partitionBy("id", "key").orderBy(F.xxhash64(F.to_json("row")))
    keyed = keyed.withColumn("place", F.row_number().over(here))
    # the place is no key of the join, so that texts keep the partitioning of the window
    on = (F.col("id") == F.col("t_id")) & (F.col("key") == F.col("t_key")) & (F.col("place") - F.col("t_place") == 0)
    repeated = keyed.join(taken, on).select("row", F.explode(F.sequence(F.lit(1), F.col("times"))).alias("copy"))
    return repeated.select("row.*")

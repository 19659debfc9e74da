"""Joins that stay parallel when one key holds a large share of the rows, or of the result.

Adaptive execution splits a hot partition only on the preserved side of an outer join, and not at all in a chain of
joins that share one partitioning; and it looks at the rows that go in, not at the product that comes out.
``fan_out_left`` covers all three: keys whose rows would give more than ``chunk`` rows of output are cut into a grid. Each
input picks its own cell on its own axis and is repeated along the other axes, so every combination of rows meets in
exactly one cell. Keys below the limit stay in one cell and cost nothing extra.

Keys that may be above the limit are found from a sample of the key columns, and those alone are counted in full; only keys
that have to be split are written, with the number of cells of each input. The sample picks the layout of a join, never
its rows.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from bankflow.plans.workspace import materialize_counted

# Rows that a key may give in one task.
DEFAULT_CHUNK = 1_000_000

BASE = "base"

# Rows in the sample that an input is expected to have of a key at its share of the limit.
_SAMPLED_AT_LIMIT = 50
_SEED = 17


def key_counts(inputs: dict[str, DataFrame], key: str) -> DataFrame:
    """``key`` and ``_n_<input>``, the rows of each input: one pass over the key columns, summed up before the shuffle."""
    marked = [
        df.select(key, *(F.lit(int(name == other)).cast("long").alias(f"_n_{other}") for other in inputs))
        for name, df in inputs.items()
    ]
    united = reduce(DataFrame.unionByName, marked).filter(F.col(key).isNotNull())
    return united.groupBy(key).agg(*(F.sum(f"_n_{name}").alias(f"_n_{name}") for name in inputs))


def layout_of(counts: DataFrame, names: list[str], key: str, chunk: int) -> DataFrame | None:
    """One row per key whose product of rows is above ``chunk``, with ``_k_<input>``, the number of cells along the axis of
    that input; None if there is no such key.

    A cell takes at most the same number of rows from every input that has to be cut, and all rows of the others, so that
    their product is at most ``chunk``.
    """
    sizes = {name: F.greatest(F.col(f"_n_{name}"), F.lit(1)).cast("double") for name in names}
    crowded = counts.filter(reduce(Column.__mul__, sizes.values()) > chunk)

    def share(state: Column) -> Column:
        return F.pow(state["room"], 1 / state["open"])

    # From the smallest input on: one that is within its share is taken whole and leaves more for the others.
    start = F.struct(F.lit(float(chunk)).alias("room"), F.lit(float(len(names))).alias("open"))
    state = F.aggregate(F.array_sort(F.array(*sizes.values())), start, lambda acc, n: F.when(
        n <= share(acc), F.struct((acc["room"] / n).alias("room"), (acc["open"] - 1).alias("open"))).otherwise(acc))
    side = F.greatest(F.floor(F.when(F.col("_state.open") > 0, share(F.col("_state"))).otherwise(F.lit(chunk))), F.lit(1))
    factors, rows = materialize_counted(
        crowded.withColumn("_state", state).withColumn("_side", side)
        .select(key, *(F.ceil(size / F.col("_side")).cast("int").alias(f"_k_{name}") for name, size in sizes.items())),
        "split_factors")
    return factors if rows else None


def may_be_crowded(inputs: dict[str, DataFrame], key: str, chunk: int) -> DataFrame | None:
    """Keys whose product of rows may be above ``chunk``, by a sample of each input; None if there are none. An input takes
    part with one sampled row more than it has, so a key that the sample missed there still counts."""
    fraction = min(1.0, _SAMPLED_AT_LIMIT / chunk ** (1 / len(inputs)))
    sampled = {name: df.select(key).sample(fraction, seed=_SEED) for name, df in inputs.items()}
    guesses = [(F.col(f"_n_{name}") + 1) / F.lit(fraction) for name in inputs]
    found, rows = materialize_counted(
        key_counts(sampled, key).filter(reduce(Column.__mul__, guesses) > chunk / 2).select(key), "sampled_keys")
    return found if rows else None


def split_layout(inputs: dict[str, DataFrame], key: str, chunk: int) -> DataFrame | None:
    """``layout_of`` the rows of ``inputs``, counted for the keys that ``may_be_crowded``."""
    likely = may_be_crowded(inputs, key, chunk)
    if likely is None:
        return None
    counted = {name: df.select(key).join(likely, key, "left_semi") for name, df in inputs.items()}
    return layout_of(key_counts(counted, key), list(inputs), key, chunk)


def _cells(count: Column) -> Column:
    return F.explode(F.when(count == 1, F.array(F.lit(0))).otherwise(F.sequence(F.lit(0), count - 1)))


def _on_grid(
    df: DataFrame, own: str, axes: list[str], factors: DataFrame, key: str, spread: Column | None
) -> DataFrame:
    spread = F.xxhash64(*df.columns) if spread is None else spread
    placed = df.withColumn("_spread", spread).join(factors, key, "left")
    for axis in axes:
        count = F.coalesce(F.col(f"_k_{axis}"), F.lit(1))
        if axis == own:
            placed = placed.withColumn(f"_s_{axis}", F.pmod(F.col("_spread"), count.cast("long")).cast("int"))
        else:
            placed = placed.withColumn(f"_s_{axis}", _cells(count))
    return placed.drop("_spread")


def fan_out_left(
    base: DataFrame,
    sides: dict[str, DataFrame],
    key: str,
    factors: DataFrame | None,
    spread: Column | None = None,
) -> DataFrame:
    """Left-join every side to ``base`` on ``key``.

    ``factors`` comes from ``split_layout`` (None when no key is crowded; then this is a plain chain of left joins). A
    side without a column in ``factors`` is repeated over the grid. Rows pick their cell by a hash of the whole row,
    which suits inputs without copies; for scan-stage inputs with copies pass ``monotonically_increasing_id()``, whose
    values are the same when a lost task reads its file split again.
    """
    if factors is None:
        return reduce(lambda left, side: left.join(side, key, "left"), sides.values(), base)

    axes = [column.removeprefix("_k_") for column in factors.columns if column.startswith("_k_")]
    wanted = base.columns + [c for side in sides.values() for c in side.columns if c != key]
    on = [key] + [f"_s_{axis}" for axis in axes]
    counts = [f"_k_{axis}" for axis in axes]
    joined = _on_grid(base, BASE, axes, factors, key, spread)
    for name, side in sides.items():
        placed = _on_grid(side, name, axes, factors, key, spread).drop(*counts).withColumn("_hit", F.lit(True))
        joined = joined.join(placed, on, "left")
        if name in axes:
            # A split side has rows for this key, so a cell without any is not a missing match.
            joined = joined.filter(F.col("_hit").isNotNull() | (F.coalesce(F.col(f"_k_{name}"), F.lit(1)) == 1))
        joined = joined.drop("_hit")
    return joined.select(*wanted)


def left_join(
    base: DataFrame, side: DataFrame, key: str, chunk: int = DEFAULT_CHUNK, spread: Column | None = None
) -> DataFrame:
    """Two-way form: looks at the keys of both inputs, then joins."""
    return fan_out_left(base, {"side": side}, key, split_layout({BASE: base, "side": side}, key, chunk), spread)

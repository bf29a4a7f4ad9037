"""Ranks, running totals and exact quantiles that never put a whole group into one task.

A window ordered over one large group runs in a single task. Here a table is dealt by range into cells
of ``ROWS_PER_CELL`` rows, which the rows of a single group cannot exceed either. Totals per cell are a
small table; their running sum gives every cell its offset, and only the rows inside a cell are
ordered. Cells are written to the shared folder before anything depends on them, so a task that runs
again after a lost executor finds the same ones.
"""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from slotwise.operators.sizing import broadcast_if_small
from slotwise.session import shared_dir

ROWS_PER_CELL = 200_000
ROUNDS = 5  # of the network that permutes places


def stored(df: DataFrame) -> DataFrame:
    """A reliable checkpoint: computed once, and its lineage cut."""
    shared_dir(df.sparkSession)
    return df.checkpoint()


def running_totals(
    df: DataFrame,
    order_by: str,
    sums: Mapping[str, Column],
    keys: Sequence[str] = (),
    descending: bool = False,
    rows_per_cell: int | None = None,
    is_stored: bool = False,
) -> DataFrame:
    """Add, per key, the inclusive running sum of each expression in the order of ``order_by``.

    ``df`` must hold one row per key and ordering value (aggregate it first), without nulls in
    either. ``is_stored`` says that reading it again costs nothing.
    """
    limit = rows_per_cell or ROWS_PER_CELL
    keys = list(keys)
    order = F.col(order_by).desc() if descending else F.col(order_by).asc()
    kept = df if is_stored else stored(df)
    cells = -(-kept.count() // limit)
    if cells <= 1:
        # The whole table is one cell, and nothing comes before it.
        up_to = W.partitionBy(*keys).orderBy(order).rowsBetween(W.unboundedPreceding, W.currentRow)
        return kept.withColumns({name: F.sum(c).over(up_to) for name, c in sums.items()})
    placed = stored(kept.repartitionByRange(cells, order).withColumn("_cell", F.spark_partition_id()))
    inner = placed.groupBy(*keys, "_cell").agg(*[F.sum(c).alias(f"_in_{name}") for name, c in sums.items()])
    # A key has a row per cell here: one for each ``ROWS_PER_CELL`` rows of the table at most.
    through = W.partitionBy(*keys).orderBy("_cell").rowsBetween(W.unboundedPreceding, W.currentRow)
    reached = inner.withColumns({f"_to_{name}": F.sum(f"_in_{name}").over(through) for name in sums})
    offsets = reached.select(
        *keys, "_cell", *[(F.col(f"_to_{name}") - F.col(f"_in_{name}")).alias(f"_before_{name}") for name in sums])
    inside = W.partitionBy(*keys, "_cell").orderBy(order).rowsBetween(W.unboundedPreceding, W.currentRow)
    out = placed.join(broadcast_if_small(offsets), on=[*keys, "_cell"])
    return out.withColumns(
        {name: F.sum(c).over(inside) + F.col(f"_before_{name}") for name, c in sums.items()}
    ).drop("_cell", *[f"_before_{name}" for name in sums])


def _sides(n: int) -> tuple[int, int]:
    """Two factors of a number that is at least ``n`` and hardly larger, near its root."""
    low = max(1, math.isqrt(n))
    best = min(range(low, min(2 * low, low + 100_000) + 1), key=lambda a: (a * -(-n // a) - n, a))
    return best, -(-n // best)


def permuted_place(place: Column, n: int, *key: int) -> Column:
    """A permutation of the places 0 to n - 1, drawn by the key: computed for each place on its own.

    A Feistel network over pairs of remainders permutes the numbers below a product of two factors that
    is hardly larger than ``n``; numbers from ``n`` on are sent through again. Such a walk meets each of these
    few numbers once at most, so it ends.
    """
    a, b = _sides(n)

    def once(x: Column) -> Column:
        start = F.struct((x % a).alias("l"), F.call_function("div", x, F.lit(a)).alias("r"))

        def mix(half: Column, other: Column, side: int, turn: Column, size: int) -> Column:
            return (half + F.pmod(F.xxhash64(other, turn, *map(F.lit, (side, *key))), F.lit(size))) % size

        def turned(pair: Column, turn: Column) -> Column:
            left = mix(pair["l"], pair["r"], 0, turn, a)
            return F.struct(left.alias("l"), mix(pair["r"], left, 1, turn, b).alias("r"))

        end = F.aggregate(F.sequence(F.lit(1), F.lit(ROUNDS)), start, turned)
        return end["l"] + end["r"] * a

    spare = a * b - n
    first = once(place.cast("long"))
    if not spare:
        return first
    return F.aggregate(F.sequence(F.lit(1), F.lit(spare)), first, lambda x, _: F.when(x < n, x).otherwise(once(x)))


def stable_order(*columns: Column | str, seed: int = 42) -> Column:
    """A reproducible shuffle key: sixty bits of the MD5 of the columns as text and the seed.

    The same rows get the same order on every run, every cluster and every engine.
    """
    text = F.concat_ws("|", *[(F.col(c) if isinstance(c, str) else c).cast("string") for c in columns], F.lit(str(seed)))
    return F.conv(F.substring(F.md5(text), 1, 15), 16, 10).cast("long")


def with_rank(
    df: DataFrame,
    order_by: str,
    keys: Sequence[str] = (),
    name: str = "rank",
    rows_per_cell: int | None = None,
) -> DataFrame:
    """1-based row number of a numeric, practically unique column, over the whole table or per key."""
    return running_totals(df, order_by, {name: F.lit(1).cast("long")}, keys, rows_per_cell=rows_per_cell)


# A sketch of this accuracy misses a rank by at most N / ACCURACY; brackets are three times as wide.
ACCURACY = 10_000


def _bracketed(
    values: DataFrame, keys: Sequence[str], shares: Sequence[float], accuracy: int,
) -> tuple[DataFrame, DataFrame]:
    """Two scans of ``_v`` and no shuffle of its rows: what lies around the wanted ranks, with counts.

    The first scan builds a mergeable sketch per key and reads from it a narrow bracket around every wanted
    share. The second keeps the distinct values inside the brackets (``_c``) with their counts ``_n``,
    and per key how many rows lie below each bracket without being inside any (``_skip``). A key of up to
    ``accuracy`` rows is its own bracket. Both results hold ``_total``.
    """
    keys, n = list(keys), len(shares)
    margin = 3.0 / accuracy
    around = [x for p in shares for x in (max(p - margin, 0.0), min(p + margin, 1.0))]
    sketch = values.groupBy(*keys).agg(
        F.count("*").alias("_total"), F.percentile_approx("_v", around, accuracy).alias("_around"))
    whole = F.col("_total") <= accuracy
    # Null stands for an open end.
    bounds = [
        F.when(~whole, F.col("_around")[i]).alias(f"_{'to' if i % 2 else 'from'}{i // 2}") for i in range(2 * n)
    ]
    limits = sketch.select(*keys, "_total", *bounds)
    if keys:
        placed = values.join(broadcast_if_small(stored(limits)), on=keys)
    else:
        row = limits.first()
        placed = values.select("_v", *[
            F.lit(row[f.name]).cast(f.dataType).alias(f.name) for f in limits.schema])
    v = F.col("_v")
    under = [F.coalesce(v < F.col(f"_from{i}"), F.lit(False)) for i in range(n)]
    over = [F.coalesce(v > F.col(f"_to{i}"), F.lit(False)) for i in range(n)]
    inside = F.lit(False)
    for below, above in zip(under, over):
        inside = inside | (~below & ~above)
    kept = stored(
        placed.withColumn("_c", F.when(inside, v)).groupBy(*keys, "_c").agg(
            F.count("*").alias("_n"), F.max("_total").alias("_total"),
            *[F.count_if(below).alias(f"_below{i}") for i, below in enumerate(under)],
            *[F.max(f"_from{i}").alias(f"_from{i}") for i in range(n)],
        ))
    skipped = kept.filter(F.col("_c").isNull()).select(*keys, *[F.col(f"_below{i}").alias(f"_skip{i}") for i in range(n)])
    return kept.filter(F.col("_c").isNotNull()).drop(*[f"_below{i}" for i in range(n)]), skipped


def _ranked(
    candidates: DataFrame, skipped: DataFrame, keys: Sequence[str], n: int, rows_per_cell: int | None,
) -> DataFrame:
    """Candidates with ``_upto{i}``, the rows up to and with each of them as seen from bracket ``i``.

    Candidates come from a checkpoint already, so they are not written again.
    """
    ranked = running_totals(candidates, "_c", {"_cum": F.col("_n")}, keys, rows_per_cell=rows_per_cell, is_stored=True)
    if keys:
        ranked = ranked.join(broadcast_if_small(skipped), on=list(keys), how="left")
    else:
        row = skipped.first()
        ranked = ranked.withColumns({f"_skip{i}": F.lit(row[i] if row else 0) for i in range(n)})
    return ranked.withColumns({f"_upto{i}": F.coalesce(F.col(f"_skip{i}"), F.lit(0)) + F.col("_cum") for i in range(n)})


def exact_quantiles(
    df: DataFrame,
    column: str,
    probabilities: Sequence[float],
    names: Sequence[str],
    keys: Sequence[str] = (),
    rows_per_cell: int | None = None,
    accuracy: int = ACCURACY,
) -> DataFrame:
    """Exact quantiles with linear interpolation, one row per key (or one row).

    Exact ranks are taken among the few values around each wanted one. Should a sketch ever have
    been worse than its accuracy says, so that a rank lies outside its bracket, the query fails.
    """
    keys, ps = list(keys), [float(p) for p in probabilities]
    values = df.select(*keys, F.col(column).cast("double").alias("_v")).na.drop()
    candidates, skipped = _bracketed(values, keys, ps, accuracy)
    ranked = _ranked(candidates, skipped, keys, len(ps), rows_per_cell)
    picks = []
    for i, (p, name) in enumerate(zip(ps, names)):
        at = F.lit(p) * (F.col("_total") - 1)
        upto = F.col(f"_upto{i}")
        open_ = F.coalesce(F.col("_c") >= F.col(f"_from{i}"), F.lit(True))
        missed = F.max(F.coalesce(F.col(f"_skip{i}"), F.lit(0)) > F.floor(at))
        high = F.min(F.when(open_ & (upto > F.ceil(at)), F.col("_c")))
        picks += [
            F.min(F.when(open_ & (upto > F.floor(at)), F.col("_c"))).alias(f"_lo_{name}"),
            F.when((missed | high.isNull()) & (F.count("*") > 0), F.raise_error(F.lit(f"{name}: rank outside its bracket")))
            .otherwise(high).alias(f"_hi_{name}"),
            F.max(at - F.floor(at)).alias(f"_w_{name}"),
        ]
    found = ranked.groupBy(*keys).agg(*picks)
    return found.select(
        *keys,
        *[
            (F.col(f"_lo_{n}") + (F.col(f"_hi_{n}") - F.col(f"_lo_{n}")) * F.col(f"_w_{n}")).alias(n)
            for n in names
        ],
    )


def column_quantiles(
    df: DataFrame, columns: Sequence[str], probabilities: Sequence[float], names: Sequence[str],
) -> DataFrame:
    """Exact quantiles of several columns (``variable``) in the same two scans."""
    numbers = df.select(*[F.col(c).cast("double").alias(c) for c in columns])
    return exact_quantiles(numbers.unpivot([], list(columns), "variable", "_value"), "_value", probabilities, names, ["variable"])


def rank_limits(
    df: DataFrame, order_by: str, shares: Sequence[float], keys: Sequence[str] = (), ranks: Sequence[int] | None = None,
    rows_per_cell: int | None = None, accuracy: int = ACCURACY,
) -> DataFrame:
    """Per key, ``_limit{i}``: the value up to which the first ``round(share * rows)`` rows lie, found without a sort.

    ``_upto{i}`` is the number of rows up to the limit: fewer than wanted where equal values straddle it.
    ``ranks`` gives the wanted numbers themselves; null keys are a key like any other.
    """
    keys = list(keys)
    # A key that is null would be lost in joins.
    safe = [f"_key{i}" for i in range(len(keys))]
    values = df.select(
        *[F.struct(F.col(k).alias("k")).alias(s) for k, s in zip(keys, safe)], F.col(order_by).alias("_v"),
    ).filter(F.col("_v").isNotNull())
    candidates, skipped = _bracketed(values, safe, shares, accuracy)
    ranked = _ranked(candidates, skipped, safe, len(shares), rows_per_cell)
    cells = []
    for i, share in enumerate(shares):
        wanted = F.lit(ranks[i]) if ranks else F.round(F.lit(share) * F.col("_total"))
        open_ = F.coalesce(F.col("_c") >= F.col(f"_from{i}"), F.lit(True))
        fits = open_ & (F.col(f"_upto{i}") <= wanted)
        missed = F.max(F.coalesce(F.col(f"_skip{i}"), F.lit(0)) > wanted)
        # Where not even the first candidate fits, the limit is just below it.
        limit = F.coalesce(F.max(F.when(fits, F.col("_c"))), F.min(F.when(open_, F.col("_c"))) - 1)
        cells += [
            F.when(missed, F.raise_error(F.lit("rank outside its bracket"))).otherwise(limit).alias(f"_limit{i}"),
            F.coalesce(F.max(F.when(fits, F.col(f"_upto{i}"))), F.max(F.coalesce(F.col(f"_skip{i}"), F.lit(0)))).alias(f"_upto{i}"),
        ]
    out = ranked.groupBy(*safe).agg(*cells)
    return out.select(*[F.col(f"{s}.k").alias(k) for k, s in zip(keys, safe)], *out.columns[len(safe):])

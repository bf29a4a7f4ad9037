"""Data-quality tables: columns, distributions, outliers, duplicates, histograms, inventory facts."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from slotwise.functions import binning as B
from slotwise.functions import cleaning as C
from slotwise.operators.enrich import stack, stack_tagged
from slotwise.operators.ranking import column_quantiles, exact_quantiles
from slotwise.operators.sizing import broadcast_if_small

#: Sketches of distinct values have 2 ** SKETCH_PRECISION cells: a standard error of 0.8 %.
SKETCH_PRECISION = 14
# Columns that mark the time axis, and categorical columns worth counting.
DATE_COLUMNS = ["fecha", "dt_operacion", "fecha_cruce"]
CATEGORICAL_COLUMNS = [
    "aeropuerto_oaci", "aerolinea_dgac", "numero_vuelo", "modelo_avion",
    "tipo_operacion", "actividad_cod", "internacional_domestico",
]


def _unpivot(one_row: DataFrame, columns: Sequence[str], names: Sequence[str], key: str) -> DataFrame:
    """One row of ``column__name`` cells to one row per column."""
    cells = [
        F.struct(F.lit(c).alias(key), *[F.col(f"{c}__{n}").alias(n) for n in names]) for c in columns
    ]
    return one_row.select(F.explode(F.array(*cells)).alias("r")).select("r.*")


def column_profile(
    df: DataFrame, columns: Sequence[str] | None = None, approx: bool = False
) -> DataFrame:
    """Type, nulls, share of nulls, distinct values and an example for every column.

    Counting the distinct values of several columns together would multiply the rows by their number,
    so each column is scanned alone: still one read of the stored data in all. The example is the
    smallest value as text, which does not depend on the order of rows. With ``approx`` distinct counts
    are estimates, and the whole profile is one pass.
    """
    distinct = F.approx_count_distinct if approx else F.count_distinct
    columns = list(columns or df.columns)
    types = {f.name: f.dataType.simpleString() for f in df.schema}
    names = ["tipo", "nulos", "pct_nulos", "valores_distintos", "ejemplo"]

    def cells(c: str) -> list[Column]:
        empty = F.count("*") - F.count(c)
        return [
            F.lit(types[c]).alias(f"{c}__tipo"),
            empty.alias(f"{c}__nulos"),
            F.round(F.try_divide(empty, F.count("*")) * 100, 2).alias(f"{c}__pct_nulos"),
            distinct(c).alias(f"{c}__valores_distintos"),
            F.substring(F.min(F.col(c).cast("string")), 1, 28).alias(f"{c}__ejemplo"),
        ]

    passes = [columns] if approx else [[c] for c in columns]
    return stack([
        _unpivot(df.agg(*[x for c in some for x in cells(c)]), some, names, "columna") for some in passes
    ])


DESCRIBE_PROBS = [0.01, 0.25, 0.5, 0.75, 0.95, 0.99]
DESCRIBE_NAMES = ["p1", "p25", "p50", "p75", "p95", "p99"]


def describe(df: DataFrame, columns: Sequence[str], places: int = 2) -> DataFrame:
    """Count, mean, sample deviation, extremes and exact percentiles per numeric column.

    The moments of all columns are one pass, the percentiles of all columns two, without a shuffle of
    rows.
    """
    numbers = df.select(*[F.col(c).cast("double").alias(c) for c in columns if c in df.columns])
    columns = numbers.columns
    cells: list[Column] = []
    for c in columns:
        cells += [
            F.count(c).alias(f"{c}__n"), F.avg(c).alias(f"{c}__media"),
            F.stddev_samp(c).alias(f"{c}__desv_estandar"),
            F.min(c).alias(f"{c}__minimo"), F.max(c).alias(f"{c}__maximo"),
        ]
    moments = _unpivot(
        numbers.agg(*cells), columns, ["n", "media", "desv_estandar", "minimo", "maximo"], "variable"
    )
    quantiles = column_quantiles(numbers, columns, DESCRIBE_PROBS, DESCRIBE_NAMES)
    out = moments.join(quantiles, on="variable", how="left")
    order = ["media", "desv_estandar", "minimo", *DESCRIBE_NAMES, "maximo"]
    return out.select("variable", "n", *[F.round(c, places).alias(c) for c in order])


def _fences(df: DataFrame, column: str, factor: float) -> tuple[float, float, float, float, float] | None:
    row = exact_quantiles(df, column, [0.25, 0.5, 0.75], ["q1", "q2", "q3"]).first()
    if row is None or row["q1"] is None:
        return None
    spread = row["q3"] - row["q1"]
    return row["q1"], row["q2"], row["q3"], row["q1"] - factor * spread, row["q3"] + factor * spread


def outlier_summary(df: DataFrame, column: str, factor: float = 1.5, places: int = 2) -> DataFrame:
    """Quartiles, fences at ``factor`` times their distance, and what lies outside."""
    v = F.col(column).cast("double")
    found = _fences(df, column, factor)
    q1, _, q3, low, high = found if found else (None,) * 5
    lit = lambda x: F.round(F.lit(x).cast("double"), places)
    below, above = F.count_if(v < F.lit(low).cast("double")), F.count_if(v > F.lit(high).cast("double"))
    return df.agg(
        F.lit(column).alias("variable"),
        lit(q1).alias("q1"),
        lit(q3).alias("q3"),
        lit(q3 - q1 if found else None).alias("iqr"),
        lit(low).alias("limite_inferior"),
        lit(high).alias("limite_superior"),
        below.alias("outliers_inferiores"),
        above.alias("outliers_superiores"),
        F.round(F.try_divide(100 * (below + above), F.count(v)), 2).alias("pct_outliers"),
        F.round(F.max(v), places).alias("maximo"),
        F.round(F.min(v), places).alias("minimo"),
    )


def box_statistics(df: DataFrame, column: str, factor: float = 1.5) -> DataFrame:
    """Quartiles, whisker ends (the outermost values inside the fences) and the count of fliers."""
    v = F.col(column).cast("double")
    found = _fences(df, column, factor)
    q1, q2, q3, low, high = (F.lit(x).cast("double") for x in (found or (None,) * 5))
    return df.agg(
        F.lit(column).alias("variable"),
        q1.alias("q1"), q2.alias("mediana"), q3.alias("q3"),
        F.min(F.when(v >= low, v)).alias("bigote_inferior"),
        F.max(F.when(v <= high, v)).alias("bigote_superior"),
        F.count_if((v < low) | (v > high)).alias("atipicos"),
    )


def extreme_values(df: DataFrame, column: str, n: int = 8) -> DataFrame:
    """The ``n`` largest values, with their position."""
    values = df.select(F.col(column).cast("double").alias("valor")).na.drop()
    return values.orderBy(F.col("valor").desc()).limit(n)


def duplicate_summary(df: DataFrame, business_key: Sequence[str]) -> DataFrame:
    """Rows beyond the first among identical rows, and among rows that share the business key.

    Missing values count as equal. Whole rows are found by a 64-bit hash of all their columns: the hashes are counted
    first, and only rows whose hash occurs again are compared in full, so a table without copies shuffles hashes and no
    row, and two rows that merely share a hash are told apart. Copies merge on the map side before either shuffle, so a
    row repeated for a third of the table costs no more than any other.
    """
    hashed = df.withColumn("_hash", F.xxhash64(*[F.col(f"`{c}`") for c in df.columns]))
    again = hashed.groupBy("_hash").agg(F.count("*").alias("_n")).filter("_n > 1").select("_hash")
    suspects = hashed.join(broadcast_if_small(again), "_hash", "left_semi")

    def extra_rows(rows: DataFrame, keys: Sequence[str]) -> DataFrame:
        groups = rows.groupBy(*[F.col(f"`{c}`") for c in keys]).agg(F.count("*").alias("_n"))
        return groups.agg(F.coalesce(F.sum(F.col("_n") - 1), F.lit(0)).alias("cantidad"), F.lit(0).alias("total"))

    total = df.agg(F.lit(0).alias("cantidad"), F.count("*").alias("total"))
    found = stack_tagged({
        kind: extra.unionByName(total) for kind, extra in (
            ("filas_identicas", extra_rows(suspects, df.columns)), ("llave_de_negocio", extra_rows(df, business_key)))
    }, "tipo")
    return found.groupBy("tipo").agg(
        F.sum("cantidad").alias("cantidad"),
        F.round(F.try_divide(100 * F.sum("cantidad"), F.sum("total")), 3).alias("pct_total"),
    )


def heavy_models(
    df: DataFrame, low: float | None, high: float | None, by: Sequence[str], n: int, top: str
) -> DataFrame:
    """Operations and largest weight per model, among weights in ``(low, high]``."""
    kept = df
    if low is not None:
        kept = kept.filter(F.col("pmd") > low)
    if high is not None:
        kept = kept.filter(F.col("pmd") <= high)
    return (
        kept.na.drop(subset=list(by))
        .groupBy(*by)
        .agg(F.count("*").alias("operaciones"), F.max("pmd").alias(top))
        .orderBy(F.col("operaciones").desc(), *[F.col(c) for c in by])
        .limit(n)
    )


def disguised_zeros(df: DataFrame, column: str) -> DataFrame:
    """Zeros of a raw column; only that column is read."""
    return df.agg(F.count_if(C.to_number(column) == 0).alias("ceros"))


def imputed_share(df: DataFrame, flag: str) -> DataFrame:
    return df.agg(
        F.sum(F.col(flag).cast("long")).alias("imputados"),
        F.round(100 * F.avg(F.col(flag).cast("double")), 2).alias("pct_imputados"),
    )


def null_rates(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Percentage of nulls of the columns that have any, largest first; none for an empty table."""
    columns = list(columns or df.columns)
    one = df.agg(*[
        F.round(F.try_divide(F.count("*") - F.count(c), F.count("*")) * 100, 2).alias(c) for c in columns
    ])
    return (
        one.unpivot([], columns, "columna", "pct_nulos")
        .filter(F.col("pct_nulos") > 0)
        .orderBy(F.col("pct_nulos").desc(), "columna")
    )


def temporal_coverage(df: DataFrame, columns: Sequence[str] = tuple(DATE_COLUMNS)) -> DataFrame:
    """First and last day of every date column that holds a date."""
    present = [c for c in columns if c in df.columns]
    cells = []
    for c in present:
        day = F.col(c).try_cast("date")
        cells += [F.min(day).alias(f"{c}__desde"), F.max(day).alias(f"{c}__hasta")]
    out = _unpivot(df.agg(*cells), present, ["desde", "hasta"], "columna")
    return out.filter(F.col("desde").isNotNull())


def cardinality(df: DataFrame, columns: Sequence[str] = tuple(CATEGORICAL_COLUMNS), approx: bool = False) -> DataFrame:
    """Distinct values per column, exact unless ``approx``."""
    present = [c for c in columns if c in df.columns]
    if approx:
        one = df.agg(*[F.approx_count_distinct(c).alias(c) for c in present])
        return one.unpivot([], present, "columna", "valores_distintos")
    # One long table: distinct pairs merge on the map side, and a column is spread over its values.
    long = df.select(*[F.col(c).cast("string").alias(c) for c in present]).unpivot(
        [], present, "columna", "valor"
    )
    return long.groupBy("columna").agg(F.count_distinct("valor").alias("valores_distintos"))


def distinct_sketches(
    df: DataFrame, by: Sequence[str], columns: Sequence[str] = tuple(CATEGORICAL_COLUMNS), precision: int = SKETCH_PRECISION,
) -> DataFrame:
    """Rows, nulls and a sketch of the distinct values (``boceto``) of each column, per group of ``by``.

    Made once per group (a year, a partition) and stored; ``merged_cardinality`` reads only these few rows, so a new
    year does not rescan the years before. One pass; a sketch holds at most about 2 ** ``precision`` bytes. Values count
    as the same when their text is. A column without values has an empty sketch.
    """
    present = [c for c in columns if c in df.columns and c not in by]
    cells = [F.struct(
        F.lit(c).alias("columna"), F.count("*").alias("n"), F.count_if(F.col(c).isNull()).alias("nulos"),
        F.hll_sketch_agg(F.col(c).cast("string"), precision).alias("boceto")) for c in present]
    grouped = df.groupBy(*by).agg(F.array(*cells).alias("_cells"))
    return grouped.select(*by, F.inline("_cells"))


def merged_cardinality(sketches: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Rows, nulls and estimated distinct values of each column from stored sketches, over all groups or those of ``by``.

    The standard error is 1.04 / sqrt(2 ** precision) at most: 0.8 % as stored by default.
    """
    return sketches.groupBy(*by, "columna").agg(
        F.sum("n").alias("n"), F.sum("nulos").alias("nulos"),
        F.hll_sketch_estimate(F.hll_union_agg("boceto")).alias("valores_distintos"))


def histogram(
    df: DataFrame, value: Column, bins: int, low: float | None = None, high: float | None = None,
    by: str | None = None,
) -> DataFrame:
    """Counts and densities of equal-width bins over the whole range (per group of ``by``).

    The range is the given one or the extremes of each group; one pass finds those, the next counts. A
    range without width has one bin, whose density is null.
    """
    keys = [by] if by else []
    base = df.select(*keys, value.cast("double").alias("_v")).filter(F.col("_v").isNotNull())
    if by:
        base = base.filter(F.col(by).isNotNull())
    if low is None or high is None:
        extremes = base.groupBy(*keys).agg(F.min("_v").alias("_lo"), F.max("_v").alias("_hi"))
        if by:
            base = base.join(broadcast_if_small(extremes), on=by)
        else:
            row = extremes.first()
            base = base.withColumns({
                "_lo": F.lit(row["_lo"]).cast("double"), "_hi": F.lit(row["_hi"]).cast("double"),
            })
    else:
        base = base.withColumns({"_lo": F.lit(float(low)), "_hi": F.lit(float(high))})
    counted = (
        base.withColumn("bin", B.equal_width_bin("_v", F.col("_lo"), F.col("_hi"), bins))
        .groupBy(*keys, "bin", "_lo", "_hi")
        .agg(F.count("*").alias("n"))
    )
    total = F.sum("n").over(W.partitionBy(*keys))  # at most ``bins`` rows per group
    width = (F.col("_hi") - F.col("_lo")) / bins
    return counted.select(
        *keys, "bin", (F.col("_lo") + width * (F.col("bin") - 1)).alias("desde"), "n",
        F.try_divide(F.col("n"), total * width).alias("densidad"),
    )


def fact(category: str, key: Column | str, value: Column) -> list[Column]:
    """The three columns of a fact row, all text."""
    key = F.lit(key) if isinstance(key, str) else key
    return [F.lit(category).alias("categoria"), key.cast("string").alias("clave"), value.cast("string").alias("valor")]


def profile_facts(sample: DataFrame, name: str) -> DataFrame:
    """Rows, columns, null rates, date ranges, month range and cardinalities as fact rows."""
    category = f"archivo: {name}"
    rates = null_rates(sample)
    none = rates.agg(F.count("*").alias("n")).filter(F.col("n") == 0)
    parts = [
        sample.agg(F.count("*").alias("n")).select(*fact(category, "filas_leidas", F.col("n"))),
        sample.sparkSession.range(1).select(*fact(category, "columnas", F.lit(", ".join(sample.columns)))),
        rates.select(*fact(category, F.concat("columna", F.lit(" (% nulos)")), F.col("pct_nulos"))),
        none.select(*fact(category, "columnas con nulos", F.lit("ninguna"))),
    ]
    if any(c in sample.columns for c in DATE_COLUMNS):
        parts.append(temporal_coverage(sample).select(*fact(
            category, F.concat(F.lit("rango de "), "columna"),
            F.concat_ws(" a ", F.col("desde").cast("string"), F.col("hasta").cast("string")))))
    if "mes_id" in sample.columns:
        parts.append(sample.agg(F.min("mes_id").alias("a"), F.max("mes_id").alias("b")).select(*fact(
            category, "rango de mes_id (YYYYMM)",
            F.concat_ws(" a ", F.col("a").cast("string"), F.col("b").cast("string")))))
    if any(c in sample.columns for c in CATEGORICAL_COLUMNS):
        parts.append(cardinality(sample).select(*fact(
            category, F.concat("columna", F.lit(" (valores distintos)")), F.col("valores_distintos"))))
    return stack(parts)


def inventory_summary(files: DataFrame, profile: DataFrame) -> DataFrame:
    """Files, total size and files per format, followed by the profile facts."""
    totals = files.agg(F.count("*").alias("n"), F.sum("tamano_mb").alias("mb"))
    return stack([
        totals.select(*fact("archivos", "total_archivos", F.col("n"))),
        totals.select(*fact("archivos", "tamano_total_mb", F.when(F.col("n") == 0, "0").otherwise(
            F.format_string("%.4f", "mb")))),
        files.groupBy("formato").agg(F.count("*").alias("n")).select(
            *fact("archivos_por_formato", F.col("formato"), F.col("n"))),
        profile,
    ])

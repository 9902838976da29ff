"""Column profiles of a catalog: completeness, distinctness, shape, alerts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F, types as T

from tremorgrid.operators.ordered import ordered_counts, quantiles_of

QUANTILES = (0.05, 0.25, 0.5, 0.75, 0.95)


def _is_numeric(field: T.StructField) -> bool:
    return isinstance(field.dataType, T.NumericType)


def null_rates(df: DataFrame) -> DataFrame:
    """Percentage of missing values per column, from one aggregate."""
    rates = df.agg(*[(F.avg(F.col(c).isNull().cast("double")) * 100).alias(c) for c in df.columns])
    return rates.unpivot([], rates.columns, "column", "pct_missing")


def value_counts(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """Occurrences of each value of each column, as text. Repeated values are
    combined before the shuffle."""
    cells = [F.struct(F.lit(c).alias("column"), F.col(c).cast("string").alias("value"))
             for c in columns or df.columns]
    return df.select(F.inline(F.array(*cells))).groupBy("column", "value").agg(
        F.count(F.lit(1)).alias("n"))


def distinct_stats(df: DataFrame) -> DataFrame:
    """Rows, missing, distinct and unique values and the most frequent value per column."""
    known = F.col("value").isNotNull()
    top = F.max(F.when(known, F.struct(F.col("n").alias("n"), F.col("value").alias("value"))))
    stats = value_counts(df).groupBy("column").agg(
        F.sum("n").alias("n_rows"),
        F.coalesce(F.sum(F.when(~known, F.col("n"))), F.lit(0)).alias("n_missing"),
        F.count_if(known).alias("n_distinct"),
        F.count_if(known & (F.col("n") == 1)).alias("n_unique"),
        top.alias("top"),
    )
    return stats.select("column", "n_rows", "n_missing", "n_distinct", "n_unique",
                        F.col("top.value").alias("top_value"), F.col("top.n").alias("top_count"))


def numeric_stats(df: DataFrame) -> DataFrame:
    """Moments, extremes, zeros and negatives of the numeric columns, in one pass."""
    numeric = [f.name for f in df.schema.fields if _is_numeric(f)]

    def stats(c: str) -> Column:
        x = F.col(c).cast("double")
        return F.struct(
            F.lit(c).alias("column"), F.avg(x).alias("mean"), F.stddev_samp(x).alias("std"),
            F.min(x).alias("min"), F.max(x).alias("max"), F.skewness(x).alias("skewness"),
            F.kurtosis(x).alias("kurtosis"), F.count_if(x == 0).alias("n_zeros"),
            F.count_if(x < 0).alias("n_negative"),
        ).alias(c)

    one = df.agg(*[stats(c) for c in numeric])
    return one.select(F.inline(F.array(*[F.col(c) for c in numeric])))


def numeric_quantiles(df: DataFrame, probs: tuple[float, ...] = QUANTILES) -> DataFrame:
    """Exact quantiles of the numeric columns: (column, prob, q)."""
    cells = [F.struct(F.lit(f.name).alias("column"), F.col(f.name).cast("double").alias("value"))
             for f in df.schema.fields if _is_numeric(f)]
    long = df.select(F.inline(F.array(*cells)))
    return quantiles_of(ordered_counts(long, ["column"], "value"), ["column"], "value",
                        list(probs))


def histogram(df: DataFrame, bins: int = 10) -> DataFrame:
    """Equal-width bins of the numeric columns: (column, bin, low, high, n)."""
    numeric = [f.name for f in df.schema.fields if _is_numeric(f)]
    span = df.agg(*[F.struct(F.min(c).cast("double").alias("lo"),
                             F.max(c).cast("double").alias("hi")).alias(c) for c in numeric])
    limits = span.select(F.struct(*numeric)).scalar()
    cells = [F.struct(
        F.lit(c).alias("column"), F.col(c).cast("double").alias("value"),
        limits[c]["lo"].alias("lo"), limits[c]["hi"].alias("hi")) for c in numeric]
    width = (F.col("hi") - F.col("lo")) / bins
    place = F.coalesce(F.try_divide(F.col("value") - F.col("lo"), width), F.lit(0.0))
    return df.select(F.inline(F.array(*cells))).where(F.col("value").isNotNull()).groupBy(
        "column", F.least(F.floor(place), F.lit(bins - 1)).cast("int").alias("bin"),
        "lo", "hi",
    ).agg(F.count(F.lit(1)).alias("n")).select(
        "column", "bin", (F.col("lo") + F.col("bin") * width).alias("low"),
        (F.col("lo") + (F.col("bin") + 1) * width).alias("high"), "n")


def correlations(df: DataFrame) -> DataFrame:
    """Pearson correlation of each pair of numeric columns, in one pass."""
    numeric = [f.name for f in df.schema.fields if _is_numeric(f)]
    pairs = [(a, b) for i, a in enumerate(numeric) for b in numeric[i + 1:]]

    def shared(a: str, b: str) -> tuple[Column, Column]:
        both = F.col(a).isNotNull() & F.col(b).isNotNull()
        return F.when(both, F.col(a)).cast("double"), F.when(both, F.col(b)).cast("double")

    cells = [F.struct(F.lit(a).alias("column_a"), F.lit(b).alias("column_b"),
                      F.corr(*shared(a, b)).alias("pearson")).alias(f"p{k}")
             for k, (a, b) in enumerate(pairs)]
    one = df.agg(*cells)
    return one.select(F.inline(F.array(*[F.col(c) for c in one.columns])))


def duplicate_rows(df: DataFrame, subset: list[str] | None = None) -> DataFrame:
    """Values (of all columns or a subset) that occur more than once, with their count."""
    columns = subset or df.columns
    return df.groupBy(*columns).agg(F.count(F.lit(1)).alias("copies")).where("copies > 1")


def profile(df: DataFrame, mode: str = "minimal") -> DataFrame:
    """One row per column with all statistics and the alerts they raise.

    ``full`` adds the strongest correlation partner. The result is as small as
    the number of columns.
    """
    ranked = numeric_quantiles(df).groupBy("column").pivot("prob", list(QUANTILES)).agg(F.first("q"))
    named = ranked.withColumnsRenamed({str(p): f"p{round(p * 100)}" for p in QUANTILES})
    table = distinct_stats(df).join(numeric_stats(df), "column", "left").join(named, "column", "left")
    if mode == "full":
        table = table.join(_strongest_partner(df), "column", "left")
    return table.withColumn("alerts", _alerts(table.columns))


def _strongest_partner(df: DataFrame) -> DataFrame:
    pairs = correlations(df)
    both = pairs.unionByName(pairs.select(
        F.col("column_b").alias("column_a"), F.col("column_a").alias("column_b"), "pearson"))
    strongest = F.max(F.struct(F.abs("pearson").alias("s"), F.col("column_b").alias("other"),
                               F.col("pearson").alias("r")))
    return both.where(F.col("pearson").isNotNull()).groupBy(
        F.col("column_a").alias("column")).agg(strongest.alias("b")).select(
        "column", F.col("b.other").alias("correlated_with"), F.col("b.r").alias("pearson"))


def _alerts(columns: list[str]) -> Column:
    rows = F.col("n_rows")
    rules = {
        "constant": F.col("n_distinct") == 1,
        "unique": (F.col("n_distinct") == rows) & (rows > 1),
        "missing": F.col("n_missing") / rows >= 0.05,
        "imbalance": F.col("top_count") / rows >= 0.95,
        "zeros": F.col("n_zeros") / rows >= 0.10,
        "skewed": F.abs("skewness") > 20,
    }
    if "pearson" in columns:
        rules["high_correlation"] = F.abs("pearson") > 0.9
    flags = F.array(*[F.when(F.coalesce(rule, F.lit(False)), name) for name, rule in rules.items()])
    return F.array_compact(flags)


def duplicate_share(df: DataFrame) -> DataFrame:
    """How many rows repeat another one in full."""
    groups = df.groupBy(*df.columns).agg(F.count(F.lit(1)).alias("copies"))
    return groups.agg(F.sum("copies").alias("n_rows"),
                      F.sum(F.col("copies") - 1).alias("n_duplicates"))

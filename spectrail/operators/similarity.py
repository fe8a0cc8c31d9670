"""Spectral similarity: 71 features over three ion scopes in log2 and linear space."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from spectrail.functions.text import linear_intensity
from spectrail.operators.kernel import feature_batches, scored_batches
from spectrail.schemas import OFFSET, SCOPES, SPECTRAL_FEATURES, TOLERANCE

_ION = {"ionb": "b", "iony": "y"}


def _in(scope: str, value: Column) -> Column:
    return value if scope == "spec" else F.when(F.col("ion") == _ION[scope], value)


def _pearson(n: Column, sx: Column, sy: Column, sxx: Column, syy: Column, sxy: Column) -> Column:
    """From raw sums; 0 without variance, or if not finite."""
    var = (sxx - F.try_divide(sx * sx, n)) * (syy - F.try_divide(sy * sy, n))
    r = F.try_divide(sxy - F.try_divide(sx * sy, n), F.sqrt(F.when(var > 0, var)))
    return F.when(~F.isnan(r) & (F.abs(r) < float("inf")), r)


def _quantile(values: Column, q: float) -> Column:
    """Linear interpolation at (n - 1) q of a sorted array."""
    at = (F.size(values) - 1) * F.lit(q)
    low = F.floor(at).cast("int")
    a, b = F.get(values, low), F.get(values, F.least(low + 1, F.size(values) - 1))
    return a + (b - a) * (at - low)


def with_ranks(ions: DataFrame, keys: list[str]) -> DataFrame:
    """Average ranks of both linear values, in the whole key and in its ion type."""
    out = ions
    for value, name in (("xl", "rx"), ("yl", "ry")):
        for cols, suffix in ((keys, "spec"), ([*keys, "ion"], "ion")):
            w = Window.partitionBy(*cols).orderBy(value)
            # peers of a row are its range frame: one sort gives both rank and ties
            ties = F.count(F.lit(1)).over(w.rangeBetween(Window.currentRow, Window.currentRow))
            out = out.withColumn(f"{name}_{suffix}", F.rank().over(w) + (ties - 1) / 2.0)
    return out


def similarity(ions: DataFrame, keys: list[str], only: tuple[str, ...] | None = None) -> DataFrame:
    """The features of each key from its ions (keys, ion b or y, predicted, observed in log2).

    One shuffle by key brings its ions together, some hundreds at most; Arrow batches of keys then go through
    one vectorised kernel. Empty scopes give 0; ions without both values don't count.
    """
    wanted = only or SPECTRAL_FEATURES
    x, y = F.col("predicted").cast("double"), F.col("observed").cast("double")
    ion = F.when(x.isNotNull() & y.isNotNull(), F.struct((F.col("ion") == "b").alias("is_b"), x.alias("x"), y.alias("y")))
    held = ions.groupBy(*keys).agg(F.collect_list(ion).alias("__ions"))
    kinds = ", ".join([f"`{k}` {ions.schema[k].dataType.simpleString()}" for k in keys] + [f"`{c}` double" for c in wanted])
    return held.mapInArrow(feature_batches(keys, wanted), kinds)


def fragment_columns(fragments: str = "fragments") -> list[Column]:
    """An array of structs (ion, mz, predicted in log2) as plain arrays, which are a fifth of its size where rows are shuffled."""
    of = F.col(fragments)
    return [F.transform(of["ion"], lambda i: i == "b").alias("__f_b"), of["mz"].alias("__f_m"), of["predicted"].cast("array<double>").alias("__f_x")]


def peak_columns(peaks: str = "peaks") -> list[Column]:
    """An array of structs (mz, intensity), ascending by mz, as plain arrays."""
    return [F.col(peaks)["mz"].alias("__p_m"), F.col(peaks)["intensity"].alias("__p_i")]


def scored(rows: DataFrame, keys: list[str], tolerance: float = TOLERANCE, only: tuple[str, ...] | None = None) -> DataFrame:
    """The features of each row from its ``fragment_columns`` and its spectrum's ``peak_columns``.

    Matching and features are one pass over Arrow batches, without a shuffle: the rows are joined with both before. Fragments
    without an m/z over 0 or a prediction don't count; the others meet a peak or are observed as 0.0, also in a spectrum without
    peaks. Rows without fragments or with null arrays give 0 in all features.
    """
    wanted = only or SPECTRAL_FEATURES
    kinds = ", ".join([f"`{k}` {rows.schema[k].dataType.simpleString()}" for k in keys] + [f"`{c}` double" for c in wanted])
    held = rows.select(*keys, "__f_b", "__f_m", "__f_x", "__p_m", "__p_i")
    return held.mapInArrow(scored_batches(keys, wanted, tolerance), kinds)


def native_similarity(ions: DataFrame, keys: list[str], only: tuple[str, ...] | None = None) -> DataFrame:
    """The same by aggregates alone, for a few features and as a check on the kernel.

    One shuffle by key: ranks are windows and everything else one aggregation over it. Scopes are
    conditions inside the aggregates.
    """
    wanted = only or SPECTRAL_FEATURES
    rows = ions.select(*keys, "ion", F.col("predicted").cast("double").alias("x"), F.col("observed").cast("double").alias("y"))
    rows = rows.withColumn("xl", linear_intensity(F.col("x"), OFFSET)).withColumn("yl", linear_intensity(F.col("y"), OFFSET))
    spearman = any("spearman" in c for c in wanted)
    if spearman:
        rows = with_ranks(rows, keys)
    sums: dict[str, Column] = {}
    for scope in SCOPES:
        sums[f"n_{scope}"] = F.count(_in(scope, F.lit(1)))
        pairs = {"_norm": ("x", "y"), "": ("xl", "yl")}
        if spearman:
            pairs["_rank"] = ("rx_spec", "ry_spec") if scope == "spec" else ("rx_ion", "ry_ion")
        for space, (a, b) in pairs.items():
            x, y = F.col(a), F.col(b)
            for name, value in (("sx", x), ("sy", y), ("sxx", x * x), ("syy", y * y), ("sxy", x * y)):
                sums[f"{name}_{scope}{space}"] = F.sum(_in(scope, value))
            if space != "_rank":
                d = F.abs(x - y)
                sums |= {f"mse_{scope}{space}": F.avg(_in(scope, d * d)), f"mean_{scope}{space}": F.avg(_in(scope, d)), f"std_{scope}{space}": F.stddev_pop(_in(scope, d))}
                if scope != "spec":
                    sums[f"d_{scope}{space}"] = F.sort_array(F.collect_list(_in(scope, d)))
    agg = rows.groupBy(*keys).agg(*(v.alias(k) for k, v in sums.items()))
    agg = agg.withColumns({f"d_spec{space}": F.sort_array(F.concat(f"d_ionb{space}", f"d_iony{space}")) for space in ("_norm", "")})
    return agg.select(*keys, *(_feature(c).alias(c) for c in wanted))


def _feature(name: str) -> Column:
    space = "_norm" if name.endswith("_norm") else ""
    scope = next((s for s in ("ionb", "iony") if s in name.split("_")), "spec")
    body = name.removesuffix("_norm")
    col = lambda c, sp=space: F.col(f"{c}_{scope}{sp}")
    sums = lambda sp: [F.col(f"n_{scope}"), *(col(c, sp) for c in ("sx", "sy", "sxx", "syy", "sxy"))]
    if body.endswith("_iontype"):
        b, y = F.col("d_ionb"), F.col("d_iony")
        end = F.lit(1) if body.startswith("min") else F.lit(-1)
        least, most = F.element_at(b, end), F.element_at(y, end)
        good = least <= most if body.startswith("min") else least >= most
        return F.when((F.col("n_ionb") == 0) | (F.col("n_iony") == 0) | good, 0.0).otherwise(1.0)
    if "pearson" in body:
        value = _pearson(*sums(space))
    elif "spearman" in body:
        value = _pearson(*sums("_rank"))
    elif "dotprod" in body:
        value = col("sxy")
    elif body.startswith("cos"):
        norm = F.sqrt(col("sxx") * col("syy"))
        value = F.when(norm > 0, F.try_divide(col("sxy"), norm))
    elif "abs_diff_Q" in body:
        value = F.when(F.col(f"n_{scope}") > 0, _quantile(col("d"), int(body[-1]) / 4))
    else:
        kind = next(k for k in ("mse", "mean", "std", "min", "max") if k in body.split("_"))
        value = F.get(col("d"), F.lit(0)) if kind == "min" else F.when(F.size(col("d")) > 0, F.element_at(col("d"), -1)) if kind == "max" else col(kind)
    return F.coalesce(F.nanvl(value.cast("double"), F.lit(0.0)), F.lit(0.0))


def correlation(ions: DataFrame, keys: list[str], *more: Column) -> DataFrame:
    """Pearson of predicted and observed log2 values; 0 with under two ions or no variance, null without observation.

    One aggregation, which ``more`` aggregates may join.
    """
    x = F.when(~F.isnan("predicted"), F.col("predicted"))
    y = F.when(x.isNotNull(), F.coalesce("observed", F.lit(0.0)))
    sums = [F.count(x), F.sum(x), F.sum(y), F.sum(x * x), F.sum(y * y), F.sum(x * y)]
    held = ions.groupBy(*keys).agg(F.count("observed").alias("__n"), *(v.alias(f"__s{i}") for i, v in enumerate(sums)), *more)
    value = F.coalesce(F.nanvl(_pearson(*(F.col(f"__s{i}") for i in range(6))), F.lit(0.0)), F.lit(0.0))
    return held.withColumn("correlation", F.when(F.col("__n") > 0, value)).select(*keys, "correlation", *held.columns[len(keys) + 7 :])

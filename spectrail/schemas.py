"""Column contracts: match tables, spectra, fragments, caches and the feature columns in output order."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import types as T

ROW_ID = "__row_id"
REQUIRED = ("SpecId", "Label", "ScanNr", "Peptide", "Proteins")
CHARGES = tuple(f"Charge{z}" for z in range(1, 7))
#: Added inside a logarithm, so that an intensity of zero has one.
OFFSET = 0.001
TOLERANCE = 0.02

SPECTRA = T.StructType([
    T.StructField("scan_number", T.LongType()), T.StructField("rt_seconds", T.DoubleType()),
    T.StructField("mz_array", T.ArrayType(T.FloatType())), T.StructField("intensity_array", T.ArrayType(T.FloatType())),
])

SCOPES = ("spec", "ionb", "iony")
_STATS = ("min_abs_diff", "max_abs_diff", "abs_diff_Q1", "abs_diff_Q2", "abs_diff_Q3", "mean_abs_diff", "std_abs_diff")


def _space(suffix: str, linear: bool) -> list[str]:
    names = [f"{s}_pearson{suffix}" for s in SCOPES]
    names += [f"{s}_spearman{suffix}" for s in SCOPES] if linear else []
    names += [f"{s}_mse{suffix}" for s in SCOPES]
    names += ["min_abs_diff_iontype", "max_abs_diff_iontype"] if linear else []
    names += [f"{scope}{stat}{suffix}" for scope in ("", "ionb_", "iony_") for stat in _STATS]
    return names + [f"{kind}{scope}{suffix}" for kind in ("dotprod", "cos") for scope in ("", "_ionb", "_iony")]


#: ``_norm`` columns are on log2 values, the others on linear ones.
SPECTRAL_FEATURES = tuple(_space("_norm", False) + _space("", True))
RT_FEATURES = ("observed_retention_time", "predicted_retention_time", "rt_diff")
RT_BEST = tuple(f"{c}_best" for c in RT_FEATURES)
FEATURES = SPECTRAL_FEATURES + RT_FEATURES + RT_BEST


def require(df: DataFrame, columns: tuple[str, ...], what: str) -> DataFrame:
    """Fails at once, on the driver, if a column is missing."""
    missing = [c for c in columns if c not in df.columns]
    if missing:
        raise ValueError(f"{what} lacks the columns {missing}")
    return df

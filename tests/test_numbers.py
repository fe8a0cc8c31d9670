"""The 71 features of one pair of vectors, by numpy, as an independent check."""

import numpy as np

STATS = ("min_abs_diff", "max_abs_diff", "abs_diff_Q1", "abs_diff_Q2", "abs_diff_Q3", "mean_abs_diff", "std_abs_diff")


def pearson(x, y):
    if len(x) < 1 or np.ptp(x) == 0 or np.ptp(y) == 0:
        return 0.0
    return float(np.corrcoef(x, y)[0, 1])


def ranks(v):
    return np.array([(v < a).sum() + ((v == a).sum() + 1) / 2 for a in v])


def feature_values(x, y, ion):
    out = {}
    for suffix, a, b in (("_norm", x, y), ("", 2.0**x - 0.001, 2.0**y - 0.001)):
        gaps = {}
        for scope, keep in (("spec", ion != ""), ("ionb", ion == "b"), ("iony", ion == "y")):
            p, q = a[keep], b[keep]
            d = gaps[scope] = np.abs(p - q)
            tail = "" if scope == "spec" else f"_{scope}"
            out[f"{scope}_pearson{suffix}"] = pearson(p, q)
            out[f"{scope}_mse{suffix}"] = float((d * d).mean()) if len(d) else 0.0
            out[f"dotprod{tail}{suffix}"] = float(p @ q)
            norm = float(np.sqrt((p @ p) * (q @ q)))
            out[f"cos{tail}{suffix}"] = float(p @ q) / norm if norm else 0.0
            values = [d.min(), d.max(), *np.quantile(d, [0.25, 0.5, 0.75]), d.mean(), d.std()] if len(d) else [0.0] * 7
            head = "" if scope == "spec" else f"{scope}_"
            out |= {f"{head}{s}{suffix}": float(v) for s, v in zip(STATS, values, strict=True)}
            if not suffix:
                out[f"{scope}_spearman"] = pearson(ranks(p), ranks(q)) if len(p) else 0.0
        if not suffix:
            both = len(gaps["ionb"]) and len(gaps["iony"])
            out["min_abs_diff_iontype"] = float(bool(both) and not gaps["ionb"].min() <= gaps["iony"].min())
            out["max_abs_diff_iontype"] = float(bool(both) and not gaps["ionb"].max() >= gaps["iony"].max())
    return out


def test_names():
    from spectrail.schemas import SPECTRAL_FEATURES

    assert set(feature_values(np.array([1.0, 2.0]), np.array([0.5, 1.0]), np.array(["b", "y"]))) == set(SPECTRAL_FEATURES)

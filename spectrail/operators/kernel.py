"""The 71 features of many ion lists at once, over flat arrays with offsets."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from spectrail.schemas import OFFSET, SCOPES

QUARTERS = (("abs_diff_Q1", 0.25), ("abs_diff_Q2", 0.5), ("abs_diff_Q3", 0.75))


#: Stretches that are sorted at once.
ROWS = 512


class Segments:
    """Consecutive stretches of a flat array, some of them empty."""

    def __init__(self, start: np.ndarray, size: np.ndarray):
        self.start, self.size, self.some = start, size, np.flatnonzero(size)
        self.of = np.repeat(np.arange(len(size)), size)
        self.at = start[self.of] + np.arange(len(self.of)) - np.repeat(np.cumsum(size) - size, size)
        self.own = np.cumsum(size) - size

    def reduce(self, by: np.ufunc, values: np.ndarray) -> np.ndarray:
        """One number a stretch, 0 for empty ones. ``values`` has the elements of the stretches in turn."""
        out = np.zeros(len(self.size))
        if len(self.some):
            out[self.some] = by.reduceat(values, self.own[self.some])
        return out

    def mean(self, values: np.ndarray) -> np.ndarray:
        return self.reduce(np.add, values) / np.maximum(self.size, 1)

    def sort(self, values: np.ndarray) -> np.ndarray:
        """Order of the elements by stretch, then value; of equal values any.

        Stretches of about one length are sorted as the rows of a matrix, which takes a third of a sort by two keys.
        """
        if not np.isfinite(values).all():
            return np.lexsort((values, self.of))
        out = np.empty(len(values), np.int64)
        by_size = self.some[np.argsort(self.size[self.some], kind="stable")]
        for first in range(0, len(by_size), ROWS):
            block = by_size[first : first + ROWS]
            own, place = self.own[block][:, None], np.arange(self.size[block[-1]])
            held = place < self.size[block][:, None]
            at = own + place
            rows = np.where(held, values[np.minimum(at, len(values) - 1)], np.inf)
            out[at[held]] = (own + rows.argsort(axis=1))[held]
        return out

    def ranks(self, values: np.ndarray) -> np.ndarray:
        """Average ranks in each stretch."""
        order = self.sort(values)
        v, of = values[order], self.of[order]
        new = np.flatnonzero(np.append(True, (v[1:] != v[:-1]) | (of[1:] != of[:-1]))[: len(v)])
        last = np.append(new[1:], len(v))[: len(new)]
        out = np.empty(len(v))
        out[order] = np.repeat((new + last - 1) / 2, last - new)
        return out - self.own[self.of] + 1

    def pearson(self, x: np.ndarray, y: np.ndarray) -> np.ndarray:
        """0 for stretches without variance on either side."""
        dx, dy = x - self.mean(x)[self.of], y - self.mean(y)[self.of]
        flat = (self.reduce(np.maximum, x) == self.reduce(np.minimum, x)) | (self.reduce(np.maximum, y) == self.reduce(np.minimum, y))
        norm = np.sqrt(self.reduce(np.add, dx * dx)) * np.sqrt(self.reduce(np.add, dy * dy))
        return np.where(flat, 0.0, self.reduce(np.add, dx * dy) / np.where(norm > 0, norm, 1.0))


def features(x: np.ndarray, y: np.ndarray, is_b: np.ndarray, size: np.ndarray) -> dict[str, np.ndarray]:
    """Features by name of each list: log2 values of prediction and observation, whether an ion is b, ions of each list.

    Empty scopes give 0, as does what isn't a number.
    """
    with np.errstate(all="ignore"):
        out = _features(x, y, is_b, size)
    return {k: np.where(np.isnan(v), 0.0, v) for k, v in out.items()}


def _features(x: np.ndarray, y: np.ndarray, is_b: np.ndarray, size: np.ndarray) -> dict[str, np.ndarray]:
    of = np.repeat(np.arange(len(size)), size)
    order = np.lexsort((~is_b, of))
    x, y = x[order], y[order]
    begin = np.cumsum(size) - size
    n_b = np.bincount(of[is_b], minlength=len(size)).astype(np.int64)
    scopes = {"spec": Segments(begin, size), "ionb": Segments(begin, n_b), "iony": Segments(begin + n_b, size - n_b)}
    out: dict[str, np.ndarray] = {}
    for suffix, p, q in (("_norm", x, y), ("", np.exp2(x) - OFFSET, np.exp2(y) - OFFSET)):
        ends = {}
        for scope in SCOPES:
            s = scopes[scope]
            a, b = p[s.at], q[s.at]
            d = np.abs(a - b)
            tail, head = ("", "") if scope == "spec" else (f"_{scope}", f"{scope}_")
            out[f"{scope}_pearson{suffix}"] = s.pearson(a, b)
            if not suffix:
                out[f"{scope}_spearman"] = s.pearson(s.ranks(a), s.ranks(b))
            dot = s.reduce(np.add, a * b)
            norm = np.sqrt(s.reduce(np.add, a * a) * s.reduce(np.add, b * b))
            out[f"dotprod{tail}{suffix}"], out[f"cos{tail}{suffix}"] = dot, np.where(norm > 0, dot / np.where(norm > 0, norm, 1.0), 0.0)
            out[f"{scope}_mse{suffix}"] = s.mean(d * d)
            mean = s.mean(d)
            low, high = s.reduce(np.minimum, d), s.reduce(np.maximum, d)
            ends[scope] = low, high
            out |= {f"{head}min_abs_diff{suffix}": low, f"{head}max_abs_diff{suffix}": high, f"{head}mean_abs_diff{suffix}": mean}
            out[f"{head}std_abs_diff{suffix}"] = np.sqrt(s.mean((d - mean[s.of]) ** 2))
            d = d[s.sort(d)]
            for name, share in QUARTERS:
                at = np.maximum(s.size - 1, 0) * share
                lower = np.floor(at).astype(np.int64)
                value = np.zeros(len(size))
                k = s.some
                first = s.own[k] + lower[k]
                second = s.own[k] + np.minimum(lower[k] + 1, s.size[k] - 1)
                value[k] = d[first] + (d[second] - d[first]) * (at - lower)[k]
                out[f"{head}{name}{suffix}"] = value
        if not suffix:
            both = (n_b > 0) & (size > n_b)
            out["min_abs_diff_iontype"] = (both & ~(ends["ionb"][0] <= ends["iony"][0])).astype(float)
            out["max_abs_diff_iontype"] = (both & ~(ends["ionb"][1] >= ends["iony"][1])).astype(float)
    return out


def observed_values(mz: np.ndarray, ions: np.ndarray, peak_mz: np.ndarray, intensity: np.ndarray, peaks: np.ndarray, tolerance: float) -> np.ndarray:
    """log2 intensity of the peak that each ion meets, 0.0 without one; ``ions`` and ``peaks`` say how many each row has.

    Peaks ascend in a row. The rule is that of ``match.nearest_peaks``: a peak strictly below and one at or above must be there, the nearer
    counts, the lower one on a tie, if it is nearer than the tolerance. Distances keep the type of the m/z, the tolerance is a double.
    """
    if not len(peak_mz):
        return np.zeros(len(mz))
    end, stop = np.cumsum(ions), np.cumsum(peaks)
    begin, start = end - ions, stop - peaks
    bounds = zip(start.tolist(), stop.tolist(), begin.tolist(), end.tolist(), strict=True)
    at = np.concatenate([np.empty(0, np.int64), *(peak_mz[a:b].searchsorted(mz[c:d]) + a for a, b, c, d in bounds)])
    low, high = np.maximum(at - 1, 0), np.minimum(at, len(peak_mz) - 1)
    both = (at > np.repeat(start, ions)) & (at < np.repeat(stop, ions)) & (mz > 0)
    below, above = mz - peak_mz[low], peak_mz[high] - mz
    left = both & (below <= above) & (below.astype(np.float64) < tolerance)
    right = both & (above < below) & (above.astype(np.float64) < tolerance)
    with np.errstate(all="ignore"):
        return np.where(left | right, np.log2(intensity[np.where(right, high, low)].astype(np.float64) + OFFSET), 0.0)


def _lists(column: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """Elements of a list column one after another, and how many each row has."""
    return column.flatten(), pc.fill_null(pc.list_value_length(column), 0).to_numpy(zero_copy_only=False).astype(np.int64)


def scored_batches(keys: list[str], wanted: tuple[str, ...], tolerance: float):
    """Batches (keys, a list of each trait of the fragments and of the peaks) to (keys, features): ions meet the peaks of their row and are compared at once."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            flat, ions = {}, np.empty(0)
            for name in ("b", "m", "x"):
                flat[name], ions = _lists(batch.column(f"__f_{name}"))
            for name in ("m", "i"):
                flat[f"peak_{name}"], peaks = _lists(batch.column(f"__p_{name}"))
            known = pc.is_valid(flat["x"]).to_numpy(zero_copy_only=False)
            value = {k: pc.fill_null(v, False if k == "b" else 0.0).to_numpy(zero_copy_only=False) for k, v in flat.items()}
            known &= value["m"] > 0
            if not known.all():
                ions = np.bincount(np.repeat(np.arange(len(ions)), ions)[known], minlength=len(ions)).astype(np.int64)
                value |= {k: value[k][known] for k in "bmx"}
            y = observed_values(value["m"], ions, value["peak_m"], value["peak_i"], peaks, tolerance)
            got = features(value["x"], y, value["b"], ions)
            yield pa.RecordBatch.from_arrays([*(batch.column(k) for k in keys), *(pa.array(got[c]) for c in wanted)], [*keys, *wanted])

    return run


def feature_batches(keys: list[str], wanted: tuple[str, ...]):
    """Batches (keys, ions: list of (is_b, x, y)) to (keys, features)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ions = batch.column("__ions")
            flat = ions.flatten()
            is_b, x, y = (flat.field(i).to_numpy(zero_copy_only=False) for i in range(3))
            size = np.diff(ions.offsets.to_numpy()).astype(np.int64)
            got = features(x, y, is_b, size)
            yield pa.RecordBatch.from_arrays([*(batch.column(k) for k in keys), *(pa.array(got[c]) for c in wanted)], [*keys, *wanted])

    return run

"""Settings and result of a build."""

from __future__ import annotations

import hashlib
import json
from dataclasses import dataclass, field
from typing import Any

from spectrail.schemas import TOLERANCE


@dataclass(slots=True)
class BuildConfig:
    """One run: its inputs, where its output and caches go, and how ions are matched."""

    match_table: str
    spectra: str
    out_dir: str
    run_id: str
    cache_dir: str | None = None
    max_rows: int | None = None
    tolerance: float = TOLERANCE
    calibration_fraction: float = 0.15
    recalibrate: bool = False
    #: One gzipped file, or a folder of its members.
    single_file: bool = True
    #: Rows cached for other contents of the inputs, settings, stores or predictors count as missing; off: keys alone decide.
    fingerprint_caches: bool = False

    def __post_init__(self) -> None:
        self.cache_dir = self.cache_dir or f"{self.out_dir}/cache/{self.run_id}"

    @property
    def output(self) -> str:
        return f"{self.out_dir}/{self.run_id}.rescore.pin.gz"

    def fingerprint(self, *facts: Any) -> str | None:
        """A digest of what a cache's rows depend on; None where keys alone decide."""
        return hashlib.sha256(json.dumps(facts, sort_keys=True, default=str).encode()).hexdigest() if self.fingerprint_caches else None


@dataclass(slots=True)
class BuildResult:
    run_id: str
    output: str
    cache_dir: str
    row_count: int
    precursor_count: int
    spectral_hits: int
    spectral_misses: int
    store_hits: int
    local_predictions: int
    rt_hits: int
    rt_misses: int
    metadata: dict[str, Any] = field(default_factory=dict)

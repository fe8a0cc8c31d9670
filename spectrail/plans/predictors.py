"""Where fragment intensities and retention times come from: plug-ins over DataFrames."""

from __future__ import annotations

import importlib
import uuid
from collections.abc import Callable
from typing import Any, Protocol

from pyspark.sql import DataFrame


class FragmentPredictor(Protocol):
    def fragments(self, precursors: DataFrame) -> DataFrame:
        """(precursor_key, ion, row, frag_charge, mz, predicted in log2) of rows with precursor_key, sequence, mods, charge."""


class TimePredictor(Protocol):
    def times(self, rows: DataFrame) -> DataFrame:
        """``rows`` with a column ``raw``: uncalibrated retention time, null where there is none."""


class TableFragments:
    """Predictions made elsewhere, as a table with the columns above."""

    def __init__(self, table: DataFrame, mark: str = ""):
        self.table, self.mark = table, mark

    def fragments(self, precursors: DataFrame) -> DataFrame:
        return self.table.join(precursors.select("precursor_key"), "precursor_key", "left_semi")


class TableTimes:
    """Raw times by ``key`` as a table (key, raw)."""

    def __init__(self, table: DataFrame, key: str = "Peptide", mark: str = ""):
        self.table, self.key, self.mark = table.select(key, "raw"), key, mark

    def times(self, rows: DataFrame) -> DataFrame:
        return rows.join(self.table, self.key, "left")


#: Models that this Python worker has loaded, by their ArrowModel.
_LOADED: dict[str, Any] = {}


def loaded(name: str, load: Callable[[], Any]) -> Any:
    if name not in _LOADED:
        _LOADED[name] = load()
    return _LOADED[name]


class ArrowModel:
    """Any function over Arrow batches; ``load`` runs once in each Python worker, which serves many tasks."""

    def __init__(self, load: Callable[[], Any], predict: Callable, schema: str, mark: str = ""):
        self.load, self.predict, self.schema, self.name, self.mark = load, predict, schema, uuid.uuid4().hex, mark

    def _run(self, rows: DataFrame) -> DataFrame:
        name, load, predict = self.name, self.load, self.predict

        def run(batches):
            model = loaded(name, load)
            for batch in batches:
                yield predict(model, batch)

        return rows.mapInArrow(run, self.schema)

    fragments = times = _run


def plug_in(path: str, **settings: Any) -> Any:
    """A predictor made by ``module:function``, called with the settings."""
    module, _, name = path.partition(":")
    return getattr(importlib.import_module(module), name)(**settings)


def mark(plug: Any) -> str:
    """Which plug-in this is, for caches that depend on it: its class, and its ``mark`` if it has one (a version, a path and time)."""
    return "" if plug is None else f"{type(plug).__module__}.{type(plug).__qualname__} {getattr(plug, 'mark', '')}"

"""Spectrum identifiers and output text."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T


def _number(text: Column) -> Column:
    return F.when(text != "", text.try_cast("long"))


def scan_from_title(title: Column) -> Column:
    """Scan number in a spectrum's title, by the first rule that gives one; else null.

    ``scan=N`` or ``scans: N`` between non-digits; digits alone; dot-separated ``name.N.N`` or
    ``name.N.M.z``; the only number in the text.
    """
    text = F.regexp_replace(title, r"^\s+|\s+$", "")
    named = _number(F.regexp_extract(text, r"(?i)(?:^|[^0-9])scans?[ =:]+([0-9]+)(?:[^0-9]|$)", 1))
    alone = _number(F.regexp_extract(text, r"^([0-9]+)$", 1))
    parts = F.split(text, r"\.")
    a, b = F.get(parts, F.lit(1)), F.get(parts, F.lit(2))
    dotted = F.when(a.rlike("^[0-9]+$") & b.rlike("^[0-9]+$") & ((a == b) | (F.size(parts) >= 4)), a.try_cast("long"))
    numbers = F.regexp_extract_all(text, F.lit("[0-9]+"), F.lit(0))
    return F.coalesce(named, alone, dotted, F.when(F.size(numbers) == 1, F.element_at(numbers, 1).try_cast("long")))


def scan_from_mgf(scans: Column, title: Column) -> Column:
    """The first of SCANS if it is digits, else the title's; fails the query if neither gives one."""
    first = F.trim(F.split_part(scans, F.lit(","), F.lit(1)))
    found = F.coalesce(F.when(first.rlike("^[0-9]+$"), first.try_cast("long")), scan_from_title(title))
    return F.coalesce(found, F.raise_error(F.concat(F.lit("no scan number in: "), F.coalesce(title, F.lit("")))).cast("long"))


def normal_id(identifier: Column, pattern: str | None = None) -> Column:
    """Percent-decoded identifier, or what ``pattern`` finds in it: group 1 if there is one, else the match.

    ``+`` stays; a text with a bad escape stays as it is; null is empty.
    """
    text = F.coalesce(F.try_url_decode(F.replace(identifier, F.lit("+"), F.lit("%2B"))), identifier, F.lit(""))
    if not pattern:
        return text
    import re

    group = 1 if re.compile(pattern).groups else 0
    return F.when(text.rlike(pattern), F.regexp_extract(text, pattern, group)).otherwise(text)


@F.pandas_udf(T.StringType())
def format_10g(value: pd.Series) -> pd.Series:
    """``%.10g`` of C, which Java's formatter lacks; null and NaN are empty."""
    out = np.char.mod("%.10g", value.fillna(0.0).to_numpy(np.float64))
    return pd.Series(np.where(value.isna(), "", out))


def log2_intensity(x: Column, offset: float = 0.001) -> Column:
    return F.log2(x.cast("double") + F.lit(offset))


def linear_intensity(x: Column, offset: float = 0.001) -> Column:
    return F.pow(F.lit(2.0), x) - F.lit(offset)

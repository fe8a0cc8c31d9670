"""Modified peptide strings, charges and keys as Catalyst expressions."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F

from spectrail.schemas import CHARGES

_MOD = r"\[U:[0-9]+\]"
#: Terminal modifications first, residues each with their own, terminal ones last. A residue after a C-terminal
#: modification is refused, which is stricter than need be.
VALID = rf"^(?:{_MOD}-)*(?:[A-Z](?:{_MOD})*)+(?:-{_MOD})*$"


def _ids(text: Column) -> Column:
    return F.regexp_extract_all(text, F.lit(r"\[U:([0-9]+)\]"), F.lit(1))


def parse_peptide(peptide: Column) -> Column:
    """struct(sequence, var_mod_sites): sites are 0-based residues, the length for the N-term, -1 for the C-term.

    Null stays null; text outside the grammar fails the query.
    """
    text = F.regexp_replace(peptide, r"^\s+|\s+$", "")
    checked = F.when(text.rlike(VALID), text).when(text.isNotNull(), F.raise_error(F.concat(F.lit("not a peptide: "), text)).cast("string"))
    sequence = F.regexp_replace(checked, rf"{_MOD}|-", "")
    residues = F.regexp_extract_all(checked, F.lit(rf"[A-Z](?:{_MOD})*(?!:)"), F.lit(0))
    residues = F.filter(residues, lambda t: t.rlike("^[A-Z]"))
    # inside brackets stands "U:" alone, so a letter before ":" is no residue
    sites = F.flatten(F.transform(residues, lambda t, i: F.transform(_ids(t), lambda u: F.concat_ws(":", i.cast("string"), u))))
    head = F.transform(_ids(F.regexp_extract(checked, rf"^((?:{_MOD}-)*)", 1)), lambda u: F.concat_ws(":", F.length(sequence).cast("string"), u))
    tail = F.transform(_ids(F.regexp_extract(checked, rf"((?:-{_MOD})*)$", 1)), lambda u: F.concat(F.lit("-1:"), u))
    return F.when(checked.isNotNull(), F.struct(sequence.alias("sequence"), F.array_join(F.concat(sites, head, tail), ";").alias("var_mod_sites")))


def decode_charge(columns: Iterable[str]) -> Column:
    """The z of the one column ChargeZ that is 1; missing columns count as 0; none or several fail the query."""
    present = [c for c in CHARGES if c in set(columns)]
    flags = F.array(*(F.when(F.col(c) == 1, F.lit(int(c[6:]))) for c in present)) if present else F.array().cast("array<int>")
    found = F.array_compact(flags)
    return F.when(F.size(found) == 1, F.element_at(found, 1)).otherwise(F.raise_error(F.concat(F.lit("not one charge: "), F.array_join(found.cast("array<string>"), ","))).cast("int"))


def _bars(*parts: Column) -> Column:
    return F.concat_ws("|", *(F.coalesce(p.cast("string"), F.lit("None")) for p in parts))


def precursor_key(label: Column, sequence: Column, mods: Column, charge: Column) -> Column:
    return _bars(label, sequence, mods, charge)


def psm_key(run: Column, spec_id: Column, peptide: Column, charge: Column, label: Column) -> Column:
    return _bars(run, spec_id, peptide, charge, label)


def proforma(peptide: Column, charge: Column) -> Column:
    return F.concat(F.replace(peptide, F.lit("[U:"), F.lit("[UNIMOD:")), F.lit("/"), charge.cast("string"))


def precursor_id(variant_id: Column, charge: Column) -> Column:
    return variant_id.cast("long") * 10 + charge


def mod_sites(text: Column) -> Column:
    """array<struct(pos, unimod)> of ``pos:id;pos:id``; blank parts are skipped, null is empty."""
    parts = F.filter(F.split(F.coalesce(text, F.lit("")), ";"), lambda p: F.trim(p) != "")
    return F.transform(parts, lambda p: F.struct(F.trim(F.split_part(p, F.lit(":"), F.lit(1))).cast("int").alias("pos"), F.trim(F.split_part(p, F.lit(":"), F.lit(2))).cast("int").alias("unimod")))

"""Modification resolver over a supplied dictionary (mod_name ``base@site``, unimod_id)."""

from __future__ import annotations

import re
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Terminal sites, and names that mean another one on some residues.
N_TERM, C_TERM = ("Any_N-term", "Protein_N-term"), ("Any_C-term", "Protein_C-term")
ALIASES = {("pyro-glu", "Q"): "gln->pyro-glu", ("pyro-glu", "E"): "glu->pyro-glu"}


def classify(mods: DataFrame) -> DataFrame:
    """Dictionary rows with unimod_id (null if not a whole number of 0 or more), base (lower case), residue and class.

    Classes: nterm, cterm, residue, nterm_residue, cterm_residue; other sites are left out.
    """
    site = F.regexp_extract("mod_name", r"@([^@]*)$", 1)
    base = F.lower(F.trim(F.regexp_replace("mod_name", r"@[^@]*$", "")))
    unimod = F.col("unimod_id").try_cast("long")
    before, after = F.split_part(site, F.lit("^"), F.lit(1)), F.regexp_extract(site, r"^[^^]*\^(.*)$", 1)
    kind = (
        F.when(site.isin(*N_TERM), "nterm").when(site.isin(*C_TERM), "cterm")
        .when(site.contains("^") & before.rlike(r"^\p{L}$") & after.isin(*N_TERM), "nterm_residue")
        .when(site.contains("^") & before.rlike(r"^\p{L}$") & after.isin(*C_TERM), "cterm_residue")
        .when(site.rlike(r"^\p{L}$"), "residue")
    )
    out = mods.where(F.col("mod_name").contains("@")).select("mod_name", F.when(unimod >= 0, unimod).alias("unimod_id"), base.alias("base"), kind.alias("class"), F.when(kind.endswith("residue"), F.upper(before)).otherwise("").alias("residue"))
    return out.where("class IS NOT NULL").distinct()


def candidates(classified: DataFrame, by: str) -> DataFrame:
    """(by, class, residue) with the one name chosen of its candidates, or null if they are ambiguous.

    Any_ is preferred over Protein_ if exactly one candidate ends in it; else a sole candidate.
    """
    names = F.collect_set("mod_name").alias("names")
    got = classified.where(F.col(by).isNotNull()).groupBy(by, "class", "residue").agg(names)
    choice = None
    for head in ("Any", "Protein"):
        ends = _ending(head)
        pick = F.when((F.col("class") != "residue") & (F.size(ends) == 1), F.element_at(ends, 1))
        choice = pick if choice is None else F.coalesce(choice, pick)
    chosen = F.coalesce(choice, F.when(F.size("names") == 1, F.element_at("names", 1)))
    return got.select(by, "class", "residue", chosen.alias("chosen"), F.lit(True).alias("known"))


def _ending(head: str) -> Column:
    return F.filter("names", lambda x: x.rlike(f"{head}_[NC]-term$"))


#: Dictionary rows up to which it is broadcast; a larger one is joined as it is.
BROADCAST_MODS = 200_000
KINDS = ("nterm_residue", "nterm", "residue", "cterm_residue", "cterm")


def _chosen(mods: DataFrame) -> DataFrame:
    """A row for each (key, residue): key ``u:id`` or ``n:name``, and of each class struct(known, chosen) or null."""
    known, parts = classify(mods), []
    for by, head in (("unimod_id", "u:"), ("base", "n:")):
        parts.append(candidates(known, by).select(F.concat(F.lit(head), F.col(by).cast("string")).alias("__key"), F.col("residue").alias("__of"), "class", F.struct("known", "chosen").alias("choice")))
    rows = parts[0].unionByName(parts[1])
    held = rows.groupBy("__key", "__of").agg(*(F.max(F.when(F.col("class") == k, F.col("choice"))).alias(f"__as_{k}") for k in KINDS))
    return F.broadcast(held) if mods.count() <= BROADCAST_MODS else held


class ModificationError(ValueError):
    """A modification that the dictionary can't resolve, named by the message."""


@contextmanager
def named() -> Iterator[None]:
    """Raises ``ModificationError`` for what ``resolve`` refuses while the block runs."""
    try:
        yield
    except Exception as e:
        found = re.search(r"(?:unknown|ambiguous) modification [^\n]*", str(e))
        if found:
            raise ModificationError(found[0]) from e
        raise


def checked(df: DataFrame) -> DataFrame:
    """Runs the resolution on its own, before anything else does."""
    with named():
        df.write.format("noop").mode("overwrite").save()
    return df


def resolve(tokens: DataFrame, mods: DataFrame, keys: list[str]) -> DataFrame:
    """Names and sites of tokens (keys, place, position, token, sequence).

    place: ``n``, ``c`` or ``r`` with a 1-based position. A token with ``@`` is a name already.
    Digits or ``UNIMOD:digits`` are looked up by id and must be found; other texts by name, and
    fall back to ``token@Any_N-term``, ``token@Any_C-term`` or ``token@X``. A residue's token tries the
    N-terminal form on the first residue, then the residue, then the C-terminal form on the last.
    Ambiguous candidates and unknown ids fail the query.
    """
    held = _chosen(mods)
    t = tokens.withColumn("token", F.trim("token"))
    t = t.withColumn("__id", F.regexp_extract("token", r"(?i)^(?:UNIMOD:)?([0-9]+)$", 1).try_cast("long"))
    n = F.length("sequence")
    residue = F.upper(F.when(F.col("place") == "n", F.substring("sequence", 1, 1)).when(F.col("place") == "c", F.right("sequence", F.lit(1))).otherwise(F.substr("sequence", F.col("position"), F.lit(1))))
    t = t.withColumn("__residue", residue)
    name = F.lower("token")
    for (alias, on), to in ALIASES.items():
        name = F.when((F.lower("token") == alias) & (F.col("__residue") == on), to).otherwise(name)
    t = t.withColumn("__name", name)
    applies = {
        "nterm_residue": (F.col("place") == "n") | (F.col("place") == "r") & (F.col("position") == 1), "nterm": F.col("place") == "n",
        "residue": F.col("place") == "r", "cterm_residue": (F.col("place") == "c") | (F.col("place") == "r") & (F.col("position") == n), "cterm": F.col("place") == "c",
    }
    site = {"nterm_residue": F.lit("0"), "nterm": F.lit("0"), "residue": F.col("position").cast("string"), "cterm_residue": F.lit("-1"), "cterm": F.lit("-1")}
    t = t.withColumn("__k", F.when(F.col("__id").isNotNull(), F.concat(F.lit("u:"), F.col("__id").cast("string"))).otherwise(F.concat(F.lit("n:"), "__name")))
    # once for the forms on a residue, once for the bare ends
    for of, kinds in ((F.col("__residue"), [k for k in KINDS if k.endswith("residue")]), (F.lit(""), ["nterm", "cterm"])):
        found = held.select("__key", "__of", *(f"__as_{k}" for k in kinds))
        t = t.join(found, (F.col("__k") == F.col("__key")) & (F.col("__of") == of), "left").drop("__key", "__of")
    wanted = F.coalesce(*(F.when(applies[k] & F.col(f"__as_{k}.known"), F.struct(F.col(f"__as_{k}.chosen").alias("name"), site[k].alias("site"), F.lit(True).alias("known"))) for k in KINDS))
    explicit = F.regexp_extract("token", r"@([^@]*)$", 1)
    default = F.when(F.col("place") == "n", "0").when(F.col("place") == "c", "-1").otherwise(F.col("position").cast("string"))
    given = F.when(explicit.rlike(r"^(?:.*\^)?(?:Any|Protein)_N-term$"), "0").when(explicit.rlike(r"^(?:.*\^)?(?:Any|Protein)_C-term$"), "-1").otherwise(default)
    fallback = F.concat("token", F.lit("@"), F.when(F.col("place") == "n", "Any_N-term").when(F.col("place") == "c", "Any_C-term").otherwise(F.col("__residue")))
    fail = lambda why: F.raise_error(F.concat(F.lit(why), "token", F.lit(" on "), "sequence")).cast("string")
    mod = F.when(F.col("token").contains("@"), F.col("token")).when(wanted["known"], F.coalesce(wanted["name"], fail("ambiguous modification "))).when(F.col("__id").isNotNull(), fail("unknown modification ")).otherwise(fallback)
    where = F.when(F.col("token").contains("@"), given).when(wanted["known"], wanted["site"]).otherwise(default)
    return t.select(*keys, "place", "position", mod.alias("mod"), where.alias("site"))


def proforma_tokens(text: Column) -> Column:
    """struct(sequence, charge, tokens) of ``[N]-PEP[mod]TIDE-[C]/2``; a missing charge fails the query."""
    body = F.regexp_replace(text, r"/[0-9]+$", "")
    charge = F.regexp_extract(text, r"/([0-9]+)$", 1)
    head, tail = F.regexp_extract(body, r"^((?:\[[^\]]*\])+)-", 1), F.regexp_extract(body, r"-((?:\[[^\]]*\])+)$", 1)
    middle = F.regexp_replace(F.regexp_replace(body, r"^(?:\[[^\]]*\])+-", ""), r"-(?:\[[^\]]*\])+$", "")
    inside = lambda s: F.regexp_extract_all(s, F.lit(r"\[([^\]]*)\]"), F.lit(1))
    of = lambda place, position, token: F.struct(F.lit(place).alias("place"), position.cast("int").alias("position"), token.alias("token"))
    residues = F.regexp_extract_all(middle, F.lit(r"[A-Za-z](?:\[[^\]]*\])*"), F.lit(0))
    each = F.flatten(F.transform(residues, lambda r, i: F.transform(inside(r), lambda k: of("r", i + 1, k))))
    tokens = F.concat(F.transform(inside(head), lambda k: of("n", F.lit(0), k)), each, F.transform(inside(tail), lambda k: of("c", F.lit(-1), k)))
    sequence = F.regexp_replace(middle, r"\[[^\]]*\]", "")
    z = F.when(charge != "", charge.try_cast("int")).otherwise(F.raise_error(F.concat(F.lit("no charge: "), text)).cast("int"))
    return F.struct(sequence.alias("sequence"), z.alias("charge"), tokens.alias("tokens"))


def variant_tokens(sites: Column, sequence: Column) -> Column:
    """Store notation ``pos:id;pos:id`` as tokens: the length is the N-term, -1 the C-term, others 0-based residues."""
    from spectrail.functions.peptide import mod_sites

    n = F.length(sequence)

    def token(s: Column) -> Column:
        bad = F.raise_error(F.lit("position outside the sequence")).cast("string")
        place = F.when(s["pos"] == n, "n").when(s["pos"] == -1, "c").when((s["pos"] >= 0) & (s["pos"] < n), "r").otherwise(bad)
        return F.struct(place.alias("place"), (s["pos"] + 1).alias("position"), s["unimod"].cast("string").alias("token"))

    return F.transform(mod_sites(sites), token)


def annotate(rows: DataFrame, mods: DataFrame, key: str, tokens: str = "tokens", sequence: str = "sequence") -> DataFrame:
    """``rows`` with ``mods`` and ``mod_sites``: names and sites joined by ``;`` in the tokens' order."""
    flat = rows.select(key, sequence, F.posexplode(tokens).alias("__pos", "t")).select(key, F.col(sequence).alias("sequence"), "__pos", "t.place", "t.position", "t.token")
    got = resolve(flat, mods, [key, "__pos"])
    got = got.groupBy(key).agg(F.array_sort(F.collect_list(F.struct("__pos", "mod", "site"))).alias("m"))
    got = got.select(F.col(key).alias("__key"), F.array_join("m.mod", ";").alias("mods"), F.array_join("m.site", ";").alias("mod_sites"))
    return rows.join(got, F.col(key) == F.col("__key"), "left").drop("__key").fillna("", subset=["mods", "mod_sites"])

"""Operator 7: personal data by regular expressions, checksums and context words, all in DataFrame functions."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from spectrail.llm._shared import free_prefix, table

#: Elements that one step of a running sum copies.
CHUNK = 256
#: Characters before a span that are searched for context words.
CONTEXT = 48


@dataclass(frozen=True)
class Kind:
    """``gate``: a cheap test without which ``pattern`` can't match. Patterns are possessive and
    anchored at the ends of earlier matches or of runs, so they find what the plain ones in
    ``plain`` find, in linear time and without recursion."""

    name: str
    plain: str
    pattern: str
    gate: str
    words: str
    score: float
    base: bool = True
    least: float = 0.0


# The base kinds' patterns, in the order in which kinds are listed.
KINDS = (
    Kind("email", r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
         r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++", "@", r"mail|contact|write|reply", 0.8),
    Kind("ip", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
         r"(?:\G|(?<![0-9]))[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++", r"[0-9]\.[0-9]++\.[0-9]++\.[0-9]", r"\bip\b|host|server|address|login", 0.5),
    Kind("card", r"[0-9]([\x20-]?[0-9])+", r"[0-9](?:[\x20-]?[0-9])++", r"[0-9](?:[\x20-]?[0-9]){15}", r"card|visa|credit|payment|kart|carte|tarjeta", 0.7),
    Kind("phone", r"\+[0-9][\x20().0-9-]+[0-9]", r"\+[0-9][\x20().0-9-]+[0-9]", r"\+[0-9]", r"phone|call|tel|mobile|fax", 0.6),
    Kind("iban", r"[A-Z]{2}[0-9]{2}[A-Z0-9]{11,30}", r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}[A-Z0-9]{11,30}+(?![A-Za-z0-9])",
         r"[A-Z]{2}[0-9]{2}[A-Z0-9]{11}", r"iban|account|bank|konto|cuenta|compte", 0.7, False, 0.6),
    Kind("national_id", r"[0-9]{3}-[0-9]{2}-[0-9]{4}", r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])",
         r"[0-9]{3}-[0-9]{2}-[0-9]{4}", r"\bssn\b|social|security|national id|tax", 0.3, False, 0.6),
)
BONUS = 0.3


def _digits(v: Column) -> Column:
    return F.regexp_replace(v, "[^0-9]", "")


def luhn(digits: Column) -> Column:
    def add(total: Column, i: Column) -> Column:
        d = F.substr(digits, -i, F.lit(1)).cast("int")
        twice = d * 2 - F.when(d > 4, 9).otherwise(0)
        return total + F.when(i % 2 == 0, twice).otherwise(d)

    return F.aggregate(F.sequence(F.lit(1), F.length(digits)), F.lit(0), add) % 10 == 0


def mod97(v: Column) -> Column:
    turned = F.concat(F.substr(v, F.lit(5)), F.substr(v, F.lit(1), F.lit(4)))

    def step(rest: Column, i: Column) -> Column:
        code = F.ascii(F.substr(turned, i, F.lit(1)))
        return F.when(code < 58, (rest * 10 + code - 48) % 97).otherwise((rest * 100 + code - 55) % 97)

    return F.aggregate(F.sequence(F.lit(1), F.length(turned)), F.lit(0), step) == 1


_PART = "0*(?:25[0-5]|2[0-4][0-9]|1?[0-9]?[0-9])"


def _valid(kind: str, v: Column) -> Column:
    if kind == "ip":
        return v.rlike(rf"^{_PART}(?:\.{_PART}){{3}}$")
    if kind == "card":
        n = F.length(_digits(v))
        return n.between(16, 19) & F.when(n.between(16, 19), luhn(_digits(v))).otherwise(False)
    if kind == "phone":
        return F.length(_digits(v)).between(8, 15)
    if kind == "iban":
        return mod97(v)
    return F.lit(True)


def _placed(k: Kind, found: Column) -> Column:
    """Adds start, end and context to matches given as (gap, its last characters, value): a running sum, in chunks of ``CHUNK``.

    ``before`` is the text's last ``CONTEXT`` characters before the match, earlier matches included. ``listed``,
    for kinds that need context, tells that a match has a word there or follows such a one within ``CONTEXT`` characters.
    """
    kind = "array<struct<start:int,end:int,value:string,before:string,listed:boolean>>"
    state = "struct<at:int,tail:string,listed:boolean>"

    def moved(acc: Column, z: Column) -> tuple[Column, Column, Column, Column]:
        start = acc["at"] + z["skip"]
        before = F.right(F.concat(acc["tail"], z["before"]), F.lit(CONTEXT))
        listed = F.lower(before).rlike(k.words) | (acc["listed"] & (z["skip"] <= CONTEXT)) if k.score < k.least else F.lit(False)
        return start, start + F.char_length(z["value"]), before, listed

    def after(end: Column, before: Column, listed: Column, z: Column) -> list[Column]:
        return [end.alias("at"), F.right(F.concat(before, z["value"]), F.lit(CONTEXT)).alias("tail"), listed.alias("listed")]

    def skipped(acc: Column, z: Column) -> Column:
        _, end, before, listed = moved(acc, z)
        return F.struct(*after(end, before, listed, z)).cast(state)

    def inside(chunk: Column, offset: Column) -> Column:
        def step(acc: Column, z: Column) -> Column:
            start, end, before, listed = moved(acc, z)
            one = F.struct(start.alias("start"), end.alias("end"), z["value"].alias("value"), before.alias("before"), listed.alias("listed"))
            return F.struct(*after(end, before, listed, z), F.concat(acc["out"], F.array(one)).alias("out"))

        return F.aggregate(chunk, F.struct(offset["at"].alias("at"), offset["tail"].alias("tail"), offset["listed"].alias("listed"), F.array().cast(kind).alias("out")), step)["out"]

    chunks = F.transform(F.sequence(F.lit(0), F.floor((F.size(found) - 1) / CHUNK).cast("int")), lambda b: F.slice(found, b * CHUNK + 1, CHUNK))
    first = F.struct(F.lit(0).alias("at"), F.lit("").alias("tail"), F.lit(False).alias("listed")).cast(state)
    offsets = F.aggregate(F.slice(chunks, 1, F.size(chunks) - 1), F.array(first), lambda a, c: F.concat(a, F.array(F.aggregate(c, F.element_at(a, -1), skipped))))
    placed = F.flatten(F.zip_with(chunks, offsets, inside))
    return F.when(F.size(found) > 0, placed).otherwise(F.array().cast(kind))


def _scored(k: Kind, placed: Column) -> Column:
    """Valid spans of a kind with their scores."""

    def span(x: Column) -> Column:
        score = F.when(x["listed"] | F.lower(x["before"]).rlike(k.words), min(1.0, k.score + BONUS)).otherwise(k.score)
        return F.struct(F.lit(k.name).alias("kind"), x["start"].alias("start"), x["end"].alias("end"), score.alias("score"), F.lit(k.base).alias("base"))

    spans = F.transform(F.filter(placed, lambda x: _valid(k.name, x["value"])), span)
    return spans if k.base else F.filter(spans, lambda x: x["score"] >= k.least)


def find_pii(df: DataFrame, text_col: str = "text", out: str = "pii") -> DataFrame:
    """Adds ``out``: array of (kind, start, end, score, base), by kind as listed, then start.

    A kind's pattern proposes spans (leftmost, not overlapping), Luhn, mod-97 or a range
    check confirms them, and context words in the ``CONTEXT`` characters before one raise its
    score. Base kinds stay at any score; the others need their least score; where that takes a
    context word, a span that follows another within ``CONTEXT`` characters shares its context, as in lists and columns. Offsets are code points of the
    whole text, end exclusive. Null and empty texts have no spans; rows are neither dropped
    nor shuffled, other columns, whatever their names, pass through; a column named ``out`` is replaced.
    """
    gap = free_prefix(*df.columns)
    df = df.withColumn(f"{gap}_text", F.coalesce(F.col(text_col), F.lit("")))
    text = F.col(f"{gap}_text")
    gates = {k.name: text.contains(k.gate) if k.gate == "@" else text.rlike(k.gate) for k in KINDS}
    df = df.withColumns({f"{gap}_g_{name}": gate for name, gate in gates.items()})
    none = F.array().cast("array<string>")
    df = df.withColumns({f"{gap}_m_{k.name}": F.when(F.col(f"{gap}_g_{k.name}"), F.regexp_extract_all(text, F.lit(k.pattern), F.lit(0))).otherwise(none) for k in KINDS})
    df = df.withColumns({f"{gap}_s_{k.name}": F.when(F.size(f"{gap}_m_{k.name}") > 0, F.split(text, k.pattern)).otherwise(none) for k in KINDS})
    zipped = {}
    for k in KINDS:
        m, s = F.col(f"{gap}_m_{k.name}"), F.col(f"{gap}_s_{k.name}")
        zipped[f"{gap}_z_{k.name}"] = F.zip_with(F.slice(s, 1, F.size(m)), m, lambda g, v: F.struct(F.char_length(g).alias("skip"), F.right(g, F.lit(CONTEXT)).alias("before"), v.alias("value")))
    df = df.withColumns(zipped)
    df = df.withColumns({f"{gap}_p_{k.name}": _placed(k, F.col(f"{gap}_z_{k.name}")) for k in KINDS})
    parts = [_scored(k, F.col(f"{gap}_p_{k.name}")) for k in KINDS]
    names = [f"{gap}_{x}_{k.name}" for x in "gmszp" for k in KINDS]
    return df.withColumn(out, F.concat(*parts)).drop(*names, f"{gap}_text")


def joined(spans: Column) -> Column:
    return F.array_join(F.transform(spans, lambda x: F.concat_ws(":", x["kind"], x["start"].cast("string"), x["end"].cast("string"))), ",")


def _reach(ends: Column) -> Column:
    """Before each element the largest of those before it, 0 for the first: a running maximum, in chunks of ``CHUNK``."""
    chunks = F.transform(F.sequence(F.lit(0), F.floor((F.size(ends) - 1) / CHUNK).cast("int")), lambda b: F.slice(ends, b * CHUNK + 1, CHUNK))
    before = F.aggregate(F.slice(chunks, 1, F.size(chunks) - 1), F.array(F.lit(0)), lambda a, c: F.concat(a, F.array(F.greatest(F.element_at(a, -1), F.array_max(c)))))

    def inside(chunk: Column, top: Column) -> Column:
        start = F.struct(top.alias("top"), F.array().cast("array<int>").alias("out"))
        return F.aggregate(chunk, start, lambda acc, x: F.struct(F.greatest(acc["top"], x).alias("top"), F.concat(acc["out"], F.array(acc["top"])).alias("out")))["out"]

    return F.flatten(F.zip_with(chunks, before, inside))


def mask_pii(df: DataFrame, text_col: str = "text") -> DataFrame:
    """Replaces every span by its kind in brackets; of overlapping spans the union goes under the first's name.

    Texts without spans, null ones included, stay as they are; columns and rows stay.
    """
    found = free_prefix(*df.columns) + "found"
    spans, reach = f"{found}_spans", f"{found}_reach"
    out = find_pii(df, text_col, found)
    ordered = F.array_sort(F.transform(found, lambda x: F.struct(x["start"].alias("start"), (-x["end"]).alias("back"), x["kind"].alias("kind"))))
    out = out.withColumn(spans, F.when(F.size(found) > 0, ordered))
    out = out.withColumn(reach, _reach(F.transform(spans, lambda x: -x["back"])))
    text = F.col(text_col)
    # a span that begins before the reach of those before it is part of their union
    piece = lambda x, r: F.when(x["start"] < r, "").otherwise(F.concat(F.substr(text, r + 1, x["start"] - r), F.lit("["), F.upper(x["kind"]), F.lit("]")))
    end = F.array_max(F.transform(spans, lambda x: -x["back"]))
    masked = F.concat(F.array_join(F.zip_with(spans, reach, piece), ""), F.substr(text, end + 1))
    return out.withColumn(text_col, F.when(F.size(spans) > 0, masked).otherwise(text)).drop(found, spans, reach)


def op7_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = find_pii(table(spark, sf_dir, "documents").select("doc_id", "text"))
    base = F.filter("pii", lambda x: x["base"])
    count = lambda name: F.size(F.filter("pii", lambda x: x["kind"] == name)).cast("long")
    return found.select(
        "doc_id", *(count(k.name).alias(f"n_{k.name}") for k in KINDS if k.base),
        F.sha2(joined(base).cast("binary"), 256).alias("base_sha256"), joined(F.col("pii")).alias("spans"),
        *(count(k.name).alias(f"n_{k.name}") for k in KINDS if not k.base), F.array_max(F.transform("pii", lambda x: x["score"])).alias("max_score"),
    )

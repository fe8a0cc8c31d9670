"""Operator 3: secrets by fixed patterns, and random-looking tokens by a battery of tests."""

from __future__ import annotations

import math
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from spectrail.llm._shared import table, written
from spectrail.llm._text import slices

# The base kinds, in the order in which they are listed.
ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.IGNORECASE | re.ASCII)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]+")
BASE = ("assign", "access", "hex")
RANDOM = "random"

#: Tokens that the battery judges: runs of these characters, of this length at least.
TOKEN = re.compile(r"[A-Za-z0-9+/_=-]{20,}")
_LONG_HEX = re.compile(r"[0-9a-f]{24,}")
#: The least length of a part of a token that is judged, and hexadecimal digits of either case.
LEAST = 16
_ANY_HEX = re.compile(r"[0-9a-fA-F]+")
#: Encodings from narrow to wide; a token's is the first that holds all its characters.
ENCODINGS = (
    ("hex", "0123456789abcdef"), ("HEX", "0123456789ABCDEF"), ("base32", "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"),
    ("base36", "0123456789abcdefghijklmnopqrstuvwxyz"), ("BASE36", "0123456789ABCDEFGHIJKLMNOPQRSTUVWXYZ"),
    ("base64", "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/"),
    ("base64url", "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789-_"),
    ("mixed", "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/-_"),
)
#: Prose: shares of letters (of a hundred; English, German, French and Spanish together), and what follows a character of a class.
LETTERS = dict(zip("abcdefghijklmnopqrstuvwxyz", (8.9, 1.4, 3.3, 4.4, 14.4, 1.5, 1.7, 3.0, 7.0, 0.4, 0.6, 4.5, 2.7, 7.5, 6.0, 2.2, 0.7, 6.6, 7.0, 6.9, 4.4, 1.1, 1.1, 0.3, 0.9, 0.6), strict=True))
FOLLOW = {
    "lower": {"lower": 0.91, "upper": 0.03, "digit": 0.03, "sign": 0.03}, "upper": {"lower": 0.15, "upper": 0.79, "digit": 0.03, "sign": 0.03},
    "digit": {"lower": 0.05, "upper": 0.05, "digit": 0.85, "sign": 0.05}, "sign": {"lower": 0.45, "upper": 0.2, "digit": 0.2, "sign": 0.15},
}
#: Share of vowels after a vowel and after a consonant of the same case.
VOWELS = {True: 0.15, False: 0.5}
_CODES = [{c: i for i, c in enumerate(letters)} for _, letters in ENCODINGS]
#: The share of false discoveries allowed.
RATE = 0.01
#: Length classes (upper ends), each with its own part of the false-discovery budget; bins a unit of -log10 p.
LENGTHS, BINS, TOP = (24, 32, 48, 64, 1 << 62), 10, 400


def normal_tail(z: float) -> float:
    return 0.5 * math.erfc(z / math.sqrt(2))


def chi_tail(x: float, df: int) -> float:
    """Upper tail of chi-squared by the cube-root normal approximation."""
    return normal_tail(((x / df) ** (1 / 3) - (1 - 2 / (9 * df))) / math.sqrt(2 / (9 * df)))


def _class(c: str) -> str:
    return "lower" if c.islower() else "upper" if c.isupper() else "digit" if c.isdigit() else "sign"


def _tables() -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Log chances in prose, of a character (second index) after another (first; 0 at the head): of its class, of it within
    its class by share alone, and what its neighbour adds to that."""
    signs, total = "+/_=-", sum(LETTERS.values()) + 0.3 * len(LETTERS)
    share = {x: (v + 0.3) / total for x, v in LETTERS.items()}
    vocal = sum(share[x] for x in "aeiou")
    every = [c for x in LETTERS for c in (x, x.upper())] + list("0123456789" + signs)
    runs, shares, serial = np.zeros((128, 128)), np.zeros((128, 128)), np.zeros((128, 128))
    for b in every:
        kind, x = _class(b), b.lower()
        shares[:, ord(b)] = math.log(1 / 10 if kind == "digit" else 1 / len(signs) if kind == "sign" else share[x])
        runs[0, ord(b)] = math.log(0.25)
        for a in every:
            runs[ord(a), ord(b)] = math.log(FOLLOW[_class(a)][kind])
            if _class(a) == kind and kind in ("lower", "upper"):
                v = VOWELS[a.lower() in "aeiou"]
                serial[ord(a), ord(b)] = math.log(v / vocal if x in "aeiou" else (1 - v) / (1 - vocal))
    return runs, shares, serial


_RUNS, _SHARES, _SERIAL = _tables()
#: Of each encoding, the log chances under randomness of a character's class, and of it within the class.
_UNIFORM = {}
for _name, _letters in ENCODINGS:
    _n = {k: sum(_class(c) == k for c in _letters) for k in FOLLOW}
    _UNIFORM[_name] = (np.zeros(128), np.zeros(128))
    for _c in _letters:
        _UNIFORM[_name][0][ord(_c)] = math.log(_n[_class(_c)] / len(_letters))
        _UNIFORM[_name][1][ord(_c)] = -math.log(_n[_class(_c)])


def battery(token: str) -> tuple[str, float, tuple[float, float, float]] | None:
    """(encoding, p of randomness, evidence of each test) of a token. Hexadecimal digits of both cases are judged as those of one.

    Three tests in the inferred encoding: is its alphabet used uniformly, do classes of characters run as they
    should, do neighbours depend on each other. Each test looks both ways:

    Against randomness (independent characters, uniform over the alphabet) by its classical statistic: chi-squared over
    groups of the alphabet, Wald-Wolfowitz runs about the middle code, serial correlation of the codes. The p is three
    times the least of the three, one at most.

    Against prose written in that encoding by the log likelihood ratio of randomness to prose in the same trait: shares
    of characters within their class, classes that follow each other, vowels among neighbouring letters.
    """
    body = token.rstrip("=")
    body = body.lower() if _ANY_HEX.fullmatch(body) else body
    found = next(((name, code) for (name, _), code in zip(ENCODINGS, _CODES, strict=True) if all(c in code for c in body)), None)
    n = len(body)
    if found is None or n < LEAST:
        return None
    name, code = found
    x = np.array([code[c] for c in body])
    size = len(code)
    groups = max(2, min(size, n // 5))
    share = np.bincount(np.arange(size) * groups // size, minlength=groups) / size
    seen = np.bincount(x * groups // size, minlength=groups)
    p_uniform = chi_tail(float((((seen - n * share) ** 2) / (n * share)).sum()), groups - 1)
    high = x >= size // 2
    n1 = int(high.sum())
    n2 = n - n1
    if n1 and n2:
        mean = 1 + 2 * n1 * n2 / n
        var = (mean - 1) * (mean - 2) / (n - 1)
        p_runs = 2 * normal_tail(abs(1 + int((high[1:] != high[:-1]).sum()) - mean) / math.sqrt(var)) if var > 0 else 1.0
    else:
        p_runs = 2.0 ** (1 - n)
    c = x - (size - 1) / 2
    p_serial = 2 * normal_tail(abs(float((c[1:] * c[:-1]).sum())) / ((size * size - 1) / 12 * math.sqrt(n - 1)))
    at = np.frombuffer(body.encode(), np.uint8)
    before = np.append(0, at[:-1])
    classes, within = _UNIFORM[name]
    evidence = (float((within[at] - _SHARES[before, at]).sum()), float((classes[at] - _RUNS[before, at]).sum()), -float(_SERIAL[before, at].sum()))
    return name, min(1.0, 3 * min(p_uniform, p_runs, p_serial)), evidence


def p_prose(found: tuple[str, float, tuple[float, float, float]]) -> float:
    """The battery's p-value of a discovery: of prose looking as random as the token, all three tests together.

    Their evidence adds up to the likelihood ratio of randomness to prose. Prose has a ratio of x or more with a
    chance of 1 / x at most, whatever the length and alphabet. Divided by the p of the classical tests, which is one at most, it only
    grows: the less a token looks random to them, the more evidence it needs. Nothing is dropped before the control.
    """
    return min(1.0, math.exp(-max(0.0, sum(found[2]))) / max(found[1], 1e-300))


def parts(token: str) -> list[str]:
    """What of a token may be random, if long enough: the whole, what stands between underscores, its groups between dashes written together, and each group.

    Underscores hold the words of names together, so what they separate is never joined.
    """
    found = [token]
    for name in token.rstrip("=").split("_"):
        found += [name.replace("-", ""), *name.split("-")]
    return list(dict.fromkeys(p for p in found if len(p) >= LEAST))


def judged(token: str) -> float | None:
    """The least p of a token's parts, times their number: the chance that prose gives any of them is no more. None if none can be judged."""
    found = [f for f in map(battery, parts(token)) if f]
    return min(1.0, len(found) * min(map(p_prose, found))) if found else None


def base_spans(text: str) -> list[tuple[int, int, str]]:
    """Leftmost, non-overlapping matches of each kind that pass its length test, by start, then kind."""
    out = [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if len(m[2]) >= 6]
    if "AKIA" in text:
        out += [(m.start(), 1, m.end()) for m in ACCESS.finditer(text) if m.end() - m.start() >= 20]
    # a run of 24 or more is a whole match of the base pattern, for that one is greedy
    out += [(m.start(), 2, m.end()) for m in _LONG_HEX.finditer(text)]
    return [(a, b, BASE[k]) for a, k, b in sorted(out)]


def scan(text: str) -> tuple[list[tuple[int, int, str]], list[tuple[int, int, int, float]]]:
    """(base spans, judged tokens as start, end, length class, p of prose)."""
    spans = base_spans(text)
    tokens = []
    for m in TOKEN.finditer(text):
        if any(a < m.end() and m.start() < b for a, b, _ in spans):
            continue
        p = judged(m[0])
        if p is not None:
            tokens.append((m.start(), m.end(), next(i for i, top in enumerate(LENGTHS) if len(m[0]) <= top), p))
    return spans, tokens


def thresholds(counts: dict[tuple[int, int], int], tested: dict[int, int], rate: float = RATE) -> list[float]:
    """Benjamini-Hochberg in each length class, on p-values in bins, with the rate shared by the classes' sizes.

    A bin's p-values count as its upper end, so binning only makes it stricter. Longer classes, where prose
    is rarer, keep the rate; shorter ones take it in proportion to their length.
    """
    out = []
    for k in range(len(LENGTHS)):
        share = rate * min(1.0, min(LENGTHS[k], 64) / 64)
        best, passed = -1.0, 0
        for b in range(TOP, 0, -1):
            passed += counts.get((k, b), 0)
            p = 10.0 ** (-b / BINS)
            if passed and p <= share * passed / max(1, tested.get(k, 0)):
                best = p
        out.append(best)
    return out


def find_secrets(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", rate: float = RATE) -> DataFrame:
    """Per row: base spans, and random-looking tokens kept at a false-discovery rate over the whole table.

    What is controlled is the battery's combined p-value (``p_prose``), by length class.

    One pass scans whole texts and writes ids, spans and candidate tokens, a small part of the
    input, to the shared folder. Their p-values are counted in at most 5 x 400 bins, from which
    the thresholds follow; the second step only filters. Null and empty texts have no spans;
    repeated rows and null ids are kept; other columns are ignored. Offsets are code points.
    Columns: id, base and random: arrays of (start, end, kind).
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        span = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32()), ("kind", pa.string())]))
        token = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32()), ("length", pa.int32()), ("bin", pa.int32())]))
        for whole in batches:
            for batch in slices(whole, "text"):
                found = [scan(t or "") for t in batch.column("text").to_pylist()]
                spans = [[{"start": a, "end": b, "kind": k} for a, b, k in x] for x, _ in found]
                tokens = [[{"start": a, "end": b, "length": k, "bin": min(TOP, math.floor(-math.log10(max(p, 1e-300)) * BINS))} for a, b, k, p in x] for _, x in found]
                yield pa.RecordBatch.from_arrays([batch.column("id"), pa.array(spans, span), pa.array(tokens, token)], ["id", "base", "tokens"])

    kind = df.schema[id_col].dataType.simpleString()
    scanned = df.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    scanned = scanned.mapInArrow(run, f"id {kind}, base array<struct<start:int,end:int,kind:string>>, tokens array<struct<start:int,end:int,length:int,bin:int>>")
    scanned = written(scanned, "scanned")
    bins = scanned.select(F.explode("tokens").alias("t")).groupBy("t.length", "t.bin").agg(F.count(F.lit(1)).alias("n")).collect()  # bounded by classes x bins
    counts = {(r["length"], r["bin"]): r["n"] for r in bins}
    tested = {k: sum(n for (c, _), n in counts.items() if c == k) for k in range(len(LENGTHS))}
    least = F.array(*(F.lit(math.ceil(-math.log10(p) * BINS - 1e-9) if p > 0 else 1 << 30) for p in thresholds(counts, tested, rate)))
    kept = F.transform(F.filter("tokens", lambda t: t["bin"] >= F.get(least, t["length"])), lambda t: F.struct(t["start"].alias("start"), t["end"].alias("end"), F.lit(RANDOM).alias("kind")))
    return scanned.select(F.col("id").alias(id_col), "base", kept.alias("random"))


def op3_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = find_secrets(table(spark, sf_dir, "documents"))
    count = lambda name: F.size(F.filter("base", lambda x: x["kind"] == name)).cast("long")
    text = lambda spans: F.array_join(F.transform(spans, lambda x: F.concat_ws(":", x["kind"], x["start"].cast("string"), x["end"].cast("string"))), ",")
    ranked = F.array_sort(F.transform(F.concat("base", "random"), lambda x: F.struct(x["start"].alias("start"), F.when(x["kind"] == "assign", 0).when(x["kind"] == "access", 1).when(x["kind"] == "hex", 2).otherwise(3).alias("place"), x["end"].alias("end"), x["kind"].alias("kind"))))
    return found.select("doc_id", *(count(k).alias(f"n_{k}") for k in BASE), F.sha2(text(F.col("base")).cast("binary"), 256).alias("base_sha256"), text(ranked).alias("spans"), F.size("random").cast("long").alias("n_random"))

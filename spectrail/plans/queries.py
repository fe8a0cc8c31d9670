"""One query for each operator, on the driver's tables, and the SQL that must give the same rows."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from spectrail.functions import peptide, text
from spectrail.operators import cache, lookup, match, modifications, ranges, retention, similarity
from spectrail.plans import build, correlate
from spectrail.plans.predictors import TableFragments
from spectrail.schemas import FEATURES, ROW_ID, RT_BEST, RT_FEATURES, SPECTRAL_FEATURES
from spectrail.sources import sinks, spectra, tables

Query = Callable[[SparkSession, str], DataFrame]
_QUERIES: dict[str, Query] = {}
_SQL: dict[str, str] = {}


def queries() -> dict[str, Query]:
    return dict(_QUERIES)


def oracle_sql() -> dict[str, str]:
    return dict(_SQL)


def query(sql: str):
    def keep(f: Query) -> Query:
        _QUERIES[f.__name__], _SQL[f.__name__] = f, sql
        return f

    return keep


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def six(c: Column | str, name: str) -> Column:
    """Six decimals, and no negative zero."""
    return (F.round(F.col(c) if isinstance(c, str) else c, 6) + F.lit(0.0)).alias(name)


# --- similarity of consecutive vectors: the first 32 components are scope b, the others y


def vector_ions(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = table(spark, sf_dir, "embeddings").select("vec_id", "embedding")
    other = e.select((F.col("vec_id") - 1).alias("vec_id"), F.col("embedding").alias("other"))
    rows = e.join(other, "vec_id").select(F.col("vec_id").alias("pair_id"), F.posexplode(F.arrays_zip("embedding", "other")).alias("i", "z"))
    return rows.select("pair_id", F.when(F.col("i") < 32, "b").otherwise("y").alias("ion"), F.col("z.embedding").cast("double").alias("predicted"), F.col("z.other").cast("double").alias("observed"))


_VALUES = """
WITH p AS (SELECT a.vec_id AS pair_id, unnest(range(1, len(a.embedding) + 1)) AS i, a.embedding AS ea, b.embedding AS eb FROM embeddings a JOIN embeddings b ON b.vec_id = a.vec_id + 1),
v AS (SELECT pair_id, CASE WHEN i <= 32 THEN 'b' ELSE 'y' END AS ion, ea[i]::DOUBLE AS x, eb[i]::DOUBLE AS y FROM p),
l AS (SELECT *, pow(2, x) - 0.001::DOUBLE AS xl, pow(2, y) - 0.001::DOUBLE AS yl FROM v),
r AS (SELECT *,
  rank() OVER (PARTITION BY pair_id ORDER BY xl) + (count(*) OVER (PARTITION BY pair_id, xl) - 1) / 2.0::DOUBLE AS rx_spec,
  rank() OVER (PARTITION BY pair_id ORDER BY yl) + (count(*) OVER (PARTITION BY pair_id, yl) - 1) / 2.0::DOUBLE AS ry_spec,
  rank() OVER (PARTITION BY pair_id, ion ORDER BY xl) + (count(*) OVER (PARTITION BY pair_id, ion, xl) - 1) / 2.0::DOUBLE AS rx_ion,
  rank() OVER (PARTITION BY pair_id, ion ORDER BY yl) + (count(*) OVER (PARTITION BY pair_id, ion, yl) - 1) / 2.0::DOUBLE AS ry_ion FROM l)
"""


def _feature_sql(name: str) -> str:
    body, linear = name.removesuffix("_norm"), not name.endswith("_norm")
    scope = next((s for s in ("ionb", "iony") if s in name.split("_")), "spec")
    only = "" if scope == "spec" else f" FILTER (WHERE ion = '{scope[-1]}')"
    x, y = ("xl", "yl") if linear else ("x", "y")
    if "spearman" in body:
        x, y = ("rx_spec", "ry_spec") if scope == "spec" else ("rx_ion", "ry_ion")
    if "pearson" in body or "spearman" in body:
        return f"corr({x}, {y}){only}"
    if "iontype" in body:
        kind, sign = body[:3], "<=" if body.startswith("min") else ">="
        b, o = (f"{kind}(abs(xl - yl)) FILTER (WHERE ion = '{i}')" for i in "by")
        return f"CASE WHEN {b} {sign} {o} THEN 0.0::DOUBLE ELSE 1.0::DOUBLE END"
    if "dotprod" in body:
        return f"sum({x} * {y}){only}"
    if body.startswith("cos"):
        return f"sum({x} * {y}){only} / sqrt(sum({x} * {x}){only} * sum({y} * {y}){only})"
    if "_Q" in body:
        return f"quantile_cont(abs({x} - {y}), {int(body[-1]) / 4}){only}"
    if "mse" in body:
        return f"avg(({x} - {y}) * ({x} - {y})){only}"
    kind = next(k for k in ("mean", "std", "min", "max") if k in body.split("_"))
    return f"{ {'mean': 'avg', 'std': 'stddev_pop'}.get(kind, kind)}(abs({x} - {y})){only}"


def _similarity(name: str, columns: list[str]) -> None:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        out = similarity.similarity(vector_ions(spark, sf_dir), ["pair_id"], tuple(columns))
        return out.select("pair_id", *(six(c, c) for c in columns))

    run.__name__ = name
    query(_VALUES + "SELECT pair_id, " + ", ".join(f"round(coalesce({_feature_sql(c)}, 0), 6) + 0.0::DOUBLE AS {c}" for c in columns) + " FROM r GROUP BY pair_id")(run)


_has = lambda *words: [c for c in SPECTRAL_FEATURES if any(w in c for w in words)]
_similarity("similarity_71", list(SPECTRAL_FEATURES))
_similarity("pearson_scopes", _has("pearson"))
_similarity("spearman_scopes", _has("spearman"))
_similarity("mse_scopes", _has("mse"))
_similarity("cosine_dot_scopes", _has("cos", "dotprod"))
_similarity("absdiff_summary", [c for c in _has("abs_diff") if "iontype" not in c])
_similarity("iontype_compare", _has("iontype"))


@query("SELECT o_orderkey, round(log2(o_totalprice + 0.001::DOUBLE), 6) AS log2_value, round(pow(2, log2(o_totalprice + 0.001::DOUBLE)) - 0.001::DOUBLE, 4) AS linear_value FROM orders")
def log2_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    value = text.log2_intensity(F.col("o_totalprice"))
    return table(spark, sf_dir, "orders").select("o_orderkey", F.round(value, 6).alias("log2_value"), F.round(text.linear_intensity(value), 4).alias("linear_value"))


# --- matching: a user's events are peaks, shifted copies of them the ions


def event_match(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = table(spark, sf_dir, "events")
    peaks = events.select("user_id", F.col("value").alias("mz"), (F.col("event_id") % 1000 + 1).cast("double").alias("intensity"), F.col("event_id").alias("peak_index"))
    ions = events.select("user_id", "event_id", (F.col("value") + (F.col("event_id") % 7 - 3) * F.lit(0.01)).alias("mz"))
    return match.nearest_peaks(ions, peaks, "user_id", 0.5)


_MATCH = """
WITH peaks AS (SELECT user_id, value AS mz, max(event_id) AS hi, min(event_id) AS lo FROM events GROUP BY ALL),
ions AS (SELECT user_id, event_id, value + (event_id % 7 - 3) * 0.01::DOUBLE AS mz FROM events),
a AS (SELECT i.*, p.mz AS low, p.hi AS low_id FROM ions i ASOF LEFT JOIN peaks p ON p.user_id = i.user_id AND i.mz > p.mz),
b AS (SELECT a.*, p.mz AS high, p.lo AS high_id FROM a ASOF LEFT JOIN peaks p ON p.user_id = a.user_id AND a.mz <= p.mz),
m AS (SELECT user_id, event_id, CASE WHEN low IS NULL OR high IS NULL OR mz <= 0 THEN 0.0::DOUBLE
  WHEN mz - low <= high - mz AND mz - low < 0.5::DOUBLE THEN log2(low_id % 1000 + 1 + 0.001::DOUBLE)
  WHEN high - mz < mz - low AND high - mz < 0.5::DOUBLE THEN log2(high_id % 1000 + 1 + 0.001::DOUBLE) ELSE 0.0::DOUBLE END AS observed FROM b)
"""


@query(_MATCH + "SELECT user_id, event_id, round(observed, 6) AS observed FROM m")
def nearest_peak_match(spark: SparkSession, sf_dir: str) -> DataFrame:
    return event_match(spark, sf_dir).select("user_id", "event_id", F.round("observed", 6).alias("observed"))


@query(_MATCH + ", h AS (SELECT user_id, max((observed > 0)::INT) AS hit FROM m GROUP BY user_id) SELECT sum(hit)::BIGINT AS matched, count(*) AS total, round(sum(hit) / count(*)::DOUBLE, 6) AS fraction FROM h")
def match_fraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return match.match_fraction(event_match(spark, sf_dir), "user_id").withColumn("fraction", F.round("fraction", 6))


@query(_VALUES + ", c AS (SELECT pair_id, coalesce(corr(x, y), 0) AS c FROM r GROUP BY pair_id) SELECT round(quantile_cont(c, 0.5), 6) + 0.0::DOUBLE AS median_correlation, count(*) AS n FROM c")
def median_correlation(spark: SparkSession, sf_dir: str) -> DataFrame:
    got = similarity.correlation(vector_ions(spark, sf_dir), ["pair_id"])
    return got.agg(six(F.percentile("correlation", F.lit(0.5)), "median_correlation"), F.count("correlation").alias("n"))


# --- text


_TITLES = """CASE c_custkey % 7 WHEN 0 THEN 'run.' || c_custkey || '.' || c_custkey || '.2' WHEN 1 THEN 'x Scan=' || c_custkey || ' end'
  WHEN 2 THEN ' ' || c_custkey || ' ' WHEN 3 THEN 'a.' || c_custkey || '.' || (c_custkey + 1) || '.z' WHEN 4 THEN c_name WHEN 5 THEN 'a1 b' || c_custkey ELSE 'scans: ' || c_custkey END"""


@query(f"""WITH t AS (SELECT c_custkey, trim({_TITLES}) AS t FROM customer), p AS (SELECT *, string_split(t, '.') AS p, regexp_extract_all(t, '[0-9]+') AS d FROM t)
SELECT c_custkey, coalesce(try_cast(regexp_extract(t, '(?i)(?:^|[^0-9])scans?[ =:]+([0-9]+)(?:[^0-9]|$)', 1) AS BIGINT), try_cast(regexp_extract(t, '^([0-9]+)$', 1) AS BIGINT),
  CASE WHEN regexp_matches(p[2], '^[0-9]+$') AND regexp_matches(p[3], '^[0-9]+$') AND (p[2] = p[3] OR len(p) >= 4) THEN p[2]::BIGINT END,
  CASE WHEN len(d) = 1 THEN d[1]::BIGINT END) AS scan FROM p""")  # fmt: skip
def title_scan_cascade(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "customer").select("c_custkey", text.scan_from_title(F.expr(_TITLES)).alias("scan"))


@query("SELECT page_id, CASE WHEN regexp_matches(url_decode(url), '([0-9]+)') THEN regexp_extract(url_decode(url), '([0-9]+)', 1) ELSE url_decode(url) END AS identifier, url_decode(url) AS decoded FROM pages")
def id_normalise(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "pages").select("page_id", text.normal_id(F.col("url"), "([0-9]+)").alias("identifier"), text.normal_id(F.col("url")).alias("decoded"))


@query("SELECT l_orderkey, l_linenumber, ((l_linenumber - 1) % 6 + 1)::INTEGER AS charge FROM lineitem")
def charge_decode(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", *(((F.col("l_linenumber") - 1) % 6 + 1 == z).cast("int").alias(f"Charge{z}") for z in range(1, 7)))
    return rows.select("l_orderkey", "l_linenumber", peptide.decode_charge(rows.columns).alias("charge"))


_LETTERS = "translate(CAST(c_custkey AS STRING), '0123456789', 'ACDEFGHIKL')"
_PEPTIDE = f"CASE WHEN c_custkey % 2 = 0 THEN '[U:1]-' ELSE '' END || {_LETTERS} || 'M[U:35]UK' || CASE WHEN c_custkey % 3 = 0 THEN '-[U:2]' ELSE '' END"


@query(f"""SELECT c_custkey, {_LETTERS} || 'MUK' AS sequence, length({_LETTERS}) || ':35' || CASE WHEN c_custkey % 2 = 0 THEN ';' || (length({_LETTERS}) + 3) || ':1' ELSE '' END
  || CASE WHEN c_custkey % 3 = 0 THEN ';-1:2' ELSE '' END AS var_mod_sites FROM customer""")  # fmt: skip
def peptide_parse(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "customer").select("c_custkey", peptide.parse_peptide(F.expr(_PEPTIDE)).alias("p")).select("c_custkey", "p.*")


@query("""SELECT o_orderkey, o_orderkey % 2 || '|' || o_orderstatus || '||' || (o_orderkey % 3 + 1) AS precursor_key,
  'run|' || o_orderkey || '|' || o_orderstatus || '|' || (o_orderkey % 3 + 1) || '|' || o_orderkey % 2 AS psm_key,
  'A[UNIMOD:35]' || o_orderstatus || '/' || (o_orderkey % 3 + 1) AS proforma, o_orderkey * 10 + o_orderkey % 3 + 1 AS precursor_id FROM orders""")  # fmt: skip
def key_build(spark: SparkSession, sf_dir: str) -> DataFrame:
    label, charge = F.col("o_orderkey") % 2, F.col("o_orderkey") % 3 + 1
    return table(spark, sf_dir, "orders").select(
        "o_orderkey", peptide.precursor_key(label, F.col("o_orderstatus"), F.lit(""), charge).alias("precursor_key"),
        peptide.psm_key(F.lit("run"), F.col("o_orderkey"), F.col("o_orderstatus"), charge, label).alias("psm_key"),
        peptide.proforma(F.concat(F.lit("A[U:35]"), "o_orderstatus"), charge).alias("proforma"), peptide.precursor_id(F.col("o_orderkey"), charge).alias("precursor_id"))


@query("SELECT p_partkey, printf('%.10g', p_retailprice / 7.0::DOUBLE) AS price, printf('%.10g', p_size * 1e-7::DOUBLE) AS small, printf('%.10g', p_partkey * 1e11::DOUBLE) AS large FROM part")
def format_10g(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "part").select("p_partkey", text.format_10g(F.col("p_retailprice") / 7.0).alias("price"), text.format_10g(F.col("p_size") * F.lit(1e-7)).alias("small"), text.format_10g(F.col("p_partkey") * F.lit(1e11)).alias("large"))


# --- prediction store: customers stand in for peptides, parts for their variants (three a peptide), suppliers for predictions.
# There are fewer parts and suppliers than customers need, so some variants and predictions are missing.

_ASK = """SELECT o_orderkey, 'k' || o_orderkey AS precursor_key, CASE WHEN o_custkey % 2 = 0 THEN 1 ELSE -1 END AS label, 'P' || o_custkey AS sequence,
  CASE WHEN o_orderkey % 3 = 0 THEN '' ELSE o_orderkey % 3 || ':35' END AS var_mod_sites_unimod, CAST(o_orderkey % 3 + 1 AS INTEGER) AS charge FROM orders"""
_PEP = "SELECT c_custkey AS peptide_id, 'P' || c_custkey AS pep_seq, c_custkey % 2 = 0 AS is_target FROM customer"
_VAR = """SELECT p_partkey AS variant_id, p_partkey // 3 AS peptide_id, p_partkey // 3 % 2 = 0 AS is_target, CASE WHEN p_partkey % 3 = 0 THEN '' ELSE p_partkey % 3 || ':35' END AS var_mod_sites_unimod,
  CASE WHEN p_partkey % 5 = 0 THEN '0:4' END AS fixed_mod_sites_unimod FROM part"""
_PRED = "SELECT s_suppkey * 10 + s_nationkey % 3 + 1 AS precursor_id, s_suppkey // 3 % 2 = 0 AS is_target, s_acctbal FROM supplier"
_RESOLVED = f"""WITH q AS ({_ASK}), pep AS ({_PEP}), var AS ({_VAR}), pred AS ({_PRED}),
r AS (SELECT q.*, v.variant_id, coalesce(v.fixed_mod_sites_unimod, '') AS fixed, v.variant_id * 10 + q.charge AS precursor_id, q.label = 1 AS is_target
  FROM q LEFT JOIN pep p ON p.pep_seq = q.sequence AND p.is_target = (q.label = 1)
  LEFT JOIN var v ON v.peptide_id = p.peptide_id AND v.var_mod_sites_unimod = q.var_mod_sites_unimod AND v.is_target = (q.label = 1))
"""


def store(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, lookup.Store]:
    read = lambda name: table(spark, sf_dir, name)
    ask = read("orders").select("o_orderkey", F.expr("'k' || o_orderkey").alias("precursor_key"), F.expr("CASE WHEN o_custkey % 2 = 0 THEN 1 ELSE -1 END").alias("label"), F.expr("'P' || o_custkey").alias("sequence"), F.expr("CASE WHEN o_orderkey % 3 = 0 THEN '' ELSE o_orderkey % 3 || ':35' END").alias("var_mod_sites_unimod"), F.expr("CAST(o_orderkey % 3 + 1 AS INT)").alias("charge"))
    pep = read("customer").select(F.col("c_custkey").alias("peptide_id"), F.expr("'P' || c_custkey").alias("pep_seq"), F.expr("c_custkey % 2 = 0").alias("is_target"))
    var = read("part").select(F.col("p_partkey").alias("variant_id"), F.expr("p_partkey div 3").alias("peptide_id"), F.expr("p_partkey div 3 % 2 = 0").alias("is_target"), F.expr("CASE WHEN p_partkey % 3 = 0 THEN '' ELSE p_partkey % 3 || ':35' END").alias("var_mod_sites_unimod"), F.expr("CASE WHEN p_partkey % 5 = 0 THEN '0:4' END").alias("fixed_mod_sites_unimod"), F.lit(None).cast("array<string>").alias("all_unimods"))
    pred = read("supplier").select(F.expr("s_suppkey * 10 + s_nationkey % 3 + 1").alias("precursor_id"), F.expr("s_suppkey div 3 % 2 = 0").alias("is_target"), F.array(F.col("s_nationkey")).alias("peak_code"), F.array("s_acctbal").alias("mz"), F.array("s_acctbal").alias("intensity"))
    return ask, lookup.Store(pep, var, pred, codes(spark, sf_dir))


@query(_RESOLVED + "SELECT o_orderkey, label, variant_id, precursor_id, fixed FROM r")
def resolve_chain(spark: SparkSession, sf_dir: str) -> DataFrame:
    ask, held = store(spark, sf_dir)
    return lookup.resolve(ask, held).select("o_orderkey", "label", "variant_id", "precursor_id", F.col("fixed_mod_sites_unimod").alias("fixed"))


@query(_RESOLVED + """SELECT o_orderkey, CASE WHEN variant_id IS NULL THEN 'missing_variant' WHEN s_acctbal IS NULL THEN 'missing_prediction' ELSE 'store' END AS prediction_source, round(s_acctbal, 2) AS first_mz
  FROM r LEFT JOIN pred ON pred.precursor_id = r.precursor_id AND pred.is_target = r.is_target""")  # fmt: skip
def routed_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    ask, held = store(spark, sf_dir)
    return lookup.look_up(ask, held).select("o_orderkey", "prediction_source", F.round(F.get("mz", F.lit(0)), 2).alias("first_mz"))


@query("SELECT l_orderkey::VARCHAR AS key, count(DISTINCT l_suppkey) AS n_variants FROM lineitem GROUP BY l_orderkey HAVING count(DISTINCT l_suppkey) > 1")
def ambiguous_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "lineitem").select(F.col("l_orderkey").cast("string").alias("key"), F.col("l_suppkey").alias("variant_id"))
    return lookup.ambiguous(rows, "key")


@query("SELECT doc_id, CASE WHEN l.doc_id IS NULL THEN 'missing_variant' WHEN toxic = 1 THEN 'missing_prediction' ELSE 'store' END AS status FROM (SELECT doc_id FROM documents) d LEFT JOIN (SELECT doc_id AS k, * FROM labels) l USING (doc_id)".replace("l.doc_id IS NULL", "k IS NULL"))
def status_classify(spark: SparkSession, sf_dir: str) -> DataFrame:
    labels = table(spark, sf_dir, "labels").select("doc_id", F.col("quality").alias("variant_id"), F.when(F.col("toxic") == 1, F.lit(None)).otherwise(F.col("toxic")).alias("a"))
    return table(spark, sf_dir, "documents").select("doc_id").join(labels, "doc_id", "left").select("doc_id", lookup.status(F.col("variant_id"), F.col("a")).alias("status"))


_CODES = """SELECT n_nationkey AS peak_code, CASE n_regionkey % 3 WHEN 0 THEN 'b' WHEN 1 THEN 'y' ELSE 'x' END AS ion_type, CAST(n_nationkey % 10 AS INTEGER) AS position,
  CAST(n_regionkey % 4 + 1 AS INTEGER) AS fragment_charge, CASE WHEN n_nationkey % 7 = 0 THEN 'H2O' ELSE 'none' END AS neutral_loss FROM nation"""


def codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "nation").select(F.col("n_nationkey").alias("peak_code"), F.expr("CASE n_regionkey % 3 WHEN 0 THEN 'b' WHEN 1 THEN 'y' ELSE 'x' END").alias("ion_type"), F.expr("CAST(n_nationkey % 10 AS INT)").alias("position"), F.expr("CAST(n_regionkey % 4 + 1 AS INT)").alias("fragment_charge"), F.expr("CASE WHEN n_nationkey % 7 = 0 THEN 'H2O' ELSE 'none' END").alias("neutral_loss"))


_CELLS = f"""WITH c AS ({_CODES}), z AS (SELECT vec_id, 6 + vec_id % 6 AS n, unnest(range(1, len(embedding) + 1)) AS i, embedding FROM embeddings),
f AS (SELECT vec_id, n, i, (i * 7 + vec_id) % 30 AS peak_code, embedding[i] + 0.1::FLOAT AS mz, embedding[i]::DOUBLE AS intensity FROM z),
g AS (SELECT f.*, ion_type AS ion, CASE WHEN ion_type = 'b' THEN position - 1 ELSE n - 1 - position END AS "row", fragment_charge AS frag_charge FROM f JOIN c USING (peak_code)
  WHERE neutral_loss = 'none' AND ion_type IN ('b', 'y') AND fragment_charge <= 3 AND position BETWEEN 1 AND n - 1 AND mz > 0 AND intensity > 0),
d AS (SELECT vec_id, ion, "row"::BIGINT AS "row", frag_charge, round(arg_max(mz, i)::DOUBLE, 6) AS mz, round(log2(arg_max(intensity, i) + 0.001::DOUBLE), 6) AS predicted, round(log2(arg_max(intensity, i) + 0.001::DOUBLE)::FLOAT::DOUBLE, 6) AS short FROM g GROUP BY vec_id, ion, "row", frag_charge)
"""


def scattered(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    e = table(spark, sf_dir, "embeddings").select("vec_id", F.repeat(F.lit("A"), (F.col("vec_id") % 6 + 6).cast("int")).alias("sequence"), "embedding")
    found = e.select("vec_id", "sequence", F.transform(F.sequence(F.lit(1), F.size("embedding")), lambda i: ((i * 7 + F.col("vec_id")) % 30).cast("int")).alias("peak_code"), F.transform("embedding", lambda x: x + F.lit(0.1).cast("float")).alias("mz"), F.col("embedding").alias("intensity"))
    return lookup.scatter(found, codes(spark, sf_dir), "vec_id"), found.select("vec_id", F.length("sequence").alias("length"))


@query(_CELLS + "SELECT * EXCLUDE (short) FROM d")
def array_scatter(spark: SparkSession, sf_dir: str) -> DataFrame:
    got, _ = scattered(spark, sf_dir)
    return got.select("vec_id", "ion", F.col("row").cast("long").alias("row"), "frag_charge", F.round(F.col("mz").cast("double"), 6).alias("mz"), F.round("predicted", 6).alias("predicted"))


@query(_CELLS + """, every AS (SELECT vec_id, ion, "row", unnest([1, 2, 3]) AS frag_charge FROM (SELECT vec_id, unnest(['b', 'y']) AS ion, r AS "row" FROM (SELECT vec_id, unnest(range(0, 5 + vec_id % 6)) AS r FROM embeddings)))
SELECT vec_id, ion, "row"::INTEGER AS "row", frag_charge, coalesce(mz, 0) AS mz, coalesce(short, 0) AS predicted FROM every LEFT JOIN d USING (vec_id, ion, "row", frag_charge)""")
def dense_matrices(spark: SparkSession, sf_dir: str) -> DataFrame:
    got = lookup.matrices(*scattered(spark, sf_dir), "vec_id")
    parts = [got.select("vec_id", F.lit(i).alias("ion"), F.posexplode(F.arrays_zip(f"{i}_mz", f"{i}_intensity")).alias("row", "z")).select("vec_id", "ion", "row", F.posexplode(F.arrays_zip(f"z.{i}_mz", f"z.{i}_intensity")).alias("c", "v")).select("vec_id", "ion", "row", (F.col("c") + 1).alias("frag_charge"), F.round(F.col("v")[f"{i}_mz"].cast("double"), 6).alias("mz"), F.round(F.col("v")[f"{i}_intensity"].cast("double"), 6).alias("predicted")) for i in "by"]
    return parts[0].unionByName(parts[1])


@query("SELECT vec_id, string_agg((i - 1)::VARCHAR, ',' ORDER BY v, i) AS places FROM (SELECT vec_id, i, embedding[i] AS v FROM (SELECT vec_id, embedding, unnest(range(1, len(embedding) + 1)) AS i FROM embeddings)) GROUP BY vec_id")
def peak_sort(spark: SparkSession, sf_dir: str) -> DataFrame:
    peaks = spectra.sorted_peaks(F.col("embedding"), F.col("embedding"))
    return table(spark, sf_dir, "embeddings").select("vec_id", F.array_join(peaks["peak_index"].cast("array<string>"), ",").alias("places"))


_MODS = """SELECT p_brand || '@' || CASE p_partkey % 8 WHEN 0 THEN 'Any_N-term' WHEN 1 THEN 'Protein_C-term' WHEN 2 THEN 'q^Any_N-term' WHEN 3 THEN 'K' WHEN 4 THEN 'k^Any_C-term' WHEN 5 THEN 'xx' WHEN 6 THEN 'Any_C-term' ELSE 'Q^Any_where' END AS mod_name,
  CAST(p_partkey % 50 - 5 AS BIGINT) AS unimod_id FROM part"""


@query(f"""WITH m AS ({_MODS}), s AS (SELECT DISTINCT mod_name, CASE WHEN unimod_id >= 0 THEN unimod_id END AS unimod_id, lower(split_part(mod_name, '@', 1)) AS base, split_part(mod_name, '@', 2) AS site FROM m)
SELECT mod_name, unimod_id, base, CASE site WHEN 'Any_N-term' THEN 'nterm' WHEN 'Protein_C-term' THEN 'cterm' WHEN 'Any_C-term' THEN 'cterm' WHEN 'q^Any_N-term' THEN 'nterm_residue' WHEN 'K' THEN 'residue' ELSE 'cterm_residue' END AS class,
  CASE site WHEN 'q^Any_N-term' THEN 'Q' WHEN 'K' THEN 'K' WHEN 'k^Any_C-term' THEN 'K' ELSE '' END AS residue FROM s WHERE site NOT IN ('xx', 'Q^Any_where')""")  # fmt: skip
def mod_classify(spark: SparkSession, sf_dir: str) -> DataFrame:
    name = F.expr("p_brand || '@' || CASE p_partkey % 8 WHEN 0 THEN 'Any_N-term' WHEN 1 THEN 'Protein_C-term' WHEN 2 THEN 'q^Any_N-term' WHEN 3 THEN 'K' WHEN 4 THEN 'k^Any_C-term' WHEN 5 THEN 'xx' WHEN 6 THEN 'Any_C-term' ELSE 'Q^Any_where' END")
    return modifications.classify(table(spark, sf_dir, "part").select(name.alias("mod_name"), F.expr("CAST(p_partkey % 50 - 5 AS BIGINT)").alias("unimod_id")))


@query("""WITH t AS (SELECT o_orderkey, unnest(list_filter(string_split(o_orderkey % 5 || ':35; ;-1:' || o_custkey % 90 || ';', ';'), lambda x: trim(x) <> '')) AS p FROM orders)
SELECT o_orderkey, split_part(p, ':', 1)::INTEGER AS pos, split_part(p, ':', 2)::INTEGER AS unimod FROM t""")
def mod_site_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    sites = F.expr("o_orderkey % 5 || ':35; ;-1:' || o_custkey % 90 || ';'")
    return table(spark, sf_dir, "orders").select("o_orderkey", F.inline(peptide.mod_sites(sites)))


@query(f"""SELECT c_custkey, {_LETTERS} || 'MK' AS sequence, (c_custkey % 5 + 1)::INTEGER AS charge,
  CASE WHEN c_custkey % 2 = 0 THEN 'n0:Acetyl;' ELSE '' END || 'r' || (length({_LETTERS}) + 1) || ':Oxidation' || CASE WHEN c_custkey % 3 = 0 THEN ';c-1:Amidated' ELSE '' END AS tokens FROM customer""")  # fmt: skip
def proforma_parse(spark: SparkSession, sf_dir: str) -> DataFrame:
    written = F.expr(f"CASE WHEN c_custkey % 2 = 0 THEN '[Acetyl]-' ELSE '' END || {_LETTERS} || 'M[Oxidation]K' || CASE WHEN c_custkey % 3 = 0 THEN '-[Amidated]' ELSE '' END || '/' || (c_custkey % 5 + 1)")
    got = table(spark, sf_dir, "customer").select("c_custkey", modifications.proforma_tokens(written).alias("p")).select("c_custkey", "p.*")
    return got.withColumn("tokens", F.array_join(F.transform("tokens", lambda t: F.concat(t["place"], t["position"].cast("string"), F.lit(":"), t["token"])), ";"))


_DICTIONARY = [("Oxidation@M", 35), ("Acetyl@Any_N-term", 1), ("Acetyl@Protein_N-term", 1), ("Amidated@Any_C-term", 2), ("Gln->pyro-Glu@Q^Any_N-term", 28), ("Oxidation@K^Any_C-term", 35)]


@query("""SELECT c_custkey, CASE c_custkey % 5 WHEN 0 THEN 'Oxidation@M' WHEN 1 THEN 'Acetyl@Any_N-term' WHEN 2 THEN 'Own@M' WHEN 3 THEN 'Gln->pyro-Glu@Q^Any_N-term' ELSE 'Oxidation@K^Any_C-term' END AS mod,
  CASE c_custkey % 5 WHEN 0 THEN '2' WHEN 1 THEN '0' WHEN 2 THEN '2' WHEN 3 THEN '0' ELSE '-1' END AS site FROM customer""")
def mod_resolve(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("c_custkey") % 5
    place = F.when(k == 1, "n").otherwise("r")
    position = F.when(k == 3, 1).when(k == 4, 3).otherwise(2)
    token = F.when(k == 0, "UNIMOD:35").when(k == 1, " acetyl ").when(k == 2, "Own").when(k == 3, "pyro-glu").otherwise("35")
    tokens = table(spark, sf_dir, "customer").select("c_custkey", place.alias("place"), position.alias("position"), token.alias("token"), F.lit("QMK").alias("sequence"))
    return modifications.resolve(tokens, spark.createDataFrame(_DICTIONARY, "mod_name string, unimod_id long"), ["c_custkey"]).select("c_custkey", "mod", "site")


@query("""SELECT event_id, round(CASE WHEN value < 50 THEN 5 + value * 0.5::DOUBLE WHEN value < 100 THEN 30 + (value - 50) * 0.2::DOUBLE ELSE 40 + (value - 100) * 1.5::DOUBLE END, 6) AS calibrated FROM events""")
def rt_calibrate(spark: SparkSession, sf_dir: str) -> DataFrame:
    at = [(0.0, 5.0), (50.0, 30.0), (100.0, 40.0), (200.0, 190.0)]
    return table(spark, sf_dir, "events").select("event_id", F.round(retention.calibrate(F.col("value"), at), 6).alias("calibrated"))


@query(_VALUES + "SELECT pair_id, round(coalesce(corr(x, y), 0), 6) + 0.0::DOUBLE AS correlation, count(*) FILTER (WHERE x > 0 AND ion = 'b') AS n_b_ions, count(*) FILTER (WHERE x > 0 AND ion = 'y') AS n_y_ions FROM r GROUP BY pair_id")
def pair_correlation(spark: SparkSession, sf_dir: str) -> DataFrame:
    ions = vector_ions(spark, sf_dir).withColumn(ROW_ID, F.col("pair_id")).withColumn("mz", F.col("predicted"))
    got = similarity.correlation(ions, [ROW_ID]).join(correlate.ion_counts(ions), ROW_ID)
    return got.select(F.col(ROW_ID).alias("pair_id"), six("correlation", "correlation"), "n_b_ions", "n_y_ions")


@query(f"""SELECT c_custkey, coalesce(try_cast(CASE WHEN c_custkey % 3 = 0 THEN c_custkey::VARCHAR END AS BIGINT), scan) AS scan FROM (SELECT c_custkey, t, coalesce(try_cast(regexp_extract(t, '(?i)(?:^|[^0-9])scans?[ =:]+([0-9]+)(?:[^0-9]|$)', 1) AS BIGINT), try_cast(regexp_extract(t, '^([0-9]+)$', 1) AS BIGINT)) AS scan
  FROM (SELECT c_custkey, 'x Scan=' || c_custkey || ' end' AS t FROM customer))""")  # fmt: skip
def mgf_scan_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    scans = F.expr("CASE WHEN c_custkey % 3 = 0 THEN c_custkey || ',7' WHEN c_custkey % 3 = 1 THEN 'none' END")
    return table(spark, sf_dir, "customer").select("c_custkey", text.scan_from_mgf(scans, F.expr("'x Scan=' || c_custkey || ' end'")).alias("scan"))


@query("""SELECT 'q' || o_orderkey AS identifier, o_custkey::VARCHAR AS scans, round(o_totalprice, 2) AS precursor_mz, (o_orderkey % 4 + 1)::INTEGER AS precursor_charge,
  CASE WHEN o_orderkey % 2 = 0 THEN o_orderkey + 0.5::DOUBLE END AS retention_time, 2 AS peaks, round(o_custkey + 0.25::DOUBLE, 3) AS first_mz FROM orders WHERE o_orderkey % 5 <> 0""")
def mgf_parse(spark: SparkSession, sf_dir: str) -> DataFrame:
    block = F.expr("""concat('junk\n\nBEGIN IONS\nTITLE=q', o_orderkey, '\nSCANS=', o_custkey, '\nPEPMASS=', round(o_totalprice, 2), ' 100\nCHARGE=', o_orderkey % 4 + 1, '+\n',
      CASE WHEN o_orderkey % 2 = 0 THEN concat('RTINSECONDS=', o_orderkey, '.5\n') ELSE '' END, CASE WHEN o_orderkey % 5 = 0 THEN 'bad line\n' ELSE concat(o_custkey, '.25 5\nbad line\n', o_custkey, '.5\t7 extra\n') END)""")
    got = spectra.mgf_spectra(table(spark, sf_dir, "orders").select(block.alias("value"), F.col("o_orderkey").alias("__order")))
    return got.select("identifier", "scans", F.round("precursor_mz", 2).alias("precursor_mz"), "precursor_charge", "retention_time", F.size("mz_array").alias("peaks"), F.round(F.col("mz_array")[0].cast("double"), 3).alias("first_mz"))


@query("SELECT o_orderkey, row_number() OVER () - 1 AS row_id FROM orders")
def row_numbers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tables._parquet(spark, f"{sf_dir}/orders.parquet").select("o_orderkey", F.col(ROW_ID).alias("row_id"))


@query("""SELECT p_partkey::VARCHAR AS p_partkey, printf('%.10g', p_retailprice / 7.0::DOUBLE) AS price, CASE WHEN p_partkey % 3 = 0 THEN '' ELSE printf('%.10g', (p_size * 0.1::FLOAT)::DOUBLE) END AS size,
  CASE WHEN p_partkey % 4 = 0 THEN '' ELSE p_brand END AS brand FROM part""")
def pin_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "part").select(F.col("p_partkey").alias(ROW_ID), "p_partkey", (F.col("p_retailprice") / 7.0).alias("price"), F.when(F.col("p_partkey") % 3 == 0, float("nan")).otherwise((F.col("p_size") * F.lit(0.1).cast("float")).cast("float")).cast("double").alias("size"), F.when(F.col("p_partkey") % 4 != 0, F.col("p_brand")).alias("brand"))
    return sinks.as_text(rows).drop(ROW_ID)


@query(f"""WITH s AS (SELECT c_custkey, {_LETTERS} || 'MUK' AS sequence, length({_LETTERS}) || ':35' AS mods FROM customer), k AS (SELECT *, CASE WHEN c_custkey % 2 = 0 THEN 1 ELSE -1 END AS label, (c_custkey % 3 + 1)::INTEGER AS charge FROM s)
SELECT c_custkey, charge, sequence, mods AS var_mod_sites_unimod, label || '|' || sequence || '|' || mods || '|' || charge AS precursor_key, 'r|s' || c_custkey || '|' || {_LETTERS} || 'M[U:35]UK|' || charge || '|' || label AS psm_key FROM k""")  # fmt: skip
def row_augmentation(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "customer").select("c_custkey", F.expr("'s' || c_custkey").alias("SpecId"), F.expr("CASE WHEN c_custkey % 2 = 0 THEN 1 ELSE -1 END").alias("Label"), F.expr(_LETTERS + " || 'M[U:35]UK'").alias("Peptide"), *((F.col("c_custkey") % 3 + 1 == z).cast("int").alias(f"Charge{z}") for z in (1, 2, 3)))
    return build.augment(rows, "r").select("c_custkey", "charge", "sequence", "var_mod_sites_unimod", "precursor_key", "psm_key")


@query(_RESOLVED + """SELECT o_orderkey FROM r LEFT JOIN pred ON pred.precursor_id = r.precursor_id AND pred.is_target = r.is_target WHERE s_acctbal IS NULL AND variant_id IS NOT NULL""")
def needs_local_prediction(spark: SparkSession, sf_dir: str) -> DataFrame:
    ask, held = store(spark, sf_dir)
    return build.wanting(lookup.look_up(ask, held)).select("o_orderkey")


@query(f"""WITH m AS ({_MODS}), s AS (SELECT DISTINCT mod_name, lower(split_part(mod_name, '@', 1)) AS base, split_part(mod_name, '@', 2) AS site FROM m),
c AS (SELECT mod_name, base, CASE site WHEN 'Any_N-term' THEN 'nterm' WHEN 'Protein_C-term' THEN 'cterm' WHEN 'Any_C-term' THEN 'cterm' WHEN 'q^Any_N-term' THEN 'nterm_residue' WHEN 'K' THEN 'residue' ELSE 'cterm_residue' END AS class,
  CASE site WHEN 'q^Any_N-term' THEN 'Q' WHEN 'K' THEN 'K' WHEN 'k^Any_C-term' THEN 'K' ELSE '' END AS residue FROM s WHERE site NOT IN ('xx', 'Q^Any_where'))
SELECT base, class, residue, CASE WHEN class <> 'residue' AND count(*) FILTER (WHERE regexp_matches(mod_name, 'Any_[NC]-term$')) = 1 THEN max(mod_name) FILTER (WHERE regexp_matches(mod_name, 'Any_[NC]-term$'))
  WHEN class <> 'residue' AND count(*) FILTER (WHERE regexp_matches(mod_name, 'Protein_[NC]-term$')) = 1 THEN max(mod_name) FILTER (WHERE regexp_matches(mod_name, 'Protein_[NC]-term$')) WHEN count(*) = 1 THEN max(mod_name) END AS chosen FROM c GROUP BY base, class, residue""")  # fmt: skip
def mod_candidates(spark: SparkSession, sf_dir: str) -> DataFrame:
    name = F.expr("p_brand || '@' || CASE p_partkey % 8 WHEN 0 THEN 'Any_N-term' WHEN 1 THEN 'Protein_C-term' WHEN 2 THEN 'q^Any_N-term' WHEN 3 THEN 'K' WHEN 4 THEN 'k^Any_C-term' WHEN 5 THEN 'xx' WHEN 6 THEN 'Any_C-term' ELSE 'Q^Any_where' END")
    known = modifications.classify(table(spark, sf_dir, "part").select(name.alias("mod_name"), F.lit(None).cast("long").alias("unimod_id")))
    return modifications.candidates(known, "base").select("base", "class", "residue", "chosen")


@query("""SELECT p_partkey, CASE p_partkey % 4 WHEN 0 THEN '' WHEN 1 THEN 'Oxidation@M' WHEN 2 THEN 'Acetyl@Any_N-term' ELSE 'Oxidation@M;Acetyl@Any_N-term;Amidated@Any_C-term' END AS mods,
  CASE p_partkey % 4 WHEN 0 THEN '' WHEN 1 THEN '2' WHEN 2 THEN '0' ELSE '1;0;-1' END AS mod_sites FROM part""")
def variant_mods(spark: SparkSession, sf_dir: str) -> DataFrame:
    sites = F.expr("CASE p_partkey % 4 WHEN 0 THEN '' WHEN 1 THEN '1:35' WHEN 2 THEN '3:1' ELSE '0:35;3:1;-1:2' END")
    rows = table(spark, sf_dir, "part").select("p_partkey", F.lit("MMK").alias("sequence"), modifications.variant_tokens(sites, F.lit("MMK")).alias("tokens"))
    return modifications.annotate(rows, spark.createDataFrame(_DICTIONARY, "mod_name string, unimod_id long"), "p_partkey").select("p_partkey", "mods", "mod_sites")


@query("""SELECT c_custkey, 'Own@' || CASE c_custkey % 3 WHEN 0 THEN 'Any_N-term' WHEN 1 THEN 'Q^Protein_C-term' ELSE 'K' END AS mod, CASE c_custkey % 3 WHEN 0 THEN '0' WHEN 1 THEN '-1' ELSE '2' END AS site FROM customer""")
def explicit_sites(spark: SparkSession, sf_dir: str) -> DataFrame:
    token = F.expr("'Own@' || CASE c_custkey % 3 WHEN 0 THEN 'Any_N-term' WHEN 1 THEN 'Q^Protein_C-term' ELSE 'K' END")
    tokens = table(spark, sf_dir, "customer").select("c_custkey", F.lit("r").alias("place"), F.lit(2).alias("position"), token.alias("token"), F.lit("QMK").alias("sequence"))
    return modifications.resolve(tokens, spark.createDataFrame(_DICTIONARY, "mod_name string, unimod_id long"), ["c_custkey"]).select("c_custkey", "mod", "site")


@query("""WITH peaks AS (SELECT user_id, value::FLOAT AS mz, max(event_id) AS hi, min(event_id) AS lo FROM events GROUP BY ALL),
held AS (SELECT c_custkey, unnest(range(0, 6)) AS k, abs(c_acctbal) / 100 AS base FROM customer),
ions AS (SELECT o_orderkey, o_custkey // 10 AS scan, k, (base + k * 0.3::DOUBLE)::FLOAT AS mz, k * 0.5::DOUBLE AS x FROM orders JOIN held ON c_custkey = o_custkey WHERE base + k * 0.3::DOUBLE > 0 AND o_custkey // 10 IN (SELECT user_id FROM events)),
a AS (SELECT i.*, p.mz AS low, p.hi AS low_id FROM ions i ASOF LEFT JOIN peaks p ON p.user_id = i.scan AND i.mz > p.mz),
b AS (SELECT a.*, p.mz AS high, p.lo AS high_id FROM a ASOF LEFT JOIN peaks p ON p.user_id = a.scan AND a.mz <= p.mz),
m AS (SELECT o_orderkey, k, x, CASE WHEN low IS NULL OR high IS NULL THEN 0.0::DOUBLE WHEN mz - low <= high - mz AND (mz - low)::DOUBLE < 0.5::DOUBLE THEN log2(low_id % 1000 + 1 + 0.001::DOUBLE)
  WHEN high - mz < mz - low AND (high - mz)::DOUBLE < 0.5::DOUBLE THEN log2(high_id % 1000 + 1 + 0.001::DOUBLE) ELSE 0.0::DOUBLE END AS y FROM b),
f AS (SELECT o_orderkey, avg((x - y) * (x - y)) AS mse, sum(x * y) FILTER (WHERE k >= 3) AS dot FROM m GROUP BY o_orderkey)
SELECT o_orderkey, round(coalesce(mse, 0), 6) AS spec_mse_norm, round(coalesce(dot, 0), 6) AS dotprod_iony_norm FROM orders LEFT JOIN f USING (o_orderkey)""")  # fmt: skip
def scored_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Both a spectrum and a prediction, or zeros: orders are rows, customers precursors, a user's events a spectrum, ten customers' each."""
    peaks = F.array_sort(F.collect_list(F.struct(F.col("value").cast("float").alias("mz"), F.col("event_id").alias("peak_index"), (F.col("event_id") % 1000 + 1).cast("float").alias("intensity"))))
    observed = table(spark, sf_dir, "events").groupBy(F.col("user_id").alias("scan_number")).agg(peaks.alias("peaks"))
    ion = lambda k: F.struct(F.when(k < 3, "b").otherwise("y").alias("ion"), k.alias("row"), F.lit(1).alias("frag_charge"), (F.abs("c_acctbal") / 100 + k * 0.3).cast("float").alias("mz"), (k * 0.5).alias("predicted"))
    held = table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("precursor_key"), F.transform(F.sequence(F.lit(0), F.lit(5)), ion).alias("fragments"))
    rows = table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("psm_key"), F.col("o_custkey").alias("precursor_key"), F.expr("o_custkey div 10").alias("ScanNr"))
    got = build.score(rows, held, observed, 0.5)
    return got.select(F.col("psm_key").alias("o_orderkey"), six("spec_mse_norm", "spec_mse_norm"), six("dotprod_iony_norm", "dotprod_iony_norm"))


@query("SELECT user_id, max(event_id) AS event_id, arg_max(value, event_id) AS value FROM events GROUP BY user_id")
def last_spectrum(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spectra.last_of_each(table(spark, sf_dir, "events").select("user_id", "event_id", "value"), "user_id", "event_id")


@query("SELECT o_orderkey, coalesce(c_acctbal, 0) AS observed_retention_time FROM orders LEFT JOIN customer ON c_custkey = o_custkey")
def observed_times(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All customers stand in for spectra."""
    observed = table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("scan_number"), F.col("c_acctbal").alias("rt_seconds"))
    rows = table(spark, sf_dir, "orders").select("o_orderkey", F.col("o_custkey").alias("ScanNr"))
    return build.with_observed_times(rows, observed).select("o_orderkey", "observed_retention_time")


@query("""SELECT p_partkey, round(p_retailprice, 2) AS price, CASE WHEN p_partkey % 3 = 0 THEN 'NA' ELSE p_brand END AS "Peptide",
  p_name || CASE WHEN p_partkey % 2 = 0 THEN chr(9) || p_type || chr(9) || p_size ELSE '' END AS "Proteins" FROM part""")
def pin_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    line = F.expr("concat_ws('\t', p_partkey, round(p_retailprice, 2), CASE WHEN p_partkey % 3 = 0 THEN 'NA' ELSE p_brand END, p_name, CASE WHEN p_partkey % 2 = 0 THEN concat(p_type, '\t', p_size) END, CASE WHEN p_partkey % 2 = 0 THEN '\r' END)")
    lines = table(spark, sf_dir, "part").select(F.regexp_replace(line, "\t\r$", "\r").alias("value"), F.col("p_partkey").alias("__order"))
    got = tables.text_rows(lines, ["p_partkey", "price", "Peptide", "Proteins"])
    return got.select("p_partkey", F.round("price", 2).alias("price"), "Peptide", "Proteins")


@query("SELECT o_orderkey, c_custkey % 2 AS row_number, round(c_acctbal, 2) AS mz FROM orders JOIN customer ON c_custkey = o_custkey")
def predicted_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Predictions joined by key; all customers stand in for them."""
    written = lambda c: F.expr(f"translate(CAST({c} AS STRING), '0123456789', 'ACDEFGHIKL') || 'K/2'")
    psms = table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias(ROW_ID), F.lit("s").alias("spectrum_id"), written("o_custkey").alias("peptidoform"))
    ions = table(spark, sf_dir, "customer").select(written("c_custkey").alias("precursor_key"), F.lit("b").alias("ion"), (F.col("c_custkey") % 2).alias("row"), F.lit(1).alias("frag_charge"), F.col("c_acctbal").alias("mz"), F.lit(0.5).alias("predicted"))
    return correlate.predict(psms, TableFragments(ions)).select(F.col(ROW_ID).alias("o_orderkey"), F.col("row").alias("row_number"), F.round("mz", 2).alias("mz"))


@query("""WITH peaks AS (SELECT user_id, value AS mz, max(event_id) AS hi, min(event_id) AS lo FROM events GROUP BY ALL),
ions AS (SELECT o_orderkey, o_custkey % 160 AS scan, abs(o_totalprice % 190) + 0.5::DOUBLE AS mz FROM orders),
a AS (SELECT i.*, p.mz AS low, p.hi AS low_id FROM ions i ASOF LEFT JOIN peaks p ON p.user_id = i.scan AND i.mz > p.mz),
b AS (SELECT a.*, p.mz AS high, p.lo AS high_id FROM a ASOF LEFT JOIN peaks p ON p.user_id = a.scan AND a.mz <= p.mz)
SELECT o_orderkey, round(CASE WHEN scan NOT IN (SELECT user_id FROM events) THEN NULL WHEN low IS NULL OR high IS NULL THEN 0.0::DOUBLE WHEN mz - low <= high - mz AND mz - low < 0.5::DOUBLE THEN log2(low_id % 1000 + 1 + 0.001::DOUBLE)
  WHEN high - mz < mz - low AND high - mz < 0.5::DOUBLE THEN log2(high_id % 1000 + 1 + 0.001::DOUBLE) ELSE 0.0::DOUBLE END, 6) AS observed FROM b""")
def attach_observed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Observed intensities by spectrum identifier; null where the spectrum is missing."""
    peak = F.struct(F.col("value").alias("mz"), F.col("event_id").alias("peak_index"), (F.col("event_id") % 1000 + 1).cast("double").alias("intensity"))
    observed = table(spark, sf_dir, "events").groupBy(F.concat(F.lit("scan%20"), F.col("user_id").cast("string")).alias("identifier")).agg(F.collect_list(peak).alias("peaks")).withColumn("identifier", text.normal_id(F.col("identifier")))
    ions = table(spark, sf_dir, "orders").select("o_orderkey", F.concat(F.lit("scan "), (F.col("o_custkey") % 160).cast("string")).alias("spectrum_id"), (F.abs(F.col("o_totalprice") % 190) + 0.5).alias("mz"))
    return correlate.attach(ions, observed, 0.5).select("o_orderkey", F.round("observed", 6).alias("observed"))


# --- caches


@query("SELECT lang, count(*) AS n FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels) GROUP BY lang")
def cache_miss(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents that the labels, a cache by id, lack."""
    return cache.missing(table(spark, sf_dir, "documents").select("doc_id", "lang"), table(spark, sf_dir, "labels"), "doc_id").groupBy("lang").agg(F.count(F.lit(1)).alias("n"))


@query("""WITH old AS (SELECT o_custkey AS k, max(o_orderkey) AS v FROM orders GROUP BY 1), new AS (SELECT user_id AS k, max(event_id) AS v FROM events GROUP BY 1)
SELECT k, coalesce(new.v, old.v) AS v FROM old FULL JOIN new USING (k)""")
def cache_merge_keep_last(spark: SparkSession, sf_dir: str) -> DataFrame:
    old = table(spark, sf_dir, "orders").groupBy(F.col("o_custkey").alias("k")).agg(F.max("o_orderkey").alias("v"))
    new = table(spark, sf_dir, "events").groupBy(F.col("user_id").alias("k")).agg(F.max("event_id").alias("v"))
    return cache.merge_keep_last(old, new, "k")


@query("WITH b AS (SELECT o_orderkey, o_orderstatus FROM orders), l AS (SELECT DISTINCT l_orderkey FROM lineitem WHERE l_returnflag = 'R') SELECT b.o_orderkey, CASE WHEN l_orderkey IS NULL THEN o_orderstatus ELSE 'local' END AS o_orderstatus FROM b LEFT JOIN l ON l_orderkey = o_orderkey")
def update_by_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    local = table(spark, sf_dir, "lineitem").where("l_returnflag = 'R'").select(F.col("l_orderkey").alias("o_orderkey"), F.lit("local").alias("o_orderstatus")).distinct()
    return cache.update_by_key(table(spark, sf_dir, "orders").select("o_orderkey", "o_orderstatus"), local, "o_orderkey", ["o_orderstatus"])


@query("SELECT DISTINCT o_custkey, o_orderstatus FROM orders")
def distinct_precursors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cache.distinct_keys(table(spark, sf_dir, "orders").select("o_custkey", "o_orderstatus"), "o_custkey", "o_orderstatus")


# --- retention time: events stand in for rows, users for peptides


def timed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events").select(F.col("event_id").alias(ROW_ID), "event_id", F.col("user_id").cast("string").alias("Peptide"), F.when(F.col("event_id") % 2 == 0, 1).otherwise(-1).alias("Label"), F.col("value").alias("observed_retention_time"), (F.round("value", 1)).alias("Xcorr"), (F.col("value") + (F.col("event_id") % 9 - 4) * F.lit(0.5)).alias("predicted_retention_time"))


@query("""WITH t AS (SELECT event_id, row_number() OVER (ORDER BY round(value, 1) DESC NULLS LAST, event_id) AS r, count(*) OVER () AS n FROM events WHERE event_id % 2 = 0 AND value > 0)
SELECT event_id FROM t WHERE r <= greatest(1, round_even(n * 0.15::DOUBLE, 0))""")
def topfraction_calibration(spark: SparkSession, sf_dir: str) -> DataFrame:
    return retention.calibration_set(timed(spark, sf_dir)).select("event_id")


@query("SELECT event_id, round(abs((value + (event_id % 9 - 4) * 0.5::DOUBLE)::FLOAT - value::FLOAT)::DOUBLE, 4) AS rt_diff FROM events")
def rt_diff(spark: SparkSession, sf_dir: str) -> DataFrame:
    return retention.base_features(timed(spark, sf_dir)).select("event_id", F.round(F.col("rt_diff").cast("double"), 4).alias("rt_diff"))


@query("""WITH d AS (SELECT event_id, user_id, value::FLOAT AS o, (value + (event_id % 9 - 4) * 0.5::DOUBLE)::FLOAT AS p FROM events), e AS (SELECT *, abs(p - o) AS d FROM d),
b AS (SELECT user_id, first(o ORDER BY d, event_id) AS bo, first(p ORDER BY d, event_id) AS bp, first(d ORDER BY d, event_id) AS bd FROM e GROUP BY user_id)
SELECT event_id, round(bo::DOUBLE, 4) AS observed_retention_time_best, round(bp::DOUBLE, 4) AS predicted_retention_time_best, round(bd::DOUBLE, 4) AS rt_diff_best FROM e JOIN b USING (user_id)""")
def best_per_group(spark: SparkSession, sf_dir: str) -> DataFrame:
    got = retention.best_per_peptide(retention.base_features(timed(spark, sf_dir)))
    return got.select("event_id", *(F.round(F.col(c).cast("double"), 4).alias(c) for c in RT_BEST))


@query("""WITH d AS (SELECT event_id, CASE WHEN user_id % 7 <> 0 THEN user_id END AS user_id, value::FLOAT AS o, CASE WHEN event_id % 11 <> 0 THEN (value + (event_id % 9 - 4) * 0.5::DOUBLE)::FLOAT END AS p FROM events),
e AS (SELECT event_id, user_id, o, coalesce(p, 0::FLOAT) AS p, coalesce(abs(p - o), 0::FLOAT) AS d FROM d),
b AS (SELECT user_id, first(p ORDER BY d, event_id) AS bp, first(d ORDER BY d, event_id) AS bd FROM e WHERE user_id IS NOT NULL GROUP BY user_id)
SELECT event_id, round(bp::DOUBLE, 4) AS predicted_retention_time_best, round(bd::DOUBLE, 4) AS rt_diff_best FROM e LEFT JOIN b USING (user_id)""")
def best_of_missing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows without a peptide have no best row; missing times count as 0 before the best one is chosen."""
    rows = timed(spark, sf_dir).withColumns({"Peptide": F.when(F.col("Peptide").cast("long") % 7 != 0, F.col("Peptide")), "predicted_retention_time": F.when(F.col("event_id") % 11 != 0, F.col("predicted_retention_time"))})
    got = retention.best_per_peptide(retention.base_features(rows))
    return got.select("event_id", *(F.round(F.col(c).cast("double"), 4).alias(c) for c in RT_BEST[1:]))


# --- assembly


@query("SELECT o_orderkey, o_custkey, coalesce(c_acctbal, 0) AS score, o_orderstatus AS Peptide FROM orders LEFT JOIN customer ON c_custkey = o_custkey")
def fill_and_insert(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", F.col("o_orderstatus").alias("Peptide"))
    held = table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("o_custkey"), F.col("c_acctbal").alias("score"))
    return build.with_cached(rows, held, "o_custkey", ["score"]).select(sinks.insert_before(rows.columns, ["score"]))


@query("SELECT o_orderkey, row_number() OVER () - 1 AS row_id FROM (SELECT o_orderkey FROM orders LIMIT 100)")
def head_by_row_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tables.first_rows(tables._parquet(spark, f"{sf_dir}/orders.parquet"), 100).select("o_orderkey", F.col(ROW_ID).alias("row_id"))


@query("""WITH asked AS (SELECT DISTINCT o_custkey AS k FROM orders)
SELECT count(*) AS psm_count, (SELECT count(*) FROM asked) AS precursor_count, (SELECT count(*) FROM asked JOIN customer ON c_custkey = k WHERE c_acctbal >= 0) AS store_hits,
  (SELECT count(*) FROM asked JOIN customer ON c_custkey = k WHERE c_acctbal < 0) AS local_predictions FROM orders""")
def run_counters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The build's counters: orders are rows, customers their precursors; of a negative balance they count as predicted locally."""
    precursors = table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("precursor_key"), F.when(F.col("c_acctbal") < 0, lookup.LOCAL).otherwise(lookup.FOUND).alias("prediction_source"))
    rows = table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("psm_key"), F.col("o_custkey").alias("precursor_key"))
    got = build.counters(rows, precursors)
    return spark.createDataFrame([tuple(got.values())], ", ".join(f"{k} long" for k in got))


@query(_RESOLVED + """SELECT o_orderkey, CASE WHEN variant_id IS NULL THEN 'missing_variant' WHEN s_acctbal IS NULL THEN 'missing_prediction' ELSE 'store' END AS prediction_source, round(s_acctbal, 2) AS first_mz
  FROM r LEFT JOIN pred ON pred.precursor_id = r.precursor_id AND pred.is_target = r.is_target""")  # fmt: skip
def keyed_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The lookup with its keys broadcast to the store where they are few enough, by a count."""
    ask, held = store(spark, sf_dir)
    return lookup.look_up(ask, held, ask.count() <= lookup.BROADCAST_KEYS).select("o_orderkey", "prediction_source", F.round(F.get("mz", F.lit(0)), 2).alias("first_mz"))


@query("""WITH c AS (SELECT *, event_id // 7 AS precursor_key FROM events), s AS (SELECT *, event_id - min(event_id) OVER (PARTITION BY precursor_key) AS place FROM c)
SELECT precursor_key, ion, place::INTEGER AS "row", frag_charge, round((value + frag_charge)::FLOAT::DOUBLE, 4) AS mz, round(log2(event_id % 100 + frag_charge + 0.001::DOUBLE), 6) AS predicted FROM s, (VALUES ('b', 1), ('b', 2), ('y', 1)) AS v(ion, frag_charge)""")
def range_fragments(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ranges of rows to fragments: events are rows of the fragment tables, seven in a row a precursor."""
    events, cell = table(spark, sf_dir, "events"), {"b_z1": 1, "b_z2": 2, "y_z1": 1}
    mz = events.select(F.col("event_id").alias("frag_row"), *((F.col("value") + z).alias(c) for c, z in cell.items()))
    intensity = events.select(F.col("event_id").alias("frag_row"), *((F.col("event_id") % 100 + z).alias(c) for c, z in cell.items()))
    held = events.groupBy(F.expr("event_id div 7").alias("precursor_key")).agg(F.min("event_id").alias("frag_start"), (F.max("event_id") + 1).alias("frag_stop"))
    got = ranges.from_ranges(held, mz, intensity)
    return got.select("precursor_key", "ion", "row", "frag_charge", F.round(F.col("mz").cast("double"), 4).alias("mz"), F.round("predicted", 6).alias("predicted"))


_NOISY = "value * 0.8::DOUBLE + 25 * sin(value / 3) + (event_id % 13 - 6)"


@query(f"""WITH e AS (SELECT event_id, value AS raw, {_NOISY} AS o, greatest(ceil(value / 4) - 1, 0)::BIGINT AS b FROM events),
m AS (SELECT least(b, 59) AS b, quantile_cont(raw, 0.5) AS x, quantile_cont(o, 0.5) AS y, count(*) AS w FROM e GROUP BY 1),
k AS (SELECT x, y, w, row_number() OVER (ORDER BY x) AS i FROM m),
means AS (SELECT l.i AS low, h.i AS high, sum(z.y * z.w) / sum(z.w) AS mean FROM k l JOIN k h ON h.i >= l.i JOIN k z ON z.i BETWEEN l.i AND h.i GROUP BY 1, 2),
least_of AS (SELECT k.i, low, min(mean) AS mean FROM k JOIN means ON low <= k.i AND high >= k.i GROUP BY 1, 2),
fitted AS (SELECT i, max(mean) AS y FROM least_of GROUP BY i),
knots AS (SELECT i, x, f.y FROM k JOIN fitted f USING (i)),
pieces AS (SELECT a.i, a.x, a.y, b.x AS x2, b.y AS y2, max(a.i) OVER () AS last FROM knots a JOIN knots b ON b.i = a.i + 1)
SELECT event_id, round(p.y + (raw - p.x) * (p.y2 - p.y) / (p.x2 - p.x), 6) + 0.0::DOUBLE AS calibrated
FROM e JOIN pieces p ON (raw >= p.x OR p.i = 1) AND (raw < p.x2 OR p.i = last)""")
def rt_isotonic(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Knots that never fall, fitted to times that do, and all times calibrated by them."""
    rows = table(spark, sf_dir, "events").select("event_id", F.col("value").alias("raw"), F.expr(_NOISY.replace("::DOUBLE", "D")).alias("observed_retention_time"))
    at = retention.knots(rows, cuts=[4.0 * i for i in range(1, 60)])
    return rows.select("event_id", six(retention.calibrate(F.col("raw"), at), "calibrated"))


assert len(FEATURES) == 77 and len(RT_FEATURES) == 3

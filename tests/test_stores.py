"""Prediction stores: keys staged in a database, bucketed tables, keys broadcast to the predictions."""

import re

import pytest
from pyspark.sql import functions as F

from spectrail.config import BuildConfig
from spectrail.operators import lookup
from spectrail.plans import build
from spectrail.sources import stores

from .test_reference import build_inputs

ASKED = "precursor_key string, label int, sequence string, var_mod_sites_unimod string, charge int"
N = 600


@pytest.fixture(scope="module")
def database(spark, tmp_path_factory):
    """Two sides of N peptides, two variants each (the second of every third is missing) and predictions for charge 2."""
    url = "jdbc:derby:memory:keyed;create=true"
    connection = spark.sparkContext._jvm.java.sql.DriverManager.getConnection(url)
    say = connection.createStatement()
    for side, shift in (("target", 0), ("decoy", 10 * N)):
        peptide = spark.range(N).select((F.col("id") + shift).alias("PEPTIDE_ID"), F.concat(F.lit("P"), F.col("id").cast("string")).alias("PEP_SEQ"))
        variant = spark.range(2 * N).where("id % 6 <> 5").select((F.col("id") + shift).alias("VARIANT_ID"), (F.expr("id div 2") + shift).alias("PEPTIDE_ID"), F.when(F.col("id") % 2 == 0, "").otherwise("0:35").alias("VAR_MOD_SITES_UNIMOD"), F.lit("1:4").alias("FIXED_MOD_SITES_UNIMOD"))
        prediction = spark.range(2 * N).select(((F.col("id") + shift) * 10 + 2).alias("PRECURSOR_ID"), *((F.col("id") + shift).cast("double").alias(c) for c in ("PEAK_CODE", "MZ", "INTENSITY")))
        for name, df in (("peptide", peptide), ("variant", variant), ("prediction", prediction)):
            kinds = ", ".join(f"{c} VARCHAR(60)" if k == "string" else f"{c} {'BIGINT' if k == 'bigint' else 'DOUBLE'}" for c, k in df.dtypes)
            say.executeUpdate(f"CREATE TABLE APP.{side}_{name} ({kinds})")
            say.executeUpdate(f"CREATE INDEX APP.{side}_{name}_by ON APP.{side}_{name} ({df.columns[name != 'prediction']})")
            df.coalesce(1).write.format("jdbc").options(url=url, dbtable=f"APP.{side}_{name}", user="APP").mode("append").save()
    say.executeUpdate("CREATE TABLE APP.fragment_peak_codes (peak_code INT, ion_type VARCHAR(1))")
    password = tmp_path_factory.mktemp("db") / "password"
    password.write_text("secret\n")
    return stores.jdbc_store(spark, url, "APP", "APP", str(password), partitions=3), say


def lower(store):
    """Derby's names are upper case; a variant has an array there, but not in Derby."""
    for t in stores.STORE_TABLES:
        df = getattr(store, t)
        setattr(store, t, df.select(*(F.col(c).alias(c.lower()) for c in df.columns)))
    store.variant = store.variant.withColumn("all_unimods", F.lit(None).cast("array<string>"))
    return store


def asked(spark, n=20):
    rows = [(f"t{i}", 1 if i % 2 else -1, f"P{i * 2}", "" if i % 3 else "0:35", 2 if i % 5 else 3) for i in range(n)]
    rows += [("none", 1, "NONE", "", 2), ("null", 1, None, "", 2), ("sites", 1, "P6", None, 2), ("charge", 1, "P6", "", None), ("again", 1, "P6", "", 2)]
    return spark.createDataFrame(rows, ASKED)


def answers(df):
    return sorted((r.precursor_key, r.variant_id, r.precursor_id, r.prediction_source, r.mz, r.fixed_mod_sites_unimod) for r in df.collect())


def tables_of(say):
    found = say.executeQuery("SELECT TABLENAME FROM SYS.SYSTABLES WHERE TABLETYPE = 'T'")
    names = set()
    while found.next():
        names.add(found.getString(1))
    return names


def test_keys_are_staged_and_rows_follow_them(spark, database):
    held, say = database
    before = tables_of(say)
    counts = {}
    for n in (20, 200):
        queries = asked(spark, n)
        found = held.for_keys(queries)
        assert len(tables_of(say)) == len(before) + 2
        counts[n] = [getattr(found, t).count() for t in stores.STORE_TABLES]
        assert [getattr(found, t).distinct().count() for t in stores.STORE_TABLES] == counts[n]  # no row comes from two parts
        got = answers(lookup.look_up(queries, lower(found)))
        if n == 20:
            whole = lower(lookup.Store(held.peptide, held.variant, held.prediction, held.codes))
            want = answers(lookup.look_up(queries, whole))
            assert got == want and {x[3] for x in want} == {"store", "missing_variant", "missing_prediction"}
        found.close()
        assert tables_of(say) == before
    small, large = counts.values()
    assert max(small) <= 25 and 8 < large[0] / small[0] < 11 and sum(large) < N  # rows fetched, of 10 N that the store has


def test_nothing_asked(spark, database):
    held, say = database
    found = held.for_keys(spark.createDataFrame([], ASKED))
    assert [getattr(found, t).count() for t in stores.STORE_TABLES] == [0, 0, 0]
    found.close()


@pytest.fixture(scope="module")
def plain(spark):
    n = 20_000
    side = (F.col("id") % 2 == 0).alias("is_target")
    pep = spark.range(n).select("id", side).select(F.col("id").alias("peptide_id"), F.concat(F.lit("P"), F.col("id").cast("string")).alias("pep_seq"), "is_target")
    var = spark.range(n).select(F.col("id").alias("variant_id"), F.col("id").alias("peptide_id"), F.lit("").alias("var_mod_sites_unimod"), F.lit(None).cast("string").alias("fixed_mod_sites_unimod"), F.array(F.lit("4")).alias("all_unimods"), side)
    pred = spark.range(n).where("id % 4 <> 1").select((F.col("id") * 10 + 2).alias("precursor_id"), F.array(F.lit(1)).alias("peak_code"), F.array(F.col("id") + 0.5).alias("mz"), F.array(F.lit(1.0)).alias("intensity"), side)
    codes = spark.createDataFrame([(1, "b", 1, 1, "none")], "peak_code int, ion_type string, position int, fragment_charge int, neutral_loss string")
    return lookup.Store(pep, var, pred, codes)


def questions(spark, n):
    return spark.range(n).select(F.concat(F.lit("k"), F.col("id").cast("string")).alias("precursor_key"), F.when(F.col("id") % 3 == 0, -1).otherwise(1).alias("label"), F.concat(F.lit("P"), (F.col("id") * 3).cast("string")).alias("sequence"), F.when(F.col("id") % 7 != 0, "").otherwise("0:35").alias("var_mod_sites_unimod"), F.lit(2).alias("charge"))


def path_to(plan, table):
    """Operators above a table's scan, up to the next join."""
    lines = plan.splitlines()
    at = next(i for i, x in enumerate(lines) if table in x and "Scan" in x)
    above, depth = [], len(re.match(r"[ :+\-|*()0-9]*", lines[at])[0])
    for x in reversed(lines[:at]):
        own = len(re.match(r"[ :+\-|*()0-9]*", x)[0])
        if own < depth:
            depth = own
            above.append(x.strip(" :+-*|"))
    return above


def test_bucketed_store_is_not_shuffled(spark, plain, tmp_path):
    held = stores.write_store(plain, f"{tmp_path}/store", 6)
    again = stores.parquet_store(spark, f"{tmp_path}/store")
    assert held.bucketed and again.bucketed and again.prediction.count() == 15_000
    queries = questions(spark, 3000)
    want = answers(lookup.look_up(queries, plain))
    assert {x[3] for x in want} == {"store", "missing_variant", "missing_prediction"}
    threshold = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")  # a real store is beyond it
    try:
        for ask, few in ((queries, False), (queries, True)):
            got = lookup.look_up(ask, again, few)
            plan = got._jdf.queryExecution().executedPlan().toString()
            for t in stores.STORE_TABLES:
                above = path_to(plan, stores._name(f"{tmp_path}/store", t))
                until = next(i for i, x in enumerate(above) if "Join" in x and ("LeftOuter" in x or "LeftSemi" in x))
                assert not any("Exchange" in x for x in above[: until + 1]), above[: until + 1]
            assert ("BroadcastHashJoin" in plan) == few
            assert answers(got) == want
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)


def test_few_keys_pass_by_a_plain_store(spark, plain, tmp_path):
    for t in (*stores.STORE_TABLES, "codes"):
        getattr(plain, t).write.parquet(f"{tmp_path}/{t}")
    held, queries = stores.parquet_store(spark, str(tmp_path)), questions(spark, 100)
    assert not held.bucketed and held.mark != stores.parquet_store(spark, str(tmp_path / "..") + f"/{tmp_path.name}").mark.replace("/../", "/x/")
    assert answers(lookup.look_up(queries, held, True)) == answers(lookup.look_up(queries, plain))


class Counting(lookup.Store):
    """Says how often it is asked, and for how many keys."""

    def for_keys(self, queries):
        self.asked = [*getattr(self, "asked", []), queries.count()]
        return self

    def close(self):
        self.closed = True


def test_build_asks_a_store_once_for_what_its_cache_lacks(spark, plain, tmp_path):
    _, times = build_inputs(spark, tmp_path)
    pep = spark.createDataFrame([(1, "PEPK", True), (2, "DECK", False)], "peptide_id long, pep_seq string, is_target boolean")
    var = spark.createDataFrame([(10, 1, "", True), (20, 2, "", False)], "variant_id long, peptide_id long, var_mod_sites_unimod string, is_target boolean").withColumns({"fixed_mod_sites_unimod": F.lit(None).cast("string"), "all_unimods": F.lit(None).cast("array<string>")})
    pred = spark.createDataFrame([(102, True, [1], [100.0], [0.5])], "precursor_id long, is_target boolean, peak_code array<int>, mz array<double>, intensity array<double>")
    held = Counting(pep, var, pred, plain.codes)
    config = BuildConfig(f"{tmp_path}/r.pin.gz", f"{tmp_path}/r.mgf", f"{tmp_path}/out", "r")
    first = build.build_pin(spark, config, held, times=times)
    assert (first.store_hits, first.local_predictions, first.precursor_count, first.spectral_misses) == (1, 0, 3, 4) and held.asked == [3] and held.closed
    again = build.build_pin(spark, config, held, times=times)
    assert held.asked == [3] and (again.store_hits, again.spectral_hits) == (1, 4)

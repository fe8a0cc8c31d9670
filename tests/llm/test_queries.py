"""The registered queries on tables of odd rows with clashing columns, against brute force of what each must return."""

import hashlib
import random
import re
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from spectrail.llm import bpe, language, pii, registry, sharding

from . import fixtures
from .test_first import brute_pii, pii_texts
from .test_jaccard import linked, shingles
from .test_scans import brute as brute_secrets
from .test_scans import secret_texts
from .test_substrings import brute as brute_repeats

#: Columns that operators use inside or return.
CLASHING = ("share", "score", "shard", "slot", "rejected", "n", "pii", "lang_pred", "key", "block", "token", "label", "cuts", "spans", "fraction", "rank", "size", "place", "__row", "__found", "base", "row")


def documents():
    r = random.Random(11)
    data = [(x[0], x[1], x[2], x[3]) for x in fixtures.rows()]
    one, two = fixtures.thue_morse()
    texts = [*secret_texts()[:60], *pii_texts()[:60], one, two, " ".join(["p", one] * 8), " ".join(["p", two] * 8), "the <|endoftext|> end", "x  \ty\r\n\x0bz\x0c"]
    texts += [" ".join(f"w{r.randrange(50)}" for _ in range(r.randint(0, 90))) for _ in range(30)]
    data += [(1000 + i, t, r.choice(["en", "de", None]), r.choice(["a", "hot", None])) for i, t in enumerate(texts)]
    items = [(i, " ".join(r.choice(["Alpha", "of", "x1", "42", "ñandú"]) for _ in range(k))) for i, k in enumerate((2, 4, 9, 30, 60))] + [(90, None), (91, "")]
    data += [(2000 + i, f"before, {t.upper() if t else t}; after", "en", "a") for i, t in items[:5]]
    return data, items


@pytest.fixture(scope="module")
def tables(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("tables"))
    data, items = documents()
    df = spark.createDataFrame(data, "doc_id long, text string, lang string, source string").withColumn("n_chars", F.length("text").cast("long"))
    df.withColumns({c: F.lit("x") for c in CLASHING}).repartition(5).write.parquet(f"{path}/documents.parquet")
    spark.createDataFrame(items, "item_id long, text string").withColumn("need", F.lit(0)).write.parquet(f"{path}/benchmark.parquet")
    rnd = np.random.default_rng(2)
    vectors = rnd.normal(size=(130, 8))
    vectors[60:90] = vectors[50]
    rows = [(i, [float(x) for x in v], 1) for i, v in enumerate(vectors)] + [(150, None, 1), (151, [None] * 8, 1), (152, [float("inf")] * 8, 1), (200, [0.5] * 8, 1)]
    spark.createDataFrame(rows, "vec_id long, embedding array<double>, score int").write.parquet(f"{path}/embeddings.parquet")
    return path, data, items, rows


def result(spark, tables, name):
    return registry.queries()[name](spark, tables[0]).collect()


def test_op1(spark, tables):
    got = result(spark, tables, "op1_interleaved_shards")
    texts = {d[0]: (d[1] or "").encode() for d in tables[1]}
    assert sorted(r.doc_id for r in got) == sorted(texts) and {r.law for r in got} == {"rows"} and {r.grown_shard for r in got} == {None}
    assert all((r["size"], r.text_crc32) == (len(texts[r.doc_id]) + 1, zlib.crc32(texts[r.doc_id])) for r in got)
    sizes = [sorted(r.slot for r in got if r.shard == s) for s in range(8)]
    assert all(s == list(range(len(s))) for s in sizes) and max(map(len, sizes)) - min(map(len, sizes)) <= 1
    assert {r.shard for r in got} == set(range(8))


def test_op2(spark, tables):
    whole = {i: [int(np.floor(256 * x)) for x in v] for i, v, _ in tables[3] if v and all(x is not None and np.isfinite(x) for x in v)}
    want = set()
    for q in (q for q in whole if q % 50 == 0):
        best = sorted((-sum(a * b for a, b in zip(whole[q], v, strict=True)), i) for i, v in whole.items() if i != q)[:5]
        want |= {(q, n, i, -s) for n, (s, i) in enumerate(best, 1)}
    assert {(r.query_id, r["rank"], r.vec_id, r.score) for r in result(spark, tables, "op2_top_k")} == want


def test_op3(spark, tables):
    got = {r.doc_id: r for r in result(spark, tables, "op3_secrets")}
    assert len(got) == len(tables[1])
    for doc_id, text, *_ in tables[1]:
        r, base = got[doc_id], brute_secrets(text or "")
        assert [r.n_assign, r.n_access, r.n_hex] == [sum(x.startswith(k) for x in base) for k in ("assign:", "access:", "hex:")]
        assert r.base_sha256 == hashlib.sha256(",".join(base).encode()).hexdigest()
        spans = r.spans.split(",") if r.spans else []
        assert [x for x in spans if not x.startswith("random:")] == base and len(spans) == len(base) + r.n_random
        assert [int(x.split(":")[1]) for x in spans] == sorted(int(x.split(":")[1]) for x in spans)


def test_op4(spark, tables):
    got = {r.doc_id: r for r in result(spark, tables, "op4_language")}
    for doc_id, text, *_ in tables[1]:
        r = got.pop(doc_id)
        assert r.held_out == (zlib.crc32(str(doc_id).encode()) % 3 == 1) and 0 <= r.score <= 1
        lettered = any(c.isalpha() for c in text or "")
        assert (r.lang_pred in {"en", "de"}) if lettered else (r.lang_pred, r.score) == ("und", 0.0)
    assert not got


def test_op5(spark, tables):
    import public_tokenizers
    from tokenizers import Tokenizer

    model, start = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json")), 0
    got = {r.doc_id: (r.start, r.n_tokens, r.ids_crc32) for r in result(spark, tables, "op5_token_files")}
    for doc_id, text, *_ in sorted(tables[1], key=lambda d: d[0]):
        ids = np.array([*model.encode(text or "", add_special_tokens=False).ids, 2], "<u4")
        assert got.pop(doc_id) == (start, len(ids), zlib.crc32(ids.tobytes()))
        start += len(ids)
    assert not got


def test_op6(spark, tables):
    got = sorted(tuple(r)[:4] for r in result(spark, tables, "op6_substrings"))
    assert got == sorted(brute_repeats([d[:2] for d in tables[1]], 13))


def test_op7(spark, tables):
    got = {r.doc_id: r for r in result(spark, tables, "op7_pii")}
    names = [k.name for k in pii.KINDS if k.base]
    for doc_id, text, *_ in tables[1]:
        r, base = got.pop(doc_id), brute_pii(text or "")
        assert [r[f"n_{k}"] for k in names] == [sum(x.startswith(k + ":") for x in base) for k in names]
        assert r.base_sha256 == hashlib.sha256(",".join(base).encode()).hexdigest()
        assert [x for x in r.spans.split(",") if x.split(":")[0] in names] == base
    assert not got


def test_op8(spark, tables):
    import public_tokenizers

    encode = bpe.rank_encoder(public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN).encode_ordinary
    got = {r.doc_id: (r.n_tokens, r.ids_sha256, r.decoded_sha256) for r in result(spark, tables, "op8_bpe_round_trip")}
    for doc_id, text, *_ in tables[1]:
        ids = encode(text or "")
        assert got.pop(doc_id) == (len(ids), hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest(), hashlib.sha256((text or "").encode()).hexdigest())
    assert not got


def test_op9(spark, tables):
    norm = lambda t: [w for w in re.split(r"[\W_]+", (t or "").lower()) if w]
    grams = lambda w, n: {tuple(w[x : x + n]) for x in range(len(w) - n + 1)}
    want = set()
    for item_id, item in tables[2]:
        n = min(5, len(norm(item)))
        own = grams(norm(item), n) if n else set()
        for doc_id, text, *_ in tables[1]:
            shared = len(own & grams(norm(text), n)) if own else 0
            if own and shared * 5 >= len(own) * 4:
                want.add((doc_id, item_id, len(own), shared))
    assert {(r.doc_id, r.item_id, r.n_item, r.n_shared) for r in result(spark, tables, "op9_decontamination")} == want
    assert {(2000 + i, i) for i in range(5)} <= {x[:2] for x in want}


def test_op10(spark, tables):
    sets = [shingles(d[1], 4) for d in tables[1]]
    label, ids = linked(sets, 85, 100), [d[0] for d in tables[1]]
    least = {k: min(i for i, x in zip(ids, label, strict=True) if x == k) for k in set(label)}
    want = {i: (len(s), least[k]) for i, s, k in zip(ids, sets, label, strict=True)}
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in result(spark, tables, "op10_jaccard_join")} == want


def test_clashing_columns(spark, tables, tmp_path):
    """Operators that pass rows on keep every other column; those that write them replace their own names."""
    df = spark.read.parquet(f"{tables[0]}/documents.parquet")
    got = language.identify(df, language.learn(df))
    assert set(got.columns) == set(df.columns) and got.count() == df.count() and dict(got.dtypes)["rejected"] == "boolean"
    masked = pii.mask_pii(df)
    assert masked.columns == df.columns and masked.where("pii = 'x' and __found = 'x'").count() == df.count()
    found = pii.find_pii(df)
    assert set(found.columns) == set(df.columns) and found.where("size(pii) > 0").count() > 0
    odd = df.unionByName(df.where("doc_id < 5")).unionByName(df.where("doc_id < 9").withColumn("doc_id", F.lit(None).cast("long")))
    written = sharding.write_shards(odd, f"{tmp_path}/out", 4, file_rows=20)
    key = lambda r: (r.doc_id, r.text, r.source)
    assert sorted(map(str, map(key, written.collect()))) == sorted(map(str, map(key, odd.collect())))
    slots = {s: sorted(r.slot for r in written.where(F.col("shard") == s).collect()) for s in range(4)}
    assert all(x == list(range(len(x))) for x in slots.values()) and max(map(len, slots.values())) - min(map(len, slots.values())) <= 1

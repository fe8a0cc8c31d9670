"""Sharding, top-k search, token files, personal data, BPE and decontamination against brute force."""

import hashlib
import random
import re
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from spectrail.llm import bpe, decontaminate, pii, sharding, token_files, topk
from spectrail.llm._shared import fresh_path

from . import fixtures


def test_shards(spark):
    df = fixtures.frame(spark)
    got = sharding.assign_shards(df, 8).collect()
    data = fixtures.rows()
    assert len(got) == len(data)
    size = [sum(r.shard == s for r in got) for s in range(8)]
    assert max(size) - min(size) <= 1
    for s in range(8):
        assert sorted(r.slot for r in got if r.shard == s) == list(range(size[s]))
    for source in ("a", "b", "hot", None):
        counts = [sum(r.shard == s and r.source == source for r in got) for s in range(8)]
        assert max(counts) - min(counts) <= 2
    by_id = {d[0]: (d[1] or "").encode() for d in data}
    assert all(r["size"] == len(by_id[r.doc_id]) + 1 and r.text_crc32 == zlib.crc32(by_id[r.doc_id]) for r in got)
    assert sharding.assign_shards(df.limit(0), 8).count() == 0


@pytest.mark.parametrize("scale", [1.0, 1e12])
def test_top_k(spark, scale):
    rnd = np.random.default_rng(3)
    vectors = rnd.normal(size=(150, 20)) * scale
    vectors[60:110] = vectors[5]
    data = [(i, [float(x) for x in v], 1) for i, v in enumerate(vectors)]
    data += [(150, None, 1), (151, [float("nan")] * 20, 1), (152, [None] * 20, 1), (153, [1.0, 2.0], 1), (200, [0.5] * 20, 2)]
    df = spark.createDataFrame(data, "vec_id long, embedding array<double>, label int")
    got = topk.top_k_inner_product(df, F.col("vec_id") % 50 == 0, 5, block=32, tile=2, query_bytes=200)
    got = {(r.query_id, r.rank): (r.vec_id, r.score) for r in got.collect()}
    whole = {i: [int(np.floor(256 * x)) for x in v] for i, v, _ in data if v and all(x is not None and np.isfinite(x) for x in v)}
    want = {}
    for q in (q for q in whole if q % 50 == 0):
        best = sorted((-min(max(sum(a * b for a, b in zip(whole[q], v, strict=True)), -(2**63)), 2**63 - 1), i) for i, v in whole.items() if i != q and len(v) == len(whole[q]))[:5]
        want |= {(q, n + 1): (i, -s) for n, (s, i) in enumerate(best)}
    assert got == want
    assert topk.top_k_inner_product(df.limit(0), F.col("vec_id") % 50 == 0, 5).count() == 0


def test_token_files(spark):
    import public_tokenizers
    from tokenizers import Tokenizer

    path = public_tokenizers.path("byte_bpe_50k.json")
    df, data = fixtures.frame(spark), sorted((d[0], d[1] or "") for d in fixtures.rows())
    listed = token_files.write_token_files(df, fresh_path(spark, "tok"), path, 2, files=3, frame_ids=50)
    got = {r.doc_id: (r.start, r.n_tokens, r.ids_crc32) for r in token_files.read_token_files(listed).collect()}
    model, start = Tokenizer.from_file(path), 0
    for doc_id, text in data:
        ids = np.array([*model.encode(text, add_special_tokens=False).ids, 2], "<u4")
        assert got.pop(doc_id) == (start, len(ids), zlib.crc32(ids.tobytes()))
        start += len(ids)
    assert not got
    reader = token_files.FrameReader(listed.orderBy("least_id").first()["file"])
    one = int(reader.documents["doc_id"][7])
    assert reader.find([one])[one].tolist()[:-1] == model.encode(dict(data)[one], add_special_tokens=False).ids
    assert token_files.read_token_files(token_files.write_token_files(df.limit(0), fresh_path(spark, "tok"), path, 2)).count() == 0


def test_intermediate_tables(spark):
    import os

    from spectrail.llm import _shared

    _shared.clear(spark)
    path = _shared.written(spark.range(5), "numbers").inputFiles()[0].removeprefix("file://")
    assert os.path.exists(path) and _shared.clear(spark) == 1 and not os.path.exists(path) and _shared.clear(spark) == 0


def test_damaged_frame(tmp_path):
    w = token_files.FrameWriter(f"{tmp_path}/a.tok", 2)
    w.add(np.array([1]), np.arange(100, dtype=np.uint32), np.array([0, 100]))
    w.close()
    raw = bytearray((tmp_path / "a.tok").read_bytes())
    raw[12] ^= 255
    (tmp_path / "a.tok").write_bytes(raw)
    with pytest.raises(Exception):  # noqa: B017
        token_files.FrameReader(f"{tmp_path}/a.tok").frame(0)


def test_chunks_match_the_library():
    import public_tokenizers
    import pyarrow as pa

    encoder, rnd = token_files.ChunkEncoder(public_tokenizers.path("byte_bpe_50k.json")), random.Random(2)
    alphabet = ["a", "é", " ", "  ", "\n", "'", "'s", "1", "½", " ", "\x1c", "the", "!", "_", "　", "漢", "×", "$$", "<|endoftext|>", "́"]
    texts = ["".join(rnd.choice(alphabet) for _ in range(rnd.randint(0, 30))) for _ in range(4000)]
    ids, at = encoder.encode(pa.array(texts))
    for e, a, b in zip(encoder.model.encode_batch(texts, add_special_tokens=False), at, at[1:], strict=False):
        assert e.ids == ids[a:b].tolist()


def test_added_tokens_match_the_library(spark):
    import public_tokenizers
    import pyarrow as pa
    from tokenizers import Tokenizer

    path, mark = public_tokenizers.path("byte_bpe_50k.json"), "<|endoftext|>"
    model, rnd = Tokenizer.from_file(path), random.Random(4)
    texts = [mark, mark * 3, f"the {mark} end", f"a{mark}b", f"  {mark}  x", mark[:6], mark[6:], f"<{mark}>", f"é{mark}\n\n the", "", f"{mark} {mark}"]
    parts = [mark, mark[:5], mark[5:], " ", "  ", "\n", "the", " and", "!", "é", "漢", "1", "'s", "<", "|>"]
    texts += ["".join(rnd.choice(parts) for _ in range(rnd.randint(0, 12))) for _ in range(2000)]
    ids, at = token_files.ChunkEncoder(path).encode(pa.array(texts))
    want = [e.ids for e in model.encode_batch(texts, add_special_tokens=False)]
    assert want[0] == [model.token_to_id(mark)]
    assert [ids[a:b].tolist() for a, b in zip(at, at[1:], strict=False)] == want
    df = spark.createDataFrame(list(enumerate(texts[:20])), "doc_id long, text string")
    listed = token_files.write_token_files(df, fresh_path(spark, "tok"), path, 2, files=2)
    got = {r.doc_id: (r.n_tokens, r.ids_crc32) for r in token_files.read_token_files(listed).collect()}
    assert got == {i: (len(w) + 1, zlib.crc32(np.array([*w, 2], "<u4").tobytes())) for i, w in enumerate(want[:20])}


def test_chunks_of_equal_hash(monkeypatch):
    """Chunks are compared as they are: with a hash that tells little apart, and with Thue-Morse words."""
    import public_tokenizers
    import pyarrow as pa
    from tokenizers import Tokenizer

    path = public_tokenizers.path("byte_bpe_50k.json")
    rnd = random.Random(3)
    texts = [*fixtures.thue_morse(), *(" ".join(rnd.choice(["the", "cat", "sat", "on", "mat", "hats", "x" * 70, "y" * 70, "é"]) for _ in range(20)) for _ in range(50))]
    want = [e.ids for e in Tokenizer.from_file(path).encode_batch(texts, add_special_tokens=False)]
    for hashed in (token_files.span_hash, lambda data, start, end: ((end - start) % 3).astype(np.uint64)):
        monkeypatch.setattr(token_files, "span_hash", hashed)
        encoder = token_files.ChunkEncoder(path)
        for part in (texts[:9], texts[9:], texts):
            ids, at = encoder.encode(pa.array(part))
            assert [ids[a:b].tolist() for a, b in zip(at, at[1:], strict=False)] == [want[texts.index(t)] for t in part]


def test_bpe(spark):
    import public_tokenizers

    path, pattern = public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN
    encode = bpe.rank_encoder(path, pattern).encode_ordinary
    got = {r.doc_id: r for r in bpe.encode_decode(fixtures.frame(spark), path, pattern, leaf=64).collect()}
    for d in fixtures.rows():
        ids, r = encode(d[1] or ""), got[d[0]]
        assert r.ids == ids and r.n_tokens == len(ids) and bytes(r.decoded) == (d[1] or "").encode()
        assert r.ids_sha256 == hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
        assert r.decoded_sha256 == hashlib.sha256((d[1] or "").encode()).hexdigest()
    rnd, alphabet = random.Random(1), ["a", "é", " ", "  ", "\n", "'", "'s", "1", "½", " ", "\x1c", "the", "!", "_", "　", "​", "漢"]
    for _ in range(4000):
        s = "".join(rnd.choice(alphabet) for _ in range(rnd.randint(0, 60)))
        assert bpe.encode_tree(s, encode, leaf=rnd.choice([2, 5, 9]), window=rnd.choice([1, 2, 4])) == encode(s)


def brute_pii(text):
    out = []
    for kind in (k for k in pii.KINDS if k.base):
        for m in re.finditer(kind.plain, text):
            v, digits = m[0], [int(c) for c in m[0] if c.isdigit()]
            if kind.name == "ip" and any(int(p) > 255 for p in v.split(".")):
                continue
            if kind.name == "phone" and not 8 <= len(digits) <= 15:
                continue
            if kind.name == "card":
                twice = [d * 2 - 9 * (d > 4) if i % 2 else d for i, d in enumerate(reversed(digits))]
                if not 16 <= len(digits) <= 19 or sum(twice) % 10:
                    continue
            out.append(f"{kind.name}:{m.start()}:{m.end()}")
    return out


def pii_texts():
    rnd = random.Random(5)
    parts = ["a.b@c.de", "@", "x@y", ".", "..d@e.f", " ", "1", "22", "255", "300", "4111 1111 1111 1111", "4111-1111-1111-1111", "+1 (415) 555-2671", "+", "é", "漢", "-", "(", ")", "x", "4242424242424242", "192.168.0.1", "1.2.3.4.5.6.7.8", "𝒳"]
    texts = ["".join(rnd.choice(parts) for _ in range(rnd.randint(1, 40))) for _ in range(400)]
    texts += ["1" * 20000, "a" * 20000 + "@b.c", " ".join(["q@w.de 10.0.0.1"] * 700), "", None]
    return [*texts, "pay to bank account GB82WEST12345698765432 now", "GB82WEST12345698765433", "social security 123-45-6789", "n 123-45-6789"]


def test_pii(spark):
    texts = pii_texts()
    df = spark.createDataFrame([(i, t, "k") for i, t in enumerate(texts)], "doc_id long, text string, kind string")
    got = {r.doc_id: r.pii for r in pii.find_pii(df).collect()}
    for i, t in enumerate(texts):
        assert [f"{x.kind}:{x.start}:{x.end}" for x in got[i] if x.base] == brute_pii(t or ""), repr(t)[:200]
    more = [[x.kind for x in got[i] if not x.base] for i in range(len(texts) - 4, len(texts))]
    assert more == [["iban"], [], ["national_id"], []]
    masked = {r.doc_id: r.text for r in pii.mask_pii(df).collect()}
    for i, t in enumerate(texts):
        assert (masked[i] == t) == (not got[i])
        if got[i]:
            merged = []
            for x in sorted(got[i], key=lambda x: (x.start, -x.end)):
                if merged and x.start < merged[-1][1]:
                    merged[-1][1] = max(merged[-1][1], x.end)
                else:
                    merged.append([x.start, x.end, x.kind])
            want, at = "", 0
            for a, b, kind in merged:
                want, at = want + t[at:a] + f"[{kind.upper()}]", b
            assert masked[i] == want + t[at:]


def test_pii_in_lists(spark):
    numbers = [f"{100 + i}-{10 + i % 80}-{1000 + i}" for i in range(600)]
    texts = ["SSN: " + ", ".join(numbers), "name,ssn\n" + "\n".join(f"Ann {'é' * (i % 9)},{x}" for i, x in enumerate(numbers)), "parts " + ", ".join(numbers)]
    texts += [f"ssn {numbers[0]}{'x' * 60} {numbers[1]}", f"{numbers[0]} ssn {numbers[1]}", f"number {numbers[0]} is a tax id, not {numbers[1]}", "mail a.b@c.de, d@e.f"]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r.doc_id: [x for x in r.pii] for r in pii.find_pii(df).collect()}
    at = lambda i: [texts[i][x.start : x.end] for x in got[i] if x.kind == "national_id"]
    assert at(0) == numbers and at(1) == numbers and at(2) == []
    assert at(3) == numbers[:1] and at(4) == numbers[1:2] and at(5) == numbers[1:2]
    assert [x.score for x in got[6]] == pytest.approx([1.0, 1.0])
    masked = {r.doc_id: r.text for r in pii.mask_pii(df).collect()}
    assert masked[0] == "SSN: " + ", ".join(["[NATIONAL_ID]"] * 600)


def test_decontamination(spark):
    rnd = random.Random(7)
    words = [f"w{i}" for i in range(300)]
    items = [(i, " ".join(rnd.choice(words) for _ in range(rnd.choice([3, 5, 12, 40, 90]))), "x") for i in range(25)] + [(90, None, "x"), (91, "", "x")]
    docs = []
    for i in range(120):
        text = [rnd.choice(words) for _ in range(rnd.randint(0, 80))]
        if i % 2:
            own = items[rnd.randrange(25)][1].upper().split()
            for _ in range(rnd.randint(0, 3)):
                own[rnd.randrange(len(own))] = "changed"
            text[len(text) // 2 : len(text) // 2] = own
        docs.append((i, ", ".join(text), 1))
    docs += [(500, None, 1), (501, "", 1)]
    d, b = spark.createDataFrame(docs, "doc_id long, text string, n int"), spark.createDataFrame(items, "item_id long, text string, need string")
    for limit in (10**6, 0):
        got = {(r.doc_id, r.item_id): (r.n_item, r.n_shared) for r in decontaminate.contaminated(d, b, broadcast_up_to=limit).collect()}
        norm = lambda t: [w for w in re.split(r"[\W_]+", (t or "").lower()) if w]
        grams = lambda w, n: {tuple(w[x : x + n]) for x in range(len(w) - n + 1)}
        want = {}
        for item_id, text, _ in items:
            w = norm(text)
            own = grams(w, min(5, len(w))) if w else set()
            for doc_id, t, _ in docs:
                shared = len(own & grams(norm(t), min(5, len(w)))) if own else 0
                if own and shared * 5 >= len(own) * 4:
                    want[doc_id, item_id] = (len(own), shared)
        assert got == want and want
    assert decontaminate.contaminated(d.limit(0), b).count() == 0 == decontaminate.contaminated(d, b.limit(0)).count()

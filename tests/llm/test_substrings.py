"""FM-index and repeat removal against brute force."""

import hashlib
import random

import numpy as np

from spectrail.llm import substrings
from spectrail.llm.fm_index import FMIndex

from . import fixtures


def test_fm_index():
    rnd = np.random.default_rng(5)
    for sigma, n in ((3, 200), (40, 500), (2, 50), (1, 20), (700, 900)):
        lengths = rnd.integers(1, 30, n // 10)
        docs = [rnd.integers(1, sigma + 1, k) for k in lengths]
        text = np.concatenate([np.append(d, 0) for d in docs])
        index = FMIndex(text, np.repeat(np.arange(len(docs)), lengths + 1), 5)
        ends = np.concatenate([np.arange(1, k + 1) + at for k, at in zip(lengths, np.cumsum(lengths + 1) - lengths - 1, strict=True)])
        room = np.concatenate([np.arange(1, k + 1) for k in lengths])
        far = room >= 5
        reached, low, high = index.statistics(text, ends[far], 5)
        held = {}
        for d, doc in enumerate(docs):
            for k in range(1, 6):
                for i in range(len(doc) - k + 1):
                    held.setdefault(tuple(doc[i : i + k].tolist()), []).append(d)
        piece = lambda e, k: tuple(text[e - k : e].tolist())
        assert reached.tolist() == [max([k for k in range(1, 6) if len(held[piece(e, k)]) > 1], default=0) for e in ends[far].tolist()]
        full = ends[far][reached == 5]
        assert index.documents.least(low, high).tolist() == [min(held[piece(e, 5)]) for e in full.tolist()]
        assert (high - low).tolist() == [len(held[piece(e, 5)]) for e in full.tolist()]


def split(text):
    for c in "\t\n\x0b\x0c\r":
        text = text.replace(c, " ")
    return [w for w in text.split(" ") if w]


def brute(rows, k):
    owner = {}
    for d, t in rows:
        w = split(t or "")
        for i in range(len(w) - k + 1):
            g = tuple(w[i : i + k])
            if d is not None:
                owner[g] = min(d, owner.get(g, d))
    out = []
    for d, t in rows:
        w = split(t or "")
        gone = set()
        for i in range(len(w) - k + 1):
            if d is not None and owner[tuple(w[i : i + k])] < d:
                gone |= set(range(i, i + k))
        out.append((d, len(w), len(gone), hashlib.sha256(" ".join(x for i, x in enumerate(w) if i not in gone).encode()).hexdigest()))
    return out


def documents(seed):
    r = random.Random(seed)
    words = [f"w{i}" for i in range(60)] + ["É,", "漢字"]
    passage = [[r.choice(words) for _ in range(r.choice([13, 14, 25, 60]))] for _ in range(6)]
    out = []
    for i in range(120):
        body = [r.choice(words) for _ in range(r.randint(0, 70))]
        for _ in range(r.randint(0, 2)):
            at = r.randint(0, len(body))
            body[at:at] = r.choice(passage)
        out.append((i * 3, " ".join(body)))
    out += [(1000 + i, out[7][1]) for i in range(15)] + [(2000, "a b " * 200), (2001, "a b " * 100), (2002, None), (2003, ""), (-5, out[20][1]), (None, out[21][1]), (9, out[21][1] + " x"), (9, out[22][1])]
    r.shuffle(out)
    return out


def test_remove_repeats(spark, monkeypatch):
    for seed, hot, broadcast in ((1, 1000, 10**6), (2, 4, 10**6), (3, 4, 0)):
        monkeypatch.setattr(substrings, "HOT_RUNS", hot)
        rows = documents(seed)
        df = spark.createDataFrame([(d, t, "x", 1) for d, t in rows], "doc_id long, text string, key string, `from` int")
        got = sorted((tuple(x)[:4] for x in substrings.remove_repeats(df, shard_bytes=8000, broadcast_ids=broadcast).collect()), key=str)
        assert got == sorted(brute(rows, 13), key=str)


def test_words_of_equal_polynomial_hash(spark):
    """Thue-Morse words and their complements: equal under any polynomial modulo a power of two."""
    one, two = fixtures.thue_morse()
    words = [f"w{i}" for i in range(12)]
    rows = [(i, " ".join([*words[:6], x, *words[6:]])) for i, x in enumerate((one, two, one))]
    rows += [(10 + i, x.replace("a", "yes ").replace("b", "no ")) for i, x in enumerate((one, two))]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    assert sorted(tuple(x) for x in substrings.remove_repeats(df, keep_text=False).collect()) == sorted(brute(rows, 13))


def test_odd_rows(spark):
    data = [(x[0], x[1]) for x in fixtures.rows()]
    got = sorted((tuple(x) for x in substrings.remove_repeats(fixtures.frame(spark), keep_text=False).collect()), key=str)
    assert got == sorted(brute(data, 13), key=str)
    assert substrings.remove_repeats(fixtures.frame(spark).limit(0)).count() == 0

"""Filter audit, SimHash groups and Merkle manifest, against brute force on odd rows with clashing columns."""

import hashlib
import itertools
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from spectrail.llm import filter_audit, merkle, registry, simhash

from . import fixtures

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
#: Columns that the operators use inside or return.
CLASHING = ("id", "part", "mask", "digest", "least", "good", "toxic", "first", "step", "bit", "b0", "kept", "removed", "fp", "key", "label", "node", "component_id", "tree", "idx", "n", "order", "path", "root", "block", "leaf", "verified", "of")


def rows():
    r = random.Random(5)
    data = [(x[0], x[1], x[2], x[3], x[4]) for x in fixtures.rows()]
    base = [f"w{r.randrange(900)}" for _ in range(400)]
    for i in range(40):  # near copies, alike by few words
        words = list(base)
        for _ in range(i % 5):
            words[r.randrange(len(words))] = "changed"
        data.append((1000 - i, " ".join(words).upper() if i % 7 == 0 else "\n".join(words), "en", "hot", 5))
    data += [(2000 + i, t, None, s, None) for i, (t, s) in enumerate([("one two three four", "a"), ("ONE\ttwo three  four", None), ("one two three", ""), ("$5 & more", "A"), ("line\nbreak", "a"), ("line break", "z"), ("été\n\n漢字", "b"), ("x\ny", "ä")])]
    data += [(None, "no id", "en", "a", 1), (None, "no id", "en", "a", 1), (None, base[0], None, None, None), (3000, "twice", "en", "a", 2), (3000, "twice", "en", "a", 2), (3000, "other\n", "en", "a", 2), (-5, "one two three four", "en", "b", 1)]
    return data


LABELS = [(i, i % 2, (i // 3) % 2) for i in range(0, 120, 3)] + [(3, 1, 1), (None, 1, 1), (1000, None, 1), (999, 1, None)]


@pytest.fixture(scope="module")
def tables(spark, tmp_path_factory):
    path, data = str(tmp_path_factory.mktemp("audits")), rows()
    spark.createDataFrame(data, SCHEMA).withColumns({c: F.lit("x") for c in CLASHING}).repartition(5).write.parquet(f"{path}/documents.parquet")
    spark.createDataFrame(LABELS, "doc_id long, quality int, toxic int").withColumns({c: F.lit("x") for c in ("good", "of", "id")}).write.parquet(f"{path}/labels.parquet")
    return path, data


@pytest.fixture(scope="module")
def nothing(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("empty"))
    spark.createDataFrame([], SCHEMA).write.parquet(f"{path}/documents.parquet")
    spark.createDataFrame([], "doc_id long, quality int, toxic int").write.parquet(f"{path}/labels.parquet")
    return path


def words_of(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text)


def failed(data):
    least = {}
    for i, t, *_ in data:
        if i is not None:
            least[t or ""] = min(least.get(t or "", i), i)
    for i, t, _, source, _ in data:
        t = t or ""
        w = words_of(t)
        fails = {
            "A": len(w) < 50, "B": 100 * len(set(w)) < 65 * len(w), "C": 100 * len(re.findall("[A-Z]", t)) > 5 * len(t),
            "D": bool(re.search(r"[#$%&*|]", t)), "E": i is not None and least.get(t, i) < i,
        }
        yield i, source or "", {k for k, v in fails.items() if v}


def test_filter_audit(spark, tables):
    good, toxic = ({x[0] for x in LABELS if x[0] is not None and x[k] == 1} for k in (1, 2))
    names = ("kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost")
    want, shapley = Counter(), Counter()
    documents = list(failed(tables[1]))
    assert {frozenset(f) for *_, f in documents} > {frozenset("A"), frozenset("AE")} and any("B" in f for *_, f in documents)
    for i, part, fails in documents:
        for order in itertools.permutations("ABCDE"):
            first = next((k for k, c in enumerate(order) if c in fails), 5)
            for k, c in enumerate(order):
                flags = (first > k, first == k, first < k and c in fails, fails == {c}, first == k and i in good, first == k and i in toxic)
                for name, flag in zip(names, flags, strict=True):
                    want[part, "".join(order), k + 1, name] += flag
                shapley[part, c] += first == k
    got = registry.queries()["op11_filter_audit"](spark, tables[0]).collect()
    parts = {p for _, p, _ in documents}
    assert len(got) == 600 * len(parts) and {(r.part, r.filter_order, r.step) for r in got} == {k[:3] for k in want}
    for r in got:
        assert [r[n] for n in names] == [want[r.part, r.filter_order, r.step, n] for n in names]
        assert r.shapley == shapley[r.part, r.filter_order[r.step - 1]]


def test_audit_combines_before_the_shuffle(spark):
    flags = spark.range(0, 4000, 1, 4).selectExpr("IF(id % 3 = 0, 'hot', 'p' || id % 5) AS part", "CAST(id % 32 AS INT) AS mask", "id % 2 = 0 AS good", "id % 7 = 0 AS toxic")
    plan = filter_audit.replay(flags)._jdf.queryExecution().executedPlan().toString()
    before = plan.split("BroadcastNestedLoopJoin")[0]
    assert before.count("partial_count") and "CartesianProduct" not in plan and plan.count("BroadcastNestedLoopJoin") == 1
    got = filter_audit.replay(flags).where("filter_order = 'CABDE' AND step = 1").agg(F.sum("removed"), F.sum("kept")).first()
    assert tuple(got) == (2000, 2000)


def brute_fingerprint(text):
    w = words_of(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    if not w:
        return 0
    shingles = [" ".join(w[i : i + 4]) for i in range(len(w) - 3)] or [" ".join(w)]
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def groups(prints, radius=4):
    """Components of a list of fingerprints, as the index of a first member for each."""
    label = list(range(len(prints)))

    def top(i):
        while label[i] != i:
            i = label[i]
        return i

    for i, j in itertools.combinations(range(len(prints)), 2):
        if (prints[i] ^ prints[j]).bit_count() <= radius:
            a, b = sorted((top(i), top(j)))
            label[b] = a
    return [top(i) for i in range(len(prints))]


def test_simhash(spark, tables):
    data = tables[1]
    prints = [brute_fingerprint(t) for _, t, *_ in data]
    label = groups(prints)
    least = {}
    for (i, *_), k in zip(data, label, strict=True):
        least[k] = min((x for x in (least.get(k), i) if x is not None), default=None)
    want = Counter((i, f"{p:016x}", least[k]) for (i, *_), p, k in zip(data, prints, label, strict=True))
    assert max(Counter(label).values()) > 20 and len(set(label)) > 30
    assert Counter((r.doc_id, r.fingerprint, r.component_id) for r in registry.queries()["op12_simhash"](spark, tables[0]).collect()) == want


def test_fingerprint_of_pieces(monkeypatch):
    r = random.Random(1)
    texts = ["", " ", "a", "A b", "a b c d", *(" \n".join(f"W{r.randrange(30)}é" for _ in range(r.randint(1, 90))) for _ in range(60)), "x" * 5000 + " y z" * 40]
    want = [brute_fingerprint(t) for t in texts]
    assert [simhash.fingerprint(t.encode()) for t in texts] == want
    monkeypatch.setattr(simhash, "PIECE", 16)
    monkeypatch.setattr(simhash, "CHUNK", 3)
    assert [simhash.fingerprint(t.encode()) for t in texts] == want


def families(seed=3):
    """Fingerprints alone, in families of chains, and many that share a half."""
    r = random.Random(seed)
    out = {r.getrandbits(64) for _ in range(300)}
    for _ in range(25):
        x = r.getrandbits(64)
        for _ in range(r.randint(2, 40)):
            x ^= sum(1 << b for b in r.sample(range(64), r.randint(1, 6)))
            out.add(x)
    for half in (0, 32):
        shared = r.getrandbits(32) << half
        out |= {shared | r.getrandbits(12) << (32 - half) for _ in range(150)}
    return sorted(out)


def components_of(spark, prints, radius):
    signed = [x - (1 << 64) if x >> 63 else x for x in prints]
    edges = [(r.a, r.b) for r in simhash.links(spark.createDataFrame([(x,) for x in signed], "fp long").repartition(3), radius).collect()]
    assert all(((a ^ b) & (1 << 64) - 1).bit_count() <= radius and a != b for a, b in edges)
    top = {x: x for x in signed}

    def find(x):
        while top[x] != x:
            x = top[x]
        return x

    for a, b in edges:
        top[find(a)] = find(b)
    heads = [find(x) for x in signed]
    return {frozenset(i for i, h in enumerate(heads) if h == head) for head in set(heads)}, edges


@pytest.mark.parametrize("bucket", [16_384, 330])
def test_links(spark, monkeypatch, bucket):
    """Links connect what brute force connects, with buckets that are compared and with hot ones."""
    monkeypatch.setattr(simhash, "BUCKET", bucket)
    prints = families()
    for radius in (4, 3, 2):
        label = groups(prints, radius)
        want = {frozenset(i for i, x in enumerate(label) if x == k) for k in set(label)}
        got, edges = components_of(spark, prints, radius)
        assert got == want
    monkeypatch.setattr(simhash, "BROADCAST_KEYS", 0)
    assert components_of(spark, prints, 2)[0] == want


def test_connecting_returns_few_links():
    r = np.random.default_rng(1)
    for n in (2, 60, 64, 65, 900):
        fp = np.unique(np.array([1 << int(b) for b in r.integers(0, 2, n) * 0 + np.arange(n) % 63] + list(range(n)), np.int64))[:n]
        a, b = simhash.connecting(fp, np.zeros(len(fp), np.int64), 4)
        assert len(a) < 3 * len(fp)  # not the square


def brute_merkle(data):
    h = lambda s: hashlib.sha256(s.encode()).hexdigest()
    field = lambda v: "-" if v is None else f"{len(str(v).encode())}:{v}"
    leaf = lambda d, text: h("".join(map(field, (d[0], d[3], d[2], d[4], text))))
    trees = {}
    for d in data:
        changed = d[0] is not None and zlib.crc32(str(d[0]).encode()) % 2 == 0
        now = leaf(d, d[1].replace("\n", "") if d[1] is not None and changed else d[1])
        trees.setdefault(d[3], []).append((d[0] is not None, d[0] or 0, leaf(d, d[1]), now))

    def build(nodes):
        """Root and, for each leaf, its steps (place, siblings)."""
        paths, at = [[] for _ in nodes], list(range(len(nodes)))
        while len(nodes) > 1:
            for k in range(len(paths)):
                run = nodes[at[k] // 3 * 3 :][:3]
                paths[k].append((at[k] % 3, run[: at[k] % 3] + run[at[k] % 3 + 1 :]))
                at[k] //= 3
            nodes = [h("".join(nodes[i : i + 3])) for i in range(0, len(nodes), 3)]
        return nodes[0], paths

    names = sorted(trees, key=lambda s: (s is not None, (s or "").encode()))
    built = {s: build([x[2] for x in sorted(trees[s])]) for s in names}
    root, tops = build([built[s][0] for s in names])
    for s, top in zip(names, tops, strict=True):
        for (known, i, own, now), path in zip(sorted(trees[s]), built[s][1], strict=True):
            found = now
            for place, siblings in path + top:
                found = h("".join(siblings[:place] + [found] + siblings[place:]))
            yield i if known else None, own, built[s][0], root, h("".join(x for _, sib in path + top for x in sib)), found, found == root


def test_merkle(spark, tables):
    want = Counter(brute_merkle(tables[1]))
    got = registry.queries()["op13_merkle_manifest"](spark, tables[0]).collect()
    assert Counter(tuple(r) for r in got) == want and {r.verified for r in got} == {True, False}
    # blocks of three and nine nodes, so that traversals feed several others
    docs = spark.read.parquet(f"{tables[0]}/documents.parquet")
    half = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 2 == 0
    for levels in (1, 2):
        assert Counter(tuple(r) for r in merkle.audited(docs, half, {"text": F.replace(F.col("text"), F.lit("\n"), F.lit(""))}, levels=levels).collect()) == want


@pytest.mark.parametrize("n", [1, 2, 3, 4])
def test_small_trees(spark, n):
    data = [(i, "a\nb", None, "s", None) for i in range(n)]
    docs = spark.createDataFrame(data, SCHEMA)
    got = merkle.audited(docs, F.lit(True), {"text": F.replace(F.col("text"), F.lit("\n"), F.lit(""))}).collect()
    assert all(not r.verified and r.root == r.subroot for r in got) and len(got) == n
    assert all(r.verified for r in merkle.audited(docs, F.lit(False), {}).collect())


@pytest.mark.parametrize("name", ["op11_filter_audit", "op12_simhash", "op13_merkle_manifest"])
def test_empty(spark, nothing, name):
    assert registry.queries()[name](spark, nothing).count() == 0

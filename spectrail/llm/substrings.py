"""Operator 6: removal of repeated word windows, by FM-indexes over shards of suspect passages."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from spectrail.llm._idfilter import MOST_IDS, IdFilter, may_hold
from spectrail.llm._shared import table, written
from spectrail.llm._text import Words, digest, gram_hash, halves, ranges, signed, slices, text_bytes
from spectrail.llm.fm_index import FMIndex

#: Words of a window; words of the grams of which the least-hashed one anchors a window.
WINDOW, GRAM = 13, 6
#: Bytes of passages for each shard; entries of a task's memory of texts and passages.
SHARD_BYTES, REMEMBERED = 1_000_000, 100_000
#: Runs under one anchor from which they are dealt window by window.
HOT_RUNS = 1000

KNOWN, EXTREME, FIRST = 0, 1, 2


class Seen:
    """The least and most id under which a task has passed something on."""

    def __init__(self):
        self.ends: dict[bytes, tuple[int, int]] = {}

    def meet(self, key: bytes, doc_id: int) -> int:
        """FIRST if the task doesn't know the key, EXTREME if the id is a new least or most one, else KNOWN."""
        ends = self.ends.get(key)
        if ends is None:
            if len(self.ends) >= REMEMBERED:
                self.ends.clear()
            self.ends[key] = (doc_id, doc_id)
            return FIRST
        if ends[0] <= doc_id <= ends[1]:
            return KNOWN
        self.ends[key] = (min(ends[0], doc_id), max(ends[1], doc_id))
        return EXTREME


def text_digests(words: Words, joined: memoryview, start: np.ndarray, end: np.ndarray) -> list[bytes]:
    """Digest of the whole word sequence of each text."""
    out = []
    for a, b in zip(words.first[:-1].tolist(), words.first[1:].tolist(), strict=True):
        out.append(digest(joined[start[a] : end[b - 1]] if b > a else b""))
    return out


def anchored_runs(words: Words, window: int, gram: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(document, anchor, first window, windows) of the runs of neighbouring windows with one anchor.

    A window's anchor is the least hash among its grams, so equal windows have equal anchors wherever they stand.
    """
    n = len(words.hash)
    if n < window:
        return np.zeros(0, np.int64), np.zeros(0, np.uint64), np.zeros(0, np.int64), np.zeros(0, np.int64)
    least = gram_hash(words.hash, np.arange(n - gram + 1), gram)
    width, full = 1, window - gram + 1
    while width < full:
        step = min(width, full - width)
        least = np.minimum(least[:-step], least[step:])
        width += step
    doc, at = ranges(words.first[:-1], np.maximum(words.count() - window + 1, 0))
    anchor = least[at]
    if not len(at):
        return doc, anchor, at, at
    begins = np.flatnonzero(np.append(True, (anchor[1:] != anchor[:-1]) | (doc[1:] != doc[:-1])))
    return doc[begins], anchor[begins], at[begins], np.diff(np.append(begins, len(at)))


def _anchors(window: int, gram: int):
    """(anchor, doc_id, runs): of each slice the least and the most id under an anchor."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen = Seen()
        for whole in batches:
            for batch in slices(whole, "text"):
                words, ids = Words(batch.column("text"), lower=False), batch.column("doc_id").to_numpy()
                data, offsets = text_bytes(batch.column("text"))
                raw, at = memoryview(data), offsets.tolist()
                new = np.array([seen.meet(digest(raw[a:b]), d) for a, b, d in zip(at, at[1:], ids.tolist(), strict=False)], np.int64)
                doc, anchor, _, _ = anchored_runs(words, window, gram)
                take = new[doc] != KNOWN
                anchor, doc_id = signed(anchor[take]), ids[doc[take]]
                if not len(anchor):
                    continue
                order = np.argsort(anchor, kind="stable")
                anchor, doc_id = anchor[order], doc_id[order]
                at = np.flatnonzero(np.append(True, anchor[1:] != anchor[:-1]))
                low, high, runs = np.minimum.reduceat(doc_id, at), np.maximum.reduceat(doc_id, at), np.diff(np.append(at, len(anchor)))
                two = high > low
                columns = [np.append(anchor[at], anchor[at][two]), np.append(low, high[two]), np.append(runs, np.zeros(int(two.sum()), np.int64)).astype(np.int32)]
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], ["anchor", "doc_id", "runs"])

    return run


def _runs(window: int, gram: int):
    """(doc_id, k1, k2, anchor, at, count) of all runs, where shared anchors are too many to be broadcast."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in slices(whole, "text"):
                words = Words(batch.column("text"), lower=False)
                joined, start, end = words.joined()
                k1, k2 = halves(text_digests(words, memoryview(joined), start, end))
                doc, anchor, at, count = anchored_runs(words, window, gram)
                ids = batch.column("doc_id").to_numpy()
                columns = [ids[doc], k1[doc], k2[doc], signed(anchor), (at - words.first[doc]).astype(np.int32), count.astype(np.int32)]
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], ["doc_id", "k1", "k2", "anchor", "at", "count"])

    return run


PASSAGES = "doc_id long, k1 long, k2 long, at int, p1 long, p2 long, cell long, words binary"


def _passages(window: int, gram: int, shared, hot):
    """Three kinds of rows, some in one:

    doc_id, k1, k2 (no p1): a document with suspect runs, and the digest of its text;
    k1, k2, at, p1, p2: a passage of that text, once for each task;
    p1, p2, cell, doc_id, words: a passage for the index under its least and its most id (words once for each task).

    Runs are suspect if their anchor may be shared; with ``shared`` None, those in the column ``runs``. Under a hot
    anchor runs go window by window, each with a cell of its own.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        texts, passages = Seen(), Seen()
        for whole in batches:
            for batch in slices(whole, "text"):
                words = Words(batch.column("text"), lower=False)
                joined, start, end = words.joined()
                raw = memoryview(joined)
                ids, digests = batch.column("doc_id").to_numpy(), text_digests(words, raw, start, end)
                doc, anchor, at, count = anchored_runs(words, window, gram)
                if shared is not None:
                    suspect, split = may_hold(shared.value, signed(anchor)), may_hold(hot.value, signed(anchor))
                else:
                    suspect, split = _listed(batch, words, digests, doc, at)
                take = np.flatnonzero(suspect)
                doc, anchor, at, count, split = doc[take], anchor[take], at[take], count[take], split[take]
                k1, k2 = halves(digests)
                has = np.unique(doc)
                yield _rows(doc_id=ids[has], k1=k1[has], k2=k2[has])
                new = np.full(len(ids), KNOWN)
                new[has] = [texts.meet(digests[i], int(ids[i])) for i in has.tolist()]
                take = np.flatnonzero(new[doc] != KNOWN)
                doc, anchor, at, count, split = doc[take], anchor[take], at[take], count[take], split[take]
                if split.any():
                    owner, place = ranges(at[split], count[split])
                    doc, anchor = np.append(doc[~split], doc[split][owner]), np.append(anchor[~split], gram_hash(words.hash, place, window))
                    at, count = np.append(at[~split], place), np.append(count[~split], np.ones(len(place), np.int64))
                if not len(at):
                    continue
                spans = [raw[a:b] for a, b in zip(start[at].tolist(), end[at + count + window - 2].tolist(), strict=True)]
                keys = [digest(s) for s in spans]
                found = np.array([passages.meet(k, d) for k, d in zip(keys, ids[doc].tolist(), strict=True)], np.int64)
                p1, p2 = halves(keys)
                sent = pa.array([bytes(s) if f == FIRST else None for s, f in zip(spans, found.tolist(), strict=True)], pa.binary())
                first = new[doc] == FIRST
                out = _rows(doc_id=ids[doc], k1=np.ma.array(k1[doc], mask=~first), k2=np.ma.array(k2[doc], mask=~first), at=(at - words.first[doc]).astype(np.int32), p1=p1, p2=p2, cell=np.ma.array(signed(anchor), mask=found == KNOWN), words=sent)
                yield out.filter(pa.array(first | (found != KNOWN)))

    return run


def _listed(batch: pa.RecordBatch, words: Words, digests: list[bytes], doc: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Which runs stand in the column ``runs``, and which of these are hot."""
    k1, k2 = halves(digests)
    suspect, hot = np.zeros(len(at), bool), np.zeros(len(at), bool)
    first = np.searchsorted(doc, np.arange(len(k1) + 1))
    for i, runs in enumerate(batch.column("runs").to_pylist()):
        own = [(r["at"], r["hot"]) for r in runs or () if (r["k1"], r["k2"]) == (k1[i], k2[i])]
        if own:
            place = first[i] + np.searchsorted(at[first[i] : first[i + 1]] - words.first[i], [a for a, _ in own])
            suspect[place], hot[place] = True, [h for _, h in own]
    return suspect, hot


def _rows(**columns) -> pa.RecordBatch:
    """A batch of ``PASSAGES``; columns not given are null."""
    n = len(columns["doc_id"])
    kinds = {"at": pa.int32(), "words": pa.binary()}
    arrays = {}
    for name in (c.split()[0] for c in PASSAGES.split(", ")):
        x = columns.get(name)
        if x is None:
            arrays[name] = pa.nulls(n, kinds.get(name, pa.int64()))
        elif isinstance(x, np.ma.MaskedArray):
            arrays[name] = pa.array(x.data, mask=np.ma.getmaskarray(x))
        else:
            arrays[name] = x if isinstance(x, pa.Array) else pa.array(x)
    return pa.RecordBatch.from_pydict(arrays)


def window_owners(passages: list[bytes], least: np.ndarray, most: np.ndarray, window: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(passage, offset, owner) of the windows whose owner is smaller than some document's that holds the passage.

    The passages, each the words of one under a least and a most id, are indexed as documents in order of the
    least one; so a window's owner is the smallest document among the rows of its interval. Words are told apart
    as they are, by a dictionary of the shard. Every passage is streamed through the index; windows whose
    matching statistic stays under ``window`` are its own.
    """
    order = np.argsort(least, kind="stable")
    flat = b" ".join([passages[i] for i in order.tolist()]).split(b" ")
    lengths = np.array([passages[i].count(b" ") + 1 for i in order.tolist()])
    code = {w: i for i, w in enumerate(dict.fromkeys(flat), 1)}
    begin = np.cumsum(lengths + 1) - (lengths + 1)
    text, document = np.zeros(int(lengths.sum()) + len(lengths), np.int64), np.repeat(np.arange(len(lengths)), lengths + 1)
    of, at = ranges(begin, lengths)
    text[at] = np.fromiter(map(code.__getitem__, flat), np.int64, len(flat))
    index = FMIndex(text, document, window)
    of, starts = ranges(begin, lengths - window + 1)
    reached, low, high = index.statistics(text, starts + window, window)
    owner = of.copy()
    hit = reached == window
    if hit.any():
        interval, which = np.unique(low, return_inverse=True)
        top = np.empty(len(interval), np.int64)
        top[which] = high
        owner[hit] = index.documents.least(interval, top)[which]
    owner = least[order][owner]
    some = owner < most[order][of]
    return order[of[some]], starts[some] - begin[of[some]], owner[some]


OWNED = "p1 long, p2 long, `from` int, `to` int, owner long"


def _searched(window: int):
    """Sorted by shard: (p1, p2, from, to, owner) for stretches of words of a passage whose windows have one owner."""

    def done(parts: list[pa.RecordBatch]) -> pa.RecordBatch:
        rows = pa.Table.from_batches(parts).combine_chunks()
        p1, p2, doc_id, valid = (x.to_numpy() for x in (rows["p1"], rows["p2"], rows["doc_id"], rows["words"].is_valid()))
        order = np.lexsort((~valid, p2, p1))
        at = np.flatnonzero(np.append(True, (p1[order[1:]] != p1[order[:-1]]) | (p2[order[1:]] != p2[order[:-1]])))
        p1, p2, words = p1[order[at]], p2[order[at]], rows["words"].take(pa.array(order[at])).to_pylist()
        which, offset, owner = window_owners(words, np.minimum.reduceat(doc_id[order], at), np.maximum.reduceat(doc_id[order], at), window)
        sort = np.lexsort((offset, which))
        which, offset, owner = which[sort], offset[sort], owner[sort]
        first = np.flatnonzero(np.append(True, (which[1:] != which[:-1]) | (owner[1:] != owner[:-1]) | (offset[1:] != offset[:-1] + 1))[: len(which)])
        last = np.append(first[1:], len(which))[: len(first)] - 1
        columns = [p1[which[first]], p2[which[first]], offset[first].astype(np.int32), (offset[last] + window).astype(np.int32), owner[first]]
        return pa.RecordBatch.from_arrays([pa.array(c) for c in columns], ["p1", "p2", "from", "to", "owner"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shard, held = None, []
        for batch in batches:
            shards = batch.column("shard").to_numpy()
            at = np.flatnonzero(np.append(True, shards[1:] != shards[:-1])[: len(shards)]).tolist()
            for lo, hi in zip(at, [*at[1:], len(shards)], strict=True):
                if shards[lo] != shard:
                    if held:
                        yield done(held)
                    shard, held = shards[lo], []
                held.append(batch.slice(lo, hi - lo))
        if held:
            yield done(held)

    return run


def _merged(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sorted by (k1, k2, owner, from): overlapping stretches of a text under one owner, merged in each batch."""
    for batch in batches:
        k1, k2, start, stop, owner = (batch.column(c).to_numpy() for c in ("k1", "k2", "from", "to", "owner"))
        if not len(k1):
            continue
        group = np.cumsum(np.append(False, (k1[1:] != k1[:-1]) | (k2[1:] != k2[:-1]) | (owner[1:] != owner[:-1]))).astype(np.int64)
        reach = np.maximum.accumulate(group * (1 << 33) + stop)
        first = np.flatnonzero(np.append(True, group[1:] * (1 << 33) + start[1:] > reach[:-1]))
        last = np.append(first[1:], len(k1)) - 1
        columns = [k1[first], k2[first], start[first], (reach[last] - group[last] * (1 << 33)).astype(np.int32), owner[first]]
        yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], ["k1", "k2", "from", "to", "owner"])


def _kept(keep_text: bool):
    """Per text: words, words removed, digest of the rest (and the rest)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in slices(whole, "text"):
                words = Words(batch.column("text"), lower=False)
                joined, start, end = words.joined()
                count = words.count()
                keep = np.ones(len(words.start), bool)
                for i, cuts in enumerate(batch.column("cuts").to_pylist()):
                    if cuts:
                        a, b = int(words.first[i]), int(words.first[i + 1])
                        own = tuple(x[0] for x in halves([digest(memoryview(joined)[start[a] : end[b - 1]])])) if b > a else None
                        for cut in cuts:
                            if (cut["k1"], cut["k2"]) == own:
                                for s in cut["spans"]:
                                    keep[a + s["from"] : a + s["to"]] = False
                total = np.append(0, np.cumsum(keep))[words.first]
                rest = joined[np.repeat(keep, end - start + 1)]
                ends = np.append(0, np.cumsum((end - start + 1)[keep]))[total]
                raw = memoryview(rest)
                parts = [raw[a : b - 1] if b > a else b"" for a, b in zip(ends[:-1].tolist(), ends[1:].tolist(), strict=True)]
                columns = [batch.column("doc_id"), pa.array(count), pa.array(count - np.diff(total)), pa.array([hashlib.sha256(p).hexdigest() for p in parts], pa.string())]
                kept = [pa.array([bytes(p).decode() for p in parts], pa.string())] if keep_text else []
                yield pa.RecordBatch.from_arrays(columns + kept, ["doc_id", "n_words", "n_removed", "kept_sha256", "kept"][: 4 + keep_text])

    return run


def remove_repeats(docs: DataFrame, window: int = WINDOW, id_col: str = "doc_id", text_col: str = "text", gram: int = GRAM, shard_bytes: int = SHARD_BYTES, keep_text: bool = True, broadcast_ids: int = MOST_IDS) -> DataFrame:
    """Removes every word covered by a window of ``window`` words that also starts in a document of smaller id.

    1. Anchors: each run of windows gives the least hash of its grams. Anchors under two ids or more mark the
       passages that may be repeated. Up to ``broadcast_ids`` of them are broadcast as a bitmap, which only passes some
       runs too many; more are joined with the runs.
    2. Passages: a task passes each distinct text and passage on once, under its least and its most id, however often it
       comes. Passages are dealt to shards by anchor, so equal windows meet in one. Under an anchor of ``HOT_RUNS``
       runs or more, windows go one by one to shards by their own hash, where equal ones still meet: so a passage of a
       third of all documents is no hot shard.
    3. A shard is indexed (``FMIndex``) and its passages streamed through it: matching statistics by backward search
       give the windows that occur elsewhere, and a range-least query their owner, the smallest document that has them.
    4. Stretches with their owners come back to the texts by digest and to the documents that have the text; those of a
       larger id than the owner lose the words. Other texts are never shuffled.

    Words are runs without the six ASCII white-space bytes, unchanged. Null, empty and short texts lose nothing. Rows
    of equal id don't remove each other; null ids neither own nor lose. Hashes only bring equal windows
    together; in a shard words are compared as they are, and texts and passages are named by 128-bit digests. Other
    columns are ignored. Columns: id, n_words, n_removed, kept_sha256 (and kept: the words joined by one space).
    """
    texts = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    owned = texts.where("doc_id is not null")
    anchors = owned.mapInArrow(_anchors(window, gram), "anchor long, doc_id long, runs int")
    shared = anchors.repartition("anchor").groupBy("anchor").agg(F.min("doc_id").alias("a"), F.max("doc_id").alias("b"), F.sum("runs").alias("n")).where("a < b")
    shared = written(shared.select("anchor", "n"), "anchors")
    known = IdFilter(shared, "anchor", broadcast_ids)
    if known.bitmap is not None:
        hot = IdFilter(shared.where(F.col("n") >= HOT_RUNS), "anchor", broadcast_ids)
        passages = owned.mapInArrow(_passages(window, gram, known.bitmap, hot.bitmap), PASSAGES)
    else:
        runs = owned.mapInArrow(_runs(window, gram), "doc_id long, k1 long, k2 long, anchor long, at int, count int").join(shared, "anchor")
        runs = runs.groupBy("doc_id").agg(F.collect_list(F.struct("k1", "k2", "at", (F.col("n") >= HOT_RUNS).alias("hot"))).alias("runs"))  # bounded by a text's length
        passages = owned.join(runs, "doc_id").select("doc_id", "text", "runs").mapInArrow(_passages(window, gram, None, None), PASSAGES)
    passages = written(passages, "passages")
    size = passages.agg(F.coalesce(F.sum(F.octet_length("words")), F.lit(0))).first()[0]
    shards = max(1, -(-size // shard_bytes))
    indexed = passages.where("cell is not null").select(F.pmod("cell", F.lit(shards)).cast("int").alias("shard"), "p1", "p2", "doc_id", "words")
    stretches = indexed.repartition("shard").sortWithinPartitions("shard").mapInArrow(_searched(window), OWNED)
    stretches = written(stretches, "stretches")
    within = passages.where("p1 is not null and k1 is not null").select("k1", "k2", "at", "p1", "p2").join(stretches, ["p1", "p2"])
    within = within.select("k1", "k2", (F.col("at") + F.col("from")).alias("from"), (F.col("at") + F.col("to")).alias("to"), "owner")
    within = within.repartition("k1", "k2").sortWithinPartitions("k1", "k2", "owner", "from").mapInArrow(_merged, "k1 long, k2 long, `from` int, `to` int, owner long")
    lost = within.groupBy("k1", "k2").agg(F.collect_set(F.struct("from", "to", "owner")).alias("spans"))  # bounded by a text's length
    lost = written(lost, "lost")  # so that the join with a text's many copies is one that Spark can split
    cut = passages.where("p1 is null").select("doc_id", "k1", "k2").join(lost, ["k1", "k2"])
    cut = cut.withColumn("spans", F.filter("spans", lambda s: s["owner"] < F.col("doc_id"))).where(F.size("spans") > 0)
    cut = written(cut.groupBy("doc_id").agg(F.collect_set(F.struct("k1", "k2", "spans")).alias("cuts")), "cuts")
    some = IdFilter(cut, "doc_id", broadcast_ids)
    whole = some.rows(texts, "doc_id", False).withColumn("cuts", F.lit(None).cast(cut.schema["cuts"].dataType))
    rows = whole.unionByName(some.rows(texts, "doc_id", True).join(cut, "doc_id", "left").select("doc_id", "text", "cuts"))
    out = rows.mapInArrow(_kept(keep_text), "doc_id long, n_words long, n_removed long, kept_sha256 string" + ", kept string" * keep_text)
    return out.withColumnRenamed("doc_id", id_col)


def op6_substrings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return remove_repeats(table(spark, sf_dir, "documents"), keep_text=False)


OP6_SQL = r"""
WITH w AS (
  SELECT doc_id, list_filter(regexp_split_to_array(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w FROM documents),
s AS (SELECT doc_id, unnest(range(1, len(w) - 11)) AS i, w FROM w),
g AS (SELECT doc_id, i, array_to_string(w[i:i + 12], ' ') AS g FROM s),
o AS (SELECT g, min(doc_id) AS owner FROM g GROUP BY g),
r AS (SELECT DISTINCT doc_id, unnest(range(i, i + 13)) AS i FROM g JOIN o USING (g) WHERE owner < doc_id),
l AS (SELECT doc_id, list(i) AS gone FROM r GROUP BY doc_id)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(len(gone), 0)::BIGINT AS n_removed,
  sha256(array_to_string(CASE WHEN gone IS NULL THEN w ELSE list_filter(w, lambda x, k: NOT list_contains(gone, k)) END, ' ')) AS kept_sha256
FROM w LEFT JOIN l USING (doc_id)
"""

"""Operator 8: byte-level BPE by monoid tree reduction, and decoding up the same tree."""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Callable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from spectrail.llm._shared import table
from spectrail.llm._text import slices

#: Characters of a leaf of the tree, and of the first window on each side of a join.
LEAF, WINDOW = 4096, 32

#: The characters that count as white space in both regular-expression engines used.
SPACES = frozenset("\t\n\x0b\x0c\r \x85\xa0                　")
#: Characters on which engines may differ; no cut touches them.
UNSURE = frozenset("\x1c\x1d\x1e\x1f᠎​﻿")

Encode = Callable[[str], list[int]]


@lru_cache(maxsize=4)
def rank_encoder(path: str, pattern: str):
    """The rank file's encoding, once for each Python worker."""
    import tiktoken

    with open(path, "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    return tiktoken.Encoding(path, pat_str=pattern, mergeable_ranks=ranks, special_tokens={})


def is_cut(text: str, p: int) -> bool:
    """Whether every split of any text around here begins a piece at ``p``.

    White space stands only at the head of a piece or in a piece that is all white space,
    so a change from another character to white space ends a piece whatever surrounds it.
    """
    a, b = text[p - 1], text[p]
    return b in SPACES and a not in SPACES and a not in UNSURE


def encode_tree(text: str, encode: Encode, leaf: int = LEAF, window: int = WINDOW) -> list[int]:
    """``encode(text)`` by halves. ``encode`` must treat pieces between cuts independently."""
    return _encode(text, 0, len(text), encode, max(2, leaf), max(1, window))


def _encode(text: str, a: int, b: int, encode: Encode, leaf: int, window: int) -> list[int]:
    if b - a <= leaf:
        return encode(text[a:b])
    m = (a + b) // 2
    return _join(text, a, m, b, _encode(text, a, m, encode, leaf, window), _encode(text, m, b, encode, leaf, window), encode, window)


def _join(text: str, a: int, m: int, b: int, left: list[int], right: list[int], encode: Encode, window: int) -> list[int]:
    """Ids of text[a:b] from those of text[a:m] and text[m:b].

    The window around m grows until a cut stands on each side. At a cut both halves' own
    encodings break as the whole's does, so ids before the left and after the right cut
    stay; only text between is encoded anew. Without cuts the window becomes the whole.
    """
    p = q = m
    w = window
    while True:
        low, high = max(a, m - w), min(b, m + w)
        p = next((x for x in range(min(m, b - 1), max(low, a + 1) - 1, -1) if x > a and is_cut(text, x)), a if low == a else -1)
        q = next((x for x in range(m + 1, high) if is_cut(text, x)), b if high == b else -1)
        if p == m:
            return left + right
        if p >= 0 and q >= 0:
            break
        w *= 2
    keep = len(left) - len(encode(text[p:m]))
    skip = len(encode(text[m:q]))
    return left[:keep] + encode(text[p:q]) + right[skip:]


def decode_tree(ids: list[int], token: list[bytes] | dict[int, bytes], leaf: int = LEAF) -> bytes:
    """Bytes of the ids: leaves decode their ids, each node joins its two halves."""
    parts = [b"".join([token[i] for i in ids[x : x + leaf]]) for x in range(0, len(ids), leaf)]
    while len(parts) > 1:
        parts = [b"".join(parts[x : x + 2]) for x in range(0, len(parts), 2)]
    return parts[0] if parts else b""


@lru_cache(maxsize=4)
def _tokens(path: str, pattern: str) -> list[bytes]:
    """Bytes by id."""
    ranks = rank_encoder(path, pattern)._mergeable_ranks
    out = [b""] * (max(ranks.values(), default=-1) + 1)
    for token, i in ranks.items():
        out[i] = token
    return out


def encode_decode(df: DataFrame, path: str, pattern: str, id_col: str = "doc_id", text_col: str = "text", keep_ids: bool = True, keep_decoded: bool = True, leaf: int = LEAF) -> DataFrame:
    """Ids and decoded bytes of every whole text.

    Nothing is shuffled; a task holds one slice of documents. Null texts are empty: no ids,
    no bytes. Texts of any length go through the same tree. Repeated rows and null ids are
    kept as they come; other columns, whatever their names, are ignored.
    Columns: id, n_tokens, ids_sha256, decoded_sha256, and if kept ids, decoded.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode, token = rank_encoder(path, pattern).encode_ordinary, _tokens(path, pattern)
        for whole in batches:
            for batch in slices(whole, text_col):
                out: list[list] = [[] for _ in schema]
                for text in batch.column(text_col).to_pylist():
                    ids = encode_tree(text or "", encode, leaf)
                    decoded = decode_tree(ids, token, leaf)
                    row = [len(ids), hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest(), hashlib.sha256(decoded).hexdigest()]
                    for x, value in zip(out[1:], row + [np.asarray(ids, np.int32)] * keep_ids + [decoded] * keep_decoded, strict=True):
                        x.append(value)
                yield pa.RecordBatch.from_arrays([batch.column(id_col), *(pa.array(x, t) for x, (_, t) in zip(out[1:], schema[1:], strict=True))], [c for c, _ in schema])

    kind = df.schema[id_col].dataType.simpleString()
    schema: list[tuple[str, pa.DataType | None]] = [(id_col, None), ("n_tokens", pa.int64()), ("ids_sha256", pa.string()), ("decoded_sha256", pa.string())]
    ddl = f"`{id_col}` {kind}, n_tokens long, ids_sha256 string, decoded_sha256 string"
    for keep, name, arrow, sql in ((keep_ids, "ids", pa.list_(pa.int32()), "array<int>"), (keep_decoded, "decoded", pa.binary(), "binary")):
        if keep:
            schema.append((name, arrow))
            ddl += f", {name} {sql}"
    return df.select(id_col, text_col).mapInArrow(run, ddl)


def op8_bpe_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return encode_decode(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN, keep_ids=False, keep_decoded=False)

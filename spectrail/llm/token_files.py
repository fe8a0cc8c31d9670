"""Operator 5: token ids in files of independent zstandard frames with a trailing seek table.

File format, all numbers little-endian::

    frame*     zstandard frames, each of whole documents' ids (uint16 or uint32) one after another
    table      one zstandard frame: frame entries, then document entries
               frame entry     offset u64, compressed u32, ids u64, first document u64, crc32 u32
               document entry  doc_id i64, ids u64
    footer     frames u64, documents u64, ids u64, table offset u64, table compressed u64,
               table crc32 u32, bytes an id u32, magic b"STKSEEK1"

A reader takes the footer and the table, then decompresses only the frames that hold the
documents it wants; a frame's crc32 is that of its uncompressed bytes.
"""

from __future__ import annotations

import re
import struct
import uuid
import zlib
from collections.abc import Iterable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.fs as pafs
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from spectrail.llm._shared import fresh_path, table
from spectrail.llm._text import ranges, same_spans, slices, span_hash, text_bytes

MAGIC = b"STKSEEK1"
FRAME_IDS = 1 << 16
FOOTER = struct.Struct("<QQQQQII8s")
FRAME = np.dtype([("offset", "<u8"), ("size", "<u4"), ("ids", "<u8"), ("document", "<u8"), ("crc", "<u4")])
DOCUMENT = np.dtype([("doc_id", "<i8"), ("ids", "<u8")])
#: Distinct chunks of text whose ids a worker remembers before it starts afresh.
MEMORY = 1_000_000
#: Bytes of text in a file, about; small tables have files enough for all cores.
FILE_BYTES = 256 << 20


class ChunkEncoder:
    """Encodes whole texts with a ``tokenizers`` file, each distinct chunk of text once.

    A chunk runs from white space to the next place where white space follows another
    character. Byte-level pieces have white space only at their head, so a piece begins at
    each such place and the ids of a text are those of its chunks in turn. The library cuts a
    text at the texts of added tokens first: each of these is a chunk of its own. Chunks are
    found in the memory by a hash and then compared byte by byte.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.model = Tokenizer.from_file(path)
        added = list(self.model.get_added_tokens_decoder().values())
        if self.model.normalizer or any(t.lstrip or t.rstrip or t.single_word for t in added):
            raise ValueError(f"{path}: added tokens that take more than their own text, or a normalizer, are not supported")
        # of those that begin at one place the longest, as in the library
        longest = sorted((t.content.encode() for t in added), key=len, reverse=True)
        self.added = re.compile(b"|".join(map(re.escape, longest))) if added else None
        self.slot: dict[int, int] = {}
        self._reset()
        self.width = np.zeros(self.model.get_vocab_size(), np.int64)
        for token, i in self.model.get_vocab().items():
            self.width[i] = len(token)

    def _reset(self) -> None:
        self.slot.clear()
        self.ids, self.used = np.zeros(1 << 16, np.uint32), 0
        self.begin, self.count, self.slots = np.zeros(1 << 12, np.int64), np.zeros(1 << 12, np.int64), 0
        self.raw, self.raw_used, self.raw_begin, self.raw_end = np.zeros(1 << 16, np.uint8), 0, np.zeros(1 << 12, np.int64), np.zeros(1 << 12, np.int64)

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all texts, offsets of len + 1)."""
        if len(self.slot) > MEMORY:
            self._reset()
        data, offsets = text_bytes(texts)
        n = len(data)
        if not n:
            return np.zeros(0, np.uint32), np.zeros(len(offsets), np.int64)
        white = np.isin(data, np.array([0x20, 0x0A, 0x0D, 0x09], np.uint8))
        # another character for certain: printable ASCII, or the end of a sequence that no white space has
        lead = (data >= 0xE1) & (data <= 0xE3) | (data == 0xC2)
        sure = (data > 0x20) & (data < 0x7F) | (data >= 0x80)
        sure[1:] &= ~lead[:-1]
        sure[2:] &= ~lead[:-2]
        sure[3:] &= ~lead[:-3]
        begins = np.zeros(n, bool)
        begins[1:] = white[1:] & sure[:-1]
        # a letter (ASCII or Latin-1) before ASCII punctuation: no piece holds both in this order
        small = data | 0x20
        letter = (small >= 0x61) & (small <= 0x7A) & (data < 0x80)
        latin = (data[1:] >= 0x80) & (data[1:] != 0x97) & (data[1:] != 0xB7) & (data[:-1] == 0xC3)
        letter[1:] |= latin
        dot = (data > 0x20) & (data < 0x7F) & ~letter & ((data < 0x30) | (data > 0x39))
        begins[1:] |= dot[1:] & letter[:-1]
        if self.added and self.added.search(data):
            for a, b in zip(offsets[:-1].tolist(), offsets[1:].tolist(), strict=True):
                for m in self.added.finditer(data, a, b):
                    begins[m.start() : m.end()] = False
                    begins[m.start()] = True
                    begins[m.end() : m.end() + 1] = True
        whole = offsets[:-1][np.diff(offsets) > 0]
        begins[whole] = True
        start = np.flatnonzero(begins)
        end = np.append(start[1:], n)
        hashes = span_hash(data, start, end)
        keys, first, inverse = np.unique(hashes, return_index=True, return_inverse=True)
        get = self.slot.get
        slots = np.array([get(x, -1) for x in keys.tolist()], np.int64)
        new = np.flatnonzero(slots < 0)
        if len(new):
            slots[new] = self._learn(data, start[first[new]], end[first[new]], keys[new], white)
        slots = slots[inverse]
        bad = np.flatnonzero(~same_spans(data, start, end, self.raw, self.raw_begin[slots], self.raw_end[slots]))
        if len(bad):  # other chunks of the same hash
            own: dict[bytes, int] = {}
            of = np.array([own.setdefault(data[a:b].tobytes(), len(own)) for a, b in zip(start[bad].tolist(), end[bad].tolist(), strict=True)])
            one = bad[np.unique(of, return_index=True)[1]]
            slots[bad] = self._learn(data, start[one], end[one], hashes[one], white)[of]
        count, begin = self.count[slots], self.begin[slots]
        total = np.cumsum(count)
        ids = self.ids[np.repeat(begin - (total - count), count) + np.arange(total[-1])]
        return ids, np.append(0, total)[np.searchsorted(start, offsets)]

    def _learn(self, data: np.ndarray, start: np.ndarray, end: np.ndarray, keys: np.ndarray, white: np.ndarray) -> np.ndarray:
        raw = data.tobytes()
        # a chunk with white space at its head is one after any other that doesn't end in white space: encode many in one go
        glued = white[start] & ~white[end - 1] & (data[end - 1] < 0x7F)
        found: list[np.ndarray] = [np.zeros(0, np.uint32)] * len(start)
        alone = np.flatnonzero(~glued).tolist()
        for x, e in zip(alone, self.model.encode_batch_fast([raw[start[x] : end[x]].decode() for x in alone], add_special_tokens=False), strict=True):
            found[x] = np.array(e.ids, np.uint32)
        together = np.flatnonzero(glued)
        for at in range(0, len(together), 512):
            part = together[at : at + 512]
            text = b"".join(raw[start[x] : end[x]] for x in part)
            ids = np.array(self.model.encode_batch_fast([text.decode()], add_special_tokens=False)[0].ids, np.uint32)
            cut = np.searchsorted(np.cumsum(self.width[ids]), np.cumsum(end[part] - start[part])) + 1
            for x, a, b in zip(part.tolist(), [0, *cut[:-1]], cut, strict=True):
                found[x] = ids[a:b]
        count = np.array([len(x) for x in found], np.int64)
        flat = np.concatenate(found)
        while self.used + len(flat) > len(self.ids):
            self.ids = np.concatenate([self.ids, np.zeros_like(self.ids)])
        while self.slots + len(count) > len(self.begin):
            self.begin, self.count, self.raw_begin, self.raw_end = (np.concatenate([x, np.zeros_like(x)]) for x in (self.begin, self.count, self.raw_begin, self.raw_end))
        length = end - start
        while self.raw_used + int(length.sum()) > len(self.raw):
            self.raw = np.concatenate([self.raw, np.zeros_like(self.raw)])
        self.ids[self.used : self.used + len(flat)] = flat
        slots = np.arange(self.slots, self.slots + len(count))
        self.begin[slots] = self.used + np.cumsum(count) - count
        self.count[slots] = count
        self.raw_end[slots] = self.raw_used + np.cumsum(length)
        self.raw_begin[slots] = self.raw_end[slots] - length
        self.raw[self.raw_used : self.raw_used + int(length.sum())] = data[ranges(start, length)[1]]
        self.raw_used += int(length.sum())
        self.used += len(flat)
        self.slots += len(count)
        self.slot.update(zip(keys.tolist(), slots.tolist(), strict=True))
        return slots


@lru_cache(maxsize=2)
def chunk_encoder(path: str) -> ChunkEncoder:
    return ChunkEncoder(path)


def _open(path: str) -> tuple[pafs.FileSystem, str]:
    return pafs.FileSystem.from_uri(path if "://" in path or path.startswith("file:") else f"file://{path}")


class FrameWriter:
    """Writes one file under a temporary name; ``close`` gives it its own in one step."""

    def __init__(self, path: str, width: int, frame_ids: int = FRAME_IDS, level: int = 1):
        import zstandard

        self.fs, self.path = _open(path)
        self.temporary = f"{self.path}.{uuid.uuid4().hex}.tmp"
        self.fs.create_dir(self.path.rpartition("/")[0], recursive=True)
        self.out = self.fs.open_output_stream(self.temporary)
        self.pack = zstandard.ZstdCompressor(level=level).compress
        self.kind, self.frame_ids, self.at = np.dtype(f"<u{width}"), frame_ids, 0
        self.frames: list[tuple] = []
        self.documents: list[np.ndarray] = []
        self.held: list[np.ndarray] = []
        self.n_held = self.n_documents = self.n_ids = self.first = 0

    def add(self, doc_ids: np.ndarray, ids: np.ndarray, offsets: np.ndarray) -> None:
        """Documents in turn; a frame is closed at the first document's end at or past ``frame_ids`` ids."""
        entries = np.zeros(len(doc_ids), DOCUMENT)
        entries["doc_id"], entries["ids"] = doc_ids, np.diff(offsets)
        self.documents.append(entries)
        at = 0
        while at < len(doc_ids):
            to = int(np.searchsorted(offsets, offsets[at] + max(1, self.frame_ids - self.n_held)))
            to = min(max(to, at + 1), len(doc_ids))
            self.held.append(ids[offsets[at] : offsets[to]].astype(self.kind))
            self.n_held += len(self.held[-1])
            self.n_documents += to - at
            at = to
            if self.n_held >= self.frame_ids:
                self._frame()

    def _put(self, raw: bytes) -> tuple[int, int, int]:
        packed, at = self.pack(raw), self.at
        self.out.write(packed)
        self.at += len(packed)
        return at, len(packed), zlib.crc32(raw)

    def _frame(self) -> None:
        if self.n_documents > self.first:
            at, size, crc = self._put(np.concatenate(self.held).tobytes())
            self.frames.append((at, size, self.n_held, self.first, crc))
            self.n_ids += self.n_held
            self.held, self.n_held, self.first = [], 0, self.n_documents

    def close(self) -> tuple[int, int]:
        self._frame()
        documents = np.concatenate([np.zeros(0, DOCUMENT), *self.documents])
        at, size, crc = self._put(np.array(self.frames, FRAME).tobytes() + documents.tobytes())
        self.out.write(FOOTER.pack(len(self.frames), len(documents), self.n_ids, at, size, crc, self.kind.itemsize, MAGIC))
        self.out.close()
        self.fs.move(self.temporary, self.path)
        return len(documents), self.n_ids


class FrameReader:
    """Reads the seek table first, then only the frames asked for."""

    def __init__(self, path: str):
        import zstandard

        self.fs, self.path = _open(path)
        self.unpack = zstandard.ZstdDecompressor().decompress
        self.file = self.fs.open_input_file(self.path)
        end = self.file.size()
        frames, documents, self.n_ids, at, size, crc, width, magic = FOOTER.unpack(self._at(end - FOOTER.size, FOOTER.size))
        if magic != MAGIC:
            raise ValueError(f"{path}: not a token file")
        raw = self._checked(at, size, frames * FRAME.itemsize + documents * DOCUMENT.itemsize, crc)
        self.frames = np.frombuffer(raw, FRAME, frames)
        self.documents = np.frombuffer(raw, DOCUMENT, documents, frames * FRAME.itemsize)
        self.offsets = np.append(0, np.cumsum(self.documents["ids"].astype(np.int64)))
        self.kind = np.dtype(f"<u{width}")

    def _at(self, offset: int, size: int) -> bytes:
        self.file.seek(offset)
        return self.file.read(size)

    def _checked(self, offset: int, size: int, length: int, crc: int) -> bytes:
        raw = self.unpack(self._at(offset, size), max_output_size=max(1, length))
        if len(raw) != length or zlib.crc32(raw) != crc:
            raise ValueError(f"{self.path}: frame at {offset} is damaged")
        return raw

    def frame(self, i: int) -> np.ndarray:
        at, size, ids, _, crc = self.frames[i].tolist()
        return np.frombuffer(self._checked(at, size, ids * self.kind.itemsize, crc), self.kind)

    def document(self, i: int) -> np.ndarray:
        """Ids of the file's i-th document, from its one frame."""
        f = int(np.searchsorted(self.frames["document"], i, "right")) - 1
        base = self.offsets[int(self.frames["document"][f])]
        return self.frame(f)[self.offsets[i] - base : self.offsets[i + 1] - base]

    def find(self, doc_ids: Iterable[int]) -> dict[int, np.ndarray]:
        at = np.searchsorted(self.documents["doc_id"], np.array(list(doc_ids), np.int64))
        return {int(self.documents["doc_id"][i]): self.document(int(i)) for i in at if i < len(self.documents)}

    def close(self) -> None:
        self.file.close()


def write_token_files(df: DataFrame, path: str, tokenizer: str, end_id: int, id_col: str = "doc_id", text_col: str = "text", files: int | None = None, frame_ids: int = FRAME_IDS) -> DataFrame:
    """Encode every whole text, append ``end_id``, write files in ascending id order; the files' list.

    Rows are dealt by ranges of the id (rows of equal ids by the heads of their texts too, so that an id that many
    rows share is spread) and sorted in each, so a file is one range of about ``FILE_BYTES`` of text; a task
    streams through it and holds one slice of texts and one frame. A task that is run again
    writes the same file again. The list has one row a file: file, documents, ids, least_id.
    Null texts are empty (the end id alone); a null id counts as the smallest and is written
    as -2**63; rows with equal ids follow each other by text. Empty tables write no file.
    """
    spark = df.sparkSession
    if files is None:
        size = df.agg(F.coalesce(F.sum(F.octet_length(text_col)), F.lit(0))).first()[0]
        files = max(-(-size // FILE_BYTES), 2 * spark.sparkContext.defaultParallelism)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        encoder, writer, least, name = chunk_encoder(tokenizer), None, None, f"{path}/part-{TaskContext.get().partitionId():06d}.tok"
        for whole in batches:
            for batch in slices(whole, "__text"):
                keys = batch.column("__id").to_numpy(zero_copy_only=False)
                ids, offsets = encoder.encode(batch.column("__text"))
                n = len(keys)
                ends = offsets[1:] + np.arange(n)
                full = np.empty(len(ids) + n, np.uint32)
                last = np.zeros(len(full), bool)
                last[ends] = True
                full[last], full[~last] = end_id, ids
                if writer is None:
                    writer, least = FrameWriter(name, 2 if encoder.model.get_vocab_size() <= 1 << 16 and end_id < 1 << 16 else 4, frame_ids), int(keys[0])
                writer.add(keys, full, offsets + np.arange(n + 1))
        if writer:
            documents, n_ids = writer.close()
            yield pa.RecordBatch.from_pydict({"file": [name], "documents": [documents], "ids": [n_ids], "least_id": [least]})

    rows = df.select(F.coalesce(F.col(id_col).cast("long"), F.lit(-(2**63))).alias("__id"), F.col(text_col).alias("__text"))
    dealt = rows.repartitionByRange(files, "__id", F.substring("__text", 1, 32)).sortWithinPartitions("__id", "__text")
    done = dealt.mapInArrow(run, "file string, documents long, ids long, least_id long").collect()  # one row a file
    return spark.createDataFrame(done, "file string, documents long, ids long, least_id long")


def read_token_files(listed: DataFrame) -> DataFrame:
    """Per document, from the files: doc_id, start (ids of all documents before), n_tokens, ids_crc32.

    ``listed`` has a row a file; its running sum of ids is over those few rows. Every frame
    is decompressed once and its checksum verified. An id of -2**63 comes back as null.
    """
    order = Window.orderBy("least_id", "file").rowsBetween(Window.unboundedPreceding, -1)
    spark = listed.sparkSession
    based = listed.withColumn("base", F.coalesce(F.sum("ids").over(order), F.lit(0)))
    count = max(1, min(int(spark.conf.get("spark.sql.shuffle.partitions")), 10_000))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for name, base in zip(batch.column("file").to_pylist(), batch.column("base").to_pylist(), strict=True):
                reader = FrameReader(name)
                for i in range(len(reader.frames)):
                    first = int(reader.frames["document"][i])
                    last = int(reader.frames["document"][i + 1]) if i + 1 < len(reader.frames) else len(reader.documents)
                    raw = reader.frame(i).astype("<u4")
                    at = reader.offsets[first : last + 1] - reader.offsets[first]
                    yield pa.RecordBatch.from_pydict({
                        "doc_id": pa.array(reader.documents["doc_id"][first:last], mask=reader.documents["doc_id"][first:last] == -(2**63)),
                        "start": base + reader.offsets[first:last],
                        "n_tokens": np.diff(at),
                        "ids_crc32": np.array([zlib.crc32(raw[a:b]) for a, b in zip(at, at[1:], strict=False)], np.int64),
                    })
                reader.close()

    return based.select("file", "base").repartition(count, "file").mapInArrow(run, "doc_id long, start long, n_tokens long, ids_crc32 long")


def op5_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    listed = write_token_files(table(spark, sf_dir, "documents"), fresh_path(spark, "tokens"), public_tokenizers.path("byte_bpe_50k.json"), 2)
    return read_token_files(listed)

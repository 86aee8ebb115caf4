"""Token-ID / binary output (3): Simple-8b files of token ids, written by tasks and read back.

Documents are range-sorted by id; each task encodes its texts and writes files
of about ``file_ids`` ids to the shared folder; a row per file (path, first
document's place, counts) is all that leaves the task.  A file name holds the
partition and a random part, so a task that runs again never meets its first
files; only files named in the written manifest are read.

File: magic, 8-byte little-endian length of the header, JSON header (counts),
then as little-endian arrays: document ids (8 bytes), null flags of them
(1 byte), end of each document in ids (8 bytes), word offset of each block + total
(8 bytes), words (8 bytes).

Defined cases: a null or empty text is the end id alone; null document ids
come last; rows that repeat an id are written each, ordered by a hash of the text; an empty
table writes no file.
"""

from __future__ import annotations

import json
import struct
import uuid
import zlib
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..session import shared_path
from . import simple8b
from .common import cut, only, open_fs, tune
from .tokens import encoder

MAGIC = b"TIDES8B1"


@dataclass(frozen=True)
class TokenFiles:
    tokenizer: str = "byte_bpe_50k.json"
    end_id: int = 0
    file_ids: int = 4 << 20


def to_bytes(doc_ids: list, ids: list[np.ndarray]) -> bytes:
    """One file of documents."""
    every = np.concatenate(ids) if ids else np.zeros(0, np.uint64)
    words, blocks = simple8b.encode(every)
    ends = np.cumsum([len(x) for x in ids]).astype("<i8")
    null = np.array([d is None for d in doc_ids], np.uint8)
    name = np.array([0 if d is None else d for d in doc_ids], "<i8")
    head = json.dumps({"documents": len(doc_ids), "ids": int(len(every)), "blocks": int(len(blocks) - 1), "words": int(len(words)),
                       "block": simple8b.BLOCK}).encode()
    return b"".join([MAGIC, struct.pack("<q", len(head)), head, name.tobytes(), null.tobytes(), ends.tobytes(),
                     blocks.astype("<i8").tobytes(), words.astype("<u8").tobytes()])


def from_bytes(data: bytes):
    """(document ids, start of each document + total, ids) of a file."""
    if data[:8] != MAGIC:
        raise ValueError("not a token file")
    n, = struct.unpack_from("<q", data, 8)
    h = json.loads(data[16:16 + n])
    if h["block"] != simple8b.BLOCK:
        raise ValueError("unknown block size")
    at = 16 + n

    def part(kind, count):
        nonlocal at
        x = np.frombuffer(data, kind, count, at)
        at += x.nbytes
        return x
    name, null, ends = part("<i8", h["documents"]), part("u1", h["documents"]), part("<i8", h["documents"])
    blocks, words = part("<i8", h["blocks"] + 1), part("<u8", h["words"])
    if at != len(data):
        raise ValueError("token file of another length than its header says")
    ids = simple8b.decode(words, blocks, h["ids"])
    return [None if z else int(d) for d, z in zip(name, null, strict=True)], np.concatenate([[0], ends]).astype(np.int64), ids


def _write(folder: str, f: TokenFiles):
    def run(batches):
        from pyspark import TaskContext
        fs, path = open_fs(folder)
        fs.create_dir(path, recursive=True)
        enc, pid = encoder(f.tokenizer), TaskContext.get().partitionId()
        docs, ids, total, k, made = [], [], 0, 0, []

        def flush():
            nonlocal docs, ids, total, k
            if docs:
                name = f"part-{pid:06d}-{k:04d}-{uuid.uuid4().hex}.s8b"
                with fs.open_output_stream(f"{path}/{name}") as out:
                    out.write(to_bytes(docs, ids))
                made.append((pid, k, name, len(docs), total))
                docs, ids, total, k = [], [], 0, k + 1
        for batch in batches:
            for d, x in zip(batch.column(0).to_pylist(), enc.encode(batch.column(1).to_pylist()), strict=True):
                x = np.append(x, x.dtype.type(f.end_id) if f.end_id <= np.iinfo(x.dtype).max else np.uint64(f.end_id))
                docs.append(d)
                ids.append(x)
                total += len(x)
                if total >= f.file_ids:
                    flush()
        flush()
        kinds = (pa.int32(), pa.int32(), pa.string(), pa.int64(), pa.int64())
        yield pa.RecordBatch.from_arrays([pa.array([m[i] for m in made], t) for i, t in enumerate(kinds)], names=["pid", "k", "file", "documents", "ids"])
    return run


def write(docs: DataFrame, f: TokenFiles = TokenFiles(), folder: str | None = None, id_col: str = "doc_id", text: str = "text") -> tuple[str, DataFrame]:
    """(folder, manifest): writes all documents; the manifest has a row per file with ``first``, the ids before it."""
    spark = docs.sparkSession
    tune(spark)
    folder = folder or shared_path(spark, f"token-files-{uuid.uuid4().hex}")
    d = only(docs, **{"doc_id": id_col, "text": text}).withColumn("doc_id", F.col("doc_id").cast("long"))
    order = [F.col("doc_id").asc_nulls_last(), F.xxhash64("text")]  # short keys: the range sample holds no text
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    rows = d.repartitionByRange(parts, *order).sortWithinPartitions(*order).mapInArrow(
        _write(folder, f), "pid int, k int, file string, documents long, ids long")
    m = cut(rows, "token-manifest")
    before = Window.orderBy("pid", "k").rowsBetween(Window.unboundedPreceding, -1)  # a row per file
    return folder, m.withColumn("first", F.coalesce(F.sum("ids").over(before), F.lit(0)))


def _read(folder: str, with_ids: bool):
    def run(batches):
        fs, path = open_fs(folder)
        for batch in batches:
            for file, first in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                with fs.open_input_stream(f"{path}/{file}") as src:
                    docs, start, ids = from_bytes(src.read())
                small = ids.astype("<u4")
                part = [small[a:b] for a, b in zip(start[:-1], start[1:], strict=True)]
                cols = [pa.array(docs, pa.int64()), pa.array(first + start[:-1]), pa.array(np.diff(start)), pa.array([zlib.crc32(x) for x in part], pa.int64())]
                names = ["doc_id", "start", "n_tokens", "ids_crc32"]
                if with_ids:
                    cols.append(pa.array([x.tobytes() for x in part], pa.binary()))
                    names.append("ids")
                yield pa.RecordBatch.from_arrays(cols, names=names)
    return run


def read(folder: str, manifest: DataFrame, with_ids: bool = False) -> DataFrame:
    """doc_id, start, n_tokens, ids_crc32 (and ids as unsigned 32-bit) per document, from the files alone."""
    parts = int(manifest.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    rows = manifest.select("file", "first").repartition(parts)
    return rows.mapInArrow(_read(folder, with_ids), "doc_id long, start long, n_tokens long, ids_crc32 long" + (", ids binary" if with_ids else ""))

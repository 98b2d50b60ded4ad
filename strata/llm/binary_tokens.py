"""Token-ID output: flat unsigned integer files with 64-bit document offsets.

A corpus is a folder of shards in ascending doc_id order.  Shard ``n`` has

* ``shard-n.ids``: its token ids, little-endian, uint16 when the vocabulary fits, else uint32;
* ``shard-n.off``: one int64 more than it has documents: where each starts, within the shard;
* ``shard-n.doc``: the doc_ids (int64; the smallest int64 stands for null).

The place of a token in the whole corpus is its place in the shard plus the
shard's base, and bases are the prefix sums of the shards' totals, so shards are
written independently.  Readers map the files into memory where the folder is
mounted, and read them as a stream from any other store.

Defined cases: a null text is an empty document (its end id alone); null doc_ids
come first; documents with equal ids stay apart, in the order of their texts' hashes;
an empty table gives a corpus without documents; other columns are not written.
A task writes under a name of its own and renames, so that a repeated task
replaces its shard by the same bytes.
"""

from __future__ import annotations

import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.llm.tokens import encoder

NULL_ID = -(1 << 63)
OFFSET = np.dtype("<i8")


def _store(uri: str) -> tuple[fs.FileSystem, str]:
    return fs.FileSystem.from_uri(uri if "://" in uri or uri.startswith("file:") else f"file://{uri}")


def _shard(path: str, n: int, kind: str) -> str:
    return f"{path}/shard-{n:08d}.{kind}"


def _open(store: fs.FileSystem, path: str) -> pa.NativeFile:
    return pa.memory_map(path) if isinstance(store, fs.LocalFileSystem) else store.open_input_file(path)


def _array(file: pa.NativeFile, dtype: np.dtype, start: int = 0, stop: int | None = None) -> np.ndarray:
    """Elements [start, stop) of a flat file; a mapped file is not copied."""
    stop = file.size() // dtype.itemsize if stop is None else stop
    file.seek(start * dtype.itemsize)
    return np.frombuffer(file.read_buffer((stop - start) * dtype.itemsize), dtype=dtype)


def write(docs: DataFrame, path: str, tokenizer: str, end_id: int, partitions: int, dtype: str = "<u2",
          doc_id: str = "doc_id", text: str = "text", by_chunk: bool = True) -> DataFrame:
    """Write the corpus below ``path``; returns one row per shard: shard, n_docs, n_tokens, base.

    One shuffle sends the texts to ranges of doc_id; each range is sorted, encoded
    and written by its own task, a batch of documents in memory at a time.
    """
    ids_type, most = np.dtype(dtype), np.iinfo(np.dtype(dtype)).max

    def write_shard(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, encode = TaskContext.get().partitionId(), encoder(tokenizer, by_chunk).encode
        store, root = _store(path)
        store.create_dir(root, recursive=True)
        end = np.array([end_id]).astype(ids_type).tobytes()
        names = {kind: f"{_shard(root, n, kind)}.{uuid.uuid4().hex}" for kind in ("ids", "off", "doc")}
        out = {kind: store.open_output_stream(name) for kind, name in names.items()}
        at = n_docs = 0
        out["off"].write(np.zeros(1, OFFSET).tobytes())
        for batch in batches:
            ends, ids = [], batch.column(0).fill_null(NULL_ID)
            for value in batch.column(1):
                found = np.frombuffer(encode(value.as_py() or ""), dtype="<u4")
                if found.size and found.max() > most:
                    raise ValueError(f"ids above {most} need a wider type than {dtype}")
                out["ids"].write(found.astype(ids_type).tobytes() + end)
                at += found.size + 1
                ends.append(at)
            out["off"].write(np.asarray(ends, OFFSET).tobytes())
            out["doc"].write(ids.to_numpy(zero_copy_only=False).astype(OFFSET).tobytes())
            n_docs += len(ends)
        for kind, name in names.items():
            out[kind].close()
            store.move(name, _shard(root, n, kind))
        yield pa.RecordBatch.from_pydict({"shard": pa.array([n], pa.int32()), "n_docs": pa.array([n_docs], pa.int64()),
                                          "n_tokens": pa.array([at], pa.int64())})

    # rows of one id, or of none, may be many: their texts' hashes deal them to several ranges
    order = [F.col("_id").asc_nulls_first(), F.col("_hash")]
    own = docs.select(F.col(doc_id).cast("long").alias("_id"), F.coalesce(text, F.lit("")).alias("_text"))
    ranged = own.select("_id", F.xxhash64("_text").alias("_hash"), "_text").repartitionByRange(partitions, *order).sortWithinPartitions(
        *order, "_text").select("_id", "_text")
    shards = ranged.mapInArrow(write_shard, "shard int, n_docs long, n_tokens long").collect()
    rows, base = [], 0
    for r in sorted(shards, key=lambda r: r["shard"]):
        rows.append((r["shard"], r["n_docs"], r["n_tokens"], base))
        base += r["n_tokens"]
    return docs.sparkSession.createDataFrame(rows, "shard int, n_docs long, n_tokens long, base long")


def read(spark: SparkSession, path: str, shards: DataFrame, dtype: str = "<u2", batch_docs: int = 2000) -> DataFrame:
    """Documents of a written corpus: doc_id, start (tokens before it in the corpus), n_tokens, ids_crc32.

    ids_crc32 is taken over the ids as little-endian unsigned 32-bit integers.
    """
    ids_type = np.dtype(dtype)

    def read_shards(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, root = _store(path)
        for batch in batches:
            for row in batch.to_pylist():
                files = {k: _open(store, _shard(root, row["shard"], k)) for k in ("ids", "off", "doc")}
                for a in range(0, row["n_docs"], batch_docs):
                    b = min(a + batch_docs, row["n_docs"])
                    ends = _array(files["off"], OFFSET, a, b + 1)
                    ids = _array(files["ids"], ids_type, int(ends[0]), int(ends[-1])).astype("<u4")
                    cut = (ends - ends[0]).tolist()
                    doc = _array(files["doc"], OFFSET, a, b)
                    yield pa.RecordBatch.from_pydict({
                        "doc_id": pa.array(doc, pa.int64(), mask=doc == NULL_ID),
                        "start": pa.array(ends[:-1] + row["base"], pa.int64()),
                        "n_tokens": pa.array(np.diff(ends), pa.int64()),
                        "ids_crc32": pa.array([zlib.crc32(ids[x:y].tobytes()) for x, y in zip(cut, cut[1:])], pa.int64())})
                for f in files.values():
                    f.close()

    n = max(1, shards.count())
    return shards.repartition(n, "shard").mapInArrow(
        read_shards, "doc_id long, start long, n_tokens long, ids_crc32 long")

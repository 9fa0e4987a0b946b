"""Token-id files: flat unsigned integers plus 64-bit document offsets.

Shard k of an output folder is three files: `k.bin` (ids one after another, 16 or
32 bits by the size of the vocabulary), `k.off` (one more 64-bit offset than
documents, in ids) and `k.doc` (ids of the documents with a validity byte). Shards
follow the range partitions of doc_id, so their order is the order of documents;
prefix sums over the shards' totals give each shard's base. Ids go to the file as they are
made.
"""

from __future__ import annotations

import zlib
from dataclasses import dataclass
from itertools import chain

import numpy as np
import pyarrow as pa
from pyarrow import fs as pafs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import Scratch, documents, put, ship
from .textbytes import pieces
from .tokens import encoder, id_type, vocabulary

DOC = np.dtype([("id", "<i8"), ("valid", "u1")])
CHUNK = 4 << 20


@dataclass(frozen=True)
class TokenFiles:
    """Where the shards are, the type of an id, and each shard's (documents, ids, base)."""

    uri: str
    dtype: str
    shards: list[tuple[int, int, int]]


def view(uri: str, dtype) -> np.ndarray:
    """The file's values, memory-mapped where the folder is a local or mounted one."""
    fs, path = pafs.FileSystem.from_uri(uri)
    if not fs.get_file_info(path).size:
        return np.zeros(0, dtype)
    if isinstance(fs, pafs.LocalFileSystem):
        return np.memmap(path, dtype, "r")
    with fs.open_input_file(path) as f:
        return np.frombuffer(f.read_buffer(), dtype)


def write_token_files(docs: DataFrame, uri: str, tokenizer: str, end_id: int) -> TokenFiles:
    """Encodes each whole text, appends `end_id`, and writes ids in ascending doc_id order.

    Null text is empty and gives the end id alone. Documents with null ids come first;
    rows with the same id stay apart, in the order in which they were read. No rows
    give no files. Other columns don't matter. An id of documents must fit 64 bits.
    """
    ship(docs.sparkSession)
    dtype = id_type(tokenizer)
    end = np.array([end_id], dtype).tobytes()
    if int(np.array([end_id]).max()) > np.iinfo(dtype).max:
        raise ValueError(f"end id {end_id} does not fit {dtype}")

    def run(batches):
        shard, encode = TaskContext.get().partitionId(), encoder(tokenizer, dtype).encode
        sizes, named = [], []

        def encoded():
            for batch in batches:
                for a, b in pieces(batch.column(1), CHUNK):
                    found = [encode(t or "") + end for t in batch.column(1).slice(a, b - a).to_pylist()]
                    sizes.append(np.fromiter(map(len, found), np.int64, len(found)))
                    yield b"".join(found)
                own = np.zeros(batch.num_rows, DOC)
                own["id"] = batch.column(0).fill_null(0).to_numpy(zero_copy_only=False)
                own["valid"] = batch.column(0).is_valid().to_numpy(zero_copy_only=False)
                named.append(own)

        blobs = encoded()
        first = next(blobs, None)
        if first is None:
            return
        put(f"{uri}/{shard}.bin", chain([first], blobs))
        offsets = np.concatenate(([0], np.cumsum(np.concatenate(sizes)))) // np.dtype(dtype).itemsize
        put(f"{uri}/{shard}.off", [offsets.astype("<u8").tobytes()])
        put(f"{uri}/{shard}.doc", [np.concatenate(named).tobytes()])
        yield pa.RecordBatch.from_pydict({"shard": [shard], "docs": [len(offsets) - 1], "ids": [int(offsets[-1])]})

    ordered = (
        docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", F.monotonically_increasing_id().alias("_nth"))
        .repartitionByRange("doc_id", "_nth")
        .sortWithinPartitions("doc_id", "_nth")
        .select("doc_id", "text")
    )
    totals = {r.shard: (r.docs, r.ids) for r in ordered.mapInArrow(run, "shard long, docs long, ids long").collect()}
    shards, base = [], 0
    for k in range(max(totals, default=-1) + 1):
        n, ids = totals.get(k, (0, 0))
        shards.append((n, ids, base))
        base += ids
    return TokenFiles(uri, dtype, shards)


def read_token_files(spark: SparkSession, files: TokenFiles, with_ids: bool = False) -> DataFrame:
    """Per document, read back from the files: doc_id, start (ids of all documents before
    it), n_tokens, ids_crc32 (of its ids as little-endian 32-bit), and with `with_ids` ids."""
    ship(spark)
    schema = "doc_id long, start long, n_tokens long, ids_crc32 long" + (", ids array<long>" if with_ids else "")

    def run(batches):
        for batch in batches:
            for k in batch.column(0).to_pylist():
                n, _, base = files.shards[k]
                if not n:
                    continue
                ids, off = view(f"{files.uri}/{k}.bin", files.dtype), view(f"{files.uri}/{k}.off", "<u8").astype(np.int64)
                named = view(f"{files.uri}/{k}.doc", DOC)
                for a in range(0, n, 5000):
                    b = min(a + 5000, n)
                    wide = ids[off[a] : off[b]].astype("<u4")
                    parts = [wide[off[i] - off[a] : off[i + 1] - off[a]] for i in range(a, b)]
                    out = {
                        "doc_id": pa.array(named["id"][a:b], mask=named["valid"][a:b] == 0),
                        "start": base + off[a:b],
                        "n_tokens": np.diff(off[a : b + 1]),
                        "ids_crc32": pa.array([zlib.crc32(p) for p in parts], pa.int64()),
                    }
                    if with_ids:
                        out["ids"] = pa.array([p.tolist() for p in parts], pa.list_(pa.int64()))
                    yield pa.RecordBatch.from_pydict(out)

    n = max(1, len(files.shards))
    return spark.range(0, len(files.shards), 1, n).mapInArrow(run, schema)


def op4_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id, start, n_tokens, ids_crc32 of every document, from the files that it writes.

    See write_token_files on nulls, repeated ids and empty tables."""
    scratch = Scratch(spark, "token-files")
    files = write_token_files(documents(spark, sf_dir), scratch.path("ids"), vocabulary("word_bpe_49k.json"), 2)
    return read_token_files(spark, files)

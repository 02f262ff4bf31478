"""Token ids in flat binary files, read back by memory map (operator 7).

File format, one family of files for each range of document ids:

* ``<shard>.bin``  token ids of all documents, unsigned little-endian, 16 bits
  if the vocabulary and the end id allow, else 32 (``width_of``); an id that does
  not fit is an error;
* ``<shard>.off``  n + 1 signed 64-bit offsets (in ids) within the shard;
* ``<shard>.doc``  n signed 64-bit document ids, then n bytes: 1 if the id is null.

A manifest table names the files of the attempt that was committed, with their
counts; a shard's base in the whole sequence is the prefix sum of the counts
before it.  Documents are in ascending order of id (null first; equal ids by
text), dealt by range, so no task sees more than its range.

Null text counts as empty (the end id alone); repeated rows are documents of
their own; an empty table gives an empty manifest.
"""

from __future__ import annotations

import os
import uuid
import zlib

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import materialize, narrow, scratch_path
from .tokens import encoder

#: Bytes of text that a range of documents has on average.
RANGE_BYTES = 32 << 20
#: Bytes that a document counts beside its text, so that empty ones fill ranges too.
ROW_BYTES = 32


def _files(uri: str):
    """(file system, path) of a folder in any store that pyarrow reaches; file:// is the shared mount."""
    from pyarrow import fs
    return fs.FileSystem.from_uri(uri if "://" in uri else "file://" + uri.removeprefix("file:"))


def width_of(vocabulary: str, end_id: int) -> int:
    """Bits of an id: 16 if every id of the vocabulary and the end id fit, else 32."""
    from tokenizers import Tokenizer
    known = Tokenizer.from_file(vocabulary).get_vocab(with_added_tokens=True)
    return 16 if max([end_id, *known.values()]) < 1 << 16 else 32


def write_token_files(docs: DataFrame, folder: str, vocabulary: str, end_id: int, id_bits: int | None = None,
                      id_col: str = "doc_id", text_col: str = "text", ranges: int | None = None) -> DataFrame:
    """Write the files below ``folder``; returns the manifest.

    Manifest: (shard int, name string, n_docs long, n_tokens long).  Without
    ``id_bits`` the vocabulary gives the width.  Each
    attempt of a task writes files of a new name, and only the names that come
    back in the manifest count, so tasks may run again or twice.
    """
    id_bits = id_bits or width_of(vocabulary, end_id)
    if not docs.schema[id_col].dataType.typeName() in ("byte", "short", "integer", "long"):
        raise TypeError(f"ids are written as 64-bit numbers, but {id_col} is {docs.schema[id_col].dataType.simpleString()}")
    src = narrow(docs, doc_id=id_col, text=text_col).withColumn("doc_id", F.col("doc_id").cast("long"))
    src = src.withColumn("tie", F.xxhash64("text"))
    if ranges is None:
        size = src.agg(F.sum(F.coalesce(F.octet_length("text"), F.lit(0)) + ROW_BYTES)).first()[0] or 0
        ranges = max(1, -(-size // RANGE_BYTES))
    order = [F.col("doc_id").asc_nulls_first(), F.col("tie").asc(), F.col("text").asc_nulls_first()]
    # Ties are ranged by the text's hash as well: no range has to hold all rows of one id.
    dealt = src.repartitionByRange(ranges, *order[:2]).sortWithinPartitions(*order)
    dealt = dealt.select(F.coalesce("doc_id", F.lit(0)).alias("doc_id"), F.col("doc_id").isNull().alias("no_id"), "text",
                         F.spark_partition_id().alias("shard"))
    kind = f"<u{id_bits // 8}"

    def write(batches):
        enc, end = encoder(vocabulary), np.array([end_id], dtype="<u4").tobytes()
        name, opened, counts, ids, nulls, shard = uuid.uuid4().hex, None, [], [], [], None
        for pdf in batches:
            if not len(pdf):
                continue
            if opened is None:
                store, base = _files(folder)
                store.create_dir(base, recursive=True)
                opened, shard = store.open_output_stream(f"{base}/{name}.bin"), int(pdf["shard"].iloc[0])
            for text in pdf.text:
                got = np.frombuffer(enc.encode(text) + end, dtype="<u4")
                if len(got) and int(got.max()) >> id_bits:
                    raise ValueError(f"id {got.max()} does not fit in {id_bits} bits")
                counts.append(len(got))
                opened.write(got.astype(kind).tobytes())
            nulls.append(pdf["no_id"].to_numpy())
            ids.append(pdf["doc_id"].to_numpy(dtype="<i8"))
        if opened is None:
            return
        opened.close()
        offsets = np.concatenate([[0], np.cumsum(counts)]).astype("<i8")
        with store.open_output_stream(f"{base}/{name}.off") as f:
            f.write(offsets.tobytes())
        with store.open_output_stream(f"{base}/{name}.doc") as f:
            f.write(np.concatenate(ids).tobytes() + np.concatenate(nulls).astype("u1").tobytes())
        yield pd.DataFrame({"shard": [shard], "name": [name], "n_docs": [len(counts)], "n_tokens": [int(offsets[-1])]})

    made = dealt.mapInPandas(write, "shard int, name string, n_docs long, n_tokens long")
    return materialize(made, "token-manifest")


def with_bases(manifest: DataFrame) -> DataFrame:
    """Adds each shard's base: the ids of all shards before it (one row for each range)."""
    return manifest.withColumn("base", F.coalesce(F.sum("n_tokens").over(
        Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))


def read_token_files(spark: SparkSession, folder: str, manifest: DataFrame, id_bits: int = 16) -> DataFrame:
    """Rows (doc_id, start, n_tokens, ids_crc32) from the files, a task for each shard."""
    kind = np.dtype(f"<u{id_bits // 8}")

    def mapped(store, path, dtype):
        from pyarrow import fs, memory_map
        if not store.get_file_info(path).size:
            return np.zeros(0, dtype)
        if isinstance(store, fs.LocalFileSystem):
            return np.frombuffer(memory_map(path).read_buffer(), dtype)
        return np.frombuffer(store.open_input_file(path).read_buffer(), dtype)

    def read(batches):
        for pdf in batches:
            for name, base in zip(pdf["name"], pdf["base"], strict=True):
                store, at = _files(folder)
                ids = mapped(store, os.path.join(at, f"{name}.bin"), kind)
                off = mapped(store, os.path.join(at, f"{name}.off"), "<i8")
                raw = mapped(store, os.path.join(at, f"{name}.doc"), "u1")
                n = len(off) - 1
                doc = pd.Series(raw[:8 * n].view("<i8")).astype("Int64").mask(raw[8 * n:].astype(bool))
                for lo in range(0, n, 4096):
                    hi = min(n, lo + 4096)
                    crc = [zlib.crc32(ids[a:b].astype("<u4").tobytes()) for a, b in zip(off[lo:hi], off[lo + 1:hi + 1], strict=True)]
                    yield pd.DataFrame({"doc_id": doc[lo:hi], "start": base + off[lo:hi],
                                        "n_tokens": np.diff(off[lo:hi + 1]), "ids_crc32": crc})

    based = with_bases(manifest)
    n = max(1, manifest.count())
    return based.repartition(n, "shard").mapInPandas(read, "doc_id long, start long, n_tokens long, ids_crc32 long")


def round_trip(spark: SparkSession, docs: DataFrame, vocabulary: str, end_id: int = 1, id_bits: int | None = None,
               id_col: str = "doc_id", text_col: str = "text", ranges: int | None = None) -> DataFrame:
    folder = scratch_path(spark, "llm-token-files")
    id_bits = id_bits or width_of(vocabulary, end_id)
    manifest = write_token_files(docs, folder, vocabulary, end_id, id_bits, id_col, text_col, ranges)
    return read_token_files(spark, folder, manifest, id_bits)

"""Token ids as flat binary files with 64-bit document offsets.

Documents are range-partitioned and sorted by key; each task writes one set of three files:

``<name>.bin``   the ids of its documents, one after the other, as little-endian unsigned integers
``<name>.idx``   n + 1 little-endian 64-bit offsets into them, counted in ids, from 0
``<name>.ids``   n little-endian 64-bit document keys

Names hold a number that is new for each attempt, so a task that is repeated after a lost executor
leaves files that no manifest row names. The manifest has one row per partition; a prefix sum over
it gives each partition's base, which makes local offsets global. Readers map local files into
memory and read ranges of others.

Defined results: NULL and empty texts are the end id alone; a NULL key sorts first and comes back as
NULL; keys that repeat stay rows of their own; an empty table gives an empty manifest. Other
columns are not read.
"""

from __future__ import annotations

import os
import uuid
import zlib
from collections.abc import Iterator
from urllib.parse import urlparse

import numpy as np
import pyarrow as pa
from pyarrow.fs import FileSystem, LocalFileSystem
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tripstrata.llm.tokens import encoder
from tripstrata.sources.staging import scratch_dir, stage_table

END_ID = 2
NULL_KEY = -(2 ** 63)
MANIFEST = "name string, dtype string, first_key long, n_documents long, n_ids long"
BATCH = 4096


def open_folder(folder: str) -> tuple[FileSystem, str]:
    """File system and path of a folder given as path or URI."""
    if urlparse(folder).scheme in ("", "file"):
        return LocalFileSystem(), urlparse(folder).path
    return FileSystem.from_uri(folder)


def write_tokens(documents: DataFrame, tokenizer: str, folder: str, key: str = "doc_id", text: str = "text",
                 end_id: int = END_ID) -> DataFrame:
    """Write the files into ``folder`` and return the manifest with each partition's bases, in order of keys."""

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode, end = encoder(tokenizer), encoder(tokenizer).pack([end_id])
        width, files, path = len(end), None, folder
        name = f"part-{TaskContext.get().partitionId():06d}-{uuid.uuid4().hex}"
        n = at = 0
        first = None
        for batch in batches:
            if not batch.num_rows:
                continue
            if files is None:
                system, path = open_folder(folder)
                system.create_dir(path, recursive=True)
                files = [system.open_output_stream(f"{path}/{name}.{kind}") for kind in ("bin", "idx", "ids")]
                files[1].write(np.zeros(1, "<u8").tobytes())
            keys = np.asarray(batch.column(0).fill_null(NULL_KEY), "<i8")
            first = int(keys[0]) if first is None else first
            ends = []
            for value in batch.column(1):
                ids = encode.encode(value.as_py()) + end
                files[0].write(ids)
                at += len(ids) // width
                ends.append(at)
            files[1].write(np.array(ends, "<u8").tobytes())
            files[2].write(keys.tobytes())
            n += len(ends)
        if files:
            for file in files:
                file.close()
            yield pa.RecordBatch.from_pydict({
                "name": [name], "dtype": [encode.dtype], "first_key": [first], "n_documents": [n], "n_ids": [at]})

    ordered = documents.select(F.col(key).cast("long"), text).repartitionByRange(key).sortWithinPartitions(key)
    manifest = stage_table(ordered.mapInArrow(write, MANIFEST), "token-manifest")
    before = Window.orderBy("first_key", "name").rowsBetween(Window.unboundedPreceding, -1)  # one row per partition
    zero = F.lit(0).cast("long")
    return manifest.select("*", F.coalesce(F.sum("n_documents").over(before), zero).alias("base_documents"),
                           F.coalesce(F.sum("n_ids").over(before), zero).alias("base_ids"))


def read_tokens(manifest: DataFrame, folder: str, key: str = "doc_id") -> DataFrame:
    """(key, start, n_tokens, ids_crc32): one row per document, from the files alone."""

    def mapped(system: FileSystem, path: str, dtype: str):
        if isinstance(system, LocalFileSystem):
            size = os.path.getsize(path)
            data = np.memmap(path, dtype, "r") if size else np.zeros(0, dtype)
            return lambda a, b: data[a:b]
        file, width = system.open_input_file(path), np.dtype(dtype).itemsize
        return lambda a, b: np.frombuffer(file.read_at((b - a) * width, a * width), dtype)

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        system, path = open_folder(folder)
        for row in (r for batch in batches for r in batch.to_pylist()):
            ids, offsets, keys = (mapped(system, f"{path}/{row['name']}.{kind}", dtype)
                                  for kind, dtype in (("bin", row["dtype"]), ("idx", "<u8"), ("ids", "<i8")))
            for a in range(0, row["n_documents"], BATCH):
                b = min(a + BATCH, row["n_documents"])
                own, cuts = np.array(keys(a, b)), np.array(offsets(a, b + 1)).astype(np.int64)
                crc = [zlib.crc32(ids(s, e).astype("<u4").tobytes()) for s, e in zip(cuts[:-1], cuts[1:], strict=True)]
                yield pa.RecordBatch.from_arrays([
                    pa.array(own.astype(np.int64), mask=own == NULL_KEY), pa.array(cuts[:-1] + row["base_ids"]),
                    pa.array(np.diff(cuts)), pa.array(crc, pa.int64())], ["doc_id", "start", "n_tokens", "ids_crc32"])

    spread = manifest.repartition(max(1, manifest.count()))
    return spread.mapInArrow(read, "doc_id long, start long, n_tokens long, ids_crc32 long").withColumnRenamed(
        "doc_id", key)


def new_folder(documents: DataFrame) -> str:
    """A folder of its own below the cluster's shared scratch folder."""
    return f"{scratch_dir(documents.sparkSession)}/token-files/{uuid.uuid4().hex}"

"""Token ids as flat binary files.

A dataset is a folder of parts and a manifest. ``part-00000.tokens`` holds the ids of its
documents back to back as little-endian unsigned integers, of two bytes where the vocabulary
allows and of four otherwise; ``part-00000.offsets`` holds, as 64-bit integers, where each
document starts in the part and, last, where the part ends; ``part-00000.docs`` holds the
document ids. ``manifest.json`` names the parts in order and says at which id of the whole
dataset each begins: these bases are prefix sums of the parts' lengths.
"""

import json
import zlib

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import functions as F

from widevec.llm.common import table
from widevec.llm.files import committed, make_folder, opened, read_all
from widevec.llm.words import word_encoder
from widevec.sources.scratch import scratch_path

TOKENIZER = "byte_bpe_50k.json"
END_ID = 0
# Documents whose rows a reader hands on at a time.
READ_ROWS = 2048
# Stands for a null document id in the files.
NO_ID = -(2**63)


def write_token_files(docs, path, tokenizer=TOKENIZER, end_id=END_ID, width=2, id_col="doc_id", text_col="text"):
    """Encode whole texts and write them to ``path`` in ascending order of id.

    One range shuffle of the texts; each task then encodes and writes its range as a stream,
    whatever its size. Null and empty texts are just the end id; null ids come first; rows of
    one id are ordered by their text's hash, which also lets a hot id spread. The manifest is
    written last, so a dataset without one is not complete. An empty table has no parts.
    """
    make_folder(path)
    dtype = {2: "<u2", 4: "<u4"}[width]
    rows = docs.select(
        F.col(id_col).cast("long").alias("doc_id"),
        F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"),
    ).withColumn("tie", F.xxhash64("text"))
    ordered = rows.repartitionByRange("doc_id", "tie").sortWithinPartitions("doc_id", "tie")

    def write(batches):
        number = TaskContext.get().partitionId()
        stem = f"{path}/part-{number:05d}"
        encoder, offsets, ids = None, [np.zeros(1, np.int64)], []
        batches = (batch for batch in batches if batch.num_rows)
        first = next(batches, None)
        if first is None:
            return
        at = 0
        with committed(f"{stem}.tokens") as out:
            while first is not None:
                encoder = encoder or word_encoder(tokenizer)
                for found, sizes in encoder.blocks(first.column("text"), end_id):
                    if int(found.max()) >= 1 << (8 * width):
                        raise ValueError(f"an id does not fit into {width} bytes")
                    out.write(found.astype(dtype).tobytes())
                    offsets.append(at + np.cumsum(sizes))
                    at += len(found)
                ids.append(first.column("doc_id").fill_null(NO_ID).to_numpy())
                first = next(batches, None)
        with committed(f"{stem}.offsets") as out:
            out.write(np.concatenate(offsets).astype("<i8").tobytes())
        with committed(f"{stem}.docs") as out:
            out.write(np.concatenate(ids).astype("<i8").tobytes())
        yield pa.RecordBatch.from_pydict(
            {"part": [number], "docs": [sum(map(len, ids))], "tokens": [at]},
            pa.schema([("part", pa.int32()), ("docs", pa.int64()), ("tokens", pa.int64())]),
        )

    # A row per part, whatever the number of documents.
    parts = sorted(ordered.select("doc_id", "text").mapInArrow(write, "part int, docs long, tokens long").collect())
    base, listed = 0, []
    for part in parts:
        listed.append({"part": part["part"], "docs": part["docs"], "tokens": part["tokens"], "base": base})
        base += part["tokens"]
    with committed(f"{path}/manifest.json") as out:
        out.write(json.dumps({"dtype": dtype, "tokens": base, "parts": listed}).encode())


def read_token_files(spark, path):
    """(doc_id, start, n_tokens, ids): every document of a dataset, as its files have it.

    A task maps one part and reads it a few documents at a time. ``ids`` is binary, in the
    file's own integers.
    """
    manifest = json.loads(read_all(f"{path}/manifest.json"))
    size = np.dtype(manifest["dtype"]).itemsize
    parts = [(p["part"], p["base"]) for p in manifest["parts"]]
    schema = pa.schema(
        [("doc_id", pa.int64()), ("start", pa.int64()), ("n_tokens", pa.int64()), ("ids", pa.binary())]
    )

    def read(batches):
        for batch in batches:
            for part, base in zip(batch.column("part").to_pylist(), batch.column("base").to_pylist()):
                stem = f"{path}/part-{part:05d}"
                offsets = np.frombuffer(read_all(f"{stem}.offsets"), "<i8")
                docs = np.frombuffer(read_all(f"{stem}.docs"), "<i8")
                with opened(f"{stem}.tokens") as source:
                    for at in range(0, len(docs), READ_ROWS):
                        edges = offsets[at : at + READ_ROWS + 1]
                        content = source.read_at((edges[-1] - edges[0]) * size, edges[0] * size)
                        places = pa.array(((edges - edges[0]) * size).astype(np.int32)).buffers()[1]
                        ids = pa.BinaryArray.from_buffers(
                            pa.binary(), len(edges) - 1, [None, places, pa.py_buffer(content)]
                        )
                        own = docs[at : at + READ_ROWS]
                        yield pa.RecordBatch.from_arrays(
                            [
                                pa.array(own, mask=own == NO_ID),
                                pa.array(edges[:-1] + base),
                                pa.array(np.diff(edges)),
                                ids,
                            ],
                            schema=schema,
                        )

    listed = spark.createDataFrame(parts or [(0, 0)], "part int, base long").limit(len(parts))
    listed = listed.repartition(max(1, len(parts)))
    return listed.mapInArrow(read, "doc_id long, start long, n_tokens long, ids binary"), manifest


def op2_token_files(spark, sf_dir):
    """All documents through token files; the digest widens the read ids to 32 bits."""
    path = scratch_path(spark, "tokens")
    write_token_files(table(spark, sf_dir, "documents"), path)
    found, manifest = read_token_files(spark, path)
    dtype = manifest["dtype"]

    def digest(batches):
        for batch in batches:
            sums = [zlib.crc32(np.frombuffer(ids, dtype).astype("<u4").tobytes()) for ids in batch.column("ids").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:3], pa.array(sums, pa.int64())], ["doc_id", "start", "n_tokens", "ids_crc32"]
            )

    return found.mapInArrow(digest, "doc_id long, start long, n_tokens long, ids_crc32 long")

"""The embedding operator."""

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F
from pyspark.sql import types as T

from widevec.model import load_model
from widevec.operators.perspectives import bind_columns, quoted
from widevec.tokenizer import gather_ragged, list_parts, list_type, make_tokenizer, pad_fixed

SHORTEST_PADDING = 16
# Tokens and vectors a task holds at a time.
CALL_TOKENS = 4 * 1024 * 1024
WINDOW_BYTES = 64 * 1024 * 1024


def output_schema(cfg, columns=None):
    """``gid`` and one vector per text column, in configured order."""
    names = cfg.input_columns if columns is None else columns
    vectors = [T.StructField(name, T.ArrayType(T.FloatType(), False), False) for name in names]
    return T.StructType([T.StructField("gid", T.LongType(), False), *vectors])


def embed(df, cfg, columns=None, partitions=None, model=None, tokenizer=None, reuse_repeats=None, profile=None):
    """``gid`` plus one ``array<float>`` of ``embedding_dim`` per text column.

    One narrow stage and no shuffle. Filter and pick ``columns`` before this operator, since
    Spark pushes nothing through it. ``partitions`` adds a round-robin shuffle of the texts,
    for inputs with fewer splits than the cluster has task slots; smaller scan splits do the
    same for free.

    The model is called with the texts of ``batch_size`` rows at most, fewer where they are
    long (``CALL_TOKENS``). ``reuse_repeats``, by default as the configuration says, runs a text that repeats within a window of such batches, in whatever column, through
    tokenizer and model once, and fills the calls with distinct texts. It is exact for a
    model whose vectors depend on the text alone.

    ``profile``, see ``inference_profile``, puts the model's stage on tasks with resources of
    their own, while reading and tokenizing run on ordinary ones. The ids cross between the
    two stages in one round-robin shuffle of at most ``max_tokens`` ids a text.
    """
    tokenizer = make_tokenizer(df.sparkSession, cfg) if tokenizer is None else tokenizer
    if profile is None:
        texts = prepare_texts(df, cfg, tokenizer, columns, partitions)
        return infer_vectors(texts, cfg, tokenizer, model, reuse_repeats)
    count = cfg.partitions if partitions is None else partitions
    count = count or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ids = packed_ids(_texts(df, cfg, tokenizer, columns), cfg, tokenizer).repartition(count)
    return infer_vectors(ids, cfg, PackedIds(), model, reuse_repeats, profile)


def prepare_texts(df, cfg, tokenizer, columns=None, partitions=None):
    """The bound rows as they go to Python: the id, and of every text what will be encoded."""
    texts = _texts(df, cfg, tokenizer, columns)
    count = cfg.partitions if partitions is None else partitions
    return texts if count is None else texts.repartition(count)


def _texts(df, cfg, tokenizer, columns):
    bound = bind_columns(df, cfg, columns)
    names = bound.columns[1:]
    return bound.select(
        "gid", *(tokenizer.text_input(F.col(quoted(name)), cfg.max_tokens).alias(name) for name in names)
    )


class PackedIds:
    """The tokenizer of texts that are ids already: little-endian 32-bit integers as bytes."""

    def open(self):
        return self

    def encode(self, packed):
        starts, lengths, values = list_parts(packed)
        ids = gather_ragged(starts, lengths, values).view(np.int32)
        return ids, lengths // 4


def packed_ids(texts, cfg, tokenizer):
    """``gid`` and the first ``max_tokens`` ids of every text as bytes: the stage before that of
    the model."""
    names = texts.columns

    def tokenize_batches(batches):
        encoder = None
        for batch in batches:
            encoder = encoder or tokenizer.open()
            columns = [batch.column(0)]
            for column in batch.columns[1:]:
                values, lengths = encoder.encode(column)
                kept = np.minimum(lengths, cfg.max_tokens)
                ids = gather_ragged(np.cumsum(lengths) - lengths, kept, np.ascontiguousarray(values, np.int32))
                ends = np.concatenate(([0], np.cumsum(kept))) * 4
                packed = pa.py_buffer(np.ascontiguousarray(ids).tobytes())
                columns.append(pa.BinaryArray.from_buffers(pa.binary(), len(kept), [None, pa.py_buffer(ends.astype(np.int32).tobytes()), packed]))
            yield pa.RecordBatch.from_arrays(columns, names=names)

    schema = T.StructType([texts.schema["gid"], *(T.StructField(name, T.BinaryType(), False) for name in names[1:])])
    return texts.mapInArrow(tokenize_batches, schema)


def infer_vectors(texts, cfg, tokenizer, model=None, reuse_repeats=None, profile=None):
    reuse_repeats = cfg.reuse_repeats if reuse_repeats is None else reuse_repeats
    model = load_model(texts.sparkSession, cfg) if model is None else model
    schema = output_schema(cfg, texts.columns[1:])
    batch_size, width = cfg.batch_size, cfg.embedding_dim
    texts_per_row = len(schema) - 1
    window = window_rows(cfg, texts_per_row) if reuse_repeats else batch_size

    def embed_batches(batches):
        infer = None
        for batch in batches:
            # An empty partition opens nothing.
            if infer is None:
                encoder, infer = tokenizer.open(), model.open()
            for start in range(0, batch.num_rows, window):
                rows = batch.slice(start, window)
                slots, texts = distinct_texts(rows.columns[1:], reuse_repeats)
                values, lengths = encoder.encode(texts)
                padded = padded_lengths(lengths, cfg.max_tokens, cfg.trim_padding)
                vectors = infer_texts(infer, values, lengths, padded, batch_size * texts_per_row, width)
                for first in range(0, rows.num_rows, batch_size):
                    lists = vector_lists(vectors, slots[:, first : first + batch_size])
                    ids = rows.column(0).slice(first, batch_size)
                    yield pa.RecordBatch.from_arrays([ids, *lists], names=schema.names)

    return texts.mapInArrow(embed_batches, schema, profile=profile)


def window_rows(cfg, texts_per_row):
    """Rows among which repeats are looked for: whole micro-batches, as many as fit in memory."""
    row_bytes = 4 * texts_per_row * (cfg.embedding_dim + cfg.max_tokens)
    return cfg.batch_size * max(1, WINDOW_BYTES // row_bytes // cfg.batch_size)


def distinct_texts(columns, reuse_repeats):
    """The texts to encode, and per column where in them each row finds its own."""
    texts = pa.concat_arrays(columns)
    if not reuse_repeats:
        return np.arange(len(texts)).reshape(len(columns), -1), texts
    encoded = texts.dictionary_encode()
    return encoded.indices.to_numpy().reshape(len(columns), -1), encoded.dictionary


def padded_lengths(lengths, max_len, trim_padding):
    """The length each text is padded to: the next power of two if trimmed, else the full one."""
    if not trim_padding:
        return np.full(len(lengths), max_len)
    longer = np.maximum(lengths, SHORTEST_PADDING)
    return np.minimum(2 ** np.ceil(np.log2(longer)).astype(np.int64), max_len)


def infer_texts(infer, values, lengths, padded, most, width):
    """One vector per text, from calls of at most ``most`` texts of one padded length and at
    most ``CALL_TOKENS`` tokens, or one text."""
    starts = np.cumsum(lengths) - lengths
    vectors = np.empty((len(lengths), width), np.float32)
    for size in np.unique(padded):
        same = np.flatnonzero(padded == size)
        step = max(1, min(most, CALL_TOKENS // int(size)))
        for at in range(0, len(same), step):
            rows = same[at : at + step]
            ids, mask = pad_fixed(gather_ragged(starts[rows], lengths[rows], values), lengths[rows], size)
            found = infer(ids, mask)
            if found.shape != (len(rows), width):
                raise ValueError(f"the model gave {found.shape}, expected {(len(rows), width)}")
            vectors[rows] = found
    return vectors


def vector_lists(vectors, slots):
    """One Arrow list array per column, each row the vector its slot points to."""
    width = vectors.shape[1]
    offsets = pa.array(np.arange(slots.shape[1] + 1, dtype=np.int32) * width)
    kind = list_type(vectors)
    return [
        pa.ListArray.from_arrays(offsets, pa.array(vectors.take(column, axis=0).ravel()), type=kind)
        for column in slots
    ]

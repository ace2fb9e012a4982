"""Tokenizers as the tasks use them.

A tokenizer is a small picklable handle. ``text_input`` is the Column that is sent to
Python, ``open`` gives the per-worker encoder, and an encoder turns one Arrow array of
texts into flat int32 ids plus one length per text.
"""

import itertools
import os
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from widevec.artifacts import Artifact, ship_file

# Fixed values of the byte vocabulary: pad 0, end 1, unknown 2, then the 256 bytes.
PAD_ID = 0
EOS_ID = 1
BYTE_OFFSET = 3
BYTE_VOCABULARY = 259

# Open tokenizers of a Python worker, the one used longest ago first.
KEPT_TOKENIZERS = 3
_opened = {}


def list_parts(array):
    """Start offsets, lengths and flat values of a string, binary or list array.

    Arrow slices share their buffers, so everything is read from the array's own offset.
    """
    wide = pa.types.is_large_string(array.type) or pa.types.is_large_binary(array.type)
    wide = wide or pa.types.is_large_list(array.type)
    buffers = array.buffers()
    if len(array) == 0:
        offsets = np.zeros(1, np.int64)
    else:
        dtype = np.int64 if wide else np.int32
        offsets = np.frombuffer(buffers[1], dtype, len(array) + 1, array.offset * dtype().itemsize)
    starts = offsets[:-1].astype(np.int64)
    lengths = np.diff(offsets).astype(np.int64)
    if array.null_count:
        lengths[array.is_null().to_numpy(zero_copy_only=False)] = 0
    if pa.types.is_list(array.type) or pa.types.is_large_list(array.type):
        values = array.values.to_numpy(zero_copy_only=False)
    elif buffers[2] is None:
        values = np.zeros(0, np.uint8)
    else:
        values = np.frombuffer(buffers[2], np.uint8)
    return starts, lengths, values


def gather_ragged(starts, lengths, values):
    """The values of all rows back to back."""
    if len(starts) and (starts[1:] == starts[:-1] + lengths[:-1]).all():
        return values[starts[0] : starts[-1] + lengths[-1]]
    firsts = np.cumsum(lengths) - lengths
    return values[np.arange(lengths.sum()) + np.repeat(starts - firsts, lengths)]


def list_type(values):
    """The Arrow type of lists of these values. No element is ever null, and saying so spares
    Spark a check per element."""
    return pa.list_(pa.field("element", pa.from_numpy_dtype(values.dtype), nullable=False))


def to_list_array(values, lengths):
    offsets = np.concatenate(([0], np.cumsum(lengths)))
    if offsets[-1] > np.iinfo(np.int32).max:
        raise ValueError("more values than one Arrow list array holds: send fewer rows per batch")
    return pa.ListArray.from_arrays(
        pa.array(offsets.astype(np.int32)), pa.array(values), type=list_type(values)
    )


def refuse_null_ids(ids):
    """A null list decodes to an empty text, but a null inside one stands for no text at all."""
    if ids.flatten().null_count:
        raise ValueError("null among the ids")


def pad_fixed(values, lengths, max_len):
    """Cut or pad every id list to ``max_len``. Returns ids and mask, both ``[texts, max_len]``."""
    kept = np.minimum(lengths, max_len)
    if (lengths > max_len).any():
        position = np.arange(lengths.sum()) - np.repeat(np.cumsum(lengths) - lengths, lengths)
        values = values[position < max_len]
    mask = np.arange(max_len) < kept[:, None]
    ids = np.full(mask.shape, PAD_ID, np.int32)
    ids[mask] = values
    return ids, mask.astype(np.int32)


@dataclass(frozen=True)
class ByteTokenizer:
    """UTF-8 bytes shifted by three, then an end mark."""

    def text_input(self, text, max_len=None):
        """The bytes to encode. A fixed length uses only its first ``max_len - 1`` bytes, so
        that cut, which may fall inside a character, is made before Arrow sees the text."""
        content = F.coalesce(text, F.lit("")).cast("binary")
        return content if max_len is None else F.substring(content, 1, max_len - 1)

    def open(self):
        return self

    def encode(self, texts):
        starts, lengths, content = list_parts(texts)
        ends = np.cumsum(lengths + 1) - 1
        ids = np.full(lengths.sum() + len(lengths), EOS_ID, np.int32)
        is_byte = np.ones(len(ids), bool)
        is_byte[ends] = False
        ids[is_byte] = gather_ragged(starts, lengths, content).astype(np.int32) + BYTE_OFFSET
        return ids, lengths + 1

    def decode(self, ids):
        """The bytes behind the ids; pad, end and unknown marks have none."""
        refuse_null_ids(ids)
        starts, lengths, values = list_parts(ids)
        flat = gather_ragged(starts, lengths, values)
        if len(flat) and (flat.min() < 0 or flat.max() >= BYTE_VOCABULARY):
            raise ValueError(f"ids outside 0..{BYTE_VOCABULARY - 1} are not byte tokens")
        real = flat >= BYTE_OFFSET
        row = np.repeat(np.arange(len(lengths)), lengths)
        kept = np.bincount(row[real], minlength=len(lengths))
        offsets = np.concatenate(([0], np.cumsum(kept))).astype(np.int32)
        content = (flat[real] - BYTE_OFFSET).astype(np.uint8)
        return pa.BinaryArray.from_buffers(
            pa.binary(), len(lengths), [None, pa.py_buffer(offsets), pa.py_buffer(content)]
        )


@dataclass(frozen=True)
class SubwordTokenizer:
    """A tokenizer given by a JSON definition.

    The definition is used as it stands, its own truncation and padding included. Special
    tokens are neither added on encoding nor left out on decoding unless asked for.
    """

    definition: Artifact
    add_special_tokens: bool = False
    skip_special_tokens: bool = False

    def text_input(self, text, max_len=None):
        return F.coalesce(text, F.lit(""))

    def open(self):
        encoder = _opened.pop(self, None)
        if encoder is None:
            while len(_opened) >= KEPT_TOKENIZERS:
                del _opened[next(iter(_opened))]
            encoder = _SubwordEncoder(self)
        _opened[self] = encoder
        return encoder

    def __hash__(self):
        return hash((self.definition.digest, self.add_special_tokens, self.skip_special_tokens))

    def __eq__(self, other):
        return isinstance(other, SubwordTokenizer) and (
            (self.definition.digest, self.add_special_tokens, self.skip_special_tokens)
            == (other.definition.digest, other.add_special_tokens, other.skip_special_tokens)
        )


class _SubwordEncoder:
    def __init__(self, handle):
        self.handle = handle
        self.library = load_definition(handle.definition.read())
        padding = self.library.padding
        # Padding "to the longest" must not depend on which texts share an Arrow batch.
        self.one_by_one = padding is not None and padding["length"] is None

    def encode(self, texts):
        special = self.handle.add_special_tokens
        words = texts.to_pylist()
        if self.one_by_one:
            found = [self.library.encode(text, add_special_tokens=special).ids for text in words]
        else:
            found = [e.ids for e in self.library.encode_batch_fast(words, add_special_tokens=special)]
        lengths = np.fromiter(map(len, found), np.int64, len(found))
        ids = np.fromiter(itertools.chain.from_iterable(found), np.int32, lengths.sum())
        return ids, lengths

    def decode(self, ids):
        refuse_null_ids(ids)
        texts = self.library.decode_batch(
            [row or [] for row in ids.to_pylist()], skip_special_tokens=self.handle.skip_special_tokens
        )
        return pa.array(texts, pa.string())


def load_definition(content):
    # One Spark task per core already: the library must not start its own threads.
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer

    return Tokenizer.from_str(content.decode("utf-8"))


def make_tokenizer(spark, cfg):
    """``"byt5"`` means bytes; anything else means the definition at ``vocab_path``."""
    if cfg.tokenizer_type == "byt5":
        return ByteTokenizer()
    if not cfg.vocab_path:
        raise ValueError(f"tokenizer_type {cfg.tokenizer_type!r} needs vocab_path")
    definition = ship_file(spark, cfg.vocab_path)
    try:
        # Read here only to fail before the job starts, not in its first task.
        load_definition(definition.read())
    except Exception as error:
        raise ValueError(f"no tokenizer definition at {cfg.vocab_path}: {error}") from error
    return SubwordTokenizer(definition)

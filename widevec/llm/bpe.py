"""BPE encoding and decoding with reuse of content-defined chunks.

A text is cut where a rolling hash of its last bytes says so, hence at the same places in
every copy of a passage, whatever stands before it. A worker encodes each distinct chunk
once. Chunks are cut anywhere, also inside a word, so the ids at a join are not yet right:
they are repaired by encoding the stretch around the join again, widened on both sides until
it begins and ends at white space, where the encodings of both sides agree with that of the
whole text from then on. A stretch without white space takes in further chunks whole.
"""

import re
from collections import OrderedDict

import numpy as np
import pyarrow as pa

from widevec.llm.common import claiming, keeps, mixed, table
from widevec.llm.words import GAP, INK, sha256_hex, word_encoder

TOKENIZER = "word_bpe_49k.json"
# The hash looks at so many bytes, a power of two; a cut comes every 256 bytes or so.
WINDOW = 16
CUT_BITS = 8
# Chunks, and bytes of a chunk, that a worker keeps.
KEPT_CHUNKS = 10_000
LONGEST_KEPT = 4096

_HEAD = re.compile(f"{GAP}*{INK}*")
# The last word from behind: searching for it forwards would try every place before it.
_LIAT = re.compile(f"{INK}*{GAP}*")
_BYTES = mixed(np.arange(256, dtype=np.uint64), 11)


def cuts(content):
    """Where the chunks of UTF-8 bytes end: after every byte whose window hash has low bits 0,
    moved on to the next character's start."""
    n = len(content)
    if n <= WINDOW:
        return [n] if n else []
    codes = np.frombuffer(content, np.uint8)
    values = _BYTES[codes]
    # A polynomial of the window's bytes, which depends on them and their order alone: that of
    # twice as many bytes is put together from two of half the length.
    total, width, base = values, 1, 0x5851F42D4C957F2D
    with np.errstate(over="ignore"):
        while width < WINDOW:
            total = total[:-width] * np.uint64(base) + total[width:]
            width, base = 2 * width, base * base % 2**64
    ends = np.flatnonzero(total >> np.uint64(64 - CUT_BITS) == 0) + WINDOW
    starts = np.append(np.flatnonzero((codes & 0xC0) != 0x80), n)
    found = np.unique(starts[np.searchsorted(starts, ends)])
    return np.append(found[found < n], n).tolist()


class ChunkEncoder:
    """Ids of whole texts by reuse of chunks; exactly those of the library."""

    def __init__(self, tokenizer):
        self.words = word_encoder(tokenizer)
        self.chunks = OrderedDict()
        self.reused = self.encoded = 0

    def chunk(self, content):
        """(head, ids, tail): the first word and the last one, each with the white space before
        it, and the ids of what is between. ``ids`` is None if all of the chunk is one word."""
        found = self.chunks.get(content)
        if found is not None:
            self.reused += 1
            self.chunks.move_to_end(content)
            return found
        self.encoded += 1
        text = content.decode("utf-8")
        head = _HEAD.match(text).group()
        if len(head) == len(text):
            found = (text, None, "")
        else:
            last = len(text) - _LIAT.match(text[: len(head) - 1 : -1] if head else text[::-1]).end()
            found = (head, self.words.unmarked(text[len(head) : last]), text[last:])
        if len(content) <= LONGEST_KEPT:
            self.chunks[content] = found
            if len(self.chunks) > KEPT_CHUNKS:
                self.chunks.popitem(last=False)
        return found

    def encode(self, text):
        words = self.words
        if any(mark in text for mark in words.marks):
            return words.encode(text)
        content = text.encode("utf-8")
        found, joint, start = [], [], 0
        for end in cuts(content):
            head, ids, tail = self.chunk(content[start:end])
            start = end
            joint.append(head)
            if ids is not None:
                found.append(words.joint("".join(joint)))
                found.append(ids)
                joint = [tail]
        found.append(words.joint("".join(joint)))
        return b"".join(found)


_encoders = keeps("words", {})


def chunk_encoder(tokenizer):
    if tokenizer not in _encoders:
        _encoders[tokenizer] = ChunkEncoder(tokenizer)
    return _encoders[tokenizer]


# Ids decoded in one call of the library.
DECODE_IDS = 200_000


def encode_texts(df, text="text", tokenizer=TOKENIZER, out="ids"):
    """``df`` with the ids of its texts as little-endian unsigned 32-bit integers (binary).

    Null and empty texts have no ids. One narrow pass, no shuffle; a column named like the
    output is replaced. Memory is that of one Arrow batch of texts and the bounded caches.
    """
    kept = [f for f in df.schema.fields if f.name != out]
    order = [f.name for f in kept]

    @claiming("words")
    def run(batches):
        encoder = chunk_encoder(tokenizer)
        for batch in batches:
            ids = [encoder.encode(t or "") for t in batch.column(text).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [*[batch.column(name) for name in order], pa.array(ids, pa.binary())], [*order, out]
            )

    schema = ", ".join([*[f"`{f.name}` {f.dataType.simpleString()}" for f in kept], f"`{out}` binary"])
    return df.mapInArrow(run, schema)


def decode_ids(df, ids="ids", tokenizer=TOKENIZER, out="decoded"):
    """``df`` with the text that its ids stand for, special tokens included."""
    kept = [f for f in df.schema.fields if f.name != out]
    order = [f.name for f in kept]

    def run(batches):
        library = word_encoder(tokenizer).library
        for batch in batches:
            found, waiting, held = [], [], 0
            for content in batch.column(ids).to_pylist():
                waiting.append(np.frombuffer(content or b"", "<u4").tolist())
                held += len(waiting[-1])
                if held >= DECODE_IDS:
                    found += library.decode_batch(waiting, skip_special_tokens=False)
                    waiting, held = [], 0
            found += library.decode_batch(waiting, skip_special_tokens=False)
            yield pa.RecordBatch.from_arrays(
                [*[batch.column(name) for name in order], pa.array(found, pa.string())], [*order, out]
            )

    schema = ", ".join([*[f"`{f.name}` {f.dataType.simpleString()}" for f in kept], f"`{out}` string"])
    return df.mapInArrow(run, schema)


def bpe_digests(docs):
    """(doc_id, n_tokens, ids_sha256, decoded_sha256) of every whole text.

    Texts become ids and ids texts in one Python pass: the ids would be twice the text on
    their way through Spark and back.
    """

    @claiming("words")
    def run(batches):
        encoder = chunk_encoder(TOKENIZER)
        library = encoder.words.library
        for batch in batches:
            counts, id_sums, text_sums, waiting, held = [], [], [], [], 0

            def settle():
                nonlocal waiting, held
                texts = library.decode_batch(waiting, skip_special_tokens=False)
                text_sums.extend(sha256_hex(text.encode("utf-8")) for text in texts)
                waiting, held = [], 0

            for text in batch.column("text").to_pylist():
                ids = encoder.encode(text or "")
                counts.append(len(ids) // 4)
                id_sums.append(sha256_hex(ids))
                waiting.append(np.frombuffer(ids, "<u4").tolist())
                held += counts[-1]
                if held >= DECODE_IDS:
                    settle()
            settle()
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(counts, pa.int64()), pa.array(id_sums), pa.array(text_sums)],
                ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"],
            )

    rows = docs.select("doc_id", "text")
    kind = rows.schema["doc_id"].dataType.simpleString()
    return rows.mapInArrow(run, f"doc_id {kind}, n_tokens long, ids_sha256 string, decoded_sha256 string")


def op6_bpe_chunks(spark, sf_dir):
    return bpe_digests(table(spark, sf_dir, "documents"))

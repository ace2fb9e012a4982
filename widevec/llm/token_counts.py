"""Token counts of whole texts by overlap resynchronisation.

A huge text is encoded in chunks that overlap, each with the offsets of its tokens. Two
neighbouring chunks are spliced at an offset where a token starts in both and that is proven
stable: no piece of the vocabulary holds the two characters around it side by side, so no
merge, whatever its rank, can reach over it, and what stands on one side cannot change the
tokens of the other. Where the overlap has no such offset it is widened.
"""

import public_tokenizers
import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from widevec.llm.common import claiming, keeps, table

MODEL = "piece_bpe_32k.model"
LIMIT = 4096
# Bytes of a chunk and of the first overlap.
CHUNK = 1 << 16
OVERLAP = 1 << 10
# Bytes of text in one call of the library.
CALL = 1 << 20
SPACE = "▁"


class PieceCounter:
    """Numbers of tokens as the library gives them for whole texts."""

    def __init__(self, model, chunk=CHUNK, overlap=OVERLAP):
        from sentencepiece import SentencePieceProcessor

        self.library = SentencePieceProcessor(model_file=model)
        self.chunk, self.overlap = chunk, overlap
        self.widened = 0
        pieces = (self.library.id_to_piece(k) for k in range(self.library.get_piece_size()) if not self.library.is_byte(k))
        self.inner = {pair for piece in pieces for pair in zip(piece, piece[1:])}

    def counts(self, texts):
        """One number per text. Texts are encoded whole unless they are longer than a chunk."""
        found, waiting, held = {}, [], 0
        for text in dict.fromkeys(texts):
            if len(text) > self.chunk:
                found[text] = self.long_count(text)
                continue
            waiting.append(text)
            held += len(text)
            if held > CALL:
                found.update(zip(waiting, map(len, self.library.encode(waiting, num_threads=1))))
                waiting, held = [], 0
        found.update(zip(waiting, map(len, self.library.encode(waiting, num_threads=1))))
        return [found[text] for text in texts]

    def _starts(self, content, low, high):
        """Where the tokens of a stretch start, as offsets into the whole text."""
        pieces = self.library.encode(content[low:high].decode("utf-8"), return_type="proto").pieces
        return low + np.fromiter((piece.begin for piece in pieces), np.int64, len(pieces))

    def _stable(self, content, at):
        before = content[max(0, at - 4) : at].decode("utf-8", "ignore")[-1:]
        after = content[at : at + 4].decode("utf-8", "ignore")[:1]
        return (before.replace(" ", SPACE), after.replace(" ", SPACE)) not in self.inner

    def _even(self, text):
        """Whether the library takes the text as it stands: the proof is about its characters."""
        return self.library.Normalize(text) == SPACE + text.replace(" ", SPACE)

    def long_count(self, text):
        if not self._even(text):
            return len(self.library.encode(text))
        content = text.encode("utf-8")
        n = len(content)

        def whole(at):
            """The start of the character at an offset."""
            while 0 < at < n and content[at] & 0xC0 == 0x80:
                at -= 1
            return min(at, n)

        low, high, overlap = 0, whole(self.chunk), self.overlap
        starts, since, total = self._starts(content, low, high), 0, 0
        while high < n:
            next_low, next_high = max(low, whole(high - overlap)), whole(high + self.chunk)
            following = self._starts(content, next_low, next_high)
            common = np.intersect1d(starts, following)
            common = common[(common > max(next_low, since)) & (common < high)].tolist()
            # From the middle outwards, away from what the chunks' ends disturb.
            common.sort(key=lambda at: abs(2 * at - next_low - high))
            joint = next((at for at in common if self._stable(content, at)), None)
            if joint is None:
                self.widened += 1
                overlap *= 2
                high = whole(high + overlap)
                starts = self._starts(content, low, high)
                continue
            total += int(np.count_nonzero((starts >= since) & (starts < joint)))
            low, high, starts, since, overlap = next_low, next_high, following, joint, self.overlap
        return total + int(np.count_nonzero(starts >= since))


_counters = keeps("token_counts", {})


def piece_counter(model):
    """One per Python worker and model; ``model`` is a public tokenizer or a path."""
    if model not in _counters:
        _counters[model] = PieceCounter(model if "/" in model else public_tokenizers.path(model))
    return _counters[model]


def count_tokens(df, text="text", model=MODEL, out="n_tokens"):
    """``df`` with the number of tokens of every whole text.

    Null and empty texts have none; a column named like the output is replaced; repeated
    texts of a batch are encoded once. One narrow pass, no shuffle: beside an Arrow batch and
    the model, memory is that of a call of 1 MB of text or, of longer texts, of two chunks,
    unless a text has no stable offset in a chunk's length.
    """
    kept = [f for f in df.schema.fields if f.name != out]
    order = [f.name for f in kept]

    @claiming("token_counts")
    def run(batches):
        for batch in batches:
            counts = piece_counter(model).counts([t or "" for t in batch.column(text).to_pylist()])
            columns = [*[batch.column(name) for name in order], pa.array(counts, pa.int64())]
            yield pa.RecordBatch.from_arrays(columns, [*order, out])

    schema = ", ".join([*[f"`{f.name}` {f.dataType.simpleString()}" for f in kept], f"`{out}` bigint"])
    return df.mapInArrow(run, schema)


def op11_token_counts(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    n_bytes = F.octet_length(F.coalesce("text", F.lit(""))).cast("long")
    return count_tokens(docs.withColumn("n_bytes", n_bytes)).select(
        "doc_id", "n_bytes", "n_tokens", (F.col("n_tokens") > LIMIT).alias("over_limit")
    )

"""Language identification by unigrams over every segmentation.

Each language has a probability for each piece of a fixed public vocabulary. A word's
probability is the sum over all ways to cut it into pieces, by the forward algorithm; a
text's is the product over its words. Piece probabilities are fitted by expectation and
maximisation: the expected uses of a piece, over all segmentations of the training words.
"""

import hashlib
import itertools
import re
from dataclasses import dataclass

import numpy as np
import public_tokenizers
import pyarrow as pa
import regex
from pyspark.sql import functions as F

from widevec.llm.common import claiming, keeps, table, utf8, written

VOCABULARY = "piece_bpe_32k.model"
# The classifier is fitted on a hash sample of about so many labelled documents.
TRAINING_DOCS = 4_000
# Of no language fewer than about so many, if it has them.
LANGUAGE_DOCS = 500
ROUNDS = 2
# Before the first round every piece costs the same, so fewer pieces are likelier.
FIRST_COST = 6.0
# Share of a language's probability that follows all languages together.
SHARED = 0.05
# Distinct words, and bytes of their scores, that a worker keeps before it starts afresh.
KEPT_WORDS = 1_000_000
KEPT_BYTES = 64 * 1024 * 1024
UNKNOWN = "und"

RUN = re.compile(r"[^\W\d_]+")
LETTER = regex.compile(r"\p{L}")


class Pieces:
    """The vocabulary's pieces in lower case, and where they lie in words."""

    def __init__(self, path):
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=path)
        named = {model.id_to_piece(i).lower() for i in range(model.vocab_size()) if not (model.is_control(i) or model.is_byte(i) or model.is_unknown(i))}
        self.number = {piece: k for k, piece in enumerate(sorted(named))}
        self.starts = {piece[:n] for piece in self.number for n in range(1, len(piece) + 1)}
        # One more stands for any character outside the vocabulary.
        self.other = len(self.number)
        self.count = self.other + 1

    def edges(self, words):
        """(word, from, to, piece) of every piece in every word, by end and then by word."""
        number, starts, other = self.number, self.starts, self.other
        found = []
        for w, word in enumerate(words):
            marked = "▁" + word
            size = len(marked)
            for at in range(size):
                alone = True
                for end in range(at + 1, size + 1):
                    piece = marked[at:end]
                    if piece not in starts:
                        break
                    k = number.get(piece)
                    if k is not None:
                        found.append((w, at, end, k))
                        alone = alone and end > at + 1
                if alone:
                    found.append((w, at, at + 1, other))
        edges = np.array(found, np.int64).reshape(-1, 4)
        return edges[np.lexsort((edges[:, 0], edges[:, 2]))]


def _pieces(name):
    if name not in _opened:
        _opened[name] = Pieces(public_tokenizers.path(name))
    return _opened[name]


_opened = keeps("language", {})


def forward(edges, sizes, costs):
    """Log probability of the first n characters of each word, for every n and model:
    [words, longest + 1, models]. ``costs`` is the log probability of a piece by model."""
    table_ = np.full((len(sizes), int(sizes.max(initial=0)) + 1, costs.shape[1]), -np.inf)
    table_[:, 0] = 0.0
    bounds = np.searchsorted(edges[:, 2], np.arange(table_.shape[1] + 1))
    for end in range(1, table_.shape[1]):
        part = edges[bounds[end] : bounds[end + 1]]
        if len(part):
            value = table_[part[:, 0], part[:, 1]] + costs[part[:, 3]]
            firsts = np.flatnonzero(np.diff(part[:, 0], prepend=-1))
            table_[part[firsts, 0], end] = np.logaddexp.reduceat(value, firsts, axis=0)
    return table_


def _groups(words):
    """Words in groups of bounded work: of like length, so that tables stay small."""
    order = sorted(range(len(words)), key=lambda k: len(words[k]))
    at = 0
    while at < len(order):
        size = len(words[order[at]]) + 1
        # As many as fit, all within twice the length of the first.
        end = at
        while end < len(order) and len(words[order[end]]) < 2 * size and (end - at) * 2 * size < 60_000:
            end += 1
        yield order[at : max(end, at + 1)]
        at = max(end, at + 1)


def word_scores(words, pieces, costs):
    """Log probability of each word under each model."""
    scores = np.zeros((len(words), costs.shape[1]))
    for chosen in _groups(words):
        part = [words[k] for k in chosen]
        sizes = np.array([len(w) + 1 for w in part])
        table_ = forward(pieces.edges(part), sizes, costs)
        scores[chosen] = table_[np.arange(len(part)), sizes]
    return scores


def expected_uses(words, counts, pieces, costs):
    """[pieces, models]: how often each piece is used in expectation, over all segmentations
    of words that model m has seen ``counts[:, m]`` times."""
    uses = np.zeros(costs.shape)
    for chosen in _groups(words):
        part = [words[k] for k in chosen]
        sizes = np.array([len(w) + 1 for w in part])
        edges = pieces.edges(part)
        ahead = forward(edges, sizes, costs)
        # The same walk from the end: turn every word around.
        turned = edges.copy()
        turned[:, 1] = sizes[edges[:, 0]] - edges[:, 2]
        turned[:, 2] = sizes[edges[:, 0]] - edges[:, 1]
        turned = turned[np.lexsort((turned[:, 0], turned[:, 2]))]
        behind = forward(turned, sizes, costs)
        whole = ahead[np.arange(len(part)), sizes][edges[:, 0]]
        share = np.exp(
            ahead[edges[:, 0], edges[:, 1]]
            + costs[edges[:, 3]]
            + behind[edges[:, 0], sizes[edges[:, 0]] - edges[:, 2]]
            - whole
        )
        share *= counts[np.array(chosen)][edges[:, 0]]
        for model in range(costs.shape[1]):
            uses[:, model] += np.bincount(edges[:, 3], share[:, model], len(uses))
    return uses


def text_words(text):
    return RUN.findall(text.lower())


@dataclass
class LanguageModel:
    """Piece costs [pieces, languages] and log priors; of a size that the vocabulary bounds."""

    languages: list
    costs: np.ndarray
    priors: np.ndarray
    vocabulary: str


def is_held_out():
    """Documents that nothing is learnt from; false for a null id."""
    return F.coalesce(F.crc32(utf8(F.col("doc_id"))) % 4 == 2, F.lit(False)) & F.col("doc_id").isNotNull()


def fit_languages(docs, training_docs=TRAINING_DOCS, rounds=ROUNDS, vocabulary=VOCABULARY, language_docs=LANGUAGE_DOCS):
    """Fit on the labelled rows of ``docs`` (doc_id, text, lang) that are not held out.

    On about ``training_docs`` of them, drawn by the hash of their ids, and besides of each
    language on as many as bring it to ``language_docs``: a fit's cost grows with the number
    of languages, not with the table, and no language is lost beside larger ones. Tasks add up expected uses themselves, so what is shuffled
    and what reaches the driver is at most a number per piece and language and task.
    """
    labelled = docs.filter(
        F.col("lang").isNotNull() & F.col("text").isNotNull() & F.col("doc_id").isNotNull() & ~is_held_out()
    ).select("doc_id", "text", F.col("lang").cast("string").alias("lang"))
    priors = {row["lang"]: row["count"] for row in labelled.groupBy("lang").count().collect()}
    languages = sorted(priors)
    pieces = _pieces(vocabulary)
    total = sum(priors.values())
    log_priors = np.log(np.array([priors[lang] for lang in languages], float) / max(1, total))
    costs = np.full((pieces.count, len(languages)), -FIRST_COST)
    if not languages:
        return LanguageModel([], costs, log_priors, vocabulary)
    rates = [min(1.0, max(training_docs / total, language_docs / priors[lang])) for lang in languages]
    bounds = zip(map(F.lit, languages), (F.lit(int(rate * (1 << 30))) for rate in rates))
    bound = F.create_map(*itertools.chain(*bounds))[F.col("lang")]
    sample = labelled.filter(F.pmod(F.xxhash64(F.lit("fit"), "doc_id"), F.lit(1 << 30)) < bound)
    sample = written(sample.select("text", "lang"), "sample")
    for _ in range(rounds):
        shipped = docs.sparkSession.sparkContext.broadcast(costs.astype(np.float32))
        rows = sample.mapInArrow(_counter(shipped, languages, vocabulary), "lang int, piece int, n double")
        uses = np.full(costs.shape, 0.01)
        for row in rows.groupBy("lang", "piece").agg(F.sum("n").alias("n")).collect():
            uses[row["piece"], row["lang"]] += row["n"]
        own = uses / uses.sum(axis=0)
        costs = np.log((1 - SHARED) * own + SHARED * own.mean(axis=1, keepdims=True))
    return LanguageModel(languages, costs, log_priors, vocabulary)


def _counter(shipped, languages, vocabulary):
    place = {lang: k for k, lang in enumerate(languages)}

    @claiming("language")
    def run(batches):
        pieces, costs = _pieces(vocabulary), shipped.value.astype(np.float64)
        uses, seen = np.zeros(costs.shape), {}

        def settle():
            nonlocal uses
            words = list(seen)
            counts = np.zeros((len(words), len(languages)))
            for k, word in enumerate(words):
                for lang, n in seen[word].items():
                    counts[k, lang] = n
            uses += expected_uses(words, counts, pieces, costs)
            seen.clear()

        for batch in batches:
            for text, lang in zip(batch.column("text").to_pylist(), batch.column("lang").to_pylist()):
                k = place[lang]
                for word in text_words(text):
                    own = seen.setdefault(word, {})
                    own[k] = own.get(k, 0) + 1
                if len(seen) > 50_000:
                    settle()
        settle()
        piece, lang = np.nonzero(uses)
        yield pa.RecordBatch.from_arrays(
            [pa.array(lang, pa.int32()), pa.array(piece, pa.int32()), pa.array(uses[piece, lang])],
            ["lang", "piece", "n"],
        )

    return run


class _Scorer:
    def __init__(self, model):
        self.model = model
        self.pieces = _pieces(model.vocabulary)
        self.costs = model.costs.astype(np.float64)
        self.room = min(KEPT_WORDS, KEPT_BYTES // (8 * max(1, len(model.languages))))
        self.rows = np.zeros((self.room, len(model.languages)))
        self.place = {}

    def predict(self, texts):
        """(language, score) per text: the likeliest one and its probability."""
        words = [text_words(t) for t in texts]
        missing = list(dict.fromkeys(w for ws in words for w in ws if w not in self.place))
        if len(self.place) + len(missing) > self.room:
            self.place = {}
            missing = list(dict.fromkeys(w for ws in words for w in ws))
            if len(missing) > self.room:
                self.room = len(missing)
                self.rows = np.zeros((self.room, len(self.model.languages)))
        if missing:
            first = len(self.place)
            self.rows[first : first + len(missing)] = word_scores(missing, self.pieces, self.costs)
            self.place.update(zip(missing, range(first, first + len(missing))))
        found = []
        for text, own in zip(texts, words):
            if not self.model.languages or not LETTER.search(text):
                found.append((UNKNOWN, 0.0))
                continue
            at = np.fromiter(map(self.place.__getitem__, own), np.int64, len(own))
            total = self.rows[at].sum(axis=0) + self.model.priors
            odds = np.exp(total - total.max())
            best = int(np.argmax(total))
            found.append((self.model.languages[best], float(odds[best] / odds.sum())))
        return found


def model_key(model):
    """A digest of a model's content."""
    found = hashlib.sha256(repr((model.languages, model.vocabulary, model.costs.shape)).encode())
    found.update(model.costs.tobytes())
    found.update(model.priors.tobytes())
    return found.hexdigest()


_scorers = keeps("language", {})
# Texts scored together; their distinct words are segmented in one go.
SCORED_CHARS = 2_000_000


def identify(docs, model, text="text"):
    """``docs`` with ``lang_pred`` (string) and ``score`` (double, 0 to 1), replacing columns
    of those names. Looks at whole texts and at nothing else. Null texts and texts without a
    letter are ``und`` with score 0, as is everything if no language was learnt."""
    shipped = docs.sparkSession.sparkContext.broadcast(model)
    kept = docs.drop("lang_pred", "score")
    names = kept.columns
    key = model_key(model)

    @claiming("language")
    def run(batches):
        for batch in batches:
            if key not in _scorers:
                _scorers.clear()
                _scorers[key] = _Scorer(shipped.value)
            scorer, found, waiting, held = _scorers[key], [], [], 0
            for content in batch.column(text).to_pylist():
                waiting.append(content or "")
                held += len(waiting[-1])
                if held > SCORED_CHARS:
                    found += scorer.predict(waiting)
                    waiting, held = [], 0
            found += scorer.predict(waiting)
            langs, scores = zip(*found) if found else ((), ())
            yield pa.RecordBatch.from_arrays(
                [*[batch.column(n) for n in names], pa.array(langs, pa.string()), pa.array(scores, pa.float64())],
                [*names, "lang_pred", "score"],
            )

    plain = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in kept.schema.fields)
    return kept.mapInArrow(run, f"{plain}, lang_pred string, score double")


# A document is of no language the model knows well if its best one is not even likelier
# than all others together.
LEAST_SCORE = 0.5


def keep_identified(docs):
    """The rows of ``docs``, with their own columns, whose language is told."""
    model = fit_languages(docs)
    rows = docs.select("text", F.struct(*[F.col(c) for c in docs.columns]).alias("l_row"))
    found = identify(rows, model)
    return found.filter((F.col("lang_pred") != UNKNOWN) & (F.col("score") >= LEAST_SCORE)).select("l_row.*")


def op4_language_id(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    found = identify(docs.select("doc_id", "text"), fit_languages(docs))
    return found.select("doc_id", is_held_out().alias("held_out"), "lang_pred", "score")

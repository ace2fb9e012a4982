"""Benchmark decontamination with a generalised suffix automaton.

The automaton of all normalised test items holds every run of their words. Training words
are streamed through it; after each word it knows the longest run of item words that ends
there. A run as long as a window is a hit.
"""

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from widevec.llm.common import claiming, keeps, table, written
from widevec.llm.words import sha256_hex

WINDOW = 13
# Contaminated: hit words times this reach the words of the document.
COVERAGE = 20
# Item words and names in one automaton. More make several, and documents pass through each.
BLOCK_WORDS = 400_000

# What is no part of a word becomes a space: 0-9, a-z and every byte of a non-ASCII character stay.
_KEPT = set(range(0x30, 0x3A)) | set(range(0x61, 0x7B)) | set(range(0x80, 0x100))
_NORMAL = bytes(b + 32 if 0x41 <= b <= 0x5A else b if b in _KEPT else 0x20 for b in range(256))


def word_list(content):
    """The lower-cased words of UTF-8 bytes."""
    return content.translate(_NORMAL).split()


class Automaton:
    """All runs of the items' words, and which items a window belongs to."""

    def __init__(self, items, window=WINDOW):
        """items: (item id, words). An item of fewer than ``window`` words is one window."""
        self.window = window
        self.next, self.link, self.length = [{}], [-1], [0]
        self.vocabulary = {}
        coded = {}
        for item, words in items:
            if words:
                ids = tuple(self.vocabulary.setdefault(w, len(self.vocabulary)) for w in words)
                coded.setdefault(ids, set()).add(item)
        for ids in coded:
            last = 0
            for word in ids:
                last = self._extend(last, word)
        # The items of each state that a window ends in, and the short items by their state.
        self.owners, self.short = {}, {}
        for ids, names in coded.items():
            state = 0
            for at, word in enumerate(ids):
                state = self.next[state][word]
                if at + 1 >= window:
                    self.owners.setdefault(self._suffix(state, window), set()).update(names)
            if len(ids) < window:
                self.short.setdefault(self._suffix(state, len(ids)), {}).setdefault(len(ids), set()).update(names)
        self.least = min([window, *(len(ids) for ids in coded)])
        self.found = {}

    def _extend(self, last, word):
        """One more word of an item; states that other items made are used again."""
        nxt, link, length = self.next, self.link, self.length
        if word in nxt[last]:
            there = nxt[last][word]
            return there if length[there] == length[last] + 1 else self._clone(last, word, there)
        state = self._state(length[last] + 1)
        at = last
        while at >= 0 and word not in nxt[at]:
            nxt[at][word] = state
            at = link[at]
        if at < 0:
            link[state] = 0
        else:
            there = nxt[at][word]
            link[state] = there if length[there] == length[at] + 1 else self._clone(at, word, there)
        return state

    def _state(self, length):
        self.next.append({})
        self.link.append(0)
        self.length.append(length)
        return len(self.length) - 1

    def _clone(self, at, word, there):
        copy = self._state(self.length[at] + 1)
        self.next[copy] = dict(self.next[there])
        self.link[copy], self.link[there] = self.link[there], copy
        while at >= 0 and self.next[at].get(word) == there:
            self.next[at][word] = copy
            at = self.link[at]
        return copy

    def _suffix(self, state, size):
        """The state of the last ``size`` words of a state's runs."""
        while self.length[self.link[state]] >= size:
            state = self.link[state]
        return state

    def _ends(self, state):
        """What may end in a state: (words, items) of every window among its suffixes."""
        known = self.found.get(state)
        if known is None:
            known, at = [], state
            while at > 0:
                below = self.length[self.link[at]]
                if below < self.window <= self.length[at] and at in self.owners:
                    known.append((self.window, self.owners[at]))
                for size, names in self.short.get(at, {}).items():
                    known.append((size, names))
                at = self.link[at]
            self.found[state] = known
        return known

    def scan(self, words):
        """(spans, items): hit words as disjoint (start, end) in order, and the items found."""
        get = self.vocabulary.get
        ids = np.array([get(w, -1) for w in words], np.int64)
        if not len(ids) or not self.vocabulary:
            return [], set()
        # Only runs of words that items have can hold a window.
        inside = np.concatenate(([0], (ids >= 0).view(np.int8), [0]))
        turns = np.flatnonzero(np.diff(inside))
        starts, ends = turns[::2], turns[1::2]
        long = ends - starts >= self.least
        spans, items = [], set()
        nxt, link, length = self.next, self.link, self.length
        for start, end in zip(starts[long].tolist(), ends[long].tolist()):
            state = matched = 0
            for at, word in enumerate(ids[start:end].tolist(), start + 1):
                while state and word not in nxt[state]:
                    state = link[state]
                    matched = length[state]
                if word in nxt[state]:
                    state = nxt[state][word]
                    matched += 1
                if matched < self.least:
                    continue
                size = 0
                for words_in, names in self._ends(state):
                    if words_in <= matched:
                        size = max(size, words_in)
                        items |= names
                if size:
                    first = at - size
                    while spans and spans[-1][1] >= first:
                        first = min(first, spans.pop()[0])
                    spans.append((first, at))
        return spans, items


def _merged(spans):
    merged = []
    for start, end in sorted(spans):
        if merged and start <= merged[-1][1]:
            merged[-1][1] = max(merged[-1][1], end)
        else:
            merged.append([start, end])
    return [tuple(span) for span in merged]


_built = keeps("decontamination", {})
SPANS = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))
SPANS_SQL = "array<struct<start:long,end:long>>"


def item_blocks(items, window=WINDOW, block_words=BLOCK_WORDS):
    """(block, words, names) of items (item, text): distinct word sequences in blocks that hold
    at most ``block_words`` words and names each, and the number of blocks.

    A long item is split into pieces that share ``window`` - 1 words, so its windows are those
    of its pieces; the names of a hot sequence are salted. Blocks are by hash; their sums are
    checked, and there are more blocks until all are small enough.
    """
    piece = max(window, block_words // 8)

    def split(batches):
        for batch in batches:
            names, found = [], []
            for item, content in zip(batch.column("item").to_pylist(), batch.column("text").cast(pa.binary()).to_pylist()):
                words = word_list(content)
                for at in range(0, max(1, len(words) - window + 1), piece):
                    if words:
                        names.append(item)
                        found.append(b" ".join(words[at : at + piece + window - 1]))
            yield pa.RecordBatch.from_arrays([pa.array(names, pa.string()), pa.array(found, pa.binary())], ["item", "words"])

    pieces = items.mapInArrow(split, "item string, words binary").distinct()
    salts = pieces.groupBy("words").agg(F.ceil(F.count("*") / piece).alias("salts"))
    salted = pieces.join(salts, "words").withColumn("salt", F.pmod(F.xxhash64("item"), "salts"))
    grouped = salted.groupBy("words", "salt").agg(
        F.sort_array(F.collect_set("item")).alias("names"), F.max(F.col("item").isNull()).alias("unnamed")
    )
    weight = F.size("names") + F.regexp_count(F.col("words").cast("string"), F.lit(" ")) + 2
    grouped = written(grouped.withColumn("weight", weight.cast("long")), "items")
    total = grouped.agg(F.sum("weight")).first()[0] or 0
    blocks = 1 if total <= block_words else -(-3 * total // (2 * block_words))
    while True:
        placed = grouped.withColumn("block", F.pmod(F.xxhash64("words", "salt"), F.lit(blocks)))
        most = placed.groupBy("block").agg(F.sum("weight").alias("sum")).agg(F.max("sum")).first()[0] or 0
        if most <= block_words:
            return placed.select("block", "words", "names", "unnamed"), blocks
        blocks *= 2


def contamination(docs, benchmark, window=WINDOW, text="text", item_id="item_id", item_text="text", block_words=BLOCK_WORDS, cut_longer_than=None):
    """``docs`` with ``n_words`` (long), ``hit_spans`` (words from start up to end) and
    ``hit_items`` (ids of the items found, sorted as strings; a null last if any found item
    has no id, all of those counting as one).

    The items go to the tasks in blocks of checked size, see ``item_blocks``. With one block,
    as most benchmarks are, documents pass through it once and nothing is shuffled or
    written. With more, the documents are written once with a row number, each block reads
    them and gives the rows it hits, and these are joined back. Null and empty texts have no
    words, items without words are none, repeated items count once by id. Columns with the
    names of the new ones are replaced.

    With ``cut_longer_than`` the result is that of ``without_spans``, in the same Python pass:
    a second one in a stage would double the workers of every executor.
    """
    items = benchmark.select(
        F.col(item_id).cast("string").alias("item"),
        F.coalesce(F.col(item_text).cast("string"), F.lit("")).alias("text"),
    )
    placed, blocks = item_blocks(items, window, block_words)
    found = docs.drop("n_words", "hit_spans", "hit_items")
    plain = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in found.schema.fields)
    kinds = f"n_words long, hit_spans {SPANS_SQL}, hit_items array<string>"
    cut = (lambda batches: batches) if cut_longer_than is None else _cutter(text, cut_longer_than, COVERAGE)

    def shipped(block):
        rows = placed.filter(F.col("block") == block).select("words", "names", "unnamed")
        held = [(bytes(r["words"]), [*r["names"], *[None] * r["unnamed"]]) for r in rows.toLocalIterator()]
        return docs.sparkSession.sparkContext.broadcast(held)

    if blocks == 1:
        scan = _scanner(shipped(0), text, window, found.columns)
        return found.mapInArrow(lambda batches: cut(scan(batches)), f"{plain}, {kinds}")
    row, held = "_row", "_held"
    rows = found.select(F.monotonically_increasing_id().alias(row), F.col(text).alias("text"), F.struct("*").alias(held))
    rows = written(rows, "documents")
    hits = None
    for block in range(blocks):
        scan = _scanner(shipped(block), "text", window, [row], hits_only=True)
        part = written(rows.select(row, "text").mapInArrow(scan, f"{row} long, {kinds}"), f"hits-{block}")
        hits = part if hits is None else hits.unionByName(part)
    # A document is in a block's hits once.
    hits = hits.groupBy(row).agg(F.flatten(F.collect_list("hit_spans")).alias("hit_spans"), F.flatten(F.collect_list("hit_items")).alias("hit_items"))
    joined = rows.join(hits, row, "left").select(f"{held}.*", "hit_spans", "hit_items")
    merge = _merger(text, found.columns)
    return joined.mapInArrow(lambda batches: cut(merge(batches)), f"{plain}, {kinds}")


def _columns(counts, spans, items):
    return [
        pa.array(counts, pa.int64()),
        pa.array([[{"start": s, "end": e} for s, e in row] for row in spans], SPANS),
        pa.array([sorted(row, key=lambda name: (name is None, name or "")) for row in items], pa.list_(pa.string())),
    ]


def _scanner(shipped, text, window, names, hits_only=False):
    """Adds what one block's automaton finds; with ``hits_only``, to rows that it finds in."""
    key = sha256_hex(repr((window, sorted(shipped.value, key=repr))).encode())

    @claiming("decontamination")
    def run(batches):
        for batch in batches:
            if key not in _built:
                _built.clear()
                _built[key] = Automaton([(name, words.split(b" ")) for words, own in shipped.value for name in own], window)
            automaton = _built[key]
            counts, spans, items = [], [], []
            for content in batch.column(text).cast(pa.binary()).to_pylist():
                words = word_list(content or b"")
                hit, owners = automaton.scan(words)
                counts.append(len(words))
                spans.append(hit)
                items.append(owners)
            whole = pa.RecordBatch.from_arrays(
                [*[batch.column(name) for name in names], *_columns(counts, spans, items)], [*names, "n_words", "hit_spans", "hit_items"]
            )
            yield whole.filter(pa.array([len(row) > 0 for row in spans], pa.bool_())) if hits_only else whole

    return run


def _merger(text, names):
    """Words of each text, and what all blocks have found in it."""

    def run(batches):
        for batch in batches:
            counts = [len(word_list(content or b"")) for content in batch.column(text).cast(pa.binary()).to_pylist()]
            spans = [_merged([(s["start"], s["end"]) for s in row or []]) for row in batch.column("hit_spans").to_pylist()]
            items = [set(row or []) for row in batch.column("hit_items").to_pylist()]
            columns = [*[batch.column(name) for name in names], *_columns(counts, spans, items)]
            yield pa.RecordBatch.from_arrays(columns, [*names, "n_words", "hit_spans", "hit_items"])

    return run


def hit_words():
    return F.aggregate("hit_spans", F.lit(0).cast("long"), lambda n, s: n + s["end"] - s["start"])


def is_contaminated(coverage=COVERAGE):
    return (hit_words() > 0) & (hit_words() * coverage >= F.col("n_words"))


def without_spans(found, longer_than=0, coverage=COVERAGE, text="text"):
    """Documents over the coverage limit go; of the others, spans of more than
    ``longer_than`` hit words are cut out of the text, from the first byte of their first
    word to the last of their last."""
    return found.mapInArrow(_cutter(text, longer_than, coverage), found.schema)


def _cutter(text, longer_than, coverage):
    def run(batches):
        for batch in batches:
            texts, spans, kept = batch.column(text).to_pylist(), batch.column("hit_spans").to_pylist(), []
            for row, n_words in enumerate(batch.column("n_words").to_pylist()):
                hit = sum(s["end"] - s["start"] for s in spans[row])
                kept.append(not (hit > 0 and hit * coverage >= n_words))
                cut = [(s["start"], s["end"]) for s in spans[row] if s["end"] - s["start"] > longer_than]
                if cut and kept[-1]:
                    texts[row] = _cut(texts[row].encode("utf-8"), cut).decode("utf-8")
            names = batch.schema.names
            columns = [pa.array(texts, pa.string()) if n == text else batch.column(n) for n in names]
            yield pa.RecordBatch.from_arrays(columns, names).filter(pa.array(kept, pa.bool_()))

    return run


def _cut(content, spans):
    marks = np.frombuffer(b" " + content.translate(_NORMAL) + b" ", np.uint8) != 0x20
    edges = np.flatnonzero(np.diff(marks.view(np.int8)))
    starts, ends = edges[::2], edges[1::2]
    parts, at = [], 0
    for first, end in spans:
        parts.append(content[at : starts[first]])
        at = ends[end - 1]
    parts.append(content[at:])
    return b"".join(parts)


def keep_clean(docs, benchmark, lengths=("n_chars",)):
    """The rows of ``docs`` that are not contaminated, with their own columns, and without the
    spans of a whole window or more that they still hold of benchmark items. Where a span is
    cut, columns named in ``lengths`` become the new length of the text."""
    rows = docs.select(F.col("text").alias("text"), F.struct(*[F.col(c) for c in docs.columns]).alias("d_row"))
    kept = contamination(rows, benchmark, cut_longer_than=WINDOW - 1)
    cut = ~F.col("text").eqNullSafe(F.col("d_row.text"))
    own = {c: F.col("d_row").getField(c) for c in docs.columns}
    own["text"] = F.col("text")
    for c in set(lengths) & set(docs.columns):
        own[c] = F.when(cut, F.length("text").cast(docs.schema[c].dataType)).otherwise(own[c])
    return kept.select(*[column.alias(c) for c, column in own.items()])


def op5_decontamination(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = contamination(docs, table(spark, sf_dir, "benchmark"))
    return found.select(
        "doc_id",
        "n_words",
        hit_words().alias("n_hit"),
        F.size("hit_items").cast("long").alias("n_items"),
        F.sha2(F.array_join("hit_items", ",").cast("binary"), 256).alias("items_sha256"),
        is_contaminated().alias("contaminated"),
    )


OP5_SQL = r"""
WITH docs AS (
    SELECT row_number() OVER () AS r, doc_id,
           regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                              '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS words
    FROM documents),
items AS (
    SELECT CAST(item_id AS VARCHAR) AS item,
           regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                              '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS words
    FROM benchmark),
windows AS (
    SELECT DISTINCT item, least(13, len(words)) AS size,
           array_to_string(words[i : i + least(13, len(words)) - 1], ' ') AS run
    FROM (SELECT item, words, unnest(range(1, greatest(CAST(len(words) AS BIGINT) - 12, 1) + 1)) AS i
          FROM items WHERE len(words) > 0)),
sizes AS (SELECT DISTINCT size FROM windows),
runs AS (
    SELECT r, i, size, array_to_string(words[i : i + size - 1], ' ') AS run
    FROM (SELECT r, size, words, unnest(range(1, CAST(len(words) AS BIGINT) - size + 2)) AS i
          FROM docs, sizes WHERE len(words) >= size)),
hits AS (SELECT r, i, size, item FROM runs JOIN windows USING (size, run)),
covered AS (
    SELECT r, count(DISTINCT place) AS n FROM (SELECT r, unnest(range(i, i + size)) AS place FROM hits) GROUP BY r),
named AS (
    SELECT r, count(*) AS n, string_agg(item, ',' ORDER BY item) AS items
    FROM (SELECT DISTINCT r, item FROM hits) GROUP BY r)
SELECT doc_id, CAST(len(words) AS BIGINT) AS n_words, CAST(coalesce(covered.n, 0) AS BIGINT) AS n_hit,
       CAST(coalesce(named.n, 0) AS BIGINT) AS n_items, sha256(coalesce(items, '')) AS items_sha256,
       coalesce(covered.n, 0) > 0 AND 20 * coalesce(covered.n, 0) >= len(words) AS contaminated
FROM docs LEFT JOIN covered USING (r) LEFT JOIN named USING (r)"""

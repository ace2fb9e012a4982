"""Near-duplicates by DartMinHash.

Every shingle of a text owns a region as wide as its weight. Darts, placed by hashing, fall
into these regions at random ranks; a dart is the same in every text that holds its shingle
with enough weight. Of the darts that fall to a coordinate, the one of least rank is kept,
so two texts agree on a coordinate with a probability equal to their weighted Jaccard
similarity. Bands of coordinates bring likely pairs together, and an exact check of their
shingles decides. What no band brings together is found by prefixes of the shingle sets,
which leave out no pair.
"""

import math

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Window
from pyspark.sql import functions as F

from widevec.llm.common import claiming, mixed, small_batches, table, unit, utf8, written

SHINGLE = 5
SIMILARITY = 0.8
# 24 bands of 5 coordinates: a pair of similarity 0.8 meets in one of them with
# probability 0.9999, one of 0.85 with 0.999999.
BANDS = 24
ROWS = 5
# The first rank cell; each further one is as wide as all before it.
FIRST_RANK = 1 / 64
# Shingles that are sketched together, and rows of prefixes that are sent together.
SKETCH_SHINGLES = 100_000
# Members of a bucket whose components all meet in pairs.
SMALL = 16
# Further bands by which larger buckets are split before components are told again.
BANDS_AT_ONCE = 6
# Frequent shingles come last in prefixes. They are told by slots, from one text of so many;
# this decides how many candidates there are, never which pairs are found.
LEVEL_SLOTS = 1 << 18
LEVEL_TEXTS = 16
# Bits that tell where shingles are wanted; a full one costs work, not results.
WANTED_BITS = 1 << 23


def shingle_hashes(words, size=SHINGLE):
    """64-bit hashes of all runs of ``size`` words; of a shorter text, of all its words."""
    if not words:
        return np.zeros(0, np.uint64)
    own = np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, len(words))
    size = min(size, len(words))
    total = np.zeros(len(own) - size + 1, np.uint64)
    for k in range(size):
        total = mixed(total ^ own[k : len(own) - size + 1 + k], k)
    return total


def text_words(text):
    return text.lower().split()


def dart_minhash(elements, weights, owner, count, coordinates, seed=0):
    """[count, coordinates] 32-bit signatures of weighted sets.

    elements, weights: the sets' elements, a set after the other; owner: which set each
    belongs to. A set's darts are thrown at ranks up to a bound that gives every coordinate
    some with high probability; where one got none, the bound doubles. Sets without
    elements have no signature and stay 0.
    """
    total = np.bincount(owner, weights, count)
    bound = np.full(count, coordinates * (math.log(coordinates) + 2)) / np.maximum(total, 1e-12)
    signature = np.zeros((count, coordinates), np.uint32)
    pending = total > 0
    while pending.any():
        chosen = pending[owner]
        dart, place, rank = _darts(elements[chosen], weights[chosen], owner[chosen], bound, coordinates, seed)
        order = np.lexsort((rank, place))
        place, dart = place[order], dart[order]
        first = np.flatnonzero(np.diff(place, prepend=-1))
        place, dart = place[first], dart[first]
        full = pending & (np.bincount(place // coordinates, minlength=count) == coordinates)
        done = full[place // coordinates]
        signature.reshape(-1)[place[done]] = (dart[done] >> np.uint64(32)).astype(np.uint32)
        pending &= ~full
        bound[pending] *= 2
    return signature


def _darts(elements, weights, owner, bound, coordinates, seed):
    """All darts under each set's bound: their hash, set and coordinate as one number, rank."""
    found = []
    reach = bound[owner]
    wide, top = 0.0, 1.0
    level = 0
    while (weights > wide).any():
        low, high, step = 0.0, FIRST_RANK, 0
        while True:
            inside = (weights > wide) & (reach > low)
            if not inside.any():
                break
            base, w, own, r = elements[inside], weights[inside], owner[inside], reach[inside]
            cell = mixed(base ^ np.uint64((level << 16 | step) * 0x9E3779B1), seed)
            number = np.searchsorted(_poisson((top - wide) * (high - low)), unit(cell), side="right")
            hit = np.flatnonzero(number)
            at = np.repeat(hit, number[hit])
            within = np.arange(len(at)) - np.repeat(np.cumsum(number[hit]) - number[hit], number[hit])
            dart = mixed(cell[at] ^ mixed(within.astype(np.uint64), 1), seed + 2)
            rank = low + (high - low) * unit(mixed(dart, 3))
            keep = (wide + (top - wide) * unit(mixed(dart, 4)) < w[at]) & (rank < r[at])
            place = own[at] * coordinates + (mixed(dart, 5) % np.uint64(coordinates)).astype(np.int64)
            found.append((dart[keep], place[keep], rank[keep]))
            low, high, step = high, 2 * high, step + 1
        wide, top, level = top, 2 * top, level + 1
    return [np.concatenate(parts) for parts in zip(*found)]


def _poisson(mean):
    """The distribution function of the number of darts in a cell of that area."""
    if mean not in _tables:
        longest = int(mean + 12 * math.sqrt(mean) + 20)
        logs = np.cumsum(np.concatenate(([-mean], np.log(mean / np.arange(1, longest)))))
        _tables[mean] = np.cumsum(np.exp(logs))
    return _tables[mean]


_tables = {}


def band_hashes(texts, bands=BANDS, rows=ROWS, weighted=False):
    """[texts, bands] 64-bit band values, and which texts have any shingle."""
    parts, weights, owner = [], [], []
    for k, text in enumerate(texts):
        own, times = np.unique(shingle_hashes(text_words(text)), return_counts=True)
        parts.append(own)
        weights.append(times.astype(np.float64) if weighted else np.ones(len(own)))
        owner.append(np.full(len(own), k))
    flat = np.concatenate(parts)
    signature = dart_minhash(flat, np.concatenate(weights), np.concatenate(owner), len(texts), bands * rows)
    found = np.zeros((len(texts), bands), np.uint64)
    for row in range(rows):
        found = mixed(found ^ signature.reshape(len(texts), bands, rows)[:, :, row].astype(np.uint64), row)
    found = mixed(found ^ np.arange(bands, dtype=np.uint64), 9)
    return found.view(np.int64), np.array([len(p) > 0 for p in parts], bool)


def shingle_bytes(text, weighted=False):
    """A text's shingle hashes in order, as bytes: each once, or as often as it occurs."""
    hashes = shingle_hashes(text_words(text))
    return (np.sort(hashes) if weighted else np.unique(hashes)).tobytes()


def similarity(a, b, weighted=False):
    """Jaccard similarity of two texts by their ``shingle_bytes``, weighted by counts if asked."""
    x, y = np.frombuffer(a, np.uint64), np.frombuffer(b, np.uint64)
    total = len(x) + len(y)
    if not total:
        return 1.0
    if weighted:
        (u, n), (v, m) = (np.unique(z, return_counts=True) for z in (x, y))
        _, i, j = np.intersect1d(u, v, assume_unique=True, return_indices=True)
        common = int(np.minimum(n[i], m[j]).sum())
    else:
        common = len(np.intersect1d(x, y, assume_unique=True))
    return common / (total - common)


def _sketches(texts, weighted):
    """(node, buckets): each distinct text's band values."""

    @claiming("near_dedup")
    def run(batches):
        seen = set()
        nodes, waiting, held = [], [], 0

        def settle():
            values, real = band_hashes(waiting, weighted=weighted)
            kept = [n for n, r in zip(nodes, real) if r]
            values = values[real]
            offsets = np.arange(len(kept) + 1, dtype=np.int32) * BANDS
            lists = pa.ListArray.from_arrays(pa.array(offsets), pa.array(values.reshape(-1)))
            return pa.RecordBatch.from_arrays([pa.array(kept, pa.binary()), lists], ["node", "buckets"])

        for batch in batches:
            for node, text in zip(batch.column("node").to_pylist(), batch.column("text").to_pylist()):
                if node in seen:
                    continue
                # Forgetting only repeats work.
                if len(seen) > 200_000:
                    seen.clear()
                seen.add(node)
                nodes.append(node)
                waiting.append(text or "")
                held += len(waiting[-1]) // 5
                if held > SKETCH_SHINGLES:
                    yield settle()
                    nodes, waiting, held = [], [], 0
        if waiting:
            yield settle()

    return texts.mapInArrow(run, "node binary, buckets array<long>").dropDuplicates(["node"])


def _verified(pairs, shingles, threshold, weighted):
    """(a, b): the components of those pairs of nodes whose texts are similar enough."""
    left = shingles.select(F.col("node").alias("left"), F.col("shingles").alias("x"))
    right = shingles.select(F.col("node").alias("right"), F.col("shingles").alias("y"))

    @claiming("near_dedup")
    def run(batches):
        for batch in batches:
            # Views into the batch: nothing is copied but one pair's intersection.
            both = zip(batch.column("x"), batch.column("y"))
            kept = pa.array([similarity(x.as_buffer(), y.as_buffer(), weighted) >= threshold for x, y in both], pa.bool_())
            yield batch.select(["a", "b"]).filter(kept)

    joined = pairs.join(left, "left").join(right, "right").select("a", "b", "x", "y")
    return joined.mapInArrow(run, "a binary, b binary").distinct()


def components(edges):
    """(node, root): the least node of each node's component, by joining labels over edges
    until none changes. Labels jump to their label's label, so long chains halve."""
    both = edges.select(F.col("a").alias("node"), F.col("b").alias("other"))
    both = written(both.unionByName(edges.select(F.col("b").alias("node"), F.col("a").alias("other"))), "links")
    labels = written(both.groupBy("node").agg(F.least("node", F.min("other")).alias("root")), "labels")
    while True:
        around = both.join(labels.withColumnRenamed("node", "other"), "other").groupBy("node").agg(F.min("root").alias("near"))
        stepped = labels.join(around, "node").select("node", F.col("root").alias("old"), F.least("root", "near").alias("root"))
        jump = labels.select(F.col("node").alias("root"), F.col("root").alias("next"))
        stepped = stepped.join(jump, "root").select(
            "node", F.least("root", "next").alias("root"), (F.least("root", "next") != F.col("old")).alias("changed")
        )
        stepped = written(stepped, "labels")
        labels = stepped.select("node", "root")
        if stepped.filter("changed").isEmpty():
            return labels


def _pairs(one, one_root, two, two_root):
    """Columns of a pair of nodes and their components, each in the order of the nodes."""
    one, two = F.col(one), F.col(two)
    first = one < two
    ends = {"left": (one, two), "right": (two, one), "a": (F.col(one_root), F.col(two_root)), "b": (F.col(two_root), F.col(one_root))}
    return [F.when(first, x).otherwise(y).alias(name) for name, (x, y) in ends.items()]


def _small_pairs(live):
    """All pairs of different components in buckets of at most ``SMALL`` members."""
    other = live.select("bucket", F.col("node").alias("o_node"), F.col("root").alias("o_root"))
    met = live.join(other, "bucket").filter((F.col("node") < F.col("o_node")) & (F.col("root") != F.col("o_root")))
    return met.select(*_pairs("node", "root", "o_node", "o_root"))


def _star_pairs(large, bands):
    """Two stars in every part of a large bucket, parts being members that share a further band.

    The first centre stands for the component with most members there, and meets all members
    outside it; the second, of a component taken by hash, meets those outside both.
    """
    further = [
        F.xxhash64("bucket", F.get("buckets", F.pmod(F.array_position("buckets", F.col("bucket")).cast("int") - 1 + band, F.lit(BANDS))))
        for band in bands
    ]
    parts = large.select(F.explode(F.array(*further)).alias("part"), "node", "root")
    own = F.xxhash64("part", "node")
    reps = parts.groupBy("part", "root").agg(F.count("*").alias("n"), F.min_by("node", own).alias("rep"))
    rep = F.struct("rep", "root")
    centres = reps.groupBy("part").agg(
        F.max_by(rep, F.struct("n", "root")).alias("one"), F.min_by(rep, F.xxhash64("part", "rep")).alias("two"), F.count("*").alias("k")
    )
    met = parts.join(centres.filter("k > 1"), "part").filter(F.col("root") != F.col("one.root"))
    second = F.when((F.col("two.root") != F.col("one.root")) & (F.col("two.root") != F.col("root")), F.col("two"))
    met = met.select("node", "root", F.explode(F.array_compact(F.array("one", second))).alias("c"))
    met = met.select("node", "root", F.col("c.rep").alias("c_node"), F.col("c.root").alias("c_root"))
    return met.select(*_pairs("node", "root", "c_node", "c_root"))


def elements(text, weighted=False):
    """A text's shingle hashes, each once; weighted, the second of a kind is another element,
    and so on, so that the similarity of counts is that of these sets."""
    hashes = np.sort(shingle_hashes(text_words(text)))
    if not weighted:
        return np.unique(hashes)
    nth = np.arange(len(hashes)) - np.searchsorted(hashes, hashes)
    return np.unique(np.where(nth, mixed(hashes ^ mixed(nth.astype(np.uint64), 7), 8), hashes))


def _levels(texts, weighted):
    """[slots] logarithms of how many texts of a part have the slot's most frequent shingle."""

    @claiming("near_dedup")
    def run(batches):
        for batch in batches:
            for text in batch.column("text").to_pylist():
                found = elements(text or "", weighted).view(np.int64)
                yield pa.RecordBatch.from_arrays([pa.array(found)], ["token"])

    part = texts.filter(F.pmod(F.xxhash64("node"), F.lit(LEVEL_TEXTS)) == 0).dropDuplicates(["node"])
    counts = part.select("text").mapInArrow(run, "token long").groupBy("token").agg(F.count("*").alias("n"))
    slots = counts.filter("n > 2").groupBy(F.pmod("token", F.lit(LEVEL_SLOTS)).alias("slot")).agg(F.max("n").alias("n"))
    found = slots.toArrow()
    levels = np.zeros(LEVEL_SLOTS, np.uint8)
    levels[found["slot"].to_numpy()] = np.log2(found["n"].to_numpy()).astype(np.uint8)
    return levels


def _prefixes(texts, levels, threshold, weighted):
    """(token, id, size, pos): the first elements of each text, rare ones before frequent ones.

    Two sets of the wanted similarity have so many elements in common that, in any order,
    the first of these is among the first of both.
    """
    shipped = texts.sparkSession.sparkContext.broadcast(levels)

    @claiming("near_dedup")
    def run(batches):
        level = shipped.value
        seen = set()
        parts, held = [], 0

        def settle():
            tokens, ids, sizes = zip(*parts)
            counts = [len(t) for t in tokens]
            columns = [
                np.concatenate(tokens).view(np.int64),
                np.repeat(np.array(ids, np.int64), counts),
                np.repeat(np.array(sizes, np.int32), counts),
                np.concatenate([np.arange(n, dtype=np.int32) for n in counts]),
            ]
            return pa.RecordBatch.from_arrays([pa.array(c) for c in columns], ["token", "id", "size", "pos"])

        for batch in batches:
            for own, text in zip(batch.column("id").to_pylist(), batch.column("text").to_pylist()):
                if own in seen:
                    continue
                # Forgetting only repeats rows.
                if len(seen) > 200_000:
                    seen.clear()
                seen.add(own)
                found = elements(text or "", weighted)
                if not len(found):
                    continue
                order = np.argsort(level[(found % np.uint64(LEVEL_SLOTS)).astype(np.int64)], kind="stable")
                least = math.ceil(threshold * len(found) * (1 - 1e-9))
                parts.append((found[order[: len(found) - least + 1]], own, len(found)))
                held += len(parts[-1][0])
                if held > SKETCH_SHINGLES:
                    yield settle()
                    parts, held = [], 0
        if parts:
            yield settle()

    keyed = texts.select(F.xxhash64("node").alias("id"), "text")
    return keyed.mapInArrow(run, "token long, id long, size int, pos int")


def _missed_pairs(texts, nodes, labels, threshold, weighted):
    """All pairs of nodes of different components whose sizes and prefixes allow the wanted
    similarity, whether or not they share a bucket; columns as those of ``_pairs``."""
    at = Window.partitionBy("token")
    told = labels.select(F.xxhash64("node").alias("id"), F.xxhash64("root").alias("root"))
    found = _prefixes(texts, _levels(texts, weighted), threshold, weighted)
    found = found.withColumns({"low": F.min("id").over(at), "high": F.max("id").over(at)}).filter("low != high")
    found = found.join(told, "id", "left").select("token", "id", "size", "pos", F.coalesce("root", "id").alias("root"))
    found = found.withColumns({"low": F.min("root").over(at), "high": F.max("root").over(at)}).filter("low != high")
    found = written(found.drop("low", "high").dropDuplicates(["token", "id"]), "prefixes")
    other = found.select("token", *(F.col(n).alias(f"o_{n}") for n in ("id", "size", "pos", "root")))
    size, o_size = F.col("size"), F.col("o_size")
    share = threshold / (1 + threshold) * (1 - 1e-9)
    wanted = (size + o_size) * share
    smaller = (o_size < size) | ((o_size == size) & (F.col("o_id") < F.col("id")))
    # Sets with so many common elements have one among those before which fewer remain, and
    # for every position that these prefixes are longer one more.
    longer = F.greatest(F.lit(0.0), F.least(size * ((1 - threshold) / 10), wanted - size * threshold))
    remain = F.least(size - F.col("pos"), o_size - F.col("o_pos"))
    near = smaller & (F.col("root") != F.col("o_root")) & (o_size >= size * (threshold * (1 - 1e-9))) & (remain >= wanted - longer)
    met = found.join(other, "token").filter(near).groupBy("id", "o_id", "size", "o_size")
    met = met.agg(F.max(remain >= wanted).alias("enough"), F.count("*").alias("common")).filter(F.col("enough") & (F.col("common") >= longer))
    met = written(met.select("id", "o_id"), "missed")
    named = nodes.join(labels, "node", "left").select(F.xxhash64("node").alias("id"), "node", F.coalesce("root", "node").alias("root"))
    others = named.select(*(F.col(n).alias(f"o_{n}") for n in named.columns))
    return met.join(named, "id").join(others, "o_id").select(*_pairs("node", "root", "o_node", "o_root"))


def _live(members, labels):
    """Members of buckets that lie in several components, with their components."""
    told = members.join(labels, "node")
    spread = told.groupBy("bucket").agg(F.min("root").alias("low"), F.max("root").alias("high"))
    return told.join(spread.filter(F.col("low") != F.col("high")).select("bucket"), "bucket")


def _contracted(labels, found):
    """Labels after joining the components that the found pairs (a, b) link."""
    if found.isEmpty():
        return labels
    joined = components(found).select(F.col("node").alias("root"), F.col("root").alias("least"))
    return written(labels.join(joined, "root", "left").select("node", F.coalesce("least", "root").alias("root")), "labels")


def _labels(texts, threshold, weighted):
    """(node, root) of the texts that share a bucket or are linked; all others are alone."""
    sketches = written(_sketches(texts, weighted), "sketches")
    members = sketches.select(F.explode("buckets").alias("bucket"), "node")
    shared = members.groupBy("bucket").agg(F.count("*").alias("size")).filter("size > 1")
    members = written(members.join(shared, "bucket"), "members")
    degree = members.groupBy("node").agg(F.sum("size").alias("score"))
    degree = written(degree, "degree")
    shingles = written(_shingles_of(texts, degree, weighted), "shingles")

    def linked(pairs, shingles=shingles):
        return written(_verified(written(pairs.distinct(), "pairs"), shingles, threshold, weighted), "links")

    centre = members.join(degree, "node").groupBy("bucket").agg(F.max_by("node", F.struct("score", "node")).alias("centre"))
    pairs = members.join(centre, "bucket").filter(F.col("node") != F.col("centre"))
    labels = degree.select("node", F.col("node").alias("root"))
    labels = _contracted(labels, linked(pairs.select(*_pairs("node", "node", "centre", "centre"))))
    live = written(_live(members, labels), "live")
    large = live.filter(F.col("size") > SMALL).select("bucket", "node")
    large = written(large.join(sketches, "node"), "large")
    pairs = _small_pairs(live.filter(F.col("size") <= SMALL).select("bucket", "node", "root"))
    if large.isEmpty():
        labels = _contracted(labels, linked(pairs))
    else:
        for first in range(1, BANDS, BANDS_AT_ONCE):
            stars = _star_pairs(_live(large, labels), range(first, min(BANDS, first + BANDS_AT_ONCE)))
            labels = _contracted(labels, linked(pairs.unionByName(stars) if first == 1 else stars))
    missed = written(_missed_pairs(texts, sketches.select("node"), labels, threshold, weighted), "pairs")
    if not missed.isEmpty():
        ends = missed.select(F.explode(F.array("left", "right")).alias("node")).distinct()
        alone = written(ends.join(degree, "node", "left_anti").select("node"), "alone")
        further = _shingles_of(texts, alone, weighted).join(shingles.select("node"), "node", "left_anti")
        shingles = shingles.unionByName(written(further, "shingles"))
        labels = labels.unionByName(alone.select("node", F.col("node").alias("root")))
        labels = _contracted(labels, linked(missed, shingles))
    return labels


def duplicate_classes(docs, threshold=SIMILARITY, weighted=False):
    """(doc_id, node, class_id, root, clash) per row of ``docs`` (doc_id, text): equal texts
    share a node, and class_id is the least doc_id among all texts linked to each other.

    Null and empty texts are one node. Texts without words are near nothing but themselves;
    texts of fewer than five words are one shingle. Case and the kind of white space do not
    count. root, the least node, is what tells classes apart: class_id is null where every
    doc_id of the class is, and unrelated texts under one doc_id may have it in common.
    clash is whether class_id is so, null or that of other classes too.

    Equal texts collapse before anything else. First one member of each bucket, that with
    most bucket mates, meets all others, and linked texts become components. In a bucket of
    at most ``SMALL`` members that still holds several, every pair of different components
    meets. A larger one is split by each of the 23 further bands in turn, so that like
    members stay together, and each part compares its members with two of them, see
    ``_star_pairs``. Work per bucket is thus in proportion to its members, however many.

    Similar texts that meet nowhere in this, or share no bucket, are left to ``_missed_pairs``:
    all pairs of different components that a bound on their common shingles does not rule
    out. No link is left to chance, whatever ``threshold`` is.
    """
    rows = docs.select("doc_id", F.unhex(F.md5(utf8(F.col("text")))).alias("node"), "text")
    named = written(rows.select("doc_id", "node"), "named")
    with small_batches(docs.sparkSession):
        labels = _labels(rows.select("node", "text"), threshold, weighted)
    joined = named.join(labels, "node", "left").withColumn("root", F.coalesce("root", "node"))
    least = joined.groupBy("root").agg(F.min("doc_id").alias("class_id"))
    several = least.groupBy("class_id").agg(F.count("*").alias("n")).filter((F.col("n") > 1) & F.col("class_id").isNotNull())
    least = least.join(several, "class_id", "left").select(
        "root", "class_id", (F.col("class_id").isNull() | F.col("n").isNotNull()).alias("clash")
    )
    return joined.join(least, "root").select("doc_id", "node", "class_id", "root", "clash")


def _shingles_of(texts, wanted, weighted):
    """(node, shingles) of the wanted nodes, and of the few others whose hashes fall together
    with theirs. Texts are never shuffled: a bit for each hash goes to where they are."""
    bit = F.pmod(F.xxhash64("node"), F.lit(WANTED_BITS))
    bytes_ = wanted.select((bit % 8).cast("int").alias("bit"), F.shiftright(bit, 3).alias("byte"))
    bytes_ = bytes_.groupBy("byte").agg(F.bit_or(F.expr("shiftleft(1, bit)")).alias("bits")).toArrow()
    marks = np.zeros(WANTED_BITS // 8, np.uint8)
    marks[bytes_["byte"].to_numpy()] = bytes_["bits"].to_numpy()
    shipped = texts.sparkSession.sparkContext.broadcast(marks)

    @claiming("near_dedup")
    def run(batches):
        marks = shipped.value
        seen = set()
        for batch in batches:
            bits = batch.column("bit").to_numpy()
            hit = np.flatnonzero(marks[bits >> 3] >> (bits & 7).astype(np.uint8) & 1)
            if not len(hit):
                continue
            batch = batch.take(pa.array(hit))
            # A column at a time of some rows: long texts are not all hashed before any is sent.
            for first in range(0, len(hit), 256):
                nodes, own = [], []
                part = batch.slice(first, 256)
                for node, text in zip(part.column("node").to_pylist(), part.column("text").to_pylist()):
                    if node not in seen:
                        # Forgetting only repeats work.
                        if len(seen) > 200_000:
                            seen.clear()
                        seen.add(node)
                        nodes.append(node)
                        own.append(shingle_bytes(text or "", weighted))
                yield pa.RecordBatch.from_arrays([pa.array(nodes, pa.binary()), pa.array(own, pa.binary())], ["node", "shingles"])

    found = texts.select("node", "text", bit.alias("bit")).mapInArrow(run, "node binary, shingles binary")
    return found.dropDuplicates(["node"])


def keep_one_each(docs):
    """The rows of ``docs``, with their own columns, that are the first of their class: one
    row for each class, that of the least doc_id, a null one being the last."""
    classes = duplicate_classes(docs.select("doc_id", "text"))
    first = F.min(F.struct(F.col("doc_id").isNull().alias("unnamed"), "doc_id", "node")).alias("first")
    # Of rows that share an id, one text.
    kept = classes.groupBy("root").agg(first).select(F.col("first.doc_id").alias("d_id"), F.col("first.node").alias("d_node"))
    node = F.unhex(F.md5(utf8(F.col("text"))))
    rows = docs.join(kept, (node == F.col("d_node")) & F.col("doc_id").eqNullSafe(F.col("d_id")))
    return rows.dropDuplicates(["d_node", "d_id"]).select(*docs.columns)


def op3_dart_minhash(spark, sf_dir):
    """class_id tells classes apart: where ids do not, it is a negative hash of the root."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    own = F.bitwise_not(F.shiftrightunsigned(F.xxhash64("root"), 1))
    return duplicate_classes(docs).select("doc_id", F.when(F.col("clash"), own).otherwise(F.col("class_id")).alias("class_id"))

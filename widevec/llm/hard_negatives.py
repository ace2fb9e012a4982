"""Hard negatives from candidate blocks in Hilbert order with zone maps.

All candidates are written once, ordered by label and by their place on a Hilbert curve
through the dimensions of greatest variance, as Parquet files whose row groups are the
blocks. Each file's footer carries the least and greatest value of every dimension per
block. For an anchor, interval arithmetic over a block's zone bounds every score that the
block can hold; blocks are visited from the greatest bound down, and one is read only where
its bounds still reach a window of the anchor: the best positives first, then for each of
them the scores between two shares of its own. Bounds, scores and ties are exact integers,
so what is skipped could not have changed the result.
"""

import json

import numpy as np
import pyarrow as pa
import pyarrow.parquet as pq
from pyspark import TaskContext
from pyspark.sql import functions as F

from widevec.llm.common import table
from widevec.llm.files import committed, located, make_folder, read_all
from widevec.sources.scratch import scratch_path

SCALE = 256
# Scaled components saturate here, so that scores of up to 4,096 dimensions fit 64 bits.
MOST = 1 << 25
BLOCK = 1024
# Dimensions of the curve and bits of each: a key of 56 bits.
CURVE_DIMS = 8
CURVE_BITS = 7
# Anchors that visit blocks together.
GROUP = 128
POSITIVES = 5
NEGATIVES = 3
# Shares of the positive's score, in hundredths, between which negatives lie.
LOW, HIGH = 50, 95
NONE = -(2**63)


def candidates(rows):
    """(vec_id, label, v) of the rows that take part: v holds floor(256 * x) of each component.

    Rows with a null id, label or vector, or with a null or non-finite component, take no
    part. Components beyond 131,072 saturate. Vectors shorter than the longest count as
    followed by zeros; an empty one scores 0 with all. Repeated rows each count.
    """
    finite = F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    whole = lambda x: F.least(F.lit(MOST), F.greatest(F.lit(-MOST), F.floor(x.cast("double") * SCALE)))
    kept = rows.filter(F.col("vec_id").isNotNull() & F.col("label").isNotNull() & F.col("embedding").isNotNull() & finite)
    return kept.select(
        F.col("vec_id").cast("long").alias("vec_id"),
        F.col("label").cast("long").alias("label"),
        F.transform("embedding", lambda x: whole(x).cast("int")).alias("v"),
    )


def matrix(column, width):
    """A list column as a matrix of ``width`` columns, shorter lists filled with zeros."""
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    flat, sizes = column.flatten().to_numpy(zero_copy_only=False), np.diff(column.offsets.to_numpy())
    if (sizes == width).all():
        return flat.reshape(len(sizes), width)
    found = np.zeros((len(sizes), width), np.int32)
    found[np.repeat(np.arange(len(sizes)), sizes), np.arange(len(flat)) - np.repeat(np.cumsum(sizes) - sizes, sizes)] = flat
    return found


def spread(rows):
    """[(low, high, variance)] of every dimension, from one row per task and dimension."""

    def run(batches):
        for batch in batches:
            column = batch.column("v")
            sizes = np.diff(column.offsets.to_numpy())
            v = matrix(column, int(sizes.max())) if len(sizes) else np.zeros((0, 0))
            if v.size:
                n = len(v)
                d = np.arange(v.shape[1])
                x = v.astype(np.float64)
                columns = [d, v.min(0), v.max(0), x.sum(0), (x * x).sum(0), np.full(len(d), n)]
                names = ["d", "low", "high", "s", "ss", "n"]
                kinds = [np.int32, np.int64, np.int64, np.float64, np.float64, np.int64]
                yield pa.RecordBatch.from_arrays([pa.array(c.astype(k)) for c, k in zip(columns, kinds)], names)

    parts = rows.select("v").mapInArrow(run, "d int, low long, high long, s double, ss double, n long")
    sums = parts.groupBy("d").agg(F.min("low"), F.max("high"), F.sum("s"), F.sum("ss"), F.sum("n"))
    # As many rows as there are dimensions.
    return [(low, high, ss / n - (s / n) ** 2) for _, low, high, s, ss, n in sorted(sums.collect())]


def hilbert_key(points, bits):
    """Each row's place on the Hilbert curve through the grid of ``bits`` bits a column: the
    transposed coordinates are rotated and reflected level by level, then Gray decoded."""
    x = points.astype(np.int64).copy()
    count = x.shape[1]
    level = 1 << (bits - 1)
    while level > 1:
        below = level - 1
        for k in range(count):
            set_here = (x[:, k] & level) != 0
            swap = np.where(set_here, 0, (x[:, 0] ^ x[:, k]) & below)
            x[:, 0] ^= np.where(set_here, below, swap)
            x[:, k] ^= swap
        level >>= 1
    for k in range(1, count):
        x[:, k] ^= x[:, k - 1]
    flip = np.zeros(len(x), np.int64)
    level = 1 << (bits - 1)
    while level > 1:
        flip ^= np.where(x[:, count - 1] & level, level - 1, 0)
        level >>= 1
    x ^= flip[:, None]
    key = np.zeros(len(x), np.int64)
    for bit in range(bits - 1, -1, -1):
        for k in range(count):
            key = key << 1 | x[:, k] >> bit & 1
    return key


def with_keys(rows, dims):
    """``rows`` with their place on the curve through the widest dimensions."""
    chosen = sorted(range(len(dims)), key=lambda d: (-dims[d][2], d))[:CURVE_DIMS]
    low = np.array([dims[d][0] for d in chosen], np.float64)
    step = np.array([max(1, dims[d][1] - dims[d][0]) for d in chosen]) / ((1 << CURVE_BITS) - 1)

    def run(batches):
        for batch in batches:
            v = matrix(batch.column("v"), len(dims))
            key = hilbert_key(((v[:, chosen] - low) / step).astype(np.int64), CURVE_BITS) if chosen else np.zeros(len(v), np.int64)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(key)], [*batch.schema.names, "key"])

    return rows.mapInArrow(run, "vec_id long, label long, v array<int>, key long")


def in_order(rows, parts=None):
    by = ["label", "key", "vec_id"]
    spread_out = rows.repartitionByRange(parts, *by) if parts else rows.repartitionByRange(*by)
    return spread_out.sortWithinPartitions(*by)


def write_blocks(rows, path, width, block=BLOCK):
    """Write ``rows`` (vec_id, label, v, key) to ``path`` in order, ``block`` rows a group.

    One range shuffle; each task writes its range as a stream under a temporary name. The
    manifest, written last, has one line per file with the zone of the whole file.
    """
    make_folder(path)
    kind = pa.schema([("vec_id", pa.int64()), ("label", pa.int64()), ("v", pa.list_(pa.int32(), width))])

    def write(batches):
        number = TaskContext.get().partitionId()
        name = f"part-{number:05d}.parquet"
        zones, held = [], []

        def groups():
            nonlocal held
            for batch in batches:
                held.append(batch.select(["vec_id", "label", "v"]))
                while sum(map(len, held)) >= block:
                    rows = pa.Table.from_batches(held).combine_chunks()
                    yield rows.slice(0, block)
                    held = rows.slice(block).to_batches()
            if sum(map(len, held)):
                yield pa.Table.from_batches(held).combine_chunks()

        found = groups()
        group = next(found, None)
        if group is None:
            return
        with committed(f"{path}/{name}") as out:
            with pq.ParquetWriter(out, kind, compression="zstd", use_dictionary=False) as writer:
                while group is not None:
                    ids, labels = (group.column(k).to_numpy() for k in ("vec_id", "label"))
                    v = np.ascontiguousarray(matrix(group.column("v"), width))
                    lists = pa.FixedSizeListArray.from_arrays(pa.array(v.reshape(-1)), width)
                    writer.write_table(pa.Table.from_arrays([pa.array(ids), pa.array(labels), lists], schema=kind), row_group_size=block)
                    low, high = (f(0) if width else np.zeros(0) for f in (v.min, v.max))
                    zones.append([labels.min(), labels.max(), ids.min(), *low, *high])
                    group = next(found, None)
                zones = np.array(zones, np.int64)
                writer.add_key_value_metadata({"zones": zones.tobytes().hex()})
        least, most = zones.min(0), zones.max(0)
        whole = [least[0], most[1], least[2], *least[3 : 3 + width], *most[3 + width :]]
        yield pa.RecordBatch.from_arrays([pa.array([name]), pa.array([[int(x) for x in whole]], pa.list_(pa.int64()))], ["file", "zone"])

    # A row per file, whatever the number of candidates.
    files = in_order(rows).mapInArrow(write, "file string, zone array<long>").collect()
    with committed(f"{path}/manifest.json") as out:
        out.write(json.dumps({"width": width, "files": sorted((f["file"], f["zone"]) for f in files)}).encode())


class Bounds:
    """The zones of blocks or files: what scores, labels and ids they can hold."""

    def __init__(self, zones, width):
        self.label_low, self.label_high, self.id_low = zones[:, 0], zones[:, 1], zones[:, 2]
        self.low, self.high = zones[:, 3 : 3 + width], zones[:, 3 + width :]

    def scores(self, vectors):
        """(least, greatest) score of each vector with anything in each zone."""
        up, down = np.maximum(vectors, 0), np.minimum(vectors, 0)
        low, high = self.low.astype(vectors.dtype).T, self.high.astype(vectors.dtype).T
        return up @ low + down @ high, up @ high + down @ low


class Windows:
    """The best entries found so far in score windows: higher scores first, then smaller ids.

    A window belongs to one anchor; ``same`` says whether it takes rows of the anchor's label
    or of the others. ``floor`` is the least score that can still enter, and with ``floor_id``
    the greatest id at that score.
    """

    def __init__(self, owner, low, high, size, labels, same):
        self.owner, self.low, self.high, self.size = owner, low, high, size
        self.labels, self.same = labels, same
        self.floor, self.floor_id = low.copy(), np.full(len(owner), 2**63 - 1)
        self.best = [(np.zeros(0, np.int64), np.zeros(0, np.int64))] * len(owner)

    def reached(self, bounds, least, greatest):
        """[windows, zones] which zones may hold an entry."""
        least, greatest = least[self.owner], greatest[self.owner]
        floor, own = self.floor[:, None], self.labels[:, None]
        found = (least <= self.high[:, None]) & ((greatest > floor) | (greatest == floor) & (bounds.id_low <= self.floor_id[:, None]))
        inside = (bounds.label_low <= own) & (own <= bounds.label_high)
        alone = (bounds.label_low == own) & (own == bounds.label_high)
        return found & (inside if self.same else ~alone)

    def take(self, chosen, scores, labels, ids):
        """Offer a block's rows to the chosen windows; scores: by anchor, one for each row."""
        for w in chosen:
            own = scores[self.owner[w]]
            fits = (own >= self.floor[w]) & (own <= self.high[w]) & ((labels == self.labels[w]) == self.same)
            at = np.flatnonzero(fits)
            if not len(at):
                continue
            s, i = np.concatenate((self.best[w][0], own[at])), np.concatenate((self.best[w][1], ids[at]))
            if len(s) > 4 * self.size:
                cut = np.partition(s, len(s) - self.size)[len(s) - self.size]
                s, i = s[s >= cut], i[s >= cut]
            order = np.lexsort((i, -s))[: self.size]
            self.best[w] = s[order], i[order]
            if len(order) == self.size:
                self.floor[w], self.floor_id[w] = s[order[-1]], i[order[-1]]


class BlockStore:
    """The written blocks as a task reads them."""

    def __init__(self, path):
        self.path = path
        found = json.loads(read_all(f"{path}/manifest.json"))
        self.width, self.names = found["width"], [name for name, _ in found["files"]]
        self.files = Bounds(np.array([zone for _, zone in found["files"]], np.int64).reshape(-1, 3 + 2 * self.width), self.width)
        most = int(max(np.abs(x).max(initial=0) for x in (self.files.low, self.files.high))).bit_length()
        # Floating point is exact up to 53 bits, and fast.
        self.kind = np.float64 if 2 * most + self.width.bit_length() <= 52 else np.int64
        self.read = self.skipped = 0

    def visit(self, vectors, windows):
        """Fill the windows from all blocks that they can reach, best bounds first."""
        if not self.names or not len(windows.owner):
            return
        least, greatest = self.files.scores(vectors)
        for at in self._order(windows, self.files, least, greatest):
            if not windows.reached(self._one(self.files, at), least[:, [at]], greatest[:, [at]]).any():
                continue
            system, place = located(f"{self.path}/{self.names[at]}")
            with system.open_input_file(place) as source:
                parquet = pq.ParquetFile(source)
                zones = bytes.fromhex(parquet.metadata.metadata[b"zones"].decode())
                blocks = Bounds(np.frombuffer(zones, np.int64).reshape(-1, 3 + 2 * self.width), self.width)
                self._visit_file(parquet, blocks, vectors, windows)

    def _visit_file(self, parquet, blocks, vectors, windows):
        least, greatest = blocks.scores(vectors)
        for at in self._order(windows, blocks, least, greatest):
            chosen = np.flatnonzero(windows.reached(self._one(blocks, at), least[:, [at]], greatest[:, [at]])[:, 0])
            if not len(chosen):
                self.skipped += 1
                continue
            self.read += 1
            group = parquet.read_row_group(int(at))
            ids, labels = (group.column(k).to_numpy() for k in ("vec_id", "label"))
            v = group.column("v").combine_chunks().flatten().to_numpy().reshape(-1, self.width).astype(self.kind)
            asked = np.unique(windows.owner[chosen])
            found = (vectors[asked] @ v.T).astype(np.int64)
            windows.take(chosen.tolist(), dict(zip(asked.tolist(), found)), labels, ids)

    @staticmethod
    def _one(bounds, at):
        one = object.__new__(Bounds)
        one.label_low, one.label_high, one.id_low = (x[[at]] for x in (bounds.label_low, bounds.label_high, bounds.id_low))
        return one

    @staticmethod
    def _order(windows, bounds, least, greatest):
        """Zones that any window reaches, by the greatest of their bounds."""
        reached = windows.reached(bounds, least, greatest).any(0)
        asked = np.unique(windows.owner)
        order = np.argsort(-greatest[asked].max(0), kind="stable")
        return order[reached[order]].tolist()


def mined(store, ids, labels, vectors, positives, negatives, low, high):
    """Rows (anchor_id, positive_id, rank, negative_id, positive_score, negative_score)."""
    vectors = vectors.astype(store.kind)
    all_low, all_high = np.full(len(ids), NONE), np.full(len(ids), 2**63 - 1)
    # One more, since the anchor itself is among the candidates.
    near = Windows(np.arange(len(ids)), all_low, all_high, positives + 1, labels, True)
    store.visit(vectors, near)
    own = (vectors * vectors).sum(1).astype(np.int64)
    pairs = []
    for a, (scores, found) in enumerate(near.best):
        others = list(zip(scores.tolist(), found.tolist()))
        if (int(own[a]), int(ids[a])) in others:
            others.remove((int(own[a]), int(ids[a])))
        pairs += [(a, i, s) for s, i in others[:positives]]
    # Shares of a score as whole numbers; a negative score has an empty window.
    bounds = [(a, -(-low * s // 100), high * s // 100) for a, _, s in pairs]
    asked = sorted({b for b in bounds if b[1] <= b[2]})
    owner, least, most = (np.array([b[k] for b in asked], np.int64) for k in range(3))
    far = Windows(owner, least, most, negatives, labels[owner], False)
    store.visit(vectors, far)
    place = {b: k for k, b in enumerate(asked)}
    rows = []
    for (a, i, s), b in zip(pairs, bounds):
        if b in place:
            for rank, (t, j) in enumerate(zip(*(x.tolist() for x in far.best[place[b]])), 1):
                rows.append((int(ids[a]), i, rank, j, s, t))
    return rows


def hard_negatives(rows, is_anchor, positives=POSITIVES, negatives=NEGATIVES, low=LOW, high=HIGH, block=BLOCK):
    """For each anchor among ``rows`` (vec_id, label, embedding) and each of its first
    ``positives`` other rows of its label, the first ``negatives`` rows of other labels that
    score between ``low`` and ``high`` hundredths of the positive's score.

    Scores are inner products of the scaled vectors, see ``candidates``; higher ones come
    first, ties by smaller vec_id. ``is_anchor`` is a condition on vec_id. Repeated rows are
    rows of their own, and each is the other's positive. Other columns are ignored; an empty
    table gives none. Candidates move once, in one range shuffle that spreads a hot label
    along the curve; anchors are a task's share of 128 or so, which hold nothing but their
    best entries and one block. A lost task starts again from the written blocks.
    """
    spark = rows.sparkSession
    # A table without components still has one dimension, of zeros.
    dims = spread(candidates(rows)) or [(0, 0, 0.0)]
    keyed = with_keys(candidates(rows), dims)
    path = scratch_path(spark, "blocks")
    write_blocks(keyed, path, len(dims), block)
    schema = "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long"
    anchors = keyed.filter(is_anchor)
    parts = -(-anchors.count() // GROUP)

    def mine(batches):
        store = None
        for batch in batches:
            for at in range(0, batch.num_rows, GROUP):
                store = store or BlockStore(path)
                part = batch.slice(at, GROUP)
                v = matrix(part.column("v"), store.width)
                ids, labels = (part.column(k).to_numpy() for k in ("vec_id", "label"))
                found = mined(store, ids, labels, v, positives, negatives, low, high)
                kinds = [pa.int64(), pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64()]
                names = ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]
                columns = zip(*found) if found else [[]] * len(names)
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names)

    return in_order(anchors, max(1, parts)).mapInArrow(mine, schema)


def op12_hard_negatives(spark, sf_dir):
    rows = table(spark, sf_dir, "embeddings")
    turned = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    rows = rows.select("vec_id", turned.alias("label"), "embedding")
    return hard_negatives(rows, F.col("vec_id") % 50 == 0)


# Every anchor against every row, in plain SQL.
OP12_SQL = """
WITH told AS (
    SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
           list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS DOUBLE)) AS v
    FROM embeddings
    WHERE label IS NOT NULL AND embedding IS NOT NULL AND vec_id IS NOT NULL
      AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
scored AS (
    SELECT a.vec_id AS anchor_id, b.vec_id AS other_id, a.label = b.label AS same,
           CAST(list_inner_product(a.v, b.v) AS BIGINT) AS score
    FROM told a, told b WHERE a.vec_id % 50 = 0 AND a.vec_id <> b.vec_id),
positives AS (
    SELECT anchor_id, other_id AS positive_id, score AS positive_score FROM scored WHERE same
    QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, other_id) <= 5),
ranked AS (
    SELECT p.anchor_id, positive_id, other_id AS negative_id, positive_score, score AS negative_score,
           row_number() OVER (PARTITION BY p.anchor_id, positive_id ORDER BY score DESC, other_id) AS rank
    FROM positives p JOIN scored n ON p.anchor_id = n.anchor_id AND NOT n.same
     AND 50 * positive_score <= 100 * score AND 100 * score <= 95 * positive_score)
SELECT anchor_id, positive_id, CAST(rank AS INTEGER) AS rank, negative_id, positive_score, negative_score
FROM ranked WHERE rank <= 3"""

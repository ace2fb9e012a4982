"""Periodic runs of words, and texts with their repetitions collapsed.

A run is a stretch of words that repeats one period at least ``powers`` times and that no
neighbouring word extends. Runs are found from repeated suffixes: two suffixes q words apart
that agree on at least q words start a stretch of period q. Suffix classes are united from
the longest common prefix (LCP) down, as Kruskal's method takes the edges of a tree, by
union-find over the ordered positions of each class. Where a position gets a new neighbour
in its class at a distance within the LCP, and the word before both differs, a run starts.
Its leftmost position and the one a period later are always such neighbours, since a
primitive period does not occur inside its own square.
"""

import re
from bisect import bisect_left, insort

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from widevec.llm.common import table

# The white space that separates words: fixed values.
SPACES = " \t\n\x0b\x0c\r"
words_of = re.compile(r"[^ \t-\r]+").findall

SHORTEST = 6
POWERS = 4
# A class this much smaller than the one it joins is inserted place by place, else merged.
INSERTED = 8


def _neighbours(codes):
    """(suffixes in order, LCP of each with the next): prefix doubling, whose ranks at every
    power of two then give each LCP by its binary digits."""
    n = len(codes)
    ranks, span = [codes.astype(np.int64)], 1
    while True:
        rank = ranks[-1]
        after = np.zeros(n, np.int64)
        after[: n - span] = rank[span:] + 1
        values, ranked = np.unique(rank * (n + 1) + after, return_inverse=True)
        span *= 2
        if len(values) == n:
            break
        ranks.append(ranked)
        if span >= n:
            break
    order = np.argsort(ranked, kind="stable")
    a, b = order[:-1].copy(), order[1:].copy()
    common = np.zeros(n - 1, np.int64)
    for level in range(len(ranks) - 1, -1, -1):
        inside = np.flatnonzero(np.maximum(a, b) < n)
        same = inside[ranks[level][a[inside]] == ranks[level][b[inside]]]
        for part in (a, b, common):
            part[same] += 1 << level
    return order, common


def periodic_runs(words, shortest=SHORTEST, powers=POWERS):
    """[(start, length, period)] by start, then period, of a sequence of words.

    ``powers`` is at least 2, ``shortest`` at least 1; the work is that of sorting the
    suffixes plus n log n insertions. Sequences in which nothing long enough occurs twice,
    the most of natural texts, are told apart by their n-grams first.
    """
    # The least LCP that any run can have, and so where uniting ends.
    least = max(1, min(max((powers - 1) * q, shortest - q) for q in range(1, shortest + 1)))
    if len(words) < least + 1:
        return []
    last = dict(zip(words, range(len(words))))
    codes = list(map(last.__getitem__, words))
    grams = list(zip(*[codes[k:] for k in range(least)]))
    if len(set(grams)) == len(grams):
        return []
    order, common = _neighbours(np.array(codes))
    edges = np.flatnonzero(common >= least)
    edges = edges[np.argsort(-common[edges], kind="stable")]
    parent, places, runs = {}, {}, {}

    def root(x):
        while parent[x] != x:
            parent[x] = x = parent[parent[x]]
        return x

    for a, b, lcp in zip(order[edges].tolist(), order[edges + 1].tolist(), common[edges].tolist()):
        for x in (a, b):
            if x not in parent:
                parent[x], places[x] = x, [x]
        small, large = sorted((root(a), root(b)), key=lambda x: len(places[x]))
        joining, joined = places.pop(small), places[large]
        parent[small] = large
        for at in joining:
            k = bisect_left(joined, at)
            for one, two in ((joined[k - 1], at) if k else (at, at), (at, joined[k]) if k < len(joined) else (at, at)):
                q = two - one
                # Equal suffixes start here, not further left, and reach far enough.
                if 0 < q and (powers - 1) * q <= lcp and q + lcp >= shortest and (not one or codes[one - 1] != codes[two - 1]):
                    # A multiple of the period may come up before the period itself.
                    key = one, two + lcp
                    runs[key] = min(q, runs.get(key, q))
        if len(joining) <= INSERTED:
            for at in joining:
                insort(joined, at)
        else:
            joined += joining
            joined.sort()
    return sorted((start, end - start, q) for (start, end), q in runs.items())


def collapsed_words(words, runs):
    """The words without those that a run contains after its first period."""
    drop = np.zeros(len(words) + 1, np.int64)
    for start, length, period in runs:
        drop[start + period] += 1
        drop[start + length] -= 1
    kept = np.cumsum(drop[:-1]) == 0
    return [word for word, keep in zip(words, kept.tolist()) if keep]


def find_runs(df, text="text", shortest=SHORTEST, powers=POWERS, runs="runs", collapsed="collapsed"):
    """``df`` with the periodic runs of its texts, array<struct<start,length,period>> in order,
    and the texts without what runs repeat, words joined by one space.

    One narrow pass over whole texts. Null and empty texts have no runs and collapse to the
    empty text. Columns named like the two outputs are replaced; rows are told apart by
    nothing, so repeated rows each get their result. Memory is that of one Arrow batch and of
    some 8 bytes per word and doubling of one text.
    """
    kept = [f for f in df.schema.fields if f.name not in (runs, collapsed)]
    order = [f.name for f in kept]

    def run(batches):
        for batch in batches:
            flat, ends, texts = [], [0], []
            for content in batch.column(text).to_pylist():
                words = words_of(content or "")
                found = periodic_runs(words, shortest, powers)
                flat += found
                ends.append(len(flat))
                texts.append(" ".join(collapsed_words(words, found) if found else words))
            columns = np.array(flat, np.int64).reshape(-1, 3)
            fields = [pa.array(columns[:, k]) for k in range(3)]
            inner = pa.StructArray.from_arrays(fields, ["start", "length", "period"])
            lists = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), inner)
            yield pa.RecordBatch.from_arrays(
                [*[batch.column(name) for name in order], lists, pa.array(texts, pa.string())], [*order, runs, collapsed]
            )

    schema = [f"`{f.name}` {f.dataType.simpleString()}" for f in kept]
    schema += [f"`{runs}` array<struct<start:bigint,length:bigint,period:bigint>>", f"`{collapsed}` string"]
    return df.mapInArrow(run, ", ".join(schema))


def with_periodic_tails(docs):
    """``docs`` (doc_id, text) with every text whose id's crc32 h is divisible by 10 made
    periodic: of its n words, word i >= a becomes word a+(i-a)%p, where g=h/10, a=g%n and
    p=1+(n-a)/(3+g%8), all whole numbers. Rows without an id or without words stay."""
    h = F.crc32(F.col("doc_id").cast("string").cast("binary"))
    bare = F.btrim("text", F.lit(SPACES))
    chosen = (h % 10 == 0) & (bare != "")
    rows = docs.select("doc_id", "text", F.when(chosen, F.split(bare, r"[ \t-\r]+")).alias("words"), F.floor(h / 10).alias("g"))
    rows = rows.withColumn("n", F.size("words").cast("long"))
    rows = rows.withColumn("a", F.when(F.col("n") > 0, F.col("g") % F.col("n")))
    rows = rows.withColumn("p", 1 + F.floor((F.col("n") - F.col("a")) / (3 + F.col("g") % 8)))
    tail = F.array_repeat(F.slice("words", (F.col("a") + 1).cast("int"), F.col("p").cast("int")), F.ceil((F.col("n") - F.col("a")) / F.col("p")).cast("int"))
    head = F.slice("words", F.lit(1), F.col("a").cast("int"))
    whole = F.slice(F.concat(head, F.flatten(tail)), F.lit(1), F.col("n").cast("int"))
    return rows.select("doc_id", F.when(F.col("words").isNull(), F.col("text")).otherwise(F.array_join(whole, " ")).alias("text"))


def op13_periodic_runs(spark, sf_dir):
    """Runs of every document after the contract's change of texts, as digests."""
    found = find_runs(with_periodic_tails(table(spark, sf_dir, "documents")))
    line = lambda r: F.concat_ws(",", *[r[k].cast("string") for k in ("start", "length", "period")])
    lines = F.concat_ws("", F.transform("runs", lambda r: F.concat(line(r), F.lit("\n"))))
    ordered = F.transform("runs", lambda r: F.struct(r["length"].alias("l"), (-r["start"]).alias("s"), (-r["period"]).alias("p")))
    rows = found.select(
        "doc_id",
        F.size("runs").cast("long").alias("n_runs"),
        F.array_max(ordered).alias("most"),
        F.sha2(lines, 256).alias("runs_sha256"),
        F.sha2(F.col("collapsed"), 256).alias("collapsed_sha256"),
    )
    return rows.select(
        "doc_id",
        "n_runs",
        (-F.col("most.s")).alias("start"),
        F.col("most.l").alias("length"),
        (-F.col("most.p")).alias("period"),
        F.floor(1000 * F.col("most.l") / -F.col("most.p")).alias("exponent_milli"),
        "runs_sha256",
        "collapsed_sha256",
    )

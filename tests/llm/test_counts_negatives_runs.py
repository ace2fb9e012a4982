"""Token counts, hard negatives and periodic runs against plain Python."""

import hashlib
import random
import re
import zlib

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from sentencepiece import SentencePieceProcessor

from widevec.llm import hard_negatives as hn
from widevec.llm import runs as rn
from widevec.llm import token_counts as tc
from widevec.llm.common import table
from widevec.llm.queries import QUERIES


@pytest.fixture(scope="module")
def library():
    return SentencePieceProcessor(model_file=public_tokenizers.path(tc.MODEL))


@pytest.fixture(scope="module")
def counter():
    return tc.PieceCounter(public_tokenizers.path(tc.MODEL), chunk=64, overlap=8)


PARTS = st.sampled_from(["the ", "cat", "  ", "\n", "é", "中", "文", "😀", "▁", " a", "\t", "ing", "<s>", "x" * 30, "。", "́", "abcab"])


@settings(max_examples=300, deadline=None)
@given(st.lists(PARTS, max_size=200).map("".join))
def test_spliced_counts_are_those_of_the_library(library, counter, text):
    assert counter.counts([text]) == [len(library.encode(text))]


def test_overlaps_widen_until_a_stable_offset(library, counter):
    before = counter.widened
    for text in ("ab" * 4000, "a" * 4000, "é" * 3000, " " * 3000, "ab" * 2000 + " " + "ba" * 2000):
        assert counter.counts([text]) == [len(library.encode(text))]
    assert counter.widened > before


def test_counts_of_odd_rows(spark, library):
    texts = [None, "", " ", "one word", "one word", "<s> and </s>", "long one " * 30_000]
    rows = spark.createDataFrame([(k, t, "x") for k, t in enumerate(texts)], "doc_id long, text string, n_tokens string")
    found = {r["doc_id"]: r["n_tokens"] for r in tc.count_tokens(rows).collect()}
    assert found == {k: len(library.encode(t or "")) for k, t in enumerate(texts)}
    assert tc.count_tokens(rows.filter("doc_id < 0")).collect() == []


def test_counts_of_the_query(spark, sf, library):
    texts = {r["doc_id"]: r["text"] or "" for r in table(spark, sf, "documents").collect()}
    for row in QUERIES["op11_token_counts"](spark, sf).collect():
        text = texts.pop(row["doc_id"])
        n = len(library.encode(text))
        assert (row["n_bytes"], row["n_tokens"], row["over_limit"]) == (len(text.encode()), n, n > 4096)
    assert not texts


def brute_negatives(rows, is_anchor, positives=5, negatives=3):
    real = []
    for i, label, vector in rows:
        if i is None or label is None or vector is None or any(x is None or not np.isfinite(x) for x in vector):
            continue
        real.append((i, label, [int(np.floor(256 * float(np.float32(x)))) for x in vector]))
    score = lambda a, b: sum(x * y for x, y in zip(a[2], b[2]))
    found = []
    for k, anchor in enumerate(real):
        if not is_anchor(anchor[0]):
            continue
        scored = sorted((-score(anchor, other), other[0], other[1]) for j, other in enumerate(real) if j != k)
        for s, i, _ in [x for x in scored if x[2] == anchor[1]][:positives]:
            fits = [x for x in scored if x[2] != anchor[1] and 50 * -s <= 100 * -x[0] <= 95 * -s]
            found += [(anchor[0], i, r, x[1], -s, -x[0]) for r, x in enumerate(fits[:negatives], 1)]
    return sorted(found)


SCHEMA = "vec_id long, label int, embedding array<float>, key string, v string"


@pytest.mark.parametrize("seed", range(3))
def test_negatives_are_those_of_brute_force(spark, seed):
    rng = random.Random(seed)
    centres = [[rng.gauss(0, 0.3) for _ in range(12)] for _ in range(4)]
    rows = []
    for i in range(400):
        # A third of all rows is one label, and every fourth vector is one of few: many ties.
        label = 0 if i % 3 == 0 else rng.randrange(4)
        centre = rng.choice(centres)
        vector = [round(x, 1) for x in centre] if i % 4 == 0 else [x + rng.gauss(0, 0.1) for x in centre]
        rows.append((i, label, [float(np.float32(x)) for x in vector]))
    rows += [(None, 1, [0.5] * 12), (500, None, [0.5] * 12), (510, 1, None), (520, 1, [None] + [0.5] * 11)]
    rows += [(530, 1, [float("nan")] * 12), (540, 2, [float("inf")] * 12), (550, 2, []), (560, 3, [0.5] * 5)]
    rows += rows[:20]
    df = spark.createDataFrame([(*r, "a", "b") for r in rows], SCHEMA).repartition(5)
    found = hn.hard_negatives(df, F.col("vec_id") % 10 == 0, block=16)
    assert sorted(map(tuple, found.collect())) == brute_negatives(rows, lambda i: i % 10 == 0)


def test_negatives_of_no_rows_and_of_empty_vectors(spark):
    nothing = spark.createDataFrame([], SCHEMA)
    assert hn.hard_negatives(nothing, F.col("vec_id") >= 0).collect() == []
    rows = [(k, k % 2, []) for k in range(6)]
    df = spark.createDataFrame([(*r, "a", "b") for r in rows], SCHEMA)
    found = hn.hard_negatives(df, F.col("vec_id") >= 0)
    assert sorted(map(tuple, found.collect())) == brute_negatives(rows, lambda i: True)


def test_large_components_saturate_and_stay_exact(spark):
    rows = [(k, k % 2, [1e30 if k % 3 else 100000.0 - k] * 4) for k in range(12)]
    df = spark.createDataFrame([(*r, "a", "b") for r in rows], SCHEMA)
    found = hn.hard_negatives(df, F.col("vec_id") >= 0).collect()
    level = lambda x: min(int(np.floor(256 * float(np.float32(x)))), hn.MOST)
    vectors = {i: [level(x) for x in v] for i, _, v in rows}
    assert found
    for row in found:
        assert row["negative_score"] == sum(x * y for x, y in zip(vectors[row["anchor_id"]], vectors[row["negative_id"]]))


def test_zone_bounds_skip_blocks_of_other_clusters(spark, tmp_path):
    rng = np.random.default_rng(0)
    v = np.repeat(np.eye(8) * 2, 256, axis=0) + rng.normal(0, 0.02, (2048, 8))
    rows = [(k, k % 2, [float(x) for x in row], "a", "b") for k, row in enumerate(v)]
    found = hn.candidates(spark.createDataFrame(rows, SCHEMA))
    dims = hn.spread(found)
    keyed = hn.with_keys(found, dims)
    hn.write_blocks(keyed, str(tmp_path / "blocks"), 8, block=32)
    store = hn.BlockStore(str(tmp_path / "blocks"))
    own = np.floor(v[:1] * 256).astype(np.int64)
    hn.mined(store, np.array([0]), np.array([0]), own, 5, 3, 50, 95)
    # Two clusters in eight at most hold anything; positives and negatives each read their own.
    assert 0 < store.read <= 24


def test_hilbert_keys_walk_the_grid_in_steps_of_one():
    for dims, bits in ((2, 4), (3, 3), (4, 2)):
        axes = np.meshgrid(*[np.arange(1 << bits)] * dims, indexing="ij")
        points = np.stack([a.reshape(-1) for a in axes], 1)
        keys = hn.hilbert_key(points, bits)
        assert sorted(keys.tolist()) == list(range(len(points)))
        walk = points[np.argsort(keys)]
        assert (np.abs(np.diff(walk, axis=0)).sum(1) == 1).all()


def brute_runs(words, shortest=6, powers=4):
    n, found = len(words), set()
    for q in range(1, n // powers + 1):
        at = 0
        while at + q < n:
            if words[at] != words[at + q]:
                at += 1
                continue
            end = at
            while end + q < n and words[end] == words[end + q]:
                end += 1
            start, stop = at, end + q
            smallest = next(d for d in range(1, q + 1) if all(words[k] == words[k + d] for k in range(start, stop - d)))
            if smallest == q and stop - start >= max(shortest, powers * q):
                found.add((start, stop - start, q))
            at = end
    return sorted(found)


@settings(max_examples=400, deadline=None)
@given(st.lists(st.sampled_from("abc"), max_size=60), st.integers(1, 12), st.integers(1, 8), st.sampled_from([(6, 4), (2, 2), (5, 3)]))
def test_runs_are_those_of_brute_force(words, period, times, limits):
    words = words[:20] + (words[:period] * times) + words[20:]
    found = rn.periodic_runs(words, *limits)
    assert found == brute_runs(words, *limits)
    held = {k for start, length, q in found for k in range(start + q, start + length)}
    assert rn.collapsed_words(words, found) == [w for k, w in enumerate(words) if k not in held]


def test_runs_of_long_texts():
    same = ["a"] * 100_000
    assert rn.periodic_runs(same) == [(0, 100_000, 1)]
    long_period = [str(k % 20_000) for k in range(100_000)]
    assert rn.periodic_runs(long_period) == [(0, 100_000, 20_000)]
    assert rn.periodic_runs([str(k) for k in range(100_000)]) == []


def test_runs_of_odd_rows(spark):
    texts = [None, "", " \t\n", "a a a a a a", "a a a a a", "x y " * 6, "A a " * 4, "a a a a a a"]
    rows = spark.createDataFrame([(k, t, "x", "y") for k, t in enumerate(texts)], "doc_id long, text string, runs string, collapsed string")
    for row in rn.find_runs(rows).collect():
        words = re.findall(r"[^\x20\x09-\x0D]+", texts[row["doc_id"]] or "")
        assert [tuple(r) for r in row["runs"]] == brute_runs(words)
        assert row["collapsed"] == " ".join(rn.collapsed_words(words, brute_runs(words)))
    assert rn.find_runs(rows.filter("doc_id < 0")).collect() == []


def test_runs_of_the_query(spark, sf):
    texts = {r["doc_id"]: r["text"] or "" for r in table(spark, sf, "documents").collect()}
    changed = 0
    for row in QUERIES["op13_periodic_runs"](spark, sf).collect():
        words = re.findall(r"[^\x20\x09-\x0D]+", texts.pop(row["doc_id"]))
        h, n = zlib.crc32(str(row["doc_id"]).encode()), len(words)
        if h % 10 == 0 and n:
            g = h // 10
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            words = [w if k < a else words[a + (k - a) % p] for k, w in enumerate(words)]
            changed += 1
        runs = brute_runs(words)
        start, length, period = min(runs, key=lambda r: (-r[1], r[0], r[2]), default=(None,) * 3)
        lines = "".join(f"{s},{n},{q}\n" for s, n, q in runs)
        kept = " ".join(rn.collapsed_words(words, runs))
        assert (row["n_runs"], row["start"], row["length"], row["period"]) == (len(runs), start, length, period)
        assert row["exponent_milli"] == (1000 * length // period if runs else None)
        assert row["runs_sha256"] == hashlib.sha256(lines.encode()).hexdigest()
        assert row["collapsed_sha256"] == hashlib.sha256(kept.encode()).hexdigest()
    assert not texts and changed > 5


def test_ids_of_none_keep_their_text(spark):
    rows = spark.createDataFrame([(None, "a b c"), (None, None)], "doc_id long, text string")
    assert sorted(map(str, (r["text"] for r in rn.with_periodic_tails(rows).collect()))) == ["None", "a b c"]

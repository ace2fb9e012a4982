"""The training-text operators against plain Python, on small tables with every odd case."""

import base64
import collections
import hashlib
import html
import itertools
import random
import re
import zlib

import duckdb
import numpy as np
import oracle
import public_tokenizers
import pyarrow as pa
import pytest
from tokenizers import Tokenizer

import corpus_pipeline
from widevec.llm import bpe, chat, decontamination, language, near_dedup, pages, quality, queries, sharding, token_files, warc, words
from widevec.sources.scratch import scratch_path

DOCS = "doc_id long, text string, lang string, source string, n_chars long"
ODD = [None, "", "  \n ", "a", "1 2 3", "x\x1c\x1dy!", "né́ e ́x", "a\tb \n\n c  ", "<|endoftext|> a <|endoftext|>b",
       "漢字かな" * 50, "a" * 3000, "it's we'll 45½ ²", "a.b,c ,d …. »,", "🏠👩‍👩‍👧 ok", "a   b　c", "\x00 a", "ΟΔΟΣ Σ"]


@pytest.fixture(scope="module")
def odd(spark):
    """Null and repeated ids, equal rows, null metadata, extra columns with clashing names."""
    rows = [(k, text, None if k % 3 else "en", None if k % 2 else "s", 0) for k, text in enumerate(ODD)]
    rows += [(3, "again", "de", "s", 1), (3, "again", "de", "s", 1), (None, "no id", None, None, None)]
    frame = spark.createDataFrame(rows, DOCS)
    from pyspark.sql import functions as F

    return frame.withColumns({n: F.lit(7) for n in ("n_words", "fail_bits", "hit_spans", "score", "lang_pred", "ids", "shard", "node")})


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], DOCS)


@pytest.mark.parametrize("name", sorted(queries.ORACLE_SQL))
def test_sql(spark, sf, name):
    found = oracle.comparable(queries.QUERIES[name](spark, sf).toArrow())
    expected = oracle.comparable(oracle.connect(sf).sql(queries.ORACLE_SQL[name]).to_arrow_table())
    assert found.num_rows > 0
    assert [f.type for f in found.schema] == [f.type for f in expected.schema]
    assert oracle.rows(found) == oracle.rows(expected)


# ------------------------------------------------------------------ 1


def kd_brute(rows, shards):
    """rows: (dims, tie1, tie2, size). The same tree, by sorting."""

    def split(part, first, leaves):
        if leaves == 1:
            return {id(r): first for r in part}
        lows = [min(r[0][d] for r in part) for d in range(3)]
        highs = [max(r[0][d] for r in part) for d in range(3)]
        widths = [(h - low) / s for h, low, s in zip(highs, lows, spread)]
        d = widths.index(max(widths))
        bits = (1 << 20) - 1

        def key(r):
            place = (r[0][d] - lows[d]) / (highs[d] - lows[d]) if highs[d] > lows[d] else 0.0
            return int(place * bits) << 40 | (r[1] & bits) << 20 | r[2] & bits

        half, total, below = leaves // 2, sum(r[3] for r in part), 0
        cut = None
        for k, same in itertools.groupby(sorted(part, key=key), key):
            weight = sum(r[3] for r in same)
            if (below + weight) * leaves >= half * total:
                cut = k if (below + weight) * leaves - half * total <= half * total - below * leaves else k - 1
                break
            below += weight
        left = [r for r in part if key(r) <= cut]
        right = [r for r in part if key(r) > cut]
        return (split(left, first, half) if left else {}) | (split(right, first + half, leaves - half) if right else {})

    spread = [max(max(r[0][d] for r in rows) - min(r[0][d] for r in rows), 1e-300) for d in range(3)]
    return split(rows, 0, shards)


@pytest.mark.parametrize("shards, cell_rows", [(1, 0), (3, 0), (8, 0), (3, 150), (8, 150), (100, 1000)])
def test_kd_tree_is_that_of_sorting(spark, monkeypatch, shards, cell_rows):
    """By histograms alone, by both ways, and by windows alone."""
    monkeypatch.setattr(sharding, "CELL_ROWS", cell_rows)
    rng = random.Random(shards)
    data = [((float(rng.randrange(3)), float(rng.randrange(40)), rng.random()), rng.randrange(1 << 32), rng.randrange(1 << 32), rng.randrange(1, 90)) for _ in range(300)]
    frame = spark.createDataFrame([(k, *r[0], *r[1:]) for k, r in enumerate(data)], "k long, a double, b double, c double, t1 long, t2 long, size long")
    found = {r["k"]: r["shard"] for r in sharding.kd_shards(frame, ["a", "b", "c"], "size", ["t1", "t2"], shards=shards).collect()}
    expected = kd_brute(data, shards)
    assert [found[k] for k in range(300)] == [expected[id(r)] for r in data]


def test_shards_of_odd_rows(odd, empty):
    rows = sharding.shard_documents(odd, shards=3).collect()
    assert len(rows) == odd.count()
    by = collections.defaultdict(list)
    for row in rows:
        by[row["shard"]].append(row["slot"])
    assert all(sorted(slots) == list(range(len(slots))) for slots in by.values())
    assert sharding.shard_documents(empty, shards=3).collect() == []
    assert {r["size"] for r in rows if r["text_crc32"] == 0} == {1}


def test_op1(spark, sf):
    docs = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    found = sharding.op1_kd_shards(spark, sf).collect()
    assert {r["doc_id"] for r in found} == set(docs) and len(found) == len(docs)
    total, largest, slots = collections.Counter(), 0, collections.defaultdict(list)
    for row in found:
        content = (docs[row["doc_id"]] or "").encode()
        assert (row["size"], row["text_crc32"]) == (len(content) + 1, zlib.crc32(content))
        assert (row["law"], row["grown_shard"]) == ("bytes", None)
        total[row["shard"]] += row["size"]
        largest = max(largest, row["size"])
        slots[row["shard"]].append(row["slot"])
    assert sorted(total) == list(range(8))
    # Each of three levels misses its half by half a document at most.
    assert all(abs(size - sum(total.values()) / 8) <= 1.5 * largest for size in total.values())
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())


def test_shards_of_target_bytes(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    found = sharding.shard_documents(docs, target_bytes=16_384, shards=None).collect()
    leaves = -(-sum(r["size"] for r in found) // 16_384)
    assert leaves > 8 and {r["shard"] for r in found} <= set(range(leaves))
    assert len(found) == docs.count()


# ------------------------------------------------------------------ 2 and 6


def library(name):
    found = Tokenizer.from_file(public_tokenizers.path(name))
    found.no_truncation()
    found.no_padding()
    return found


def test_token_files_hold_the_ids_of_the_library(spark, odd, empty):
    found = library(token_files.TOKENIZER)
    path = scratch_path(spark, "tokens")
    token_files.write_token_files(odd, path)
    rows = token_files.read_token_files(spark, path)[0].collect()
    expected = collections.Counter(
        (r["doc_id"], tuple([*found.encode(r["text"] or "", add_special_tokens=False).ids, 0])) for r in odd.collect()
    )
    assert collections.Counter((r["doc_id"], tuple(np.frombuffer(r["ids"], "<u2").tolist())) for r in rows) == expected
    rows.sort(key=lambda r: r["start"])
    assert [r["start"] for r in rows] == [0, *np.cumsum([r["n_tokens"] for r in rows])[:-1].tolist()]
    ids = [-1 if r["doc_id"] is None else r["doc_id"] for r in rows]
    assert ids == sorted(ids)
    token_files.write_token_files(empty, path + "-none")
    assert token_files.read_token_files(spark, path + "-none")[0].collect() == []


def test_op2(spark, sf):
    found = library(token_files.TOKENIZER)
    at = 0
    texts = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    for row in sorted(token_files.op2_token_files(spark, sf).collect()):
        ids = [*found.encode(texts[row["doc_id"]], add_special_tokens=False).ids, 0]
        assert tuple(row)[1:] == (at, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes()))
        at += len(ids)


@pytest.mark.parametrize("size", [1, 60, words.BLOCK_BYTES])
@pytest.mark.parametrize("name", ["byte_bpe_50k.json", "word_bpe_49k.json"])
def test_blocks_of_texts_hold_the_ids_of_the_library(name, size, monkeypatch):
    monkeypatch.setattr(words, "BLOCK_BYTES", size)
    rng = random.Random(3)
    signs = [*"aZé×9,.'\u2019 \n\t-<\x00\x1c\x7f\x85\xa0\u1680\u2003\u2028\u205f\u3000\u2018か字Ж½", "<|endoftext|>", "'s", " the", "\r\n"]
    texts = [t or "" for t in ODD]
    for _ in range(1500):
        some = rng.sample(signs, rng.choice([3, 6, len(signs)]))
        texts.append("".join(rng.choice(some) for _ in range(rng.choice([1, 3, 9, 40]))))
    found = []
    # A part of a column: its buffers begin before it.
    for ids, sizes in words.WordEncoder(public_tokenizers.path(name)).blocks(pa.array(["é before", *texts]).slice(1), 7):
        found += [part.tolist() for part in np.split(ids, np.cumsum(sizes)[:-1])]
    whole = library(name)
    assert found == [[*whole.encode(t, add_special_tokens=False).ids, 7] for t in texts]


def test_a_block_looks_up_each_distinct_word_once():
    class Counted(dict):
        asked = 0

        def get(self, word):
            self.asked += 1
            return super().get(word)

    encoder = words.WordEncoder(public_tokenizers.path(token_files.TOKENIZER))
    encoder.known = Counted()
    texts = [" ".join(f"word{'abcdefgh'[(k + i) % 8]}" for i in range(50)) for k in range(200)]
    list(encoder.blocks(pa.array(texts), 0))
    assert encoder.known.asked <= 16


@pytest.mark.parametrize("name", ["byte_bpe_50k.json", "word_bpe_49k.json"])
def test_word_and_chunk_encoders_equal_the_library(name):
    found = library(name)
    plain, chunked = words.WordEncoder(public_tokenizers.path(name)), bpe.ChunkEncoder(name)
    rng = random.Random(5)
    texts = [t or "" for t in ODD]
    for _ in range(400):
        texts.append("".join(rng.choice([" ", "\n", "\t", "a", "B", "é", "the", ",", ".", "'s", "1", "…", "ß", "́", "   ", "\x1d", "ñ", "!?"]) for _ in range(rng.randrange(60))))
    texts.append("".join(texts) * 3)
    for text in texts:
        ids = found.encode(text, add_special_tokens=False).ids
        assert np.frombuffer(plain.encode(text), "<u4").tolist() == ids, repr(text)
        assert np.frombuffer(chunked.encode(text), "<u4").tolist() == ids, repr(text)
    assert chunked.reused > 0


def test_chunks_are_cut_by_content():
    rng = random.Random(1)
    shared = "".join(rng.choice("abcdefgh é ") for _ in range(5000))
    parts = []
    for lead in ("", "another start ", "ß" * 77):
        content = (lead + shared).encode()
        ends = bpe.cuts(content)
        assert ends[-1] == len(content)
        parts.append({content[a:b] for a, b in zip([0, *ends], ends)})
        assert all(part.decode() for part in parts[-1])
    assert len(parts[0] & parts[1] & parts[2]) >= len(parts[0]) - 2


def test_bpe_round_trip(spark, odd, empty):
    found = library(bpe.TOKENIZER)
    texts = odd.select("doc_id", "text").collect()
    rows = bpe.decode_ids(bpe.encode_texts(odd)).collect()
    expected = collections.Counter()
    for row in texts:
        ids = found.encode(row["text"] or "", add_special_tokens=False).ids
        expected[row["doc_id"], tuple(ids), found.decode(ids, skip_special_tokens=False)] += 1
    assert collections.Counter((r["doc_id"], tuple(np.frombuffer(r["ids"], "<u4").tolist()), r["decoded"]) for r in rows) == expected
    sums = collections.Counter(
        (d, len(i), hashlib.sha256(np.array(i, "<u4").tobytes()).hexdigest(), hashlib.sha256(t.encode()).hexdigest()) for (d, i, t), n in expected.items() for _ in range(n)
    )
    assert collections.Counter(tuple(r) for r in bpe.bpe_digests(odd).collect()) == sums
    assert bpe.bpe_digests(empty).collect() == []


# ------------------------------------------------------------------ 3


def test_signatures_agree_as_often_as_sets_are_similar():
    rng = np.random.default_rng(2)
    both = rng.integers(0, 2**62, 300).astype(np.uint64)
    for weights in (np.ones(300), rng.uniform(0.2, 6, 300)):
        other = weights * rng.choice([0.0, 0.6, 1.0], 300)
        kept = other > 0
        true = np.minimum(weights, other).sum() / np.maximum(weights, other).sum()
        owner = np.repeat([0, 1], [300, kept.sum()])
        agreed = []
        for seed in range(12):
            signs = near_dedup.dart_minhash(np.append(both, both[kept]), np.append(weights, other[kept]), owner, 2, 120, 10 * seed)
            agreed.append((signs[0] == signs[1]).mean())
        assert abs(np.mean(agreed) - true) < 0.05


def groups_brute(rows):
    shingles = {k: set(near_dedup.shingle_hashes(near_dedup.text_words(t or "")).tolist()) for k, (_, t) in enumerate(rows)}
    parent = list(range(len(rows)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in itertools.combinations(range(len(rows)), 2):
        x, y = shingles[a], shingles[b]
        same = (rows[a][1] or "") == (rows[b][1] or "")
        if same or (x and y and len(x & y) >= 0.8 * len(x | y)):
            parent[find(a)] = find(b)
    groups = collections.defaultdict(list)
    for k in range(len(rows)):
        groups[find(k)].append(k)
    return list(groups.values())


def classes_brute(rows):
    least = {}
    for group in groups_brute(rows):
        ids = [rows[k][0] for k in group if rows[k][0] is not None]
        for k in group:
            least[k] = min(ids, default=None)
    return collections.Counter((rows[k][0], least[k]) for k in range(len(rows)))


def test_near_duplicates(spark, odd, empty):
    rng = random.Random(4)
    base = [f"w{rng.randrange(10**6)}" for _ in range(120)]
    rows = [(r["doc_id"], r["text"]) for r in odd.collect()]
    for k in range(30):
        near = list(base)
        near[rng.randrange(120)] = f"x{k}"
        near[rng.randrange(120)] = f"y{k}"
        rows.append((100 + k, " ".join(near)))
    rows.append((140, " ".join(base).upper()))
    rows += [(150 + k, " ".join(base[:60])) for k in range(5)]
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    found = collections.Counter((r["doc_id"], r["class_id"]) for r in near_dedup.duplicate_classes(frame).collect())
    assert found == classes_brute(rows)
    kept = near_dedup.keep_one_each(frame).collect()
    # One row for each group, also where several groups share an id.
    assert len(kept) == len(groups_brute(rows))
    assert near_dedup.duplicate_classes(empty).collect() == []


def test_one_document_of_every_class_is_kept(spark, tmp_path):
    words_of = lambda k: " ".join(f"t{k}w{i}" for i in range(30))
    rows = [(None, words_of(k)) for k in range(4)] + [(None, words_of(0)), (5, words_of(10)), (5, words_of(11)), (6, words_of(11)), (7, words_of(12)), (None, words_of(12))]
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    groups = len({text for _, text in rows})
    kept = near_dedup.keep_one_each(frame).collect()
    assert sorted(map(tuple, kept), key=str) == sorted([*rows[:4], rows[5], rows[6], rows[8]], key=str)
    assert len(kept) == groups == len({r["root"] for r in near_dedup.duplicate_classes(frame).collect()})
    frame.write.parquet(f"{tmp_path}/documents.parquet")
    found = near_dedup.op3_dart_minhash(spark, str(tmp_path)).collect()
    assert len(found) == len(rows) and len({r["class_id"] for r in found}) == groups
    assert {r["class_id"] for r in found if r["doc_id"] == 7} == {7}


def test_near_duplicates_of_documents(spark, sf):
    rows = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{sf}/documents.parquet").collect()]
    assert collections.Counter(tuple(r) for r in near_dedup.op3_dart_minhash(spark, sf).collect()) == classes_brute(rows)


def test_python_is_given_near_duplicates_in_small_batches(spark, tmp_path, monkeypatch):
    """Of 7 MB of texts in one partition, workers hold a few MB at a time in every step."""
    told = str(tmp_path)

    def watched(name):
        def decorate(run):
            def measured(batches):
                import tracemalloc

                most = [0]

                def each():
                    for batch in batches:
                        most[0] = max(most[0], batch.nbytes)
                        yield batch

                tracemalloc.start()
                yield from run(each())
                peak = tracemalloc.get_traced_memory()[1]
                tracemalloc.stop()
                with open(f"{told}/{random.random()}", "w") as out:
                    out.write(f"{most[0]} {peak}")

            return measured

        return decorate

    monkeypatch.setattr(near_dedup, "claiming", watched)
    rng = random.Random(7)
    rows = [(k, " ".join(f"w{rng.randrange(10**6)}" for _ in range(600))) for k in range(1500)]
    rows += [(2000 + k, f"{text} x") for k, text in rows[:700]]
    key = "spark.sql.execution.arrow.maxBytesPerBatch"
    before = spark.conf.get(key, None)
    frame = spark.createDataFrame(rows, "doc_id long, text string").coalesce(1)
    found = near_dedup.duplicate_classes(frame).collect()
    assert {(r["doc_id"], r["class_id"]) for r in found} == {(k, k % 2000) for k, _ in rows}
    sizes = [tuple(map(int, path.read_text().split())) for path in tmp_path.iterdir()]
    assert sum(n for n, _ in sizes) > 0
    assert max(n for n, _ in sizes) < 3 << 20
    assert max(peak for _, peak in sizes) < 40 << 20
    assert spark.conf.get(key, None) == before


def test_python_is_given_stages_of_the_pipeline_in_small_batches(spark, sf, tmp_path, monkeypatch):
    """Of 7 MB of texts in one partition, workers hold a few MB at a time; the session's limit is its own again."""
    told = str(tmp_path)

    def watched(name):
        def decorate(run):
            def measured(batches):
                most = [0]

                def each():
                    for batch in batches:
                        most[0] = max(most[0], batch.nbytes)
                        yield batch

                yield from run(each())
                with open(f"{told}/{name}-{random.random()}", "w") as out:
                    out.write(f"{most[0]}")

            return measured

        return decorate

    for module in (language, decontamination, bpe):
        monkeypatch.setattr(module, "claiming", watched)
    key = "spark.sql.execution.arrow.maxBytesPerBatch"
    spark.conf.unset(key)
    rng = random.Random(7)
    rows = [(k, " ".join(f"w{rng.randrange(10**6)}" for _ in range(600)), "xx") for k in range(1500)]
    frame = spark.createDataFrame(rows, "doc_id long, text string, lang string").coalesce(1)
    for stage, name in ((corpus_pipeline.language, "language"), (corpus_pipeline.decontamination, "decontamination"), (corpus_pipeline.bpe, "words")):
        assert sorted(r["doc_id"] for r in stage(spark, frame, sf).drop("text").collect()) == list(range(1500))
        sizes = [int(path.read_text()) for path in tmp_path.iterdir() if path.name.startswith(name)]
        assert 1 << 20 < max(sizes) < 3 << 20
    assert spark.conf.get(key, None) is None
    spark.conf.set(key, "64m")
    try:
        assert corpus_pipeline.bpe(spark, frame.limit(1), sf).count() == 1
        assert spark.conf.get(key) == "64m"
    finally:
        spark.conf.unset(key)


def linked_brute(rows, threshold, weighted):
    sets = [set(near_dedup.elements(text, weighted).tolist()) for _, text in rows]
    least = [k for k, _ in rows]
    for a, b in itertools.combinations(range(len(rows)), 2):
        common = len(sets[a] & sets[b])
        if least[a] != least[b] and common >= threshold * (len(sets[a]) + len(sets[b]) - common):
            low, high = sorted((least[a], least[b]))
            least = [low if x == high else x for x in least]
    return {k: root for (k, _), root in zip(rows, least)}


@pytest.mark.parametrize("weighted", [False, True])
def test_near_duplicates_that_share_no_bucket(spark, weighted):
    """At a similarity of 0.5 bands miss every other pair."""
    rng = random.Random(1)
    words_of = lambda n: [f"w{rng.randrange(10**6)}" for _ in range(n)]
    rows = []
    for k in range(40):
        base = words_of(100)
        rows += [(2 * k, " ".join(base + base[:20])), (2 * k + 1, " ".join(base[:70] + words_of(25) + base[:20]))]
    expected = linked_brute(rows, 0.5, weighted)
    assert len(set(expected.values())) == 40
    found = near_dedup.duplicate_classes(spark.createDataFrame(rows, "doc_id long, text string"), 0.5, weighted)
    assert {r["doc_id"]: r["class_id"] for r in found.collect()} == expected


def test_near_duplicates_that_meet_no_centre(spark):
    """400 texts leave out some of 80 passages each: all are alike, few enough to be linked."""
    rng = random.Random(4)
    passages = [" ".join(f"h{i}_{rng.randrange(10**6)}" for _ in range(6)) for i in range(80)]
    rows = []
    for k in range(400):
        out = set(rng.sample(range(80), 7))
        rows.append((k, " ".join(p for i, p in enumerate(passages) if i not in out)))
    expected = linked_brute(rows, near_dedup.SIMILARITY, False)
    assert 100 < len(set(expected.values())) < 200
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    assert {r["doc_id"]: r["class_id"] for r in near_dedup.duplicate_classes(frame).collect()} == expected
    # The step of the pipeline keeps one of each.
    assert sorted(r["doc_id"] for r in corpus_pipeline.near_dedup(spark, frame, None).collect()) == sorted(set(expected.values()))


# ------------------------------------------------------------------ 4


def test_forward_sums_all_segmentations():
    pieces = language._pieces(language.VOCABULARY)
    rng = np.random.default_rng(1)
    costs = np.log(rng.uniform(0.01, 1, (pieces.count, 2)))

    def total(marked, at=0):
        if at == len(marked):
            return np.ones(2)
        found, whole = np.zeros(2), 0
        for end in range(at + 1, len(marked) + 1):
            k = pieces.number.get(marked[at:end])
            if k is None and end == at + 1:
                k = pieces.other
            if k is not None:
                found = found + np.exp(costs[k]) * total(marked, end)
        return found

    own = ["the", "straße", "漢a", "x", "nation"]
    assert np.allclose(np.exp(language.word_scores(own, pieces, costs)), [total("▁" + w) for w in own])
    # Every character of a word is in one piece of each segmentation.
    uses = language.expected_uses(own, np.ones((5, 2)), pieces, costs)
    sizes = np.array([len(p) for p in sorted(pieces.number)] + [1])
    assert np.allclose((uses * sizes[:, None]).sum(axis=0), sum(len(w) + 1 for w in own))


def test_languages_of_held_out_documents(spark, sf, odd, empty):
    rows = language.op4_language_id(spark, sf).collect()
    true = {r["doc_id"]: r["lang"] for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    held = [r for r in rows if r["held_out"]]
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 4 == 2) for r in rows)
    assert np.mean([r["lang_pred"] == true[r["doc_id"]] for r in held]) > 0.95
    found = language.identify(odd, language.fit_languages(odd)).collect()
    assert all((r["lang_pred"] == "und") == (not re.search(r"[^\W\d_]", r["text"] or "")) for r in found if "½" not in (r["text"] or ""))
    assert all(0 <= r["score"] <= 1 for r in found)
    none = language.fit_languages(empty)
    assert {r["lang_pred"] for r in language.identify(odd, none).collect()} == {"und"}
    assert language.identify(empty, none).collect() == []


def test_a_rare_language_is_learnt(spark):
    rng = random.Random(6)
    common, rare = ["the house is old".split(), "to jest mały dom nad rzeką".split()]
    text = lambda own: " ".join(rng.choice(own) for _ in range(6))
    rows = [(k, text(common), "en") for k in range(3000)] + [(3000 + k, text(rare), "pl") for k in range(40)]
    frame = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    found = {r["doc_id"]: r["lang_pred"] for r in language.identify(frame, language.fit_languages(frame, training_docs=30)).collect()}
    assert found == {k: lang for k, _, lang in rows}


def test_models_of_other_content_have_other_keys():
    model = lambda x: language.LanguageModel(["a"], np.full((2, 1), x), np.zeros(1), "v")
    assert language.model_key(model(1.0)) == language.model_key(model(1.0)) != language.model_key(model(2.0))


# ------------------------------------------------------------------ 5


def contamination_brute(text, items):
    own = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    hit, names = set(), set()
    for item, item_text in items:
        iw = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), item_text or ""))
        size = min(13, len(iw))
        runs = {tuple(iw[k : k + size]) for k in range(len(iw) - size + 1)} if size else set()
        for k in range(len(own) - size + 1 if size else 0):
            if tuple(own[k : k + size]) in runs:
                hit.update(range(k, k + size))
                names.add(None if item is None else str(item))
    return len(own), hit, sorted(names, key=lambda name: (name is None, name or ""))


@pytest.mark.parametrize("block_words", [10**6, 40])
def test_contamination(spark, empty, odd, block_words):
    rng = random.Random(block_words)
    text = lambda n: " ".join(rng.choice(["a", "B", "c-d", "É", "7"]) for _ in range(n))
    items = [(k, text(rng.choice([1, 2, 5, 13, 14, 20]))) for k in range(12)] + [(99, None), (98, ""), (1, "b b b a 7"), (None, "a")]
    docs = [(k, text(rng.randrange(80)) + " " + (items[k % 12][1] or "")) for k in range(40)] + [(50, None), (51, "")]
    frame = spark.createDataFrame(docs, "doc_id long, text string")
    bench = spark.createDataFrame(items, "item_id long, text string")
    for row in decontamination.contamination(frame, bench, block_words=block_words).collect():
        n, hit, names = contamination_brute(row["text"], items)
        assert row["n_words"] == n and row["hit_items"] == names
        assert {w for s in row["hit_spans"] for w in range(s["start"], s["end"])} == hit
    nothing = spark.createDataFrame([], "item_id long, text string")
    assert all(r["hit_items"] == [] for r in decontamination.contamination(odd, nothing).collect())
    assert decontamination.contamination(empty, bench).collect() == []


def test_spans_are_cut_out(spark):
    bench = spark.createDataFrame([(1, "one two three")], "item_id long, text string")
    long = " ".join(f"w{k}" for k in range(100))
    frame = spark.createDataFrame([(1, f"é {long}, One-two three! end"), (2, "one two three"), (3, None)], "doc_id long, text string")
    found = {r["doc_id"]: r["text"] for r in decontamination.without_spans(decontamination.contamination(frame, bench)).collect()}
    assert found == {1: f"é {long}, ! end", 3: None}


def test_items_without_id_count_as_the_sql_counts_them(spark, tmp_path):
    docs = [(1, "alpha beta gamma delta"), (2, "one two three"), (3, None), (None, "beta gamma beta gamma")]
    items = [(None, "beta gamma"), (None, "one two"), ("q", "gamma"), ("q", "gamma"), ("r", None)]
    spark.createDataFrame(docs, "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame(items, "item_id string, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    found = sorted(map(tuple, decontamination.op5_decontamination(spark, str(tmp_path)).collect()), key=str)
    connection = duckdb.connect()
    for name in ("documents", "benchmark"):
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{tmp_path}/{name}.parquet/*.parquet')")
    assert found == sorted(connection.execute(decontamination.OP5_SQL).fetchall(), key=str)
    assert {r[0]: r[3] for r in found} == {1: 2, 2: 1, 3: 0, None: 2}


def test_many_blocks_find_what_one_finds(spark, monkeypatch):
    rng = random.Random(8)
    words = [f"w{k}" for k in range(300)]
    items = [(f"i{k}", " ".join(rng.choices(words, k=rng.choice([3, 13, 20])))) for k in range(60)]
    items += [("long", " ".join(rng.choices(words, k=2000))), (None, items[0][1]), ("again", items[0][1])]
    rows = []
    for k in range(80):
        text = rng.choices(words, k=100)
        for _, item in rng.sample(items[:61], 2):
            own = item.split()
            start, at = rng.randrange(max(1, len(own) - 15)), rng.randrange(100)
            text[at:at] = own[start : start + 15]
        rows.append((k, " ".join(text), "x"))
    rows += [(None, None, "x"), (5, "", "x")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, _row string")
    bench = spark.createDataFrame(items, "item_id string, text string")
    one = decontamination.contamination(docs, bench).collect()
    written = []
    monkeypatch.setattr(decontamination, "written", lambda df, name, f=decontamination.written: (written.append(name), f(df, name))[1])
    many = decontamination.contamination(docs, bench, block_words=700).collect()
    assert sorted(map(str, one)) == sorted(map(str, many))
    for size in (10**6, 700):
        # Cutting goes along in the same Python pass.
        cut = decontamination.contamination(docs, bench, block_words=size, cut_longer_than=12)
        apart = decontamination.without_spans(decontamination.contamination(docs, bench), longer_than=12)
        assert cut._jdf.queryExecution().executedPlan().toString().count("MapInArrow") == 1
        assert sorted(map(str, cut.collect())) == sorted(map(str, apart.collect()))
        assert 0 < cut.count() < len(one)
    # Each call with several blocks writes the documents once, however many blocks there are.
    assert written.count("documents") == 2 and sum(name.startswith("hits-") for name in written) > 3
    assert sum(len(r["hit_items"]) for r in one) > 60


def test_kept_documents_lose_spans_of_whole_windows(spark):
    item = " ".join(f"b{k}" for k in range(13))
    clean = " ".join(f"c{k}" for k in range(400))
    rows = [(1, f"{clean} {item}. End", 9, "x"), (2, item, 9, "x"), (3, clean, 9, "x"), (4, f"{clean} short one", 9, "x"), (5, None, 9, "x")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, n_chars int, d_row string")
    bench = spark.createDataFrame([("a", item), ("b", "short one")], "item_id string, text string")
    found = decontamination.keep_clean(docs, bench)
    assert found.columns == docs.columns
    found = {r["doc_id"]: r for r in found.collect()}
    assert set(found) == {1, 3, 4, 5}
    assert found[1]["text"] == f"{clean} . End" and found[1]["n_chars"] == len(clean) + 6
    assert found[3]["text"] == clean and found[3]["n_chars"] == 9 and found[4]["text"].endswith("short one") and found[5]["text"] is None


# ------------------------------------------------------------------ 7 and 8


def test_snapshots(spark):
    turns = [("user", "a"), ("assistant", "b"), ("user", "c")]
    rows = [(k, t, *turns[t]) for k, n in ((1, 1), (2, 3), (3, 2), (4, 3), (6, 3)) for t in range(n)]
    rows += [(5, 0, "user", "other"), (7, None, None, None), (None, 0, "user", "x")]
    rows += [(8, t, "user", str(t)) for t in range(600)] + [(9, t, "user", str(t)) for t in range(300)]
    frame = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    found = {(r["conv_id"], r["segment"]): r for r in chat.collapse_and_render(frame).collect()}
    assert sorted(found, key=str) == sorted([(2, 0), (5, 0), (7, 0), (None, 0), (8, 0), (8, 1), (8, 2)], key=str)
    assert found[2, 0]["n_copies"] == 3
    assert found[2, 0]["text"] == "".join(f"<|im_start|>{r}\n{t}<|im_end|>\n" for r, t in turns)
    assert [found[8, s]["n_turns"] for s in range(3)] == [256, 256, 88]
    assert chat.collapse_and_render(frame.limit(0)).collect() == []


def measures_brute(text):
    text = text or ""
    own = re.findall("[^\x20\x09-\x0d]+", text)
    runs = [tuple(own[k : k + 3]) for k in range(len(own) - 2)]
    many = collections.Counter(runs)
    lines = [line for line in text.split("\n") if re.search("[^\x20\x09-\x0d]", line)]
    covered = {k + i for k, run in enumerate(runs) if many[run] > 1 for i in range(3)}
    return len(own), sum(map(len, own)), len(re.findall("[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(covered)


def test_quality(spark, odd, empty):
    rng = random.Random(8)
    texts = [r["text"] for r in odd.collect()] + ["".join(rng.choice("ab \n#\t") for _ in range(rng.randrange(300))) for _ in range(60)]
    frame = spark.createDataFrame([(k, t, 5) for k, t in enumerate(texts)], "doc_id long, text string, n_words int")
    found = {r["doc_id"]: r for r in quality.ledger(frame).collect()}
    for k, text in enumerate(texts):
        r = found[k]
        assert (r["n_words"], r["word_chars"], r["n_symbols"], r["n_dup_lines"], r["n_repeat_words"]) == measures_brute(text), repr(text)
    assert quality.ledger(empty).collect() == []
    assert quality.keep_good(odd).columns == odd.columns
    costs = {r["rule"]: r for r in quality.ablations(quality.ledger(frame), quality.STANDARD).collect()}
    assert costs["few_words"]["failed"] == sum(r["n_words"] < 50 for r in found.values())
    assert costs["few_words"]["only_by_it"] == sum(r["fail_bits"] == 1 for r in found.values())


# ------------------------------------------------------------------ 9


def test_shared_lines_are_a_longest_common_subsequence(monkeypatch):
    def length(a, b):
        rows = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
        for i, j in itertools.product(range(len(a)), range(len(b))):
            rows[i + 1][j + 1] = rows[i][j] + 1 if a[i] == b[j] else max(rows[i][j + 1], rows[i + 1][j])
        return rows[-1][-1]

    rng = random.Random(3)
    for bits in (1 << 28, 8):
        monkeypatch.setattr(pages, "KEPT_BITS", bits)
        for _ in range(200):
            a, b = ([rng.randrange(5) for _ in range(rng.randrange(12))] for _ in range(2))
            chosen = [x for x, both in zip(a, pages.common_lines(a, b)) if both]
            rest = iter(b)
            assert len(chosen) == length(a, b) and all(any(x == y for y in rest) for x in chosen)


def test_page_text(spark):
    site = "<nav><a>Home</a></nav><p>Shared line</p>{}<div class='cookie-notice'>We use cookies</div><footer>&copy; x</footer>"
    plain = lambda text: site.format(f"<div>{text}</div>")
    article = "<article><header><h1>T &amp; U</h1></header><p>Shared line<p>one <b>two</b>\n three<br>four<div class='comments'>no</div><script>if (a<b) '</p>'</script><!-- no --></article>"
    rows = [(1, "http://h/a", plain("first")), (2, "http://h/b", plain("second")), (3, "http://h/c", site.format(article)),
            (4, "http://alone/", plain("only")), (5, None, None), (6, "http://h/d", ""), (7, "http://h/e", "<article><p>a &lt;b&gt; &eacute;</article>"), (7, "http://h/e", "<article><p>a &lt;b&gt; &eacute;</article>")]
    found = pages.extract_pages(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()
    assert len(found) == len(rows)
    texts = {r["page_id"]: r["text"] for r in found}
    assert texts == {1: "first", 2: "second", 3: "T & U\n\nShared line\n\none two three four", 4: "Shared line\n\nonly", 5: "", 6: "", 7: "a <b> é"}


def test_copies_of_a_page_keep_its_text(spark):
    page = lambda *lines: "<nav>Home</nav><p>Site line</p>" + "".join(f"<p>{x}</p>" for x in lines) + "<footer>x</footer>"
    copy, near = page("one", "two", "three"), page("one", "two", "changed")
    rows = [(1, "http://h/a", page("first")), (2, "http://h/b", copy), (2, "http://h/b", copy), (3, "http://h/b?utm=1", copy),
            (4, "http://h/b", copy), (5, "http://h/c", copy), (6, "http://h/b?utm=2", near), (7, "http://h/z", page("last")), (8, "http://h/z2", ""),
            (9, "http://g/b", copy), (10, "http://g/b?utm=1", near), (11, "http://g/b", copy)]
    found = pages.extract_pages(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()
    assert len(found) == len(rows)
    own, other = "one\n\ntwo\n\nthree", "one\n\ntwo\n\nchanged"
    alone = {9: "Site line\n\n" + own, 10: "Site line\n\n" + other, 11: "Site line\n\n" + own}
    assert {r["page_id"]: r["text"] for r in found} == {1: "first", 2: own, 3: own, 4: own, 5: own, 6: other, 7: "last", 8: ""} | alone


def test_every_page_meets_its_neighbour_on_a_host_of_any_size(spark):
    """Sections of four pages with a line of their own; one page of each has many versions."""
    rows, true = [], {}
    for k in range(3000):
        path = f"http://h/{k // 4:04}/{k % 4}"
        for version in range(150 if k in (0, 1001) else 1):
            number = len(rows)
            rows.append((number, f"{path}?v={version}", f"<p>Site</p><p>Section {k // 4}</p><p>own {k}</p><p>version {version}</p>" if k in (0, 1001) else f"<p>Site</p><p>Section {k // 4}</p><p>own {k}</p>"))
            # The first page of a section follows another section, but for the host's first.
            true[number] = [*([f"Section {k // 4}"] if k % 4 == 0 and k else []), f"own {k}", *([f"version {version}"] if k in (0, 1001) else [])]
    rows += [(len(rows) + k, f"http://small{k}/", "<p>Site</p>") for k in range(20)]
    frame = spark.createDataFrame(rows, "page_id long, url string, html string").repartition(8)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    spark.conf.set("spark.sql.shuffle.partitions", "61")
    try:
        found = {r["page_id"]: r["text"] for r in pages.extract_pages(frame).collect()}
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
        spark.conf.set("spark.sql.shuffle.partitions", "8")
    assert found == {k: "\n\n".join(x) for k, x in true.items()} | {len(true) + k: "Site" for k in range(20)}


def test_differencing_decides_outside_the_only_article(spark):
    page = lambda body: f"<nav>Home</nav><p>Site line</p>{body}<p>Imprint</p>"
    teaser = "<article><p>teaser</p></article>"
    rows = [(1, "http://h/a", page("<div>plain</div>")), (2, "http://h/b", page(f"<div>long body</div>{teaser}<div class='ad'>ad</div>")),
            (3, "http://h/c", page(f"<article><p>real</p></article>{teaser}")), (4, "http://h/d", page(f"<main><h1>Top</h1><article>mine</article>{teaser}</main>")),
            (5, "http://h/e", page("<article><p>Site line</p><article>reply</article></article>")), (6, "http://h/f", page("<main><p>x</p><article>reply</article></main>"))]
    found = pages.extract_pages(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()
    assert {r["page_id"]: r["text"].split("\n\n") for r in found} == {
        1: ["plain"], 2: ["long body", "teaser"], 3: ["real"], 4: ["Top", "mine"], 5: ["Site line", "reply"], 6: ["x", "reply"]}


def test_text_of_given_pages(spark, sf):
    true = {}
    for row in spark.read.parquet(f"{sf}/pages.parquet").collect():
        inner = re.search(r"<article>(.*?)</article>", row["html"], re.S)[1]
        parts = [" ".join(html.unescape(re.sub(r"<[^>]*>", " ", re.sub(r"</?b>", "", x))).split()) for x in re.split(r"</?(?:p|h1)>", inner)]
        true[row["page_id"]] = "\n\n".join(x for x in parts if x)
    found = pages.op9_page_text(spark, sf).collect()
    assert {r["page_id"]: r["text"] for r in found} == true
    assert all(r["n_chars"] == len(r["text"]) for r in found)


# ------------------------------------------------------------------ 10


def test_archives(spark):
    rows = [(1, "u", "a"), (2, "u\r\nX: y", "a"), (2, "u", "a"), (3, None, None), (4, None, ""), (None, "x", "a"), (1, "u", "a"), (1, "v", "é" * 5000)]
    frame = spark.createDataFrame(rows, "page_id long, url string, html string")
    paths = [scratch_path(spark, "warc") for _ in range(2)]
    for path, roll in zip(paths, (1, 10**6)):
        warc.write_warc(frame, path, roll_bytes=roll)
        found = warc.read_warc(spark, path).collect()
        assert collections.Counter((r["page_id"], r["record_type"], r["refers_to"], r["payload_bytes"]) for r in found) == collections.Counter(
            [(None, "revisit", 1, 1), (1, "response", None, 1), (1, "revisit", 1, 1), (2, "revisit", 1, 1), (2, "revisit", 1, 1),
             (1, "response", None, 10000), (3, "response", None, 0), (4, "revisit", 3, 0)]
        )
        assert all(r["payload_digest"] == base64.b32encode(hashlib.sha1(r["html"].encode()).digest()).decode() for r in found if r["html"] is not None)
    warc.write_warc(frame.limit(0), paths[0] + "-none")
    assert warc.read_warc(spark, paths[0] + "-none").collect() == []
    small = scratch_path(spark, "warc")
    warc.write_warc(frame, small, min_bytes=2)
    assert {r["record_type"] for r in warc.read_warc(spark, small).collect()} == {"response"}
    nulls, anonymous = scratch_path(spark, "warc"), [(None, "u", "same"), (None, "v", "same"), (None, None, None)]
    extra = spark.createDataFrame([(*r, 1, "x") for r in anonymous], "page_id long, url string, html string, digest int, refers_to string")
    warc.write_warc(extra, nulls)
    assert [(r["page_id"], r["record_type"], r["refers_to"]) for r in warc.read_warc(spark, nulls).collect()] == [(None, "response", None)] * 3


def test_op10(spark, sf):
    rows = spark.read.parquet(f"{sf}/pages.parquet").select("page_id", "html").collect()
    least, expected = {}, {}
    for page_id, html in sorted(tuple(r) for r in rows):
        payload = (html or "").encode()
        first = least.setdefault(payload, page_id)
        digest = base64.b32encode(hashlib.sha1(payload).digest()).decode()
        expected[page_id] = (len(payload), digest, "response" if first == page_id else "revisit", None if first == page_id else first)
    found = warc.op10_warc(spark, sf).collect()
    assert len(found) == len(rows)
    assert {r["page_id"]: tuple(r)[1:] for r in found} == expected


# ------------------------------------------------------------------ pipeline


def test_pipeline_keeps_clean_documents(spark, sf, odd, empty):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    before = {r["doc_id"]: r for r in docs.collect()}
    names = set(before)
    for name, stage in corpus_pipeline.STAGES[:-1]:
        kept = stage(spark, docs, sf)
        assert kept.columns == docs.columns
        path = scratch_path(spark, name)
        kept.write.parquet(path)
        docs = spark.read.parquet(path)
        left = {r["doc_id"] for r in docs.collect()}
        assert left <= names and len(left) > len(names) // 2
        assert all(r == before[r["doc_id"]] for r in docs.collect())
        names = left
        assert stage(spark, empty, sf).collect() == []
        assert stage(spark, odd, sf).columns == odd.columns
    found = corpus_pipeline.STAGES[-1][1](spark, docs, sf).collect()
    assert {r["doc_id"] for r in found} == names

import json
import weakref

import brute
import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

import widevec as wv
from widevec.functions.tokens import decode_udf, encode_fixed_udf, encode_udf, slices
from widevec.tokenizer import gather_ragged, list_parts, pad_fixed, to_list_array

BYTES = wv.ByteTokenizer()
EDGES = [
    "", " ", "a", "abc", "abcd", "éé", "é" * 100, "x" * 126, "x" * 127, "x" * 128, "🏠", "a\x00b", "x" * 5000, None,
]


@pytest.fixture(scope="module")
def edges(spark):
    return spark.createDataFrame(list(enumerate(EDGES)), "i int, t string")


def by_index(df, *columns):
    return [tuple(r[c] for c in columns) for r in df.orderBy("i").collect()]


def test_known_text(spark):
    rows = spark.createDataFrame([(0, "Property: 123 Main St! 🏠")], "i int, t string")
    found = wv.tokenize(rows, "t", BYTES, 32).first()
    assert found.ids[0] == 83
    assert found.ids[27] == 1
    assert found.ids[31] == 0 and found.attention_mask[31] == 0
    assert sum(found.attention_mask) == 28


@pytest.mark.parametrize(
    "text, ids, real",
    [
        ("", [1, 0, 0, 0], 1),
        (None, [1, 0, 0, 0], 1),
        ("a", [100, 1, 0, 0], 2),
        ("abc", [100, 101, 102, 1], 4),
        ("abcd", [100, 101, 102, 1], 4),
        ("éé", [198, 172, 198, 1], 4),
    ],
)
def test_fixed_cases(spark, text, ids, real):
    rows = spark.createDataFrame([(0, text)], "i int, t string")
    found = wv.tokenize(rows, "t", BYTES, 4).first()
    assert list(found.ids) == ids and sum(found.attention_mask) == real
    assert list(found.token_type_ids) == [0] * 4


@pytest.mark.parametrize("max_len", [1, 2, 3, 32, 127, 128, 129])
def test_fixed_both_forms(edges, max_len):
    found = wv.tokenize(edges, "t", BYTES, max_len)
    found = found.withColumn("plain", wv.byte_ids_expr(F.col("t"), max_len))
    for text, (ids, plain, mask, kinds) in zip(
        EDGES, by_index(found, "ids", "plain", "attention_mask", "token_type_ids")
    ):
        assert list(ids) == list(plain) == brute.byte_ids(text, max_len)
        assert list(mask) == brute.byte_mask(text, max_len)
        assert list(kinds) == [0] * max_len


def test_very_long_lists_come_in_pieces(spark):
    """300 lists of 65,536 are more than is made at a time."""
    text = F.repeat(F.lit("x"), F.col("id").cast("int"))
    rows = spark.range(0, 300, 1, 1).select(F.col("id").alias("i"), text.alias("t"))
    found = wv.tokenize(rows, "t", BYTES, 2**16)
    sums = [F.aggregate(c, F.lit(0), lambda total, x: total + x) for c in ("ids", "attention_mask")]
    for i, size, ids, real in found.select("i", F.size("ids"), *sums).collect():
        assert (size, ids, real) == (2**16, 123 * i + 1, i + 1)


def test_variable_both_forms(edges):
    found = wv.encode(edges, "t", BYTES).withColumn("plain", wv.byte_ids_expr(F.col("t")))
    for text, (ids, plain) in zip(EDGES, by_index(found, "ids", "plain")):
        assert list(ids) == list(plain) == brute.byte_ids(text)


def test_max_len_must_be_positive(edges):
    with pytest.raises(ValueError):
        wv.tokenize(edges, "t", BYTES, 0)


def test_other_columns_stay(edges):
    found = wv.tokenize(edges.withColumn("a.b", F.lit(1)), "t", BYTES, 4)
    assert found.columns == ["i", "t", "a.b", "ids", "attention_mask", "token_type_ids"]
    again = wv.tokenize(found, "t", BYTES, 2)
    assert again.columns == found.columns and len(again.first().ids) == 2


def test_large_arrow_types(spark, edges):
    spark.conf.set("spark.sql.execution.arrow.useLargeVarTypes", "true")
    try:
        found = by_index(wv.tokenize(edges, "t", BYTES, 32), "ids")
        back = by_index(wv.detokenize(wv.encode(edges, "t", BYTES), "ids", BYTES), "text")
    finally:
        spark.conf.set("spark.sql.execution.arrow.useLargeVarTypes", "false")
    assert [list(ids) for (ids,) in found] == [brute.byte_ids(text, 32) for text in EDGES]
    assert [text for (text,) in back] == [text or "" for text in EDGES]


@settings(max_examples=200, deadline=None)
@given(st.lists(st.text(max_size=40), max_size=8), st.integers(1, 40), st.integers(0, 3))
def test_encoder_property(texts, max_len, offset):
    array = pa.array([t.encode("utf-8", "surrogatepass") for t in ["skip"] * offset + texts], pa.binary())
    array = array.slice(offset)
    ids, lengths = BYTES.encode(array)
    assert to_list_array(ids, lengths).to_pylist() == [brute.byte_ids(t) for t in texts]
    cut = pa.array([b[: max_len - 1] for b in array.to_pylist()], pa.binary())
    fixed, mask = pad_fixed(*BYTES.encode(cut), max_len)
    assert fixed.tolist() == [brute.byte_ids(t, max_len) for t in texts]
    assert (mask.sum(axis=1) == [min(len(b), max_len - 1) + 1 for b in array.to_pylist()]).all()


@settings(max_examples=200, deadline=None)
@given(st.lists(st.lists(st.integers(0, 9), max_size=6), max_size=8), st.integers(1, 7))
def test_pad_fixed_property(rows, max_len):
    flat = np.array([x for row in rows for x in row], np.int32)
    ids, mask = pad_fixed(flat, np.array([len(row) for row in rows], np.int64), max_len)
    expected = [brute.cut_and_pad(row, max_len) for row in rows]
    assert ids.tolist() == [e[0] for e in expected]
    assert mask.tolist() == [e[1] for e in expected]


@settings(max_examples=100, deadline=None)
@given(st.lists(st.text(max_size=12), max_size=20), st.integers(1, 5), st.integers(1, 20))
def test_slices_cover_everything(texts, rows, size):
    array = pa.array(texts, pa.string())
    pieces = list(slices(array, rows, size))
    assert [t for piece in pieces for t in piece.to_pylist()] == texts
    for piece in pieces:
        used = sum(len(t.encode()) for t in piece.to_pylist())
        assert 0 < len(piece) <= rows and (used <= size or len(piece) == 1)


def test_list_parts_of_nulls_and_slices():
    array = pa.array([[9], [1, 2], None, [], [3]], pa.list_(pa.int32())).slice(1)
    starts, lengths, values = list_parts(array)
    assert lengths.tolist() == [2, 0, 0, 1]
    assert gather_ragged(starts, lengths, values).tolist() == [1, 2, 3]


# ---------------------------------------------------------------- decoding


def test_bytes_round_trip(edges):
    found = by_index(wv.detokenize(wv.encode(edges, "t", BYTES), "ids", BYTES), "text")
    assert [text for (text,) in found] == [text or "" for text in EDGES]


def test_decode_drops_marks_and_replaces_broken_characters(spark):
    rows = [(0, [100, 1, 0, 0]), (1, [0, 1, 2]), (2, []), (3, [198, 172, 198, 1]), (4, [2, 103, 1, 104])]
    found = wv.detokenize(spark.createDataFrame(rows, "i int, ids array<int>"), "ids", BYTES)
    assert [t for (t,) in by_index(found, "text")] == ["a", "", "", "é\ufffd", "de"]


def test_decode_replaces_like_python(spark):
    generator = np.random.default_rng(7)
    contents = [bytes(generator.integers(0, 256, generator.integers(0, 12)).tolist()) for _ in range(400)]
    rows = [(i, [b + 3 for b in content]) for i, content in enumerate(contents)]
    found = wv.detokenize(spark.createDataFrame(rows, "i int, ids array<int>"), "ids", BYTES)
    assert [t for (t,) in by_index(found, "text")] == [c.decode("utf-8", "replace") for c in contents]


def test_decode_rejects_unknown_ids(spark):
    rows = spark.createDataFrame([([300],)], "ids array<int>")
    with pytest.raises(Exception, match="not byte tokens"):
        wv.detokenize(rows, "ids", BYTES).collect()


# ---------------------------------------------------------------- subwords


@pytest.fixture(scope="module", params=["word pieces", "byte pairs"])
def library(request, spark, sf):
    """Small tokenizers with separators, trained on the documents."""
    from tokenizers import Tokenizer, decoders, models, normalizers, pre_tokenizers, processors, trainers

    texts = [r.text for r in spark.read.parquet(f"{sf}/documents.parquet").select("text").collect()]
    marks = ["[PAD]", "[UNK]", "[CLS]", "[SEP]"]
    if request.param == "word pieces":
        found = Tokenizer(models.WordPiece(unk_token="[UNK]"))
        found.normalizer = normalizers.BertNormalizer()
        found.pre_tokenizer = pre_tokenizers.BertPreTokenizer()
        trainer = trainers.WordPieceTrainer(vocab_size=400, special_tokens=marks)
    else:
        found = Tokenizer(models.BPE(unk_token="[UNK]"))
        found.pre_tokenizer = pre_tokenizers.ByteLevel(add_prefix_space=False)
        found.decoder = decoders.ByteLevel()
        alphabet = pre_tokenizers.ByteLevel.alphabet()
        trainer = trainers.BpeTrainer(vocab_size=500, special_tokens=marks, initial_alphabet=alphabet)
    found.train_from_iterator(texts, trainer)
    found.post_processor = processors.TemplateProcessing(
        single="[CLS] $A [SEP]", special_tokens=[("[CLS]", 2), ("[SEP]", 3)]
    )
    return found


def handle(spark, library, **options):
    return wv.SubwordTokenizer(wv.ship_bytes(spark, library.to_str().encode()), **options)


@pytest.mark.parametrize("special", [False, True])
def test_subword_equals_the_library(spark, sf, library, special):
    rows = spark.read.parquet(f"{sf}/documents.parquet").select(F.col("doc_id").alias("i"), "text")
    tokenizer = handle(spark, library, add_special_tokens=special)
    whole = by_index(wv.encode(rows, "text", tokenizer), "text", "ids")
    fixed = by_index(wv.tokenize(rows, "text", tokenizer, 20), "ids", "attention_mask")
    for (text, ids), (cut, mask) in zip(whole, fixed):
        expected = library.encode(text, add_special_tokens=special).ids
        assert list(ids) == expected
        # A plain cut: the closing separator of a long text is lost.
        assert (list(cut), list(mask)) == brute.cut_and_pad(expected, 20)


def test_subword_empty_text(spark, library):
    rows = spark.createDataFrame([(0, ""), (1, None)], "i int, t string")
    for ids, mask in by_index(wv.tokenize(rows, "t", handle(spark, library), 3), "ids", "attention_mask"):
        assert list(ids) == [0, 0, 0] and list(mask) == [0, 0, 0]
    marked = handle(spark, library, add_special_tokens=True)
    for ids, mask in by_index(wv.tokenize(rows, "t", marked, 3), "ids", "attention_mask"):
        assert list(ids) == [2, 3, 0] and list(mask) == [1, 1, 0]


def test_definition_is_used_as_it_stands(spark, library):
    """Its own truncation and padding count, and never depend on the rest of a batch."""
    definition = json.loads(library.to_str())
    definition["truncation"] = {"direction": "Right", "max_length": 3, "strategy": "LongestFirst", "stride": 0}
    for strategy, multiple in (("BatchLongest", None), ("BatchLongest", 4), ({"Fixed": 6}, None)):
        definition["padding"] = {
            "strategy": strategy, "direction": "Right", "pad_to_multiple_of": multiple,
            "pad_id": 0, "pad_type_id": 0, "pad_token": "[PAD]",
        }
        content = json.dumps(definition)
        alone = type(library).from_str(content)
        tokenizer = wv.SubwordTokenizer(wv.ship_bytes(spark, content.encode()))
        texts = ["", "the", "the of and to in a", "of the"]
        rows = spark.createDataFrame(list(enumerate(texts)), "i int, t string").coalesce(1)
        found = by_index(wv.encode(rows, "t", tokenizer), "ids")
        assert [list(ids) for (ids,) in found] == [alone.encode(t, add_special_tokens=False).ids for t in texts]


@pytest.mark.parametrize("skip", [False, True])
def test_subword_decode(spark, sf, library, skip):
    rows = spark.read.parquet(f"{sf}/conversations.parquet").select(
        (F.col("conv_id") * 1000 + F.col("turn")).alias("i"), F.col("text").alias("original")
    )
    tokenizer = handle(spark, library, add_special_tokens=True, skip_special_tokens=skip)
    found = wv.detokenize(wv.encode(rows, "original", tokenizer), "ids", tokenizer)
    for original, text in by_index(found, "original", "text"):
        assert text == library.decode(library.encode(original).ids, skip_special_tokens=skip)


def test_tokenizer_choice(spark, config, tmp_path, library):
    path = tmp_path / "tokenizer.json"
    path.write_text(library.to_str())
    assert isinstance(wv.make_tokenizer(spark, config(tokenizer_type="byt5")), wv.ByteTokenizer)
    for kind in ("huggingface", "BYT5", ""):
        found = wv.make_tokenizer(spark, config(tokenizer_type=kind, vocab_path=str(path)))
        assert isinstance(found, wv.SubwordTokenizer)


def test_bad_definitions_raise(spark, config, tmp_path):
    path = tmp_path / "broken.json"
    path.write_text("{}")
    with pytest.raises(ValueError, match="no tokenizer definition"):
        wv.make_tokenizer(spark, config(tokenizer_type="x", vocab_path=str(path)))
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        wv.make_tokenizer(spark, config(tokenizer_type="x", vocab_path=str(tmp_path / "absent.json")))
    with pytest.raises(ValueError, match="vocab_path"):
        wv.make_tokenizer(spark, config(tokenizer_type="x"))


def test_null_ids_are_refused():
    with pytest.raises(ValueError, match="null among"):
        wv.ByteTokenizer().decode(pa.array([[100, None, 101]], pa.list_(pa.int32())))
    assert wv.ByteTokenizer().decode(pa.array([None, [100]], pa.list_(pa.int32()))).to_pylist() == [b"", b"a"]


class Watched:
    """A tokenizer that notes how many values it is given at a time."""

    def __init__(self):
        self.given = []

    def open(self):
        return self

    def encode(self, texts):
        self.given.append(int(list_parts(texts)[1].sum()))
        return BYTES.encode(texts)

    def decode(self, ids):
        self.given.append(int(list_parts(ids)[1].sum()))
        return BYTES.decode(ids)


def batches_once(make):
    """An empty batch, then batches of which none is held when the next one is asked for."""
    yield make(0)
    for _ in range(3):
        batch = make(3000)
        held = weakref.ref(batch)
        yield batch
        del batch
        assert held() is None


@pytest.mark.parametrize("udf", [lambda t: encode_udf(t), lambda t: encode_fixed_udf(t, 64)])
def test_encoding_takes_small_pieces_and_holds_no_batch(udf):
    tokenizer = Watched()
    found = [len(part) for part in udf(tokenizer).func(batches_once(lambda n: pa.array([b"a" * 999] * n, pa.binary())))]
    assert sum(found) == 9000
    assert sum(tokenizer.given) == 9000 * 999 and max(tokenizer.given) <= 1 << 20


def test_decoding_takes_small_pieces_and_holds_no_batch(spark):
    tokenizer = Watched()
    one = pa.scalar([100] * 999, pa.list_(pa.int32()))
    found = [part for part in decode_udf(tokenizer, "binary").func(batches_once(lambda n: pa.array([one.as_py()] * n, one.type)))]
    assert sum(map(len, found)) == 9000
    assert sum(tokenizer.given) == 9000 * 999 and max(tokenizer.given) <= 1 << 20

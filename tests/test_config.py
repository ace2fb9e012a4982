import json

import pytest

import widevec as wv

FULL = {
    "tokenizer_type": "byt5",
    "max_tokens": 128,
    "batch_size": 256,
    "embedding_dim": 1472,
    "model_path": "model.onnx",
    "vocab_path": "vocab.txt",
    "input_columns": ["x", "y"],
    "enable_s3_output": True,
    "s3_output_path": "s3a://bucket/out",
}


def write(tmp_path, values):
    path = tmp_path / "config.json"
    path.write_text(json.dumps(values))
    return str(path)


def test_reads_every_key(tmp_path):
    cfg = wv.EmbedConfig.from_json(write(tmp_path, FULL | {"engine_path": "unused", "more": 1}))
    assert (cfg.embedding_dim, cfg.max_tokens, cfg.batch_size) == (1472, 128, 256)
    assert cfg.input_columns == ("x", "y")
    assert cfg.tokenizer_type == "byt5"
    assert (cfg.enable_s3_output, cfg.s3_output_path) == (True, "s3a://bucket/out")


def test_defaults(tmp_path):
    needed = ("embedding_dim", "max_tokens", "batch_size", "model_path", "vocab_path")
    cfg = wv.EmbedConfig.from_json(write(tmp_path, {key: FULL[key] for key in needed}))
    assert cfg.tokenizer_type == "huggingface"
    assert cfg.input_columns == ()
    assert (cfg.enable_s3_output, cfg.s3_output_path) == (False, "")


def test_exported_model_name_is_taken(tmp_path):
    values = {key: value for key, value in FULL.items() if key != "model_path"}
    cfg = wv.EmbedConfig.from_json(write(tmp_path, values | {"onnx_path": "exported.onnx"}))
    assert cfg.model_path == "exported.onnx"


@pytest.mark.parametrize("key", ["embedding_dim", "max_tokens", "batch_size", "model_path", "vocab_path"])
def test_missing_key(tmp_path, key):
    with pytest.raises(ValueError):
        wv.EmbedConfig.from_json(write(tmp_path, {k: v for k, v in FULL.items() if k != key}))


@pytest.mark.parametrize("key", ["embedding_dim", "max_tokens", "batch_size"])
@pytest.mark.parametrize("value", [0, -1])
def test_dimensions_must_be_positive(tmp_path, key, value):
    with pytest.raises(ValueError, match=key):
        wv.EmbedConfig.from_json(write(tmp_path, FULL | {key: value}))


@pytest.mark.parametrize("changes", [{"max_tokens": 1.5}, {"max_tokens": True}, {"enable_s3_output": "no"}])
def test_wrong_types(changes):
    with pytest.raises(TypeError):
        wv.EmbedConfig(**({"embedding_dim": 8, "max_tokens": 4, "batch_size": 2} | changes))


def test_missing_file(tmp_path):
    with pytest.raises(OSError):
        wv.EmbedConfig.from_json(str(tmp_path / "absent.json"))


def test_repeated_names():
    with pytest.raises(ValueError, match="repeat"):
        wv.EmbedConfig(8, 4, 2, input_columns=("a", "a"))
    with pytest.raises(ValueError, match="repeat"):
        wv.EmbedConfig(8, 4, 2, input_columns=("gid",), id_column="key")


def test_batches_fit_arrow():
    with pytest.raises(ValueError, match="Arrow"):
        wv.EmbedConfig(4096, 128, 2**20)


def test_enabled_output_needs_a_path():
    with pytest.raises(ValueError, match="s3_output_path"):
        wv.EmbedConfig(8, 4, 2, enable_s3_output=True).check_output()
    wv.EmbedConfig(8, 4, 2, enable_s3_output=False).check_output()


@pytest.mark.parametrize("partitions", [0, -1, "8", True])
def test_partitions_are_checked(config, partitions):
    with pytest.raises((ValueError, TypeError), match="partitions"):
        config(partitions=partitions)

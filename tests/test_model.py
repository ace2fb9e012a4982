import numpy as np
import pyarrow as pa
import pytest

import widevec as wv
from widevec import artifacts, model
from widevec.functions.pooling import pool_tensor
from widevec.testing import INT32, INT64, check_model, token_vectors

IDS = np.array([[83, 70, 1, 0], [1, 0, 0, 0], [5, 6, 7, 1], [0, 0, 0, 0]], np.int32)
MASK = np.array([[1, 1, 1, 0], [1, 0, 0, 0], [1, 1, 1, 1], [0, 0, 0, 0]], np.int32)


def session(content, pooling="mean"):
    return model._OnnxSession(content, pooling)


@pytest.mark.parametrize("ids_type", [INT32, INT64])
@pytest.mark.parametrize("segment_ids", [False, True])
@pytest.mark.parametrize("pooled", [False, True])
def test_inputs_are_discovered(ids_type, segment_ids, pooled):
    found = session(check_model(pooled=pooled, segment_ids=segment_ids, ids_type=ids_type))
    expected = pool_tensor(token_vectors(259, 8)[IDS], MASK, "mean")
    assert found(IDS, MASK).tolist() == expected.tolist()
    assert set(found.inputs) == {"input_ids", "attention_mask"} | ({"token_type_ids"} if segment_ids else set())


@pytest.mark.parametrize("mode", ["mean", "cls", "max"])
def test_hidden_output_is_pooled_in_pieces(mode, monkeypatch):
    whole = session(check_model(pooled=False), mode)(IDS, MASK)
    assert whole.tolist() == pool_tensor(token_vectors(259, 8)[IDS], MASK, mode).tolist()
    calls = []
    monkeypatch.setattr(model, "HIDDEN_BYTES", 2 * 4 * 8 * 4)
    pieces = session(check_model(pooled=False), mode)
    run = pieces._run
    monkeypatch.setattr(pieces, "_run", lambda ids, mask: calls.append(len(ids)) or run(ids, mask))
    assert pieces(IDS, MASK).tolist() == whole.tolist() and calls == [2, 2]
    # A width the file does not tell is learned from one text.
    pieces.width = None
    assert pieces(IDS, MASK).tolist() == whole.tolist() and calls == [2, 2, 1, 2, 2]


def test_unfit_models_raise():
    good = check_model()
    with pytest.raises(ValueError, match="model inputs"):
        session(good.replace(b"attention_mask", b"attention_musk"))
    with pytest.raises(ValueError, match="neither"):
        session(good.replace(b"embeddings", b"embeddingz"))
    with pytest.raises(Exception):
        session(b"not a model")


class Context:
    def __init__(self, addresses=None, cores=3):
        self.addresses, self.cores = addresses, cores

    def cpus(self):
        return self.cores

    def resources(self):
        return {} if self.addresses is None else {"gpu": self}


def test_device_follows_the_task(monkeypatch):
    both = ["CUDAExecutionProvider", "CPUExecutionProvider"]
    assert model.device_providers(both) == ["CPUExecutionProvider"] and model.task_cores() == 1
    monkeypatch.setattr(model.TaskContext, "get", lambda: Context(["1"]))
    assert model.device_providers(both) == [("CUDAExecutionProvider", {"device_id": 1})]
    assert model.task_cores() == 3
    with pytest.raises(RuntimeError, match="GPU"):
        model.device_providers(["CPUExecutionProvider"])
    monkeypatch.setattr(model.TaskContext, "get", lambda: Context())
    assert model.device_providers(both) == ["CPUExecutionProvider"]


def test_broadcast_is_size_checked(spark, monkeypatch):
    monkeypatch.setattr(artifacts, "BROADCAST_LIMIT", 10)
    with pytest.raises(ValueError, match="give a path"):
        wv.ship_bytes(spark, b"x" * 11)


@pytest.mark.parametrize("size", [0, 40 * 1024 * 1024])
def test_files_of_one_name_and_a_replaced_one(spark, tmp_path, size):
    """Whatever their size: each is an artifact of its own, and later jobs still run."""
    paths = [tmp_path / folder / "model.onnx" for folder in ("m1", "m2")]
    shipped = []
    for k, path in enumerate([*paths, paths[0]]):
        path.parent.mkdir(exist_ok=True)
        path.write_bytes(bytes([k + 1]) * (size + 5))
        shipped.append(wv.ship_file(spark, str(path)))
    assert len({a.digest for a in shipped}) == 3
    assert wv.ship_file(spark, str(paths[0])) == shipped[2]

    def read(batches):
        for batch in batches:
            found = [a.read() for a in shipped]
            yield pa.RecordBatch.from_pydict({"n": [len(f) for f in found], "first": [f[0] for f in found]})

    rows = spark.range(0, 1, 1, 1).mapInArrow(read, "n long, first long").collect()
    assert [tuple(r) for r in rows] == [(size + 5, 1), (size + 5, 2), (size + 5, 3)]
    assert spark.range(10).count() == 10


def test_one_file_is_expected(spark, tmp_path):
    for name in ("a.onnx", "b.onnx"):
        (tmp_path / name).write_bytes(b"x")
    with pytest.raises(ValueError, match="one file"):
        wv.ship_file(spark, f"{tmp_path}/*.onnx")


def test_a_reused_worker_opens_a_model_per_device(spark, monkeypatch):
    from widevec import model as models

    monkeypatch.setattr(models, "_opened", {})
    handle = wv.model_from_bytes(spark, check_model())
    monkeypatch.setattr(models, "device_providers", lambda available: ["CPUExecutionProvider"])
    found = []
    for device in (0, 1, 0):
        monkeypatch.setattr(models, "task_device", lambda device=device: device)
        found.append(handle.open())
    assert found[0] is found[2] and found[0] is not found[1]
    for device in range(9):
        monkeypatch.setattr(models, "task_device", lambda device=device: device)
        handle.open()
    assert len(models._opened) == models.KEPT_MODELS

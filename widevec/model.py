"""Models as the tasks use them.

A model is a picklable handle whose ``open`` gives, once per Python worker, a callable from
ids and mask (int32, ``[sequences, max_len]``) to float32 vectors ``[sequences, width]``.
"""

from dataclasses import dataclass

import numpy as np
from pyspark import TaskContext

from widevec.artifacts import Artifact, is_folder, ship_bytes, ship_file, ship_folder
from widevec.functions.pooling import pool_tensor, read_pooling_mode

# Fixed names of the model's inputs and outputs.
INPUTS = ("input_ids", "attention_mask", "token_type_ids")
POOLED_OUTPUT = "embeddings"
HIDDEN_OUTPUT = "last_hidden_state"

INTEGER_TYPES = {"tensor(int32)": np.int32, "tensor(int64)": np.int64}
# Token vectors held at a time while a model without pooling of its own is run.
HIDDEN_BYTES = 64 * 1024 * 1024

# Open models of a Python worker, the one used longest ago first.
KEPT_MODELS = 3
_opened = {}


@dataclass(frozen=True)
class OnnxModel:
    """An ONNX model with a pooled ``embeddings`` output, or token vectors to be pooled here."""

    artifact: Artifact
    pooling: str = "mean"

    def open(self):
        # A worker outlives its tasks, and the next one may have another device.
        key = (self.artifact.digest, self.pooling, task_device(), task_cores())
        session = _opened.pop(key, None)
        if session is None:
            while len(_opened) >= KEPT_MODELS:
                del _opened[next(iter(_opened))]
            session = _OnnxSession(self.artifact.content(), self.pooling)
        _opened[key] = session
        return session


class _OnnxSession:
    def __init__(self, content, pooling):
        import onnxruntime

        options = onnxruntime.SessionOptions()
        options.log_severity_level = 3
        options.intra_op_num_threads = task_cores()
        options.inter_op_num_threads = 1
        self.pooling = pooling
        self.session = onnxruntime.InferenceSession(
            content, options, providers=device_providers(onnxruntime.get_available_providers())
        )
        self.inputs = {found.name: INTEGER_TYPES.get(found.type) for found in self.session.get_inputs()}
        unknown = [name for name in self.inputs if name not in INPUTS]
        if unknown or None in self.inputs.values():
            raise ValueError(f"model inputs {self.inputs} are not integer tensors named {INPUTS}")
        outputs = [found.name for found in self.session.get_outputs()]
        self.output = next((name for name in (POOLED_OUTPUT, HIDDEN_OUTPUT) if name in outputs), None)
        if self.output is None:
            raise ValueError(f"model outputs {outputs} have neither {POOLED_OUTPUT} nor {HIDDEN_OUTPUT}")
        shape = next(found.shape for found in self.session.get_outputs() if found.name == self.output)
        self.gives_tokens = len(shape or ()) == 3
        self.width = shape[-1] if shape and isinstance(shape[-1], int) else None

    def __call__(self, ids, mask):
        if not self.gives_tokens or len(ids) == 1:
            return self._run(ids, mask)
        if self.width is None:
            self.width = self._run(ids[:1], mask[:1]).shape[-1]
        step = max(1, HIDDEN_BYTES // (ids.shape[1] * self.width * 4))
        parts = range(0, len(ids), step)
        return np.concatenate([self._run(ids[at : at + step], mask[at : at + step]) for at in parts])

    def _run(self, ids, mask):
        offered = {"input_ids": ids, "attention_mask": mask, "token_type_ids": np.zeros_like(ids)}
        feeds = {name: offered[name].astype(dtype, copy=False) for name, dtype in self.inputs.items()}
        (found,) = self.session.run([self.output], feeds)
        return pool_tensor(found, mask, self.pooling) if found.ndim == 3 else found


def task_cores():
    context = TaskContext.get()
    return context.cpus() if context else 1


def task_device():
    """The accelerator Spark gave this task, None for the CPU."""
    context = TaskContext.get()
    gpu = context.resources().get("gpu") if context else None
    return None if gpu is None else int(gpu.addresses[0])


def device_providers(available):
    """The model runtime's name for the task's device."""
    device = task_device()
    if device is None:
        return ["CPUExecutionProvider"]
    if "CUDAExecutionProvider" not in available:
        raise RuntimeError(f"the task has GPU {device} but the model runtime offers {available}")
    return [("CUDAExecutionProvider", {"device_id": device})]


def load_model(spark, cfg):
    """The model at ``model_path``, pooled as its flags file says if it needs pooling: one file,
    or a folder with one ``.onnx`` file and the weights that it names."""
    if not cfg.model_path:
        raise ValueError("model_path is empty")
    ship = ship_folder if is_folder(spark, cfg.model_path) else ship_file
    return OnnxModel(ship(spark, cfg.model_path), read_pooling_mode(cfg.pooling_config_path, spark))


def model_from_bytes(spark, content, pooling="mean"):
    return OnnxModel(ship_bytes(spark, content), pooling)

"""Job configuration."""

import json
import logging
from dataclasses import dataclass, fields

from widevec.sources.files import read_json

log = logging.getLogger(__name__)

REQUIRED_KEYS = ("embedding_dim", "max_tokens", "batch_size", "vocab_path")
SOURCE_KEYS = ("source_query", "source_table", "source_path")


@dataclass(frozen=True)
class EmbedConfig:
    """Everything one embedding job needs.

    ``batch_size`` counts rows, so one inference call sees
    ``batch_size * len(input_columns)`` sequences. Any ``tokenizer_type`` other than
    ``"byt5"`` means the subword tokenizer defined by the JSON file at ``vocab_path``.
    Exactly one of the three source fields names the input, unless the job is handed a
    DataFrame.

    ``trim_padding`` runs short texts at a shorter padded length than ``max_tokens``. It
    needs a model that takes any length and ignores masked positions.

    ``reuse_repeats`` runs a text that repeats nearby once; switch it off for a model whose
    vectors depend on the other texts of a call.

    ``output_parts`` writes that many parts, each with a commit of its own, so that a run that
    was stopped goes on with those that are missing.
    """

    embedding_dim: int
    max_tokens: int
    batch_size: int
    input_columns: tuple[str, ...] = ()
    model_path: str = ""
    vocab_path: str = ""
    tokenizer_type: str = "huggingface"
    enable_s3_output: bool = False
    s3_output_path: str = ""
    id_column: str = "gid"
    source_query: str = ""
    source_table: str = ""
    source_path: str = ""
    pooling_config_path: str = ""
    partitions: int | None = None
    trim_padding: bool = False
    reuse_repeats: bool = True
    output_parts: int | None = None

    def __post_init__(self):
        for name in ("embedding_dim", "max_tokens", "batch_size", "partitions", "output_parts"):
            value = getattr(self, name)
            if name in ("partitions", "output_parts") and value is None:
                continue
            if isinstance(value, bool) or not isinstance(value, int):
                raise TypeError(f"{name} must be an integer, got {value!r}")
            if value <= 0:
                raise ValueError(f"{name} must be positive, got {value}")
        for name in ("enable_s3_output", "trim_padding", "reuse_repeats"):
            if not isinstance(getattr(self, name), bool):
                raise TypeError(f"{name} must be true or false, got {getattr(self, name)!r}")
        if self.batch_size * self.embedding_dim >= 2**31:
            raise ValueError("batch_size * embedding_dim is more than one Arrow list column holds")
        if isinstance(self.input_columns, str):
            raise TypeError("input_columns must be a list of names")
        object.__setattr__(self, "input_columns", tuple(self.input_columns))
        names = ("gid", *self.input_columns)
        if len(set(names)) != len(names):
            raise ValueError(f"the output columns {names} repeat a name")

    @classmethod
    def from_json(cls, path, spark=None):
        """Read a JSON file, on any file system that ``spark`` can read, on the driver's disk
        without one. Keys the job does not know are named in a warning and left out."""
        if spark is not None:
            raw = read_json(spark, path)
        else:
            with open(path, encoding="utf-8") as handle:
                raw = json.load(handle)
        missing = [key for key in REQUIRED_KEYS if key not in raw]
        if missing:
            raise ValueError(f"{path} lacks required keys {missing}")
        known = {field.name for field in fields(cls)}
        values = {key: value for key, value in raw.items() if key in known}
        unknown = sorted(set(raw) - known - {"onnx_path"})
        if unknown:
            log.warning("%s has keys that the job does not know: %s", path, ", ".join(unknown))
        # Files written by a model exporter name the model "onnx_path".
        values.setdefault("model_path", raw.get("onnx_path", ""))
        if not values["model_path"]:
            raise ValueError(f"{path} names no model: set model_path")
        return cls(**values)

    def check_columns(self):
        if not self.input_columns:
            raise ValueError("input_columns is empty: nothing to embed")

    def check_output(self):
        if self.enable_s3_output and not self.s3_output_path:
            raise ValueError("output is enabled but s3_output_path is empty")

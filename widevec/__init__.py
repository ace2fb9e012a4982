"""Bulk text embedding as Spark DataFrame operators."""

from widevec.artifacts import ship_bytes, ship_file, ship_folder, ship_package
from widevec.config import EmbedConfig
from widevec.functions.pooling import pooling_mode, read_pooling_mode
from widevec.functions.text import context, is_in, joined, labelled, non_empty, text_or_empty
from widevec.functions.tokens import byte_ids_expr, mask_expr, segment_ids_expr
from widevec.model import OnnxModel, load_model, model_from_bytes
from widevec.operators.embed import embed, output_schema
from widevec.operators.perspectives import bind_columns, pack_slots, perspectives
from widevec.operators.pooling import pool
from widevec.operators.tokens import detokenize, encode, tokenize
from widevec.plans.job import RunMetrics, RunResult, run
from widevec.plans.owner_mail import owner_mail, owner_mail_spec
from widevec.sinks.parquet import read_parts, write_in_parts, write_vectors
from widevec.sources.lake import (
    catalog_conf,
    inference_profile,
    object_store_conf,
    read_source,
    task_conf,
    text_batch,
)
from widevec.tokenizer import ByteTokenizer, SubwordTokenizer, make_tokenizer

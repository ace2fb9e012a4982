"""From raw documents to token ids: five stages, each written and read again.

A stage takes the documents that the one before it kept and returns documents with the same
columns; the last one returns what encoding gives.

Stages that hand texts to Python do so in batches of 2 MB, unless the session has a limit of its
own: their frames are read after they have returned, so the limit stays in the session until the
last stage, which takes it back.
"""

from widevec.artifacts import ship_package
from widevec.llm.bpe import bpe_digests
from widevec.llm.common import hold_small_batches, release_batches, table, written
from widevec.llm.decontamination import keep_clean
from widevec.llm.language import keep_identified
from widevec.llm.near_dedup import keep_one_each
from widevec.llm.quality import keep_good


def quality(spark, docs, sf_dir):
    """Drops what the standard quality policy rejects."""
    ship_package(spark)
    return keep_good(docs)


def language(spark, docs, sf_dir):
    """Drops texts without a letter and texts whose language cannot be told."""
    ship_package(spark)
    hold_small_batches(spark)
    return keep_identified(docs)


def near_dedup(spark, docs, sf_dir):
    """Keeps one document of each group of near-duplicates, that of the least id."""
    ship_package(spark)
    return keep_one_each(docs)


def decontamination(spark, docs, sf_dir):
    """Drops documents that hold benchmark items to 5 % of their words or more."""
    ship_package(spark)
    hold_small_batches(spark)
    return keep_clean(docs, table(spark, sf_dir, "benchmark"))


def bpe(spark, docs, sf_dir):
    """Encodes every kept text and decodes its ids."""
    ship_package(spark)
    hold_small_batches(spark)
    try:
        return written(bpe_digests(docs), "digests")
    finally:
        release_batches(spark)


STAGES = [
    ("quality", quality),
    ("language", language),
    ("near_dedup", near_dedup),
    ("decontamination", decontamination),
    ("bpe", bpe),
]


def run(spark, sf_dir):
    """All stages over the documents of ``sf_dir``; each result is a table in the shared folder."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), name)
    return docs


# Language models, sketches and tokenizers have no SQL form.
ORACLE_SQL = None

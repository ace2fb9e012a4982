"""The registered queries of this subpackage, and the SQL of those that SQL can express."""

from widevec.llm.bpe import op6_bpe_chunks
from widevec.llm.chat import OP7_SQL, op7_chat_snapshots
from widevec.llm.decontamination import OP5_SQL, op5_decontamination
from widevec.llm.hard_negatives import OP12_SQL, op12_hard_negatives
from widevec.llm.language import op4_language_id
from widevec.llm.near_dedup import op3_dart_minhash
from widevec.llm.pages import op9_page_text
from widevec.llm.quality import OP8_SQL, op8_quality_ledger
from widevec.llm.runs import op13_periodic_runs
from widevec.llm.sharding import op1_kd_shards
from widevec.llm.token_counts import op11_token_counts
from widevec.llm.token_files import op2_token_files
from widevec.llm.warc import op10_warc

QUERIES = {
    query.__name__: query
    for query in (
        op1_kd_shards,
        op2_token_files,
        op3_dart_minhash,
        op4_language_id,
        op5_decontamination,
        op6_bpe_chunks,
        op7_chat_snapshots,
        op8_quality_ledger,
        op9_page_text,
        op10_warc,
        op11_token_counts,
        op12_hard_negatives,
        op13_periodic_runs,
    )
}

# k-d cuts, tokenizers, sketches, trained models, page text and archives have no SQL form:
# tests/llm holds them against plain Python, exact round trips and held-out labels.
ORACLE_SQL = {
    "op5_decontamination": OP5_SQL,
    "op7_chat_snapshots": OP7_SQL,
    "op8_quality_ledger": OP8_SQL,
    "op12_hard_negatives": OP12_SQL,
}

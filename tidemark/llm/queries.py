"""The registered queries of this subpackage, and SQL for those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from tidemark.llm.cas_store import op4_cas_store
from tidemark.llm.edit_counts import op6_edit_counts
from tidemark.llm.fair_mix import OP9_SQL, op9_fair_mix
from tidemark.llm.grace_dedup import OP3_SQL, op3_grace_dedup
from tidemark.llm.gru_lm import op10_gru_lm
from tidemark.llm.quality_ledger import OP2_SQL, op2_quality_ledger
from tidemark.llm.sparse_jaccard import OP8_SQL, op8_sparse_jaccard
from tidemark.llm.toxic_crf import op5_toxic_crf
from tidemark.llm.trie_bpe import op7_trie_bpe
from tidemark.llm.url_cascade import OP1_SQL, op1_url_cascade

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_url_cascade": op1_url_cascade,
    "op2_quality_ledger": op2_quality_ledger,
    "op3_grace_dedup": op3_grace_dedup,
    "op4_cas_store": op4_cas_store,
    "op5_toxic_crf": op5_toxic_crf,
    "op6_edit_counts": op6_edit_counts,
    "op7_trie_bpe": op7_trie_bpe,
    "op8_sparse_jaccard": op8_sparse_jaccard,
    "op9_fair_mix": op9_fair_mix,
    "op10_gru_lm": op10_gru_lm,
}

SQL: dict[str, str] = {
    "op1_url_cascade": OP1_SQL,
    "op2_quality_ledger": OP2_SQL,
    "op3_grace_dedup": OP3_SQL,
    "op8_sparse_jaccard": OP8_SQL,
    "op9_fair_mix": OP9_SQL,
}

"""Registered queries of the llm operators and their SQL, where SQL can
express them."""

from __future__ import annotations

from shelfwise.llm import ann, audit, decontaminate, negatives, ngram_join, topk
from shelfwise.llm.ann import op9_rotated_codes
from shelfwise.llm.audit import op12_filter_audit
from shelfwise.llm.bpe import op10_bpe
from shelfwise.llm.decontaminate import op6_decontaminate
from shelfwise.llm.hilbert import op3_hilbert_shards
from shelfwise.llm.negatives import op11_hard_negatives
from shelfwise.llm.ngram_join import op7_ngram_join
from shelfwise.llm.paragraph_dedup import op2_every_paragraph, op2_paragraph_dedup
from shelfwise.llm.pii import op4_pii
from shelfwise.llm.ppm import op5_ppm
from shelfwise.llm.suffix_dedup import op8_suffix_dedup
from shelfwise.llm.topk import op13_pivot_index
from shelfwise.llm.toxicity import op1_toxicity

QUERIES = {f.__name__: f for f in (
    op1_toxicity, op2_paragraph_dedup, op2_every_paragraph, op3_hilbert_shards, op4_pii, op5_ppm, op6_decontaminate,
    op7_ngram_join, op8_suffix_dedup, op9_rotated_codes, op10_bpe,
    op11_hard_negatives, op12_filter_audit, op13_pivot_index)}

ORACLE_SQL: dict[str, str] = {
    "op6_decontaminate": decontaminate.SQL,
    "op7_ngram_join": ngram_join.SQL,
    "op9_rotated_codes": ann.SQL,
    "op11_hard_negatives": negatives.SQL,
    "op12_filter_audit": audit.SQL,
    "op13_pivot_index": topk.SQL,
}

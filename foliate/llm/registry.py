"""Query names of this subpackage, their functions and, where it exists, their SQL."""

from __future__ import annotations

from foliate.llm.alignment import op11_alignment
from foliate.llm.ann import op10_ann
from foliate.llm.bpe import op9_bpe
from foliate.llm.html_extract import op7_html_text
from foliate.llm.language import op13_language
from foliate.llm.near_dup import op5_near_dup
from foliate.llm.packing import op2_packing
from foliate.llm.pii import op3_pii
from foliate.llm.quality import op1_quality
from foliate.llm.sharding import op6_sharding
from foliate.llm.toxicity import op4_toxicity
from foliate.llm.url_filter import OP8_SQL, op8_url_filter
from foliate.llm.whitening import op12_whitening

QUERIES = {
    "op1_quality": op1_quality,
    "op2_packing": op2_packing,
    "op3_pii": op3_pii,
    "op4_toxicity": op4_toxicity,
    "op5_near_dup": op5_near_dup,
    "op6_sharding": op6_sharding,
    "op7_html_text": op7_html_text,
    "op8_url_filter": op8_url_filter,
    "op9_bpe": op9_bpe,
    "op10_ann": op10_ann,
    "op11_alignment": op11_alignment,
    "op12_whitening": op12_whitening,
    "op13_language": op13_language,
}
ORACLES = {
    "op8_url_filter": OP8_SQL,
}

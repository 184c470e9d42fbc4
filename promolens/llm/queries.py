"""The registered queries of the operators, and SQL for those that SQL can express."""

from __future__ import annotations

from promolens.llm.bpe import op3_bpe
from promolens.llm.jaccard import OP2_SQL, op2_ngram_jaccard
from promolens.llm.lattice import OP5_SQL, op5_lattice
from promolens.llm.packing import op4_packing
from promolens.llm.pii import op9_pii
from promolens.llm.quality import op7_quality
from promolens.llm.ranked_search import OP13_SQL, op13_ranked_search
from promolens.llm.substring_dedup import OP1_SQL, op1_substring_dedup
from promolens.llm.suffix_dedup import op6_suffix_dedup
from promolens.llm.tool_chat import OP10_SQL, op10_tool_chat
from promolens.llm.toxicity import op12_toxicity
from promolens.llm.warc import OP8_SQL, op8_warc
from promolens.llm.whitening import op11_whitening

QUERIES = {
    "op1_substring_dedup": op1_substring_dedup,
    "op2_ngram_jaccard": op2_ngram_jaccard,
    "op3_bpe": op3_bpe,
    "op4_packing": op4_packing,
    "op5_lattice": op5_lattice,
    "op6_suffix_dedup": op6_suffix_dedup,
    "op7_quality": op7_quality,
    "op8_warc": op8_warc,
    "op9_pii": op9_pii,
    "op10_tool_chat": op10_tool_chat,
    "op11_whitening": op11_whitening,
    "op12_toxicity": op12_toxicity,
    "op13_ranked_search": op13_ranked_search,
}

ORACLES: dict[str, str] = {
    "op1_substring_dedup": OP1_SQL,
    "op2_ngram_jaccard": OP2_SQL,
    "op5_lattice": OP5_SQL,
    "op8_warc": OP8_SQL,
    "op10_tool_chat": OP10_SQL,
    "op13_ranked_search": OP13_SQL,
}

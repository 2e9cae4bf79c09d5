"""Registered queries of this package and their DuckDB SQL where SQL can state them."""

from __future__ import annotations

from racelake.llm import op11_negatives as _op11
from racelake.llm import op12_fim as _op12
from racelake.llm import op13_topk as _op13
from racelake.llm import sql as _sql
from racelake.llm.op1_suffix import op1_suffix
from racelake.llm.op2_repetition import op2_repetition
from racelake.llm.op3_decontaminate import op3_decontaminate
from racelake.llm.op4_debruijn import op4_debruijn
from racelake.llm.op5_style_tree import op5_style_tree
from racelake.llm.op6_fuzzy_lines import op6_fuzzy_lines
from racelake.llm.op7_packing import op7_packing
from racelake.llm.op8_jaccard import op8_jaccard
from racelake.llm.op9_pii import op9_pii
from racelake.llm.op10_hmm import op10_hmm

QUERIES = {
    "op1_suffix": op1_suffix,
    "op2_repetition": op2_repetition,
    "op3_decontaminate": op3_decontaminate,
    "op4_debruijn": op4_debruijn,
    "op5_style_tree": op5_style_tree,
    "op6_fuzzy_lines": op6_fuzzy_lines,
    "op7_packing": op7_packing,
    "op8_jaccard": op8_jaccard,
    "op9_pii": op9_pii,
    "op10_hmm": op10_hmm,
    "op11_negatives": _op11.op11_negatives,
    "op12_fim": _op12.op12_fim,
    "op13_topk": _op13.op13_topk,
}
ORACLES: dict[str, str] = {
    "op1_suffix": _sql.SUFFIX,
    "op2_repetition": _sql.REPETITION,
    "op8_jaccard": _sql.JACCARD,
    "op11_negatives": _op11.ORACLE,
    "op12_fim": _op12.ORACLE,
    "op13_topk": _op13.ORACLE,
}

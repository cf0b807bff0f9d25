"""Registered queries of this subpackage: each applies one operator, with its
production parameters, to whole tables."""

from __future__ import annotations

from pathcredit.llm.codes import OP13_SQL, op13_codes
from pathcredit.llm.counts import op10_counts
from pathcredit.llm.decontamination import OP3_SQL, op3_decontamination
from pathcredit.llm.jaccard import OP11_SQL, op11_jaccard
from pathcredit.llm.lines import OP6_SQL, op6_lines
from pathcredit.llm.minhash import OP1_SQL, op1_minhash
from pathcredit.llm.packing import op5_packing
from pathcredit.llm.personal import op8_personal
from pathcredit.llm.quality import op7_quality
from pathcredit.llm.resampling import op12_resampling
from pathcredit.llm.scoring import op9_scoring
from pathcredit.llm.substrings import OP4_SQL, op4_substrings
from pathcredit.llm.suffixes import OP2_SQL, op2_suffixes

QUERIES = {
    "op10_counts": op10_counts,
    "op11_jaccard": op11_jaccard,
    "op12_resampling": op12_resampling,
    "op13_codes": op13_codes,
    "op1_minhash": op1_minhash,
    "op2_suffixes": op2_suffixes,
    "op3_decontamination": op3_decontamination,
    "op4_substrings": op4_substrings,
    "op5_packing": op5_packing,
    "op6_lines": op6_lines,
    "op7_quality": op7_quality,
    "op8_personal": op8_personal,
    "op9_scoring": op9_scoring,
}

#: DuckDB statements for the queries that SQL can express.
ORACLE_SQL: dict[str, str] = {
    "op11_jaccard": OP11_SQL,
    "op13_codes": OP13_SQL,
    "op1_minhash": OP1_SQL,
    "op2_suffixes": OP2_SQL,
    "op3_decontamination": OP3_SQL,
    "op4_substrings": OP4_SQL,
    "op6_lines": OP6_SQL,
}

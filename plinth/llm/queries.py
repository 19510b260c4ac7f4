"""The subpackage's registered queries and their SQL."""

from __future__ import annotations

from plinth.llm.decontamination import op1_decontamination
from plinth.llm.licences import OP9_SQL, op9_licence_scan
from plinth.llm.packing import op3_packing
from plinth.llm.quality import OP6_SQL, op6_quality_rules
from plinth.llm.sharding import op10_sharding
from plinth.llm.simhash import op8_simhash
from plinth.llm.substring_dedup import OP4_SQL, op4_substring_dedup
from plinth.llm.suffix_dedup import op2_suffix_dedup
from plinth.llm.token_counts import op7_token_counts
from plinth.llm.token_output import op5_token_output

QUERIES = {
    "op1_decontamination": op1_decontamination,
    "op2_suffix_dedup": op2_suffix_dedup,
    "op3_packing": op3_packing,
    "op4_substring_dedup": op4_substring_dedup,
    "op5_token_output": op5_token_output,
    "op6_quality_rules": op6_quality_rules,
    "op7_token_counts": op7_token_counts,
    "op8_simhash": op8_simhash,
    "op9_licence_scan": op9_licence_scan,
    "op10_sharding": op10_sharding,
}

SQL: dict[str, str] = {"op4_substring_dedup": OP4_SQL, "op6_quality_rules": OP6_SQL, "op9_licence_scan": OP9_SQL}

"""The registered queries of this subpackage and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame

from linkwright.llm import mixing, oracles, topk
from linkwright.llm.decontaminate import op5_decontaminate
from linkwright.llm.line_dedup import op4_line_dedup
from linkwright.llm.near_dedup import op3_minhash_near_dedup
from linkwright.llm.substring_dedup import op2_substring_dedup
from linkwright.llm.token_counts import op10_token_counts
from linkwright.llm.token_output import op1_token_output
from linkwright.llm.toxicity import op7_toxicity
from linkwright.llm.url_filter import op6_url_filter

QUERIES: dict[str, Callable[..., DataFrame]] = {
    "op1_token_output": op1_token_output,
    "op2_substring_dedup": op2_substring_dedup,
    "op3_minhash_near_dedup": op3_minhash_near_dedup,
    "op4_line_dedup": op4_line_dedup,
    "op5_decontaminate": op5_decontaminate,
    "op6_url_filter": op6_url_filter,
    "op7_toxicity": op7_toxicity,
    "op8_exact_topk": topk.op8_exact_topk,
    "op9_mixing": mixing.op9_mixing,
    "op10_token_counts": op10_token_counts,
}
#: The others learn a model or need a tokenizer; their tests compare them with plain versions.
ORACLES: dict[str, str] = {
    "op2_substring_dedup": oracles.OP2,
    "op3_minhash_near_dedup": oracles.OP3,
    "op4_line_dedup": oracles.OP4,
    "op5_decontaminate": oracles.OP5,
    "op8_exact_topk": topk.OP8_SQL,
    "op9_mixing": mixing.sql(),
}

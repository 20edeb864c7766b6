"""The subpackage's queries by name, and the DuckDB SQL of those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from .decontaminate import OP4_SQL, op4_decontaminate
from .embeddings import OP6_SQL, op6_embedding_dedup
from .language import op2_language
from .lines import OP1_SQL, op1_line_dedup
from .minhash import OP8_SQL, op8_minhash
from .mixing import op9_mixing
from .substring import OP7_SQL, op7_substring_dedup
from .token_output import op10_token_output
from .tokens import op3_token_counts
from .warc import OP5_SQL, op5_warc

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_line_dedup": op1_line_dedup,
    "op2_language": op2_language,
    "op3_token_counts": op3_token_counts,
    "op4_decontaminate": op4_decontaminate,
    "op5_warc": op5_warc,
    "op6_embedding_dedup": op6_embedding_dedup,
    "op7_substring_dedup": op7_substring_dedup,
    "op8_minhash": op8_minhash,
    "op9_mixing": op9_mixing,
    "op10_token_output": op10_token_output,
}

ORACLE_SQL: dict[str, str] = {
    "op1_line_dedup": OP1_SQL,
    "op4_decontaminate": OP4_SQL,
    "op5_warc": OP5_SQL,
    "op6_embedding_dedup": OP6_SQL,
    "op7_substring_dedup": OP7_SQL,
    "op8_minhash": OP8_SQL,
}

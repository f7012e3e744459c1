"""The queries of this subpackage, one for each operator, with their SQL where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from . import op4_warc, op6_mixing, op7_exact_dedup
from .op1_minhash import op1_minhash
from .op2_packing import op2_packing
from .op3_quality import op3_quality
from .op5_tokens import op5_tokens
from .op8_ann import op8_ann
from .op9_licenses import op9_licenses
from .op10_pii import op10_pii

Query = Callable[[SparkSession, str], DataFrame]


def queries() -> dict[str, Query]:
    return {f.__name__: f for f in (op1_minhash, op2_packing, op3_quality, op4_warc.op4_warc, op5_tokens, op6_mixing.op6_mixing, op7_exact_dedup.op7_exact_dedup, op8_ann, op9_licenses, op10_pii)}


def oracle_sql() -> dict[str, str]:
    return {"op4_warc": op4_warc.SQL, "op6_mixing": op6_mixing.SQL, "op7_exact_dedup": op7_exact_dedup.SQL}

"""The registered queries of this subpackage, and their SQL where SQL can say the same."""

from __future__ import annotations

from collections.abc import Callable
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

from contactloom.llm import (alignment, byte_bpe, decontaminate, digest_index, katz, ngram_join, periodic_runs, personal_data, quality, ring_shards,
                            suffix_dedup, toxicity, warc)

_QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op4_warc": warc.op4_warc,
    "op1_quality": quality.op1_quality,
    "op6_toxicity": toxicity.op6_toxicity,
    "op2_ngram_join": ngram_join.op2_ngram_join,
    "op3_suffix_dedup": suffix_dedup.op3_suffix_dedup,
    "op5_personal_data": personal_data.op5_personal_data,
    "op7_exact_dedup": digest_index.op7_exact_dedup,
    "op9_katz": katz.op9_katz,
    "op10_decontaminate": decontaminate.op10_decontaminate,
    "op8_byte_bpe": byte_bpe.op8_byte_bpe,
    "op11_alignment": alignment.op11_alignment,
    "op12_ring_shards": ring_shards.op12_ring_shards,
    "op13_periodic_runs": periodic_runs.op13_periodic_runs,
}
ORACLES: dict[str, str] = {
    "op4_warc": warc.OP4_SQL,
    "op7_exact_dedup": digest_index.OP7_SQL,
}


def reachable(query: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    """The query, with this checkout on the path of Python workers that were not told of it."""
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        root, known = str(Path(__file__).resolve().parents[2]), spark.sparkContext.environment
        if root not in known.get("PYTHONPATH", "").split(":"):
            known["PYTHONPATH"] = ":".join(filter(None, (root, known.get("PYTHONPATH"))))
        return query(spark, sf_dir)

    return run


QUERIES = {name: reachable(query) for name, query in sorted(_QUERIES.items())}

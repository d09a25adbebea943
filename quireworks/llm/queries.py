"""The named queries of this subpackage and the SQL they are checked against."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from quireworks.llm import centroids, fixity, mixing, near_dups, negatives, neighbours, ngrams, packing, pii, quality, repeats, token_counts, toxicity

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    function.__name__: function
    for function in (
        pii.op1_pii,
        token_counts.op2_token_counts,
        near_dups.op3_near_dups,
        mixing.op4_mixing,
        repeats.op5_repeats,
        quality.op6_quality,
        packing.op7_packing,
        neighbours.op8_neighbours,
        fixity.op9_fixity,
        toxicity.op10_toxicity,
        negatives.op11_negatives,
        ngrams.op12_scores,
        centroids.op13_centroids,
    )
}
CHECKS: dict[str, str] = {
    "op3_near_dups": near_dups.OP3_SQL,
    "op4_mixing": mixing.OP4_SQL,
    "op5_repeats": repeats.OP5_SQL,
    "op9_fixity": fixity.OP9_SQL,
    "op11_negatives": negatives.OP11_SQL,
    "op13_centroids": centroids.OP13_SQL,
}

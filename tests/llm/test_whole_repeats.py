"""Runs of repeated passages: how they are dealt, and what comes back to the parts."""

from __future__ import annotations

import numpy as np
from pyspark.sql import functions as F

from framestore.llm import repeats
from framestore.llm.parts import dealing, kept_by_part, recurring


def test_only_smaller_ids_come_back_to_a_part(spark):
    """Nothing comes back for a run that no smaller id has; it had an answer for itself before."""
    texts = [f"{k} " + " ".join(f"w{(k % 40) * 100 + i}" for i in range(60)) for k in range(80)]
    docs = spark.createDataFrame(list(enumerate(texts)), "id bigint, text string").repartition(2, "id")
    n, bits = dealing(spark)
    with kept_by_part(docs.select(F.monotonically_increasing_id().alias("row"), "id", "text")) as (rows, _):
        grams = recurring(repeats.deal_grams(rows, bits).repartition(n, "bucket"), repeats.HOT).localCheckpoint()
        dealt = repeats.deal_runs(rows, grams, bits).repartition(n, "bucket").localCheckpoint()
        found = repeats.first_holders(dealt).collect()
        made = sum(len(r["ids"]) // 8 for r in dealt.collect())
    assert found and sum(len(r["ids"]) // 8 for r in found) < made
    assert max(np.frombuffer(r["ids"], "<i8").max() for r in found) < 40


def test_grams_are_dealt_evenly():
    """The gram of a window is the one with the least hash: by the first bits of that hash most came into a few buckets."""
    data = np.random.default_rng(3).integers(97, 123, 200_000, dtype=np.uint8)
    _, _, _, gram = repeats.anchors(data, np.array([0, len(data)]))
    share = np.bincount((gram >> np.uint64(58)).astype(np.int64), minlength=64) / len(gram)
    assert share.max() < 0.05

"""What packing takes of an executor's memory beside its heap."""

from __future__ import annotations

import sys

from framestore.llm.packing import CACHE_BYTES, pack
from framestore.llm.vocabulary import WordIds


def test_words_that_a_worker_remembers_stay_small():
    joined = WordIds(lambda texts: [[5] if t == " " else [7, 5, 7] for t in texts], " ", "\0", fast=lambda ws: [b"\0" * 12] * len(ws), cache_bytes=CACHE_BYTES)
    most = 0
    for a in range(0, 1_000_000, 20_000):
        joined.learn(b"word%d" % i for i in range(a, a + 20_000))
        held = [joined.known, joined._before]
        most = max(most, sum(sys.getsizeof(d) + sum(sys.getsizeof(k) + sys.getsizeof(v) for k, v in d.items()) for d in held))
    # Two workers of an executor keep less than 100 MB of words together.
    assert most < 50 << 20


def test_the_plan_needs_no_python_worker(spark):
    docs = spark.createDataFrame([(i, "some words " * i) for i in range(40)], "doc_id bigint, text string")
    packed = pack(docs, with_ids=False)
    plan = packed._jdf.queryExecution().executedPlan().toString()
    assert "ExistingRDD" not in plan and "LocalTableScan" in plan
    rows = packed.collect()
    assert len({r["doc_id"] for r in rows}) == 40
    assert {c: t for c, t in packed.dtypes} == {
        "doc_id": "bigint", "piece": "int", "start": "bigint", "length": "bigint", "ids_crc32": "bigint", "sequence_id": "bigint", "offset": "bigint",
    }

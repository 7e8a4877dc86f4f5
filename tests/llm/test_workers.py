"""What a Python worker keeps between tasks, and holds within one."""

import sys

import pyarrow as pa

from tidemark.llm import common


def test_a_task_gets_its_rows_in_portions():
    sizes = []

    def run(batches):
        for batch in batches:
            sizes.append(batch.num_rows)
            yield batch

    rows = [list(range(2 * common.PORTION + 7)), [], [-1, -2]]
    given = [pa.record_batch({"n": pa.array(r, pa.int64())}) for r in rows]
    got = [n for batch in common.in_portions(run)(iter(given)) for n in batch["n"].to_pylist()]
    assert got == sum(rows, [])
    assert sizes == [common.PORTION, common.PORTION, 7, 2]


def test_a_worker_keeps_the_object_of_the_latest_operator_only(spark):
    def run(batches):
        for batch in batches:
            for key in ("first", "second", "second"):
                common.per_worker(key, lambda key=key: key.upper())
            made = sys.modules["_tidemark_llm_worker"].made
            yield pa.record_batch({"kept": [f"{k} {v}" for k, v in sorted(made.items())]})

    kept = spark.range(1).coalesce(1).mapInArrow(run, "kept string").collect()
    assert [r.kept for r in kept] == ["second SECOND"]

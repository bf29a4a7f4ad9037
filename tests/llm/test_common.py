import re
import time

import pyarrow as pa
import pytest

from slotwise.llm import bpe, minhash
from tests.llm.test_bpe import PATH


def held_by_workers(spark):
    """MB that each Python worker holds by itself, by process."""

    def run(batches):
        import os

        for _ in batches:
            time.sleep(0.2)  # so that every idle worker gets a task
            with open("/proc/self/smaps_rollup") as f:
                kb = sum(map(int, re.findall(r"\nPrivate_Dirty:\s+(\d+)", f.read())))
            yield pa.RecordBatch.from_pydict({"pid": [os.getpid()], "mb": [kb / 1024]})

    return dict(spark.range(32).repartition(32).mapInArrow(run, "pid long, mb double").collect())


@pytest.mark.parametrize("step", [minhash.signed, lambda docs: bpe.encode(docs, PATH)], ids=["signatures", "tokens"])
def test_workers_give_back_what_a_task_took(spark, step):
    words = "concat_ws(' ', transform(sequence(1, 400), i -> hex(xxhash64(id, i))))"
    docs = spark.range(1600).selectExpr("id as doc_id", f"{words} as text").repartition(1)
    step(docs.limit(8)).write.format("noop").mode("overwrite").save()  # modules and vocabulary are there
    before = held_by_workers(spark)
    step(docs).write.format("noop").mode("overwrite").save()
    after = held_by_workers(spark)
    assert max(after[pid] - before.get(pid, min(before.values())) for pid in after) < 40, (before, after)

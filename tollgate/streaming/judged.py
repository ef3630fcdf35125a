"""Judging a stream of partitions: every micro-batch is judged as a whole and both sides are appended.

Uniqueness is judged within a partition, and a micro-batch is taken to hold whole partitions
(a file source does, with a file a day).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery

from tollgate.contract import Contract
from tollgate.operators import judge, split


def judge_stream(rows: DataFrame, contract: Contract, path: str, checkpoint: str) -> StreamingQuery:
    """accepted/ and quarantined/ under path, each with the batch it came in, so that a repeated batch replaces itself."""

    def each(batch: DataFrame, batch_id: int) -> None:
        judged = judge.judged(batch, contract).persist()
        try:
            for name, side in (("accepted", split.accepted(judged)), ("quarantined", split.held(judged))):
                side.write.mode("overwrite").parquet(f"{path}/{name}/_batch={batch_id}")
        finally:
            judged.unpersist()

    return rows.writeStream.foreachBatch(each).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()

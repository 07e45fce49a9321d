"""Scoring of row streams."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery

from gaugemill.contracts import FeatureContract
from gaugemill.plans.scoring import predict_full, predict_minimal


def predict_stream(
    rows: DataFrame, dim: DataFrame, model, contract: FeatureContract, info: Mapping[str, str], destination: str,
    checkpoint: str, minimal: bool = False, keep: Sequence[str] = (), available_now: bool = True, **rules,
) -> list[StreamingQuery]:
    """Score a stream into ``destination/predictions`` and its refused rows into ``destination/rejected``.

    A stateless model runs as a plain stream joined with the static dimension. The neighbour join ranks rows and
    is run on each micro-batch, written under its batch number, so that a repeated batch replaces itself.
    """
    run: Callable = predict_minimal if minimal else predict_full
    trigger = {"availableNow": True} if available_now else {"processingTime": "10 seconds"}
    if model.kind == "tree":
        parts = zip(("predictions", "rejected"), run(rows, dim, model, contract, info, keep=keep, **rules), strict=True)
        return [
            part.writeStream.format("parquet").option("path", f"{destination}/{name}")
            .option("checkpointLocation", f"{checkpoint}/{name}").trigger(**trigger).start()
            for name, part in parts
        ]

    def one_batch(batch: DataFrame, number: int) -> None:
        parts = zip(("predictions", "rejected"), run(batch, dim, model, contract, info, keep=keep, **rules), strict=True)
        for name, part in parts:
            part.write.mode("overwrite").parquet(f"{destination}/{name}/batch={number}")

    return [rows.writeStream.foreachBatch(one_batch).option("checkpointLocation", checkpoint).trigger(**trigger).start()]

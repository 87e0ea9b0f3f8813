"""Score a Structured Streaming source with a fitted chain.

The preparation stages are projections (plus a stream-static join when a
rare-category list is large), so they run on streaming DataFrames directly.
The classifier step runs per micro-batch through ``foreachBatch`` because
the k-NN classifier joins against its training table with windows. Every
micro-batch writes its own folder ``batch_id=N`` of the parquet sink and
replaces it when it is tried again, so a retry leaves no row twice. The
checkpoint is named by the caller: a restart with the same one goes on where
the last run ended.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery

from pawprint.plans.chain import ChainModel
from pawprint.sources.schema import KEY


def score_batch(model: ChainModel, batch: DataFrame, keep=(KEY,)) -> DataFrame:
    pred = model.predict(batch)
    cols = [c for c in keep if c in pred.columns] + ["prediction", "proba"]
    return pred.select(*cols)


def start_scoring(stream: DataFrame, model: ChainModel, sink_path: str,
                  checkpoint: str, trigger_once: bool = False, keep=(KEY,)) -> StreamingQuery:
    """Start a query that adds ``(key, prediction, proba)`` rows to ``sink_path``."""
    def write(batch: DataFrame, batch_id: int) -> None:
        (score_batch(model, batch, keep).write.mode("overwrite")
         .parquet(f"{sink_path.rstrip('/')}/batch_id={batch_id}"))

    writer = stream.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint)
    if trigger_once:
        writer = writer.trigger(availableNow=True)
    return writer.start()

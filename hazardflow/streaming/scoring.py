"""SCORE-2: the batch scorer on a stream; rejected rows go to a second sink."""

from __future__ import annotations

from pyspark.sql import DataFrame

from hazardflow.plans.scoring import PREDICT_TIMES, score_batch


def start_stream_scoring(stream: DataFrame, model, *, model_name: str | None, scored_sink, rejected_sink,
                         checkpoint: str, scaler=None, id_col: str = "subject_id",
                         times=PREDICT_TIMES, trigger=None):
    """Stateless: model literals are fixed when the query starts (H0 looked up once)."""
    if model is None or not model_name:
        raise RuntimeError("No model is loaded.")
    from hazardflow.operators.cox import baseline_at

    h0 = baseline_at(model, times)

    def write(batch: DataFrame, epoch: int) -> None:
        scored, bad = score_batch(batch, model, model_name=model_name, scaler=scaler, id_col=id_col,
                                  times=times, h0=h0)
        scored_sink(scored, epoch)
        rejected_sink(bad, epoch)

    w = stream.writeStream.option("checkpointLocation", checkpoint).foreachBatch(write)
    if trigger:
        w = w.trigger(**trigger)
    return w.start()

"""Optional: decontamination of files as they arrive. The batch operators run on each micro-batch."""

from __future__ import annotations

from pyspark.sql import DataFrame

from corpusmill.operators.decontamination import split_by_matches, substring_matches


def decontaminate_stream(stream: DataFrame, needles: DataFrame, clean_path: str, checkpoint: str, id_col: str = "doc_id", text_col: str = "text"):
    """Starts a query that appends clean rows of each micro-batch to ``clean_path``; batches are named, so a replay replaces its own."""

    def write(batch: DataFrame, number: int) -> None:
        clean, _ = split_by_matches(batch, substring_matches(batch, needles, id_col, text_col), id_col)
        clean.write.mode("overwrite").parquet(f"{clean_path}/batch={number}")

    return stream.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).start()

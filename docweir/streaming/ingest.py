"""Extension: incremental ingest, a micro-batch of new files at a time."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from docweir.operators.chunking import chunk_segments
from docweir.plans.ingest import save_table, sequenced
from docweir.sources.files import EXTENSIONS
from docweir.sources.parsers import parsed_segments


def stream_chunks(spark: SparkSession, input_dir: str, output_dir: str, checkpoint_dir: str, parser: str = "offline") -> StreamingQuery:
    """Upsert the chunks of files as they appear into the keyed table ``output_dir``/chunks. A batch that is sent again is passed over."""
    files = (
        spark.readStream.format("binaryFile")
        .schema("path string, modificationTime timestamp, length bigint, content binary")
        .option("recursiveFileLookup", True)
        .option("pathGlobFilter", f"*.{{{','.join(EXTENSIONS)}}}")
        .load(input_dir)
    )

    def add(batch: DataFrame, number: int) -> None:
        chunks = sequenced(chunk_segments(parsed_segments(batch.select("path", "content"), parser)))
        latest = chunks.groupBy("chunk_id").agg(F.max_by(F.struct(*[c for c in chunks.columns if c not in ("chunk_id", "seq")]), "seq").alias("c"))
        save_table(spark, latest.select("chunk_id", "c.*"), f"{output_dir}/chunks", ["chunk_id"], writer=checkpoint_dir, batch=number)

    return files.writeStream.foreachBatch(add).option("checkpointLocation", checkpoint_dir).trigger(availableNow=True).start()

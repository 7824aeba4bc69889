"""Runs a streaming DataFrame into a memory table (tests only)."""
from pyspark.sql import DataFrame


def start_to_memory(df: DataFrame, name: str, checkpoint: str, mode: str = "append"):
    """Run a streaming DataFrame to completion over what is available."""
    q = (df.writeStream.outputMode(mode).format("memory").queryName(name)
         .option("checkpointLocation", checkpoint).trigger(availableNow=True).start())
    q.awaitTermination()
    return q

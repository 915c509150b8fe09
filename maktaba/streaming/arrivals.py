"""Files as they arrive: the same narrow operators over a stream of files, for folders that fill up over time."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..functions import text as T
from ..operators.cleaning import rule_clean
from ..sources.files import decode_text


def text_stream(spark: SparkSession, folder: str, *, pattern: str = "*.txt", files_per_trigger: int = 1000) -> DataFrame:
    """path, modificationTime and text of the text files of a folder, new ones as they come."""
    schema = "path string, modificationTime timestamp, length long, content binary"
    files = spark.readStream.format("binaryFile").schema(schema).option("pathGlobFilter", pattern).option("maxFilesPerTrigger", files_per_trigger).load(folder)
    text, _ = decode_text(F.col("content"))
    return files.select("path", "modificationTime", T.clean_text(text).alias("text"))


def clean_stream(spark: SparkSession, folder: str, out: str, checkpoint: str, **options) -> StreamingQuery:
    """Cleans arriving text files into a Parquet folder, each file once; runs over what is there, then stops."""
    cleaned = rule_clean(text_stream(spark, folder, **options))
    return cleaned.writeStream.format("parquet").option("path", out).option("checkpointLocation", checkpoint).outputMode("append").trigger(availableNow=True).start()

"""Archive and live ingest."""

from __future__ import annotations

from pyspark.sql import SparkSession

from veleta.functions.lang import language
from veleta.operators import langmodel
from veleta.schemas import MICROBATCH_SECONDS, SUBREDDITS
from veleta.sources.historical import keep_posts, scan_archive, select_files, write_months
from veleta.sources.bronze import BY_MONTH
from veleta.streaming.ingest import start_live


def run_archive(spark: SparkSession, folder: str, out: str, subreddits=SUBREDDITS, model: str = "") -> None:
    """Select archive files by path, filter their posts and write them by month; ``model`` is a folder with
    a fitted language model that takes the place of the stop words."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(folder) \
        .select("path")
    chosen = [r["path"] for r in select_files(files, subreddits).select("path").toLocalIterator()]
    if chosen:
        detect = langmodel.load(spark, model).language if model else language
        write_months(keep_posts(scan_archive(spark, chosen), subreddits, detect=detect), out)


def run_live(spark: SparkSession, landing: str, bronze: str, quarantine: str, checkpoints: str,
             seconds: int = MICROBATCH_SECONDS, by: tuple[str, ...] = BY_MONTH) -> None:
    """The live query; returns when it stops (at once drained for ``seconds`` <= 0)."""
    start_live(spark, landing, bronze, quarantine, f"{checkpoints}/live", seconds, by=by).awaitTermination()

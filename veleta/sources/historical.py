"""Archived posts: compressed JSON lines, selected by path, filtered and split by month."""

from __future__ import annotations

from collections.abc import Callable, Iterable

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from veleta.functions.lang import language
from veleta.functions.once import add_once
from veleta.functions.text import strip
from veleta.functions.values import epoch_timestamp, month_key
from veleta.schemas import ARCHIVE_END, ARCHIVE_START, LANGUAGES

POST = "subreddit string, created_utc double, title string, selftext string, _corrupt_record string"
COMMUNITY_PRIORITY, MONTHLY_PRIORITY = 7, 6


def _month_in_range(path: Column, pattern: str) -> Column:
    key = F.concat(F.regexp_extract(path, pattern, 1), F.lit("-"), F.regexp_extract(path, pattern, 2),
                   F.lit("-01"))
    start = F.unix_timestamp(F.try_to_timestamp(key, F.lit("yyyy-MM-dd")))
    return F.coalesce(start.between(ARCHIVE_START, ARCHIVE_END), F.lit(False))


def community_file_priority(path: Column, subreddits: Iterable[str]) -> Column:
    """7 for files below a wanted community's folder with a month in range, else 0."""
    low = F.lower(path)
    wanted = F.lit(False)
    for s in sorted({s.lower() for s in subreddits}):
        wanted = wanted | F.contains(low, F.lit(f"/{s}/"))
    ok = F.contains(low, F.lit("/submissions/")) & wanted & _month_in_range(low, r"(\d{4})-(\d{2})")
    return F.when(ok, COMMUNITY_PRIORITY).otherwise(0)


def monthly_file_priority(path: Column) -> Column:
    """6 for monthly dumps RS_YYYY-MM.zst in range, else 0."""
    name = F.substring_index(path, "/", -1)
    pattern = r"(?i)^RS_(\d{4})-(\d{2})\.zst$"
    ok = name.rlike(pattern) & _month_in_range(name, pattern)
    return F.when(ok, MONTHLY_PRIORITY).otherwise(0)


def select_files(paths: DataFrame, subreddits: Iterable[str], column: str = "path") -> DataFrame:
    """Paths worth reading with their priority, the higher of both rules."""
    best = F.greatest(community_file_priority(F.col(column), subreddits),
                      monthly_file_priority(F.col(column)))
    return paths.withColumn("prioridad", best).filter("prioridad > 0")


def scan_archive(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """Lines of (compressed) JSON-lines files with the parsed ``post``; malformed lines dropped.

    The raw line is kept so the sink can write it unchanged.  Compressed archives are not
    splittable: parallelism is the number of files, hence the month-wise layout of the sink.
    """
    lines = spark.read.text(path)
    parsed = add_once(lines, post=F.from_json("value", POST, {
        "mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_corrupt_record"}))
    # A numeric created_utc inside a string is a per-field error: the field is null.
    return parsed.filter(F.col("post").isNotNull() & F.col("post.subreddit").isNotNull())


def keep_posts(scanned: DataFrame, subreddits: Iterable[str], languages: Iterable[str] = LANGUAGES,
               detect: Callable[[Column], Column] = language) -> DataFrame:
    """Wanted community, numeric time in range, wanted language — cheapest test first.

    ``detect`` tells the language of a text: by stop words, or ``LanguageModel.language``.
    """
    wanted = sorted({s.lower() for s in subreddits})
    low = F.lower("post.subreddit")
    timed = F.floor("post.created_utc").between(ARCHIVE_START, ARCHIVE_END)
    text = strip(F.concat(F.coalesce("post.title", F.lit("")), F.lit(" "),
                          F.coalesce("post.selftext", F.lit(""))))
    return scanned.filter(low.isin(wanted) & timed) \
        .filter(detect(text).isin(list(languages))) \
        .withColumn("sub", low) \
        .withColumn("mes", month_key(epoch_timestamp(F.col("post.created_utc"))))


def write_months(kept: DataFrame, path: str, mode: str = "append") -> None:
    """Raw lines below sub=…/mes=…; busy communities are split over several files."""
    kept.select("value", "sub", "mes").hint("rebalance", "sub", "mes") \
        .write.mode(mode).partitionBy("sub", "mes").text(path)

"""Explicit schemas; nothing in the engine infers one. Names of table and message columns are fixed values."""

from pyspark.sql.types import (
    ArrayType,
    DateType,
    DoubleType,
    LongType,
    StringType,
    StructField,
    StructType,
    TimestampType,
)

RAW_EVENT = StructType(
    [
        StructField("event_id", LongType()),
        StructField("type", StringType()),
        StructField(
            "repo",
            StructType([StructField("id", LongType()), StructField("name", StringType())]),
        ),
        StructField("payload", StructType([StructField("head", StringType())])),
        StructField("created_at", TimestampType()),
    ]
)

# The feed's own name for an event's key.
FEED_ID = StructField("id", StringType())

# What is kept of a commit's file: scores and names instead of its text.
FINDING = StructType(
    [
        StructField("repo_name", StringType()),
        StructField("commit_sha", StringType()),
        StructField("entropy_score", DoubleType()),
        StructField("language", StringType()),
        StructField("libraries", ArrayType(StringType())),
    ]
)

# Both message shapes at once: the flat one and the raw event.
PUSH_MESSAGE = StructType(
    [
        StructField("name", StringType()),
        StructField("head", StringType()),
        StructField("pushed_at", TimestampType()),
        StructField("repo", StructType([StructField("name", StringType())])),
        StructField("payload", StructType([StructField("head", StringType())])),
        StructField("created_at", TimestampType()),
    ]
)

COMMIT = StructType(
    [
        StructField("repo_name", StringType()),
        StructField("sha", StringType()),
        StructField(
            "files",
            ArrayType(
                StructType(
                    [StructField("filename", StringType()), StructField("patch", StringType())]
                )
            ),
        ),
    ]
)

# First digits of the hash, the folder level of a commit table laid out for lookups.
SHA_PREFIX = StructField("sha_prefix", StringType())
SHA_PREFIX_LENGTH = 3

TECH_TRENDS = StructType(
    [
        StructField("library_name", StringType(), False),
        StructField("language", StringType()),
        StructField("repo_name", StringType()),
        StructField("detected_at", TimestampType()),
    ]
)

DETECTED_LEAKS = StructType(
    [
        StructField("repo_name", StringType()),
        StructField("commit_sha", StringType(), False),
        StructField("entropy_score", DoubleType()),
        StructField("detected_at", TimestampType()),
    ]
)

WEEKLY_VIBES = StructType(
    [
        StructField("vibe_date", DateType()),
        StructField("theme_name", StringType()),
        StructField("summary", StringType()),
        StructField("top_libraries", ArrayType(StringType())),
    ]
)

REPORT_ITEM = StructType(
    [
        StructField("sector", StringType()),
        StructField("theme", StringType()),
        StructField("summary", StringType()),
        StructField("top_libs", ArrayType(StringType())),
    ]
)

"""Push events, commits, leaks, trends and report answers derived from the given tables.

``events`` become push events and ``documents`` become the files of commits, by
rules that DuckDB can repeat (``testbed/oracle.py``). Nothing is sampled.
"""

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from patchlens.operators.commits import enrich, explode_files
from patchlens.operators.dependencies import trend_rows, with_libraries
from patchlens.operators.events import JSON_TIME, flatten_push
from patchlens.operators.scoring import detect_leaks
from patchlens.plans.reports import parse_responses, vibe_rows
from patchlens.session import configure

# Few of the given texts pass 4.5 bits; 4.0 fills the reports.
THRESHOLD = 4.0
# Single tokens are shorter.
TOKEN_THRESHOLD = 3.5

NOISE = ("the", "of", "and")
SEEDS = {
    "Frontend & UI": ("th", "re"),
    "Backend & API": ("de", "eau"),
    "Data Science & Database": ("an", "er"),
    "Developer Experience & Testing": ("ci", "la"),
}


SCHEMAS = {
    "events": "event_id long, ts timestamp_ntz, user_id long, event_type string, value double, "
    "props string",
    "documents": "doc_id long, text string, lang string, source string, n_chars long",
}


def spread(df: DataFrame) -> DataFrame:
    """Fan the one-file test tables, which are a split or a few, out over the cores of a test machine.

    Eight splits are about a gigabyte; anything larger is left as it is scanned.
    """
    cores = min(8, df.sparkSession.sparkContext.defaultParallelism)
    return df if df.rdd.getNumPartitions() >= cores else df.repartition(cores, "doc_id")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return configure(spark).read.schema(SCHEMAS[name]).parquet(f"{sf_dir}/{name}.parquet")


def _repo(k: Column) -> Column:
    path = F.concat(
        F.lit("owner"), (k % 20).cast("string"), F.lit("/project"), (k % 180).cast("string")
    )
    return F.when(k % 180 == 7, "solo").when(k % 180 == 11, "ab/cde").otherwise(path)


def _sha(c: Column) -> Column:
    return F.sha1(c.cast("string").cast("binary"))


def to_raw_events(events: DataFrame, documents: DataFrame) -> DataFrame:
    """Events as pushes: some without head or name, some to an unknown commit."""
    event_id = F.col("event_id")
    # Counted from the file footers. As a subquery it would be repeated in each
    # of the many places that k is folded into.
    k = event_id % documents.count()
    head = (
        F.when(event_id % 97 == 0, None)
        .when(event_id % 89 == 0, _sha(F.concat(F.lit("gone-"), event_id)))
        .otherwise(_sha(k))
    )
    return events.select(
        "event_id",
        F.when(F.col("event_type") == "error", "WatchEvent").otherwise("PushEvent").alias("type"),
        F.struct(
            F.col("user_id").alias("id"),
            F.when(event_id % 101 == 0, "").otherwise(_repo(k)).alias("name"),
        ).alias("repo"),
        F.struct(head.alias("head")).alias("payload"),
        F.col("ts").cast("timestamp").alias("created_at"),
    )


def raw_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return to_raw_events(table(spark, sf_dir, "events"), table(spark, sf_dir, "documents"))


def pushes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return flatten_push(raw_events(spark, sf_dir))


def to_mixed_messages(events: DataFrame) -> DataFrame:
    """Both message shapes and text that is no JSON, as one queue would hold them."""
    flat = F.struct(
        F.col("repo.name").alias("name"),
        F.col("payload.head").alias("head"),
        F.col("created_at").alias("pushed_at"),
    )
    raw = F.struct("type", "repo", "payload", "created_at")
    shape = F.col("event_id") % 5
    return events.select(
        "event_id",
        F.when(shape == 0, F.concat(F.lit("garbage "), F.col("event_id")))
        .when(shape < 3, F.to_json(flat, JSON_TIME))
        .otherwise(F.to_json(raw, JSON_TIME))
        .alias("value"),
    )


def commits(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents as commits of two files: a source file and, mostly, a manifest."""
    doc_id, text = F.col("doc_id"), F.col("text")
    kind = doc_id % 4
    manifest = (
        F.when(kind == 0, "Requirements.txt")
        .when(kind == 1, "web/package.json")
        .when(kind == 2, "dev-requirements.txt")
        .otherwise("README.md")
    )
    requirements = F.concat(F.lit("+"), F.replace(text, F.lit(" "), F.lit("\n+")))
    package = F.concat(
        F.lit('+  "'), F.replace(text, F.lit(" "), F.lit('": "1",\n+  "')), F.lit('": "1"')
    )
    patch = (
        F.when(kind == 1, package)
        .when(kind != 3, requirements)
        .when(doc_id % 8 == 3, "")
        .otherwise(F.concat(F.lit("+"), text))
    )
    source = F.struct(
        F.lit("src/main.py").alias("filename"), F.when(doc_id % 50 != 0, text).alias("patch")
    )
    added = F.struct(manifest.alias("filename"), patch.alias("patch"))
    return spread(table(spark, sf_dir, "documents").select("doc_id", "text")).select(
        _repo(doc_id).alias("repo_name"), _sha(doc_id).alias("sha"), F.array(source, added).alias("files")
    )


def commit_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents as commits in JSON with more fields than the commit table's; some texts are no commit."""
    doc_id = F.col("doc_id")
    file = F.struct(
        F.lit("src/Main.py").alias("filename"), F.col("text").alias("patch"), F.col("n_chars").alias("changes"),
        F.struct(F.col("source").alias("from")).alias("origin"),
    )
    commit = F.struct(
        F.when(doc_id % 13 != 0, _sha(doc_id)).alias("sha"), _repo(doc_id).alias("repo_name"), "lang", F.array(file).alias("files")
    )
    bare = F.struct(_sha(doc_id).alias("sha"), _repo(doc_id).alias("repo_name"), F.lit("none").alias("files"))
    whole = F.to_json(commit)
    value = (
        F.when(doc_id % 11 == 0, F.concat(whole, F.lit(" tail")))
        .when(doc_id % 11 == 1, F.concat(F.lit("["), whole, F.lit("]")))
        .when(doc_id % 11 == 2, F.to_json(bare))
        .otherwise(whole)
    )
    documents = spread(table(spark, sf_dir, "documents"))
    return documents.select("doc_id", value.alias("value"))


def arriving_commits(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Commits with ``arrived_at``: ten minutes before their first push, or for every tenth two hours after it."""
    first = table(spark, sf_dir, "events").select(F.col("event_id").alias("doc_id"), F.col("ts").cast("timestamp").alias("ts"))
    when = first.withColumn(
        "arrived_at",
        F.when(F.col("doc_id") % 10 == 3, F.col("ts") + F.expr("INTERVAL 2 HOURS")).otherwise(
            F.col("ts") - F.expr("INTERVAL 10 MINUTES")
        ),
    )
    return commits(spark, sf_dir).join(when.select(_sha(F.col("doc_id")).alias("sha"), "arrived_at"), "sha")


def seeds(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A table of keywords from the documents' first words, of one to six letters; the language is the sector."""
    word = F.lower(F.element_at(F.split("text", " "), 1))
    keyword = F.substring(word, F.lit(1), (F.col("doc_id") % 6 + 1).cast("int"))
    rows = table(spark, sf_dir, "documents").select(F.col("lang").alias("sector"), F.ascii("lang").alias("sector_ord"), keyword.alias("keyword"))
    return rows.filter("sector IS NOT NULL AND keyword <> ''").distinct()


def slices(df: DataFrame, time: str, n: int) -> list[DataFrame]:
    """df cut in n slices by time, for a stream to read one after the other."""
    low, high = df.agg(F.unix_timestamp(F.min(time)), F.unix_timestamp(F.max(time))).first()
    step = max(1, (high - low) // n + 1)
    number = F.floor((F.unix_timestamp(time) - F.lit(low)) / F.lit(step))
    return [df.filter(number == k) for k in range(n)]


def files(spark: SparkSession, sf_dir: str) -> DataFrame:
    return explode_files(commits(spark, sf_dir))


def as_of(spark: SparkSession, sf_dir: str) -> Column:
    """The newest event's time, as a subquery of the plan that uses it."""
    return table(spark, sf_dir, "events").select(F.max("ts").cast("timestamp")).scalar()


def leaks(spark: SparkSession, sf_dir: str, threshold: float = THRESHOLD) -> DataFrame:
    found = detect_leaks(files(spark, sf_dir), threshold)
    return enrich(pushes(spark, sf_dir), found).select(
        "repo_name",
        "commit_sha",
        F.round("entropy_score", 12).alias("entropy_score"),
        F.col("pushed_at").alias("detected_at"),
    )


def trends(spark: SparkSession, sf_dir: str) -> DataFrame:
    manifests = with_libraries(files(spark, sf_dir)).filter(F.col("language").isNotNull())
    found = manifests.select("repo_name", "commit_sha", "language", "libraries")
    pushed = enrich(pushes(spark, sf_dir), found).withColumnRenamed("pushed_at", "detected_at")
    return trend_rows(pushed, "detected_at")


def responses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents as a model's answers: good, fenced, cut, trailing, incomplete, no list."""
    doc_id, words = F.col("doc_id"), F.col("words")
    libraries = F.concat(F.lit('["'), F.replace(words, F.lit(" "), F.lit('","')), F.lit('"]'))

    def item(sector: Column, theme: Column, summary: Column | None) -> Column:
        middle = [] if summary is None else [F.lit('", "summary": "'), summary]
        return F.concat(
            F.lit('{"sector": "'), sector, F.lit('", "theme": "'), theme, *middle,
            F.lit('", "top_libs": '), libraries, F.lit("}"),
        )

    first = item(F.col("source"), F.col("lang"), words)
    second = item(F.lit("Backend & API"), F.col("n_chars").cast("string"), F.col("lang"))
    broken = item(F.lit("Backend & API"), F.col("lang"), None)
    good = F.concat(F.lit("["), first, F.lit(", "), second, F.lit("]"))
    shape = doc_id % 9
    response = (
        F.when(shape == 0, F.concat(F.lit("```json\n"), good, F.lit("\n```\n")))
        .when(shape == 1, F.concat(F.lit("oops "), good))
        .when(shape == 2, F.concat(F.lit("["), first, F.lit(", "), broken, F.lit("]")))
        .when(shape == 3, F.concat(good, F.lit(" That is all.")))
        .when(shape == 4, first)
        .otherwise(F.concat(F.lit("\n "), good))
    )
    days = (doc_id % 28).cast("int")
    documents = spread(table(spark, sf_dir, "documents"))
    clean = F.trim(F.regexp_replace("text", "[^A-Za-z0-9]+", " "))
    return documents.withColumn("words", clean).select(
        "doc_id",
        F.date_add(F.lit("2024-01-01").cast("date"), days).alias("answered_on"),
        response.alias("response"),
    )


def vibes(spark: SparkSession, sf_dir: str) -> DataFrame:
    parsed = parse_responses(responses(spark, sf_dir), "answered_on")
    return vibe_rows(parsed, F.col("answered_on"))

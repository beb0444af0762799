"""Every operator as a query over the given tables: name -> f(spark, sf_dir)."""

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from patchlens.functions.masking import mask_repo, mask_segments, mask_sha
from patchlens.functions.report import risk_band, vibe_sector
from patchlens.functions.sql import register_functions
from patchlens.functions.text import manifest_kind
from patchlens.operators import commits as commit_ops
from patchlens.operators import constraints, dependencies, events, filters, scoring, variants
from patchlens.plans import leaks as leak_plans
from patchlens.plans import reports, summaries, trends as trend_plans
from patchlens.session import configure, scratch_path
from patchlens.sources import pages, sinks, streams, tables
from patchlens.streaming import jobs, latest, lookup, metrics, sliding
from testbed import binding
from testbed.binding import NOISE, SEEDS, THRESHOLD, TOKEN_THRESHOLD

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}


def query(fn, name: str | None = None):
    QUERIES[name or fn.__name__] = fn
    return fn


def query_as(name: str):
    return lambda fn: query(fn, name)


def _plain(df: DataFrame) -> DataFrame:
    """For comparison: timestamps without a zone, days as text, scores to six places."""
    shown = {
        "timestamp": lambda c: c.cast("timestamp_ntz"),
        "date": lambda c: c.cast("string"),
        "double": lambda c: F.round(c, 6),
    }
    return df.withColumns(
        {name: shown[kind](F.col(name)) for name, kind in df.dtypes if kind in shown}
    )


# --- events -------------------------------------------------------------------


@query
def push_filter(spark, sf):
    pushes = events.push_events(binding.raw_events(spark, sf))
    return _plain(
        pushes.select(
            "event_id", "type", F.col("repo.id").alias("repo_id"),
            F.col("repo.name").alias("repo_name"), "created_at",
        )
    )


@query
def push_project(spark, sf):
    return _plain(events.flatten_push(binding.raw_events(spark, sf), "event_id"))


@query
def push_messages(spark, sf):
    return events.to_messages(binding.raw_events(spark, sf))


@query
def push_messages_flat(spark, sf):
    return events.to_messages(binding.raw_events(spark, sf), shape="flat", key=None)


@query
def push_parse(spark, sf):
    messages = binding.to_mixed_messages(binding.raw_events(spark, sf))
    return _plain(events.parse_messages(messages, "event_id"))


@query
def push_batch_summary(spark, sf):
    return events.push_batch_summary(binding.raw_events(spark, sf))


def _delivered_twice(raw: DataFrame) -> DataFrame:
    return raw.withColumn("delivery", F.explode(F.array(F.lit(1), F.lit(2)))).drop("delivery")


@query
def push_dedupe(spark, sf):
    unique = events.dedupe_pushes(_delivered_twice(binding.raw_events(spark, sf)))
    return _plain(unique.select("event_id", "type", "created_at"))


# --- commits ------------------------------------------------------------------


@query
def file_explode(spark, sf):
    return binding.files(spark, sf)


@query
def commit_enrich(spark, sf):
    findings = binding.files(spark, sf).select(
        "repo_name", "commit_sha", "filename", F.length("patch").alias("patch_length")
    )
    pushes = events.flatten_push(binding.raw_events(spark, sf), "event_id")
    return _plain(commit_ops.enrich(pushes, findings))


@query
def commit_missing(spark, sf):
    pushes = events.flatten_push(binding.raw_events(spark, sf), "event_id")
    return _plain(commit_ops.commit_missing(pushes, binding.commits(spark, sf)))


@query
def not_null_split(spark, sf):
    heads = binding.raw_events(spark, sf).select(
        "event_id", F.col("repo.name").alias("repo_name"), F.col("payload.head").alias("commit_sha")
    )
    tagged = constraints.tag_not_null(heads, ["repo_name", "commit_sha"])
    return tagged.select(
        "event_id",
        (F.size("violations") == 0).alias("is_valid"),
        F.array_join("violations", ",").alias("violations"),
    )


# --- entropy and dependencies -------------------------------------------------


@query
def patch_entropy(spark, sf):
    scored = scoring.patch_entropy(binding.files(spark, sf), ["commit_sha", "filename"])
    return _plain(scored)


@query
def patch_entropy_native(spark, sf):
    files = binding.files(spark, sf)
    return _plain(scoring.patch_entropy(files, ["commit_sha", "filename"], method="native"))


@query
def leak_detect(spark, sf):
    return _plain(scoring.detect_leaks(binding.files(spark, sf), THRESHOLD))


@query
def token_entropy(spark, sf):
    return _plain(scoring.token_entropy(binding.files(spark, sf), TOKEN_THRESHOLD))


@query_as("manifest_kind")
def manifest_kinds(spark, sf):
    return binding.files(spark, sf).select(
        "commit_sha", "filename", manifest_kind(F.col("filename")).alias("language")
    )


@query
def py_deps(spark, sf):
    return dependencies.py_deps(binding.files(spark, sf))


@query
def js_deps(spark, sf):
    return dependencies.js_deps(binding.files(spark, sf))


@query
def trend_extract(spark, sf):
    return dependencies.extract_trends(binding.files(spark, sf))


# --- leak reports -------------------------------------------------------------


@query
def kpi_24h(spark, sf):
    return _plain(leak_plans.kpi(binding.leaks(spark, sf), binding.as_of(spark, sf)))


@query
def kpi_30d(spark, sf):
    return _plain(leak_plans.kpi(binding.leaks(spark, sf), binding.as_of(spark, sf), hours=720))


@query
def kpi_tiles(spark, sf):
    kpis = leak_plans.kpi(binding.leaks(spark, sf), binding.as_of(spark, sf), hours=720)
    return leak_plans.kpi_tiles(kpis)


def _stored_summaries(spark: SparkSession, sf: str) -> DataFrame:
    out = scratch_path(configure(spark), "leak-hours")
    made = summaries.leak_summaries(binding.leaks(spark, sf), 4.5).withColumn("day", F.to_date("hr"))
    made.write.partitionBy("day").parquet(out)
    return spark.read.schema(made.schema).parquet(out)


@query
def kpi_sketch(spark, sf):
    """KPIs of a day and of a month from one scan of hourly sketches, checked against the exact counts."""
    at = binding.as_of(spark, sf)
    found = summaries.summary_kpi(_stored_summaries(spark, sf), (24, 720), at)
    leaks = binding.leaks(spark, sf).withColumn("hr", F.date_trunc("hour", "detected_at"))
    hours = F.array_compact(F.array(*(F.when(summaries.last_hours(F.col("hr"), h, at), F.lit(h)) for h in (24, 720))))
    exact = leaks.withColumn("hours", F.explode(hours)).groupBy("hours").agg(
        F.count_distinct("commit_sha").alias("commits"), F.count_distinct("repo_name").alias("repos")
    )
    near = lambda a, b: F.abs(F.col(a) - F.col(b)) <= F.ceil(F.col(b) * summaries.distinct_error())
    return _plain(
        found.join(exact, "hours").select(
            "hours", "avg_risk", "critical_count", F.col("commits").alias("total_leaks"), F.col("repos").alias("affected_repos"),
            near("total_leaks", "commits").alias("leaks_in_bound"), near("affected_repos", "repos").alias("repos_in_bound"),
        )
    )


@query
def entropy_quantiles(spark, sf):
    """Quantiles of a month's scores from merged sketches, and whether their exact ranks are within the error."""
    at = binding.as_of(spark, sf)
    ranks = [p / 20 for p in range(21)]
    found = summaries.summary_quantiles(_stored_summaries(spark, sf), ranks, 720, at)
    leaks = binding.leaks(spark, sf).withColumn("hr", F.date_trunc("hour", "detected_at"))
    scores = leaks.filter(summaries.last_hours(F.col("hr"), 720, at))
    # Of equal scores one quantile covers the ranks from below to above. One pass checks all of the few quantiles.
    error, score = F.lit(summaries.SCORE_ERROR) * F.count("*") + 1, F.col("entropy_score")
    checks = [
        F.struct(
            F.lit(r.p).alias("p"),
            F.count("*").alias("scored"),
            (
                (F.count_if(score < r.entropy_score - 1e-12) - error <= r.p * F.count("*"))
                & (r.p * F.count("*") <= F.count_if(score <= r.entropy_score + 1e-12) + error)
            ).alias("in_bound"),
        )
        for r in found.collect()
    ]
    return scores.agg(F.array(*checks).alias("checks")).select(F.inline("checks"))


@query
def entropy_hourly(spark, sf):
    return _plain(leak_plans.entropy_hourly(binding.leaks(spark, sf)))


@query
def entropy_distribution(spark, sf):
    return _plain(
        leak_plans.entropy_distribution(binding.leaks(spark, sf), binding.as_of(spark, sf))
    )


@query
def entropy_histogram(spark, sf):
    leaks = binding.leaks(spark, sf)
    return _plain(leak_plans.entropy_histogram(leaks, binding.as_of(spark, sf), hours=720))


@query
def top_risky_repos(spark, sf):
    return leak_plans.top_risky_repos(binding.leaks(spark, sf), binding.as_of(spark, sf))


@query
def activity_heatmap(spark, sf):
    return leak_plans.activity_heatmap(binding.leaks(spark, sf))


@query
def activity_heatmap_pivot(spark, sf):
    return leak_plans.heatmap_pivot(binding.leaks(spark, sf))


@query
def live_latest_per_repo(spark, sf):
    return leak_plans.live_latest(binding.leaks(spark, sf))


@query
def public_masked_view(spark, sf):
    return _plain(leak_plans.public_security_stream(binding.leaks(spark, sf)))


@query
def mask_variants(spark, sf):
    name, sha = F.col("repo.name"), F.col("payload.head")
    return binding.raw_events(spark, sf).select(
        "event_id",
        mask_segments(name).alias("segments"),
        mask_repo(name, 4, 8).alias("risky"),
        mask_repo(name, 3, 6).alias("live"),
        mask_sha(sha).alias("sha"),
    )


@query_as("risk_band")
def risk_bands(spark, sf):
    scored = scoring.patch_entropy(binding.files(spark, sf), ["commit_sha", "filename"])
    rounded = F.round(F.round("entropy_score", 6), 2)
    return scored.select("commit_sha", "filename", risk_band(rounded).alias("risk"))


# --- trend reports ------------------------------------------------------------


@query
def trend_counts(spark, sf):
    return trend_plans.trend_counts(binding.trends(spark, sf), binding.as_of(spark, sf))


@query
def noise_anti_join(spark, sf):
    counts = trend_plans.trend_counts(binding.trends(spark, sf), binding.as_of(spark, sf))
    noise = binding.table(spark, sf, "documents").select(F.lower("lang").alias("word")).distinct()
    words = noise.unionByName(spark.createDataFrame([(w,) for w in NOISE], "word string"))
    return filters.drop_noise(counts, words)


@query
def tech_trends_top60(spark, sf):
    trends = binding.trends(spark, sf)
    return _plain(trend_plans.tech_trends_top(trends, NOISE, binding.as_of(spark, sf)))


@query
def trend_radar_top12(spark, sf):
    return _plain(
        trend_plans.trend_radar(binding.trends(spark, sf), NOISE, binding.as_of(spark, sf))
    )


@query
def category_libs(spark, sf):
    trends = binding.trends(spark, sf)
    return trend_plans.category_libs(trends, SEEDS, NOISE, binding.as_of(spark, sf))


@query
def category_libs_table(spark, sf):
    """Sectors from a table of keywords instead of a few given ones."""
    trends = binding.trends(spark, sf)
    return trend_plans.category_libs(trends, binding.seeds(spark, sf), NOISE, binding.as_of(spark, sf))


@query
def trend_topk_summary(spark, sf):
    """The exact top 300 of a week from stored daily summaries and a count of the libraries that can be in it."""
    out, trends = scratch_path(configure(spark), "trend-days"), binding.trends(spark, sf)
    summaries.trend_summaries(trends).write.partitionBy("day").parquet(out)
    stored = spark.read.schema("library_name string, n long, missed long, day date").parquet(out)
    return summaries.top_from_summaries(trends, stored, binding.as_of(spark, sf))


@query
def llm_candidates(spark, sf):
    return trend_plans.llm_candidates(binding.trends(spark, sf), NOISE, binding.as_of(spark, sf))


@query
def llm_candidate_list(spark, sf):
    return reports.llm_candidate_list(QUERIES["llm_candidates"](spark, sf))


@query
def sector_top_libraries(spark, sf):
    top = reports.sector_top_libraries(QUERIES["llm_candidates"](spark, sf), SEEDS)
    return top.withColumn("top_libraries", F.array_join("top_libraries", ","))


# --- sector reports -----------------------------------------------------------


@query
def llm_response_parse(spark, sf):
    parsed = reports.parse_responses(binding.responses(spark, sf), "doc_id")
    return parsed.withColumn("top_libs", F.array_join("top_libs", ","))


@query
def vibe_rows(spark, sf):
    rows = _plain(binding.vibes(spark, sf))
    return rows.withColumn("top_libraries", F.array_join("top_libraries", ","))


@query
def vibe_latest(spark, sf):
    latest = _plain(reports.vibe_latest(binding.vibes(spark, sf)))
    return latest.withColumn("top_libraries", F.array_join("top_libraries", ","))


@query_as("vibe_sector")
def vibe_sectors(spark, sf):
    rows = binding.vibes(spark, sf).groupBy(vibe_sector(F.col("theme_name")).alias("sector"))
    return rows.agg(F.count("*").alias("reports"))


# --- sinks and streams --------------------------------------------------------


@query
def leak_table_layout(spark, sf):
    """Write the leaks as a table and read one week of it back by its day partitions."""
    out = scratch_path(configure(spark), "leak-table")
    sinks.recluster(
        binding.leaks(spark, sf).withColumn("detected_date", F.to_date("detected_at")),
        out,
        sinks.LEAK_CLUSTER,
    )
    week = filters.since(tables.leaks(spark, out, streamed=False), "7 DAYS", binding.as_of(spark, sf))
    return _plain(week)


def _event_stream(spark: SparkSession, sf: str) -> DataFrame:
    documents = binding.table(spark, sf, "documents")
    stream = streams.read_push_stream(
        spark,
        "parquet",
        schema=binding.table(spark, sf, "events").schema,
        path=f"{sf}/events.parque[t]",  # a glob, so that a file and a folder of files are read alike
    )
    return binding.to_raw_events(stream, documents)


def _finish(started) -> None:
    started.awaitTermination()


@query
def stream_push_parse(spark, sf):
    out = scratch_path(configure(spark), "parse")
    messages = binding.to_mixed_messages(_event_stream(spark, sf))
    parsed = events.parse_messages(messages, "event_id")
    _finish(jobs.run_append(parsed, f"{out}/rows", f"{out}/checkpoint"))
    rows = spark.read.schema(parsed.schema).parquet(f"{out}/rows")
    return _plain(rows.select("event_id", "name", "head", "pushed_at"))


def _run_both_sinks(spark: SparkSession, sf: str) -> str:
    out = scratch_path(configure(spark), "detect")
    pushes = events.flatten_push(_event_stream(spark, sf))
    started = jobs.run_stream(
        pushes, binding.commits(spark, sf), out, f"{out}/checkpoint", threshold=THRESHOLD
    )
    _finish(started)
    return out


def _counted(df: DataFrame) -> DataFrame:
    return df.groupBy("detected_date").agg(F.count("*").alias("n"))


@query
def stream_leaks_sink(spark, sf):
    leaks = tables.leaks(spark, f"{_run_both_sinks(spark, sf)}/leaks")
    return _plain(leaks.select("repo_name", "commit_sha", "entropy_score", "detected_at"))


@query
def stream_findings_sink(spark, sf):
    """The leaks sink over findings stored once, by hash prefix, instead of the commits' texts."""
    out = scratch_path(configure(spark), "findings")
    sinks.write_findings(jobs.commit_findings(binding.commits(spark, sf), THRESHOLD), f"{out}/findings")
    pushes = events.flatten_push(_event_stream(spark, sf))
    found = tables.read_findings(spark, f"{out}/findings")
    _finish(jobs.run_stream(pushes, found, out, f"{out}/checkpoint", threshold=THRESHOLD))
    leaks = tables.leaks(spark, f"{out}/leaks")
    return _plain(leaks.select("repo_name", "commit_sha", "entropy_score", "detected_at"))


@query
def feed_dedupe(spark, sf):
    """The given events as the feed's pages, delivered twice, read and de-duplicated."""
    out = scratch_path(configure(spark), "feed")
    pages = _delivered_twice(binding.raw_events(spark, sf)).withColumnRenamed("event_id", "id")
    pages.withColumn("id", F.col("id").cast("string")).write.json(
        f"{out}/pages", timestampFormat="yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX"
    )
    unique = events.dedupe_pushes(tables.read_events(spark, f"{out}/pages"))
    return _plain(unique.select("event_id", "type", "created_at"))


@query
def commit_table_lookup(spark, sf):
    """Leaks from a commit table stored by hash prefix and read back."""
    out = scratch_path(configure(spark), "commits")
    sinks.write_commits(binding.commits(spark, sf), f"{out}/commits")
    stored = tables.read_commits(spark, f"{out}/commits", prefixed=True)
    return _plain(scoring.detect_leaks(commit_ops.explode_files(stored), THRESHOLD))


@query
def vibe_table_roundtrip(spark, sf):
    out = scratch_path(configure(spark), "vibes")
    sinks.write_vibes(binding.vibes(spark, sf), f"{out}/vibes")
    rows = _plain(tables.vibes(spark, f"{out}/vibes"))
    return rows.withColumn("top_libraries", F.array_join("top_libraries", ","))


@query
def masked_view_sql(spark, sf):
    tables.register_views(leak_table=binding.leaks(spark, sf))
    return _plain(spark.sql("SELECT * FROM v_public_security_stream"))


FILES = 4  # of a slice, and of a micro-batch


def _add(slice_: DataFrame, folder: str) -> None:
    slice_.repartition(FILES).write.mode("append").parquet(folder)


def _stored(df: DataFrame, path: str) -> DataFrame:
    """df written and read back: its slices then cost a scan each, and not all that df was made by."""
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def _arriving(spark: SparkSession, like: DataFrame, folder: str) -> DataFrame:
    return streams.read_push_stream(spark, "parquet", like.schema, folder, maxFilesPerTrigger=str(FILES))


@query
def stream_commits_sink(spark, sf):
    """Leaks of pushes that meet a stream of commits, in several micro-batches and over a restart.

    Every tenth commit arrives two hours after its push and some never do. What did not meet in time is
    settled from the stored outcomes, half way and at the end.
    """
    out = scratch_path(configure(spark), "meeting")
    pushes = events.flatten_push(binding.raw_events(spark, sf)).withColumn("arrived_at", F.col("pushed_at"))
    commits = binding.arriving_commits(spark, sf)
    last = pushes.agg(F.max("arrived_at")).first()[0]
    # The queue's next rows, a day on: they let the watermark pass the last pushes.
    later = spark.range(1).select(
        F.lit("next/day").alias("name"), F.lit("later").alias("head"), F.lit(last).alias("pushed_at"),
        (F.lit(last) + F.expr("INTERVAL 1 DAY")).alias("arrived_at"),
    )
    commit_later = later.select(F.lit("other").alias("sha"), F.col("name").alias("repo_name"), F.array().cast(commits.schema["files"].dataType).alias("files"), "arrived_at")
    for half in (0, 1):
        for k in (0, 1):
            _add(binding.slices(pushes, "arrived_at", 4)[2 * half + k], f"{out}/pushes")
            _add(binding.slices(commits, "arrived_at", 4)[2 * half + k].select(*commit_later.columns), f"{out}/commits")
        if half:
            later.write.mode("append").parquet(f"{out}/pushes")
            commit_later.write.mode("append").parquet(f"{out}/commits")
        arriving = _arriving(spark, commit_later, f"{out}/commits")
        _finish(lookup.run_findings(arriving, f"{out}/findings", f"{out}/checkpoints/findings", THRESHOLD))
        meeting = jobs.run_stream(
            _arriving(spark, later, f"{out}/pushes"), arriving, f"{out}/facts", f"{out}/checkpoints/meeting",
            threshold=THRESHOLD, arrival=("arrived_at", "arrived_at"),
        )
        _finish(meeting)
        if lookup.dropped_rows(meeting):
            raise RuntimeError("rows came out of order")
        lookup.settle(spark, f"{out}/facts", tables.read_findings(spark, f"{out}/findings", batched=True), THRESHOLD)
    leaks = tables.leaks(spark, f"{out}/facts/leaks")
    return _plain(leaks.select("repo_name", "commit_sha", "entropy_score", "detected_at"))


@query
def stream_quarantine(spark, sf):
    """Fact rows of which some lack their commit: stored, or set aside with the reason, over two runs."""
    out = scratch_path(configure(spark), "quarantine")
    value = binding.table(spark, sf, "events").select("event_id", "value")
    pushes = events.push_events(binding.raw_events(spark, sf)).join(value, "event_id")
    facts = pushes.select(
        F.col("repo.name").alias("repo_name"), F.col("payload.head").alias("commit_sha"),
        F.col("value").alias("entropy_score"), F.col("created_at").alias("detected_at"),
    )
    parts = binding.slices(facts, "detected_at", 4)
    for both in (parts[:2], parts[2:]):
        for part in both:
            _add(part, f"{out}/facts")
        _finish(jobs.run_facts(_arriving(spark, facts, f"{out}/facts"), "leaks", out, f"{out}/checkpoint"))
    stored = tables.leaks(spark, f"{out}/leaks").select(*facts.columns, F.lit("").alias("violations"))
    aside = tables.rejected_rows(spark, f"{out}/rejects/leaks", facts.schema)
    return _plain(stored.unionByName(aside.withColumn("violations", F.array_join("violations", ","))))


@query
def stream_feed_pages(spark, sf):
    """The given events as pages that overlap and of which every second is the one before, read over a restart."""
    out = scratch_path(configure(spark), "feed-pages")
    raw = binding.raw_events(spark, sf).withColumnRenamed("event_id", "id")
    size = 200
    # A page starts with the last events of the page before it.
    pages_of = F.when(F.col("id") % size >= size - 20, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
    paged = raw.withColumn("ahead", F.explode(pages_of)).withColumn("n", F.col("ahead") + F.floor(F.col("id") / size))
    event = F.struct(F.col("id").cast("string").alias("id"), "type", "repo", "payload", "created_at")
    whole = paged.groupBy("n").agg(F.to_json(F.collect_list(event), {"timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX"}).alias("value"))
    twice = whole.withColumn("again", F.explode(F.array(F.lit(0), F.lit(1))))
    sent = twice.select((F.col("n") * 2 + F.col("again")).alias("page"), F.md5("value").alias("etag"), "value")
    half = sent.agg(F.max("page")).first()[0] // 2
    for part in (sent.where(F.col("page") <= half), sent.where(F.col("page") > half)):
        # Each task puts its own pages in place; by default the driver would move every page's file, one after the other.
        placed = part.write.mode("append").option("mapreduce.fileoutputcommitter.algorithm.version", "2")
        placed.partitionBy("page", "etag").text(f"{out}/pages")
        found = pages.feed_events(pages.read_feed_pages(spark, f"{out}/pages"))
        unique = jobs.dedupe_stream(found, delay="31 days").select("event_id", "type", "created_at")
        _finish(jobs.run_append(unique, f"{out}/rows", f"{out}/checkpoint"))
    return _plain(spark.read.schema(unique.schema).parquet(f"{out}/rows").select(*unique.columns))


@query
def stream_live_latest(spark, sf):
    """The latest leak of each repository from keyed state, over micro-batches out of order and a restart."""
    out = scratch_path(configure(spark), "latest")
    leaks = _stored(binding.leaks(spark, sf), f"{out}/all-leaks")
    parts = binding.slices(leaks, "detected_at", 4)
    for two in ((2, 0), (3, 1)):
        for k in two:
            _add(parts[k], f"{out}/leaks")
        _finish(latest.run_latest(_arriving(spark, leaks, f"{out}/leaks"), f"{out}/rows", f"{out}/checkpoint"))
    return leak_plans.live_latest(latest.latest_snapshot(spark, f"{out}/rows"))


@query
def stream_kpi_sliding(spark, sf):
    """KPIs of the day up to every hour, over micro-batches out of order, a compaction and a restart."""
    out = scratch_path(configure(spark), "sliding")
    leaks = _stored(binding.leaks(spark, sf), f"{out}/all-leaks")
    parts = binding.slices(leaks, "detected_at", 4)
    for two in ((2, 0), (3, 1)):
        for k in two:
            _add(parts[k], f"{out}/leaks")
        _finish(sliding.run_sliding(_arriving(spark, leaks, f"{out}/leaks"), f"{out}/hours", f"{out}/checkpoint"))
        if two == (2, 0):
            sliding.compact_hours(spark, f"{out}/hours")
    return _plain(sliding.sliding_kpis(sliding.stored_parts(spark, f"{out}/hours")))


@query
def stream_batch_metrics(spark, sf):
    """Events, pushes and signals, counted in passing by each micro-batch of a job and stored, over a restart."""
    out = scratch_path(configure(spark), "metrics")
    raw = binding.raw_events(spark, sf)
    parts = binding.slices(raw, "created_at", 4)
    for two in (parts[:2], parts[2:]):
        for part in two:
            _add(part, f"{out}/events")
        counted = events.observe_pushes(_arriving(spark, raw, f"{out}/events"))
        with metrics.BatchMetrics(spark, f"{out}/metrics") as listener:
            started = jobs.run_append(events.flatten_push(counted), f"{out}/pushes", f"{out}/checkpoint")
            _finish(started)
            listener.wait(started)
    names = ("total_events", "push_events", "signals")
    value = lambda name: F.sum(F.when(F.col("metric") == name, F.col("value"))).alias(name)
    return metrics.batch_metrics(spark, f"{out}/metrics").agg(*map(value, names))


@query
def commit_variant_files(spark, sf):
    """Files of commits in JSON, with the fields that no schema names."""
    found = variants.commit_files(binding.commit_messages(spark, sf))
    get = lambda rest, name, kind: F.try_variant_get(F.element_at(rest, F.lit(name)), "$", kind)
    return found.select(
        "repo_name", "commit_sha", "filename", "patch",
        get("commit_rest", "lang", "string").alias("lang"),
        get("file_rest", "changes", "bigint").alias("changes"),
        F.array_join(F.array_sort(F.map_keys("commit_rest")), ",").alias("commit_fields"),
        F.array_join(F.array_sort(F.map_keys("file_rest")), ",").alias("file_fields"),
    )


@query
def commit_variant_rejects(spark, sf):
    return variants.commit_reasons(binding.commit_messages(spark, sf), "doc_id")


@query
def llm_response_rejects(spark, sf):
    return reports.response_reasons(binding.responses(spark, sf), "doc_id")


@query
def sql_surface(spark, sf):
    """Masks, scores, bands and dependency names from SQL text alone."""
    register_functions(configure(spark))
    binding.raw_events(spark, sf).createOrReplaceTempView("surface_events")
    binding.files(spark, sf).createOrReplaceTempView("surface_files")
    return spark.sql("""
      SELECT 'mask' AS kind, CAST(event_id AS STRING) AS key, mask_segments(repo.name) AS a,
             mask_repo(repo.name, 4, 8) AS b, mask_sha(payload.head) AS c
      FROM surface_events
      UNION ALL
      SELECT 'score', concat(commit_sha, ':', filename), risk_band(round(round(h, 6), 2)), CAST(h > 0 AS STRING), NULL
      FROM (SELECT commit_sha, filename, shannon_entropy(patch) AS h FROM surface_files)
      UNION ALL
      SELECT 'dependency', commit_sha, library_name, language, repo_name
      FROM (SELECT *, dependencies(filename, patch) AS found FROM surface_files) LATERAL VIEW inline(found) added""")


@query
def stream_trends_sink(spark, sf):
    trends = tables.trends(spark, f"{_run_both_sinks(spark, sf)}/trends")
    return _plain(
        trends.groupBy("library_name", "language").agg(
            F.count("*").alias("n"),
            F.count_distinct("repo_name").alias("repos"),
            F.min("detected_date").alias("first_day"),
            F.max("detected_date").alias("last_day"),
        )
    )


@query
def stream_dual_sink(spark, sf):
    out = _run_both_sinks(spark, sf)
    leaks = _counted(tables.leaks(spark, f"{out}/leaks")).withColumnRenamed("n", "leaks")
    trends = _counted(tables.trends(spark, f"{out}/trends")).withColumnRenamed("n", "trends")
    both = trends.join(leaks, "detected_date", "full_outer").na.fill(0, ["leaks", "trends"])
    return _plain(both)


@query
def stream_dedupe(spark, sf):
    out = scratch_path(configure(spark), "dedupe")
    unique = jobs.dedupe_stream(_delivered_twice(_event_stream(spark, sf)), delay="31 days")
    kept = unique.select("event_id", "type", "created_at")
    _finish(jobs.run_append(kept, f"{out}/rows", f"{out}/checkpoint"))
    rows = spark.read.schema(kept.schema).parquet(f"{out}/rows")
    return _plain(rows.select("event_id", "type", "created_at"))


@query
def stream_entropy_hourly(spark, sf):
    out = scratch_path(configure(spark), "hourly")
    found = scoring.detect_leaks(binding.files(spark, sf), THRESHOLD)
    pushes = events.flatten_push(_event_stream(spark, sf))
    leaks = commit_ops.enrich(pushes, found).withColumnRenamed("pushed_at", "detected_at")
    rounded = leaks.withColumn("entropy_score", F.round("entropy_score", 12))
    _finish(jobs.run_hourly(rounded, f"{out}/hours", f"{out}/checkpoint"))
    return _plain(jobs.hourly_snapshot(spark, f"{out}/hours"))

"""Registered jobs. Each runs over whole tables; sources and sinks run on data that Spark
derives from them and stores in the shared scratch folder."""

from pyspark.sql import functions as F

from repotrends import functions as fn, operators as op, plans, sources as src, streaming
from repotrends.schemas import METADATA

from . import roles as r
from .registry import AI_CTES, ROLE_SQL, SHARE_CTES, SUMMARY_CTES, TREND_CTES, ctes, query

_PUSH_SQL = """
SELECT CAST(event_id AS VARCHAR) AS event_id, 'PushEvent' AS event_type,
       'org/r' || CAST(user_id AS VARCHAR) AS repo_name,
       CASE WHEN event_type = 'click' THEN md5(CAST(event_id AS VARCHAR)) ELSE '' END AS head_sha,
       strftime(ts, '%Y-%m-%dT%H:%M:%SZ') AS created_at
FROM events WHERE event_type IN ('click', 'purchase')"""


IN_ARRAY = 10_000  # rows of a metadata file, about


def _write_metadata(rows, fields, path):
    """Metadata files, each one JSON array: as many to a month (`yymm`) as its rows ask for, dealt by
    repository."""
    months = rows.groupBy("yymm").agg(F.ceil(F.count(F.lit(1)) / IN_ARRAY).alias("parts"))
    part = F.pmod(F.xxhash64("repo_name"), F.col("parts")).alias("part")
    # A reader of whole files takes the first value of each only, so every array gets its own.
    rows.join(F.broadcast(months), "yymm").select("yymm", part, F.struct(*fields).alias("row")).groupBy(
        "yymm", "part").agg(F.to_json(F.collect_list("row")).alias("value")).drop("part").write.option(
        "maxRecordsPerFile", 1).partitionBy("yymm").text(path)


def _summary(spark, sf):
    return plans.monthly_summary(r.pushes(spark, sf), r.metadata(spark, sf), **r.RULES)


def _shares(spark, sf):
    return plans.language_shares(_summary(spark, sf), r.BRANDS)


# --- scans, filters, projections -------------------------------------------------------

@query("event_filter_project", """
SELECT event_id, user_id AS repo_id, ts AS created_at, props AS payload
FROM events WHERE event_type = 'click'""")
def event_filter_project(spark, sf):
    return r.table(spark, sf, "events").filter(F.col("event_type") == "click").select(
        "event_id", F.col("user_id").alias("repo_id"), F.col("ts").alias("created_at"),
        F.col("props").alias("payload"),
    )


@query("json_path_extract", """
SELECT event_id, json_extract_string(props, '$.k') AS k FROM events""")
def json_path_extract(spark, sf):
    return r.table(spark, sf, "events").select(
        "event_id", F.from_json("props", "k string")["k"].alias("k")
    )


@query("event_log_scan", _PUSH_SQL)
def event_log_scan(spark, sf):
    """Gzip event files, malformed lines among them, to flat pushes."""
    return op.push_events(src.read_events(spark, r.stored_log(spark, sf)))


@query("event_text_scan", """
SELECT source AS repo_name, lang AS title, text AS body, source AS head_ref FROM documents""")
def event_text_scan(spark, sf):
    lines = src.read_event_lines(spark, r.stored_log(spark, sf))
    return op.pull_request_events(op.parse_pull_request_lines(lines))


@query("pull_request_scan", """
SELECT source AS repo_name, lang AS title, text AS body, source AS head_ref FROM documents""")
def pull_request_scan(spark, sf):
    return op.pull_request_events(src.read_pull_request_events(spark, r.stored_log(spark, sf)))


@query("malformed_lines", """
SELECT CASE WHEN event_type = 'error' THEN 'malformed' WHEN event_type IN ('click', 'purchase')
            THEN 'PushEvent' WHEN event_type = 'view' THEN 'WatchEvent' ELSE 'ForkEvent' END AS type,
       count(*) AS n_lines
FROM events GROUP BY 1
UNION ALL SELECT 'PullRequestEvent', count(*) FROM documents""")
def malformed_lines(spark, sf):
    """Lines per type; a broken line carries no type and so falls to every type filter."""
    events = src.read_events(spark, r.stored_log(spark, sf))
    return events.groupBy(fn.blank_to(F.col("type"), "malformed").alias("type")).agg(
        F.count(F.lit(1)).alias("n_lines")
    )


@query("incremental_landing", _PUSH_SQL)
def incremental_landing(spark, sf):
    """Two landing runs over the same log: the second finds nothing new."""
    log, out = r.stored_log(spark, sf), src.scratch_path(spark, "landed")
    for _ in range(2):
        streaming.land_new_files(
            streaming.push_stream(spark, log).drop("yymm"), f"{out}/pushes", f"{out}/checkpoint"
        )
    return spark.read.parquet(f"{out}/pushes")


@query("metadata_scan", ctes("heads", "latest") + """
SELECT CAST(repo_name AS VARCHAR) AS repo_name, head_sha, CAST(NULL AS VARCHAR) AS commit_message,
       CAST(NULL AS VARCHAR) AS author_email, 'Unknown' AS primary_language FROM latest""")
def metadata_scan(spark, sf):
    """Monthly metadata as JSON arrays, written and read."""
    latest = op.latest_per_key(
        r.heads(spark, sf), ["yymm", "repo_name"], ["head_sha"], ["created_at", *op.id_order("event_id")])
    rows = latest.select(
        "yymm", F.col("repo_name").cast("string"), "head_sha",
        *(F.lit(None).cast("string").alias(c) for c in ("commit_message", "author_email")),
        F.lit("Unknown").alias("primary_language"),
    )
    path = src.scratch_path(spark, "metadata")
    _write_metadata(rows, METADATA.fieldNames(), path)
    return src.read_metadata(spark, path + "/*")


@query("peek_first_event", """
SELECT event_id, ts, user_id, event_type FROM events WHERE event_type = 'click'
ORDER BY event_id LIMIT 1""")
def peek_first_event(spark, sf):
    events = r.table(spark, sf, "events").select("event_id", "ts", "user_id", "event_type")
    return op.first_event(events, "click", "event_type", ["event_id"])


@query("preview_messages", ctes("messages") + """
SELECT doc_id, repo_name, commit_message FROM messages WHERE commit_message IS NOT NULL
ORDER BY doc_id LIMIT 5""")
def preview_messages(spark, sf):
    rows = r.messages(spark, sf).select("doc_id", "repo_name", "commit_message")
    return op.preview_messages(rows, order=["doc_id"])


@query("text_keyword_match", """
SELECT source AS repo_name, lang AS title, text AS body, '' AS head_ref FROM documents
WHERE regexp_matches(lower(lang || ' ' || text || ' '), 'license|apache|mit')""")
def text_keyword_match(spark, sf):
    return op.ai_pull_requests(r.pull_requests(spark, sf), r.TERMS)


@query("keyword_counts", """
SELECT source AS repo_name, count(*) AS ai_pr_count FROM documents
WHERE regexp_matches(lower(lang || ' ' || text || ' '), 'license|apache|mit')
GROUP BY 1 ORDER BY 2 DESC, 1""")
def keyword_counts(spark, sf):
    matched = op.ai_pull_requests(r.pull_requests(spark, sf), r.TERMS)
    return op.count_by(matched).orderBy(F.desc("ai_pr_count"), "repo_name")


@query("ai_flag", ctes("messages") + """
SELECT doc_id, CASE WHEN regexp_matches(lower(commit_message), 'license|apache|mit')
                      OR lower(author_email) LIKE '%toxic1%' THEN 1 ELSE 0 END AS is_ai
FROM messages""")
def ai_flag(spark, sf):
    return r.messages(spark, sf).select("doc_id", fn.ai_flag(
        F.col("commit_message"), F.col("author_email"), r.TERMS, ("toxic1",)
    ).alias("is_ai"))


@query("task_bucket", ctes("messages") + """
SELECT doc_id, CASE WHEN lower(commit_message) LIKE '%license%' THEN 'feat'
                    WHEN lower(commit_message) LIKE '%the%' OR lower(commit_message) LIKE '%que%'
                    THEN 'fix'
                    WHEN lower(commit_message) LIKE '%der%' THEN 'refactor' ELSE 'chore' END
               AS task_type
FROM messages""")
def task_bucket(spark, sf):
    buckets = (("feat", ("license",)), ("fix", ("the", "que")), ("refactor", ("der",)))
    return r.messages(spark, sf).select(
        "doc_id", fn.first_match_bucket(F.col("commit_message"), buckets).alias("task_type")
    )


@query("unknown_excluded", ctes("messages") + """
SELECT doc_id, primary_language,
       coalesce(nullif(primary_language, ''), 'Unknown') AS with_default
FROM messages WHERE primary_language IS NOT NULL AND primary_language NOT IN ('', 'Unknown')""")
def unknown_excluded(spark, sf):
    lang = F.col("primary_language")
    return r.messages(spark, sf).filter(fn.is_known(lang)).select(
        "doc_id", lang, fn.blank_to(lang, "Unknown").alias("with_default")
    )


@query("unknown_default", ctes("messages") + """
SELECT doc_id, coalesce(nullif(primary_language, ''), 'Unknown') AS primary_language FROM messages""")
def unknown_default(spark, sf):
    return r.messages(spark, sf).select(
        "doc_id", fn.blank_to(F.col("primary_language"), "Unknown").alias("primary_language")
    )


@query("key_guard", ctes("messages") + """
SELECT doc_id FROM messages WHERE repo_name <> '' AND primary_language <> ''""")
def key_guard(spark, sf):
    return r.messages(spark, sf).filter(
        fn.present(F.col("repo_name"), F.col("primary_language"))
    ).select("doc_id")


@query("target_whitelist", """
SELECT p_partkey, p_brand FROM part WHERE p_brand IN ("""
       + ", ".join(f"'{b}'" for b in r.BRANDS) + ")")
def target_whitelist(spark, sf):
    parts = r.table(spark, sf, "part").select("p_partkey", "p_brand")
    return op.target_rows(parts, r.BRANDS, "p_brand")


# --- sinks and round trips -------------------------------------------------------------

def _enriched_messages(spark, sf):
    return r.messages(spark, sf).select(
        "repo_name", F.col("doc_id").cast("string").alias("event_id"),
        F.lit("PushEvent").alias("event_type"), F.lit(None).cast("string").alias("head_sha"),
        F.lit("2026-01-02T15:00:00Z").alias("created_at"),
        "commit_message", "author_email", "primary_language",
    )


@query("tsv_roundtrip", ctes("messages") + """
SELECT repo_name, CAST(doc_id AS VARCHAR) AS event_id, 'PushEvent' AS event_type,
       CAST(NULL AS VARCHAR) AS head_sha, '2026-01-02T15:00:00Z' AS created_at,
       commit_message, author_email, primary_language FROM messages""")
def tsv_roundtrip(spark, sf):
    """Multi-line messages, NULL and empty fields through headered TSV and back."""
    path = src.scratch_path(spark, "enriched")
    src.write_tsv(_enriched_messages(spark, sf), path)
    return src.read_enriched_tsv(spark, path)


@query("tsv_bounded_roundtrip", ctes("messages") + """
SELECT repo_name, CAST(doc_id AS VARCHAR) AS event_id, 'PushEvent' AS event_type,
       CAST(NULL AS VARCHAR) AS head_sha, '2026-01-02T15:00:00Z' AS created_at,
       commit_message, author_email, primary_language, CAST(0 AS BIGINT) AS n_long_files FROM messages""")
def tsv_bounded_roundtrip(spark, sf):
    """The same through files of at most 256 KB, or of one row; and how many files are longer."""
    rows = _enriched_messages(spark, sf)
    stored, path = src.scratch_path(spark, "messages"), src.scratch_path(spark, "enriched")
    rows.write.parquet(stored)
    src.write_bounded_tsv(spark.read.schema(rows.schema).parquet(stored), path, 1 << 18)
    back = src.read_enriched_tsv(spark, path)
    one = back.groupBy(F.input_file_name().alias("path")).agg(F.count(F.lit(1)).alias("n"))
    long = src.list_files(spark, path).filter(F.col("length") > 1 << 18).join(one.filter("n > 1"), "path", "left_semi")
    return back.withColumn("n_long_files", long.agg(F.count(F.lit(1))).scalar())


@query("csv_roundtrip", """
SELECT source AS repo_name, count(*) AS ai_pr_count FROM documents GROUP BY 1""")
def csv_roundtrip(spark, sf):
    counts = op.count_by(r.pull_requests(spark, sf)).orderBy(F.desc("ai_pr_count"), "repo_name")
    path = src.scratch_path(spark, "ai_repos")
    src.write_csv(counts, path)
    return src.read_ai_repos(spark, path)


@query("plain_tsv", ctes(*SUMMARY_CTES) + "SELECT * FROM summary")
def plain_tsv(spark, sf):
    """Headerless TSV of the summary, read back by position."""
    summary = _summary(spark, sf).orderBy(
        "year", "month", F.desc("ai_commits"), "primary_language"
    )
    path = src.scratch_path(spark, "summary")
    src.write_plain_tsv(summary, path)
    return spark.read.schema(summary.schema).option("sep", "\t").csv(path)


@query("write_if_absent", "SELECT event_id, event_type FROM events")
def write_if_absent(spark, sf):
    """A second write to a complete stage changes nothing."""
    events = r.table(spark, sf, "events").select("event_id", "event_type")
    path = src.scratch_path(spark, "once")
    src.write_once(events, path)
    return src.write_once(events.withColumn("event_type", F.lit("again")), path)


@query("month_partitions", ctes("heads", "latest") + "SELECT * FROM latest")
def month_partitions(spark, sf):
    """One folder per month: a second run adds no month that is held."""
    path = src.scratch_path(spark, "targets")
    latest = op.latest_per_key(
        r.heads(spark, sf), ["yymm", "repo_name"], ["head_sha"], ["created_at", *op.id_order("event_id")])
    src.append_missing_months(latest, path)
    return src.append_missing_months(latest.withColumn("head_sha", F.lit("again")), path)


@query("calendar_with_day_31", """
WITH months AS (
    SELECT unnest(generate_series(date_trunc('month', min(o_orderdate)),
                                  date_trunc('month', max(o_orderdate)), INTERVAL 1 MONTH)) AS month
    FROM orders),
dated AS (
    SELECT month, CAST(month AS DATE) + day - 1 AS snapshot_date FROM months, (VALUES (15), (31)) d(day))
SELECT snapshot_date, strftime(snapshot_date, '%Y-%m-%d-15.json.gz') AS file_name FROM dated
WHERE month(snapshot_date) = month(month)""", dates="snapshot_date")
def calendar_with_day_31(spark, sf):
    """Only days that a month has."""
    return op.snapshot_calendar(op.span_of(r.table(spark, sf, "orders"), "o_orderdate"), (15, 31))


@query("peek_text_ids", """
SELECT CAST(event_id AS VARCHAR) AS id, event_type AS type FROM events WHERE event_type = 'click'
ORDER BY event_id LIMIT 1""")
def peek_text_ids(spark, sf):
    """Ids held as text still come in numeric order."""
    events = r.table(spark, sf, "events").select(
        F.col("event_id").cast("string").alias("id"), F.col("event_type").alias("type"))
    return op.first_event(events, "click")


@query("metadata_absent", "SELECT count(*) AS n FROM events WHERE event_type IN ('click', 'purchase')")
def metadata_absent(spark, sf):
    """Pushes stay, with NULL metadata, where there is no metadata file."""
    log = r.stored_log(spark, sf)
    enriched = plans.enriched_pushes(spark, log, log + "/no-such-folder/*.json")
    return enriched.filter("primary_language IS NULL").agg(F.count(F.lit(1)).alias("n"))


@query("blank_lines", """
SELECT doc_id, value FROM (
    SELECT doc_id, unnest(string_split(text, chr(10))) AS value FROM documents) WHERE value <> ''""")
def blank_lines(spark, sf):
    lines = r.table(spark, sf, "documents").select(
        "doc_id", F.explode(F.split("text", "\n")).alias("value")
    )
    return src.drop_blank_lines(lines)


# --- joins and enrichment --------------------------------------------------------------

_ENRICHED_COLS = """repo_name, event_id, event_type, head_sha, created_at, commit_message,
author_email, primary_language"""


@query("metadata_left_join", ctes("pushes", "metadata", "enriched")
       + f"SELECT {_ENRICHED_COLS} FROM enriched")
def metadata_left_join(spark, sf):
    return op.attach_metadata(r.pushes(spark, sf), r.metadata(spark, sf))


@query("metadata_salted_join", ctes("pushes", "metadata", "enriched")
       + f"SELECT {_ENRICHED_COLS} FROM enriched")
def metadata_salted_join(spark, sf):
    """The same join with hot repositories spread by hand."""
    return op.attach_metadata(
        r.pushes(spark, sf), r.metadata(spark, sf), skew="salted", hot_rows=20
    )


@query("metadata_head_match", ctes("pushes", "metadata") + f"""
SELECT {_ENRICHED_COLS} FROM pushes LEFT JOIN metadata USING (repo_name, head_sha)""")
def metadata_head_match(spark, sf):
    return op.attach_metadata(r.pushes(spark, sf), r.metadata(spark, sf), match="head")


_FAN_OUT_PUSHES = """pushes AS (
    SELECT 'c' || c_custkey AS event_id, 'PushEvent' AS event_type, c_custkey AS repo_name,
           CAST(NULL AS VARCHAR) AS head_sha, c_mktsegment AS created_at FROM customer)"""


def _customers(spark, sf):
    return r.table(spark, sf, "customer").select(
        F.concat(F.lit("c"), F.col("c_custkey")).alias("event_id"),
        F.lit("PushEvent").alias("event_type"), F.col("c_custkey").alias("repo_name"),
        F.lit(None).cast("string").alias("head_sha"), F.col("c_mktsegment").alias("created_at"),
    )


def _event_metadata(spark, sf):
    return r.table(spark, sf, "events").select(
        F.col("user_id").alias("repo_name"), F.col("props").alias("commit_message"),
        F.col("event_type").alias("author_email"),
        F.col("event_id").cast("string").alias("primary_language"),
    )


@query("metadata_fan_out", f"""
WITH {_FAN_OUT_PUSHES}
SELECT repo_name, p.event_id, p.event_type, head_sha, created_at, props AS commit_message,
       e.event_type AS author_email, CAST(e.event_id AS VARCHAR) AS primary_language
FROM pushes p LEFT JOIN events e ON p.repo_name = e.user_id""")
def metadata_fan_out(spark, sf):
    """Many metadata rows per key, and keys with none; a hot key may sit on either side."""
    return op.attach_metadata(_customers(spark, sf), _event_metadata(spark, sf), skew="both")


@query("metadata_deduped", f"""
WITH {_FAN_OUT_PUSHES}, one AS (
    SELECT * FROM (
        SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY props, event_type,
                                     CAST(event_id AS VARCHAR)) AS r FROM events) WHERE r = 1)
SELECT repo_name, p.event_id, p.event_type, head_sha, created_at, props AS commit_message,
       e.event_type AS author_email, CAST(e.event_id AS VARCHAR) AS primary_language
FROM pushes p LEFT JOIN one e ON p.repo_name = e.user_id""")
def metadata_deduped(spark, sf):
    return op.attach_metadata(_customers(spark, sf), _event_metadata(spark, sf), dedupe=True)


@query("dominant_category", """
SELECT user_id, coalesce(event_type, 'Other') AS primary_type
FROM (SELECT DISTINCT user_id FROM events)
LEFT JOIN (
    SELECT user_id, event_type FROM (
        SELECT user_id, event_type, row_number() OVER (PARTITION BY user_id
               ORDER BY count(*) DESC, event_type) AS r
        FROM events WHERE event_type IN ('click', 'view') GROUP BY user_id, event_type)
    WHERE r = 1) USING (user_id)""")
def dominant_category(spark, sf):
    """Each user's most frequent type of an allow-list; users without one get the fallback."""
    events = r.table(spark, sf, "events").select("user_id", "event_type")
    counts = events.groupBy("user_id", "event_type").agg(F.count(F.lit(1)).alias("n"))
    best = op.dominant_category(
        counts, "user_id", "event_type", "n", ("click", "view"), "primary_type"
    )
    return op.attach_dominant(events.select("user_id").distinct(), best, "user_id", "primary_type")


@query("language_rows", ctes("source_bytes") + "SELECT * FROM source_bytes")
def language_rows(spark, sf):
    """Per-repository language maps, exploded back to rows."""
    maps = r.language_bytes(spark, sf).groupBy("repo_name").agg(
        F.map_from_entries(F.collect_list(F.struct("language", "bytes"))).alias("breakdown")
    )
    return op.language_rows(maps)


@query("latest_per_key", """
SELECT user_id, props, value FROM (
    SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS r
    FROM events) WHERE r = 1""")
def latest_per_key(spark, sf):
    return op.latest_per_key(
        r.table(spark, sf, "events"), ["user_id"], ["props", "value"], ["ts", "event_id"]
    )


@query("metadata_targets", ctes("heads", "latest", "sampled") + "SELECT * FROM sampled")
def metadata_targets(spark, sf):
    return op.metadata_targets(r.heads(spark, sf), seed="7")


@query("monthly_sample", """
SELECT event_type, user_id FROM (
    SELECT *, row_number() OVER (PARTITION BY event_type ORDER BY
              md5('0' || CAST(user_id AS VARCHAR)), user_id) AS r
    FROM (SELECT DISTINCT event_type, user_id FROM events)) WHERE r <= 10""")
def monthly_sample(spark, sf):
    users = r.table(spark, sf, "events").select("event_type", "user_id").distinct()
    return op.seeded_sample(users, "event_type", "user_id", 10)


@query("large_sample", """
SELECT event_type, event_id FROM (
    SELECT *, row_number() OVER (PARTITION BY event_type ORDER BY
              md5('0' || CAST(event_id AS VARCHAR)), event_id) AS r FROM events) WHERE r <= 1500""")
def large_sample(spark, sf):
    """A sample size beyond the optimizer's own group limit."""
    events = r.table(spark, sf, "events").select("event_type", "event_id")
    return op.seeded_sample(events, "event_type", "event_id", 1500)


# --- aggregations ----------------------------------------------------------------------

@query("monthly_summary", ctes(*SUMMARY_CTES) + "SELECT * FROM summary")
def monthly_summary(spark, sf):
    return _summary(spark, sf)


@query("monthly_summary_counted", ctes(*SUMMARY_CTES) + "SELECT * FROM summary")
def monthly_summary_counted(spark, sf):
    """The route for metadata too large to broadcast: both sides added up before they meet."""
    return op.summary_from_parts(r.pushes(spark, sf), r.metadata(spark, sf), **r.RULES)


@query("monthly_summary_enriched", ctes(*SUMMARY_CTES) + "SELECT * FROM summary")
def monthly_summary_enriched(spark, sf):
    """The summary over enriched rows."""
    enriched = op.attach_metadata(r.pushes(spark, sf), r.metadata(spark, sf))
    return op.monthly_language_summary(enriched, **r.RULES)


@query("distinct_per_group", """
SELECT substr(CAST(l_shipdate AS VARCHAR), 1, 4) AS year,
       substr(CAST(l_shipdate AS VARCHAR), 6, 2) AS month,
       count(DISTINCT l_orderkey) AS unique_orders
FROM lineitem GROUP BY 1, 2""")
def distinct_per_group(spark, sf):
    day = F.col("l_shipdate").cast("date").cast("string")
    return r.table(spark, sf, "lineitem").groupBy(
        fn.year_of(day).alias("year"), fn.month_of(day).alias("month")
    ).agg(F.count_distinct("l_orderkey").alias("unique_orders"))


@query("distinct_repos", "SELECT DISTINCT user_id FROM events")
def distinct_repos(spark, sf):
    return op.distinct_rows(r.table(spark, sf, "events"), "user_id")


@query("unique_repo_count", "SELECT count(DISTINCT l_partkey) AS unique_repos FROM lineitem")
def unique_repo_count(spark, sf):
    return op.distinct_count(r.table(spark, sf, "lineitem"), "l_partkey")


@query("top_repos", """
SELECT user_id AS repo_name, count(*) AS ai_pr_count FROM events GROUP BY 1
ORDER BY 2 DESC, 1 LIMIT 20""")
def top_repos(spark, sf):
    counts = op.count_by(r.table(spark, sf, "events"), "user_id").withColumnRenamed(
        "user_id", "repo_name"
    )
    return op.top_rows(counts, 20, F.desc("ai_pr_count"), "repo_name")


@query("row_counts", """
SELECT 'pushes' AS name, count(*) AS n_rows FROM lineitem
UNION ALL SELECT 'metadata', count(*) FROM part
UNION ALL SELECT 'events', count(*) FROM events""")
def row_counts(spark, sf):
    return op.row_counts(
        pushes=r.pushes(spark, sf), metadata=r.metadata(spark, sf),
        events=r.table(spark, sf, "events"),
    )


@query("summary_key_check", """
SELECT l_orderkey, l_linenumber, count(*) AS n_rows FROM lineitem GROUP BY 1, 2 HAVING count(*) > 1""")
def summary_key_check(spark, sf):
    return op.duplicate_keys(r.table(spark, sf, "lineitem"), ["l_orderkey", "l_linenumber"])


@query("month_start", """
SELECT l_orderkey, l_linenumber, l_partkey,
       CAST(date_trunc('month', l_shipdate) AS DATE) AS date FROM lineitem""", dates="date")
def month_start(spark, sf):
    day = F.col("l_shipdate")
    return r.table(spark, sf, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey",
        fn.month_start(F.year(day), F.month(day)).alias("date"),
    )


@query("files_per_month", """
SELECT strftime(o_orderdate, '%y%m') AS yymm,
       array_to_string(list_sort(list(DISTINCT strftime(o_orderdate, '%Y-%m-%d-15.json.gz'))), ' ')
           AS files
FROM orders GROUP BY 1""")
def files_per_month(spark, sf):
    days = r.table(spark, sf, "orders").select(
        fn.snapshot_file_name(F.col("o_orderdate")).alias("file_name")
    )
    return op.files_per_month(days).withColumn("files", F.array_join("files", " "))


# --- trends ----------------------------------------------------------------------------

@query("month_totals", ctes(*SHARE_CTES)
       + "SELECT date, primary_language, total_commits FROM monthly", dates="date")
def month_totals(spark, sf):
    return op.monthly_volume(op.target_rows(_summary(spark, sf), r.BRANDS))


@query("month_share", ctes(*SHARE_CTES) + "SELECT * FROM shares", dates="date")
def month_share(spark, sf):
    return _shares(spark, sf)


@query("top_languages", ctes(*TREND_CTES) + "SELECT * FROM top8")
def top_languages(spark, sf):
    return op.top_categories(op.target_rows(_summary(spark, sf), r.BRANDS))


@query("share_top8", ctes(*TREND_CTES) + "SELECT * FROM trend ORDER BY date, primary_language", dates="date")
def share_top8(spark, sf):
    return plans.language_share_trend(_summary(spark, sf), r.BRANDS).orderBy(
        "date", "primary_language"
    )


@query("growth_index", ctes(*TREND_CTES, "growth") + "SELECT * FROM growth", dates="date")
def growth_index(spark, sf):
    return plans.language_growth_index(_summary(spark, sf), r.BRANDS)


@query("share_pivot", ctes(*SHARE_CTES) + "SELECT date, " + ", ".join(
    f"max(share) FILTER (primary_language = '{b}') AS \"{b}\"" for b in r.BRANDS
) + " FROM shares GROUP BY date", dates="date")
def share_pivot(spark, sf):
    return op.pivot_series(_shares(spark, sf), r.BRANDS)


@query("share_unpivot", ctes(*SHARE_CTES) + "SELECT date, primary_language, share FROM shares",
       dates="date")
def share_unpivot(spark, sf):
    return op.unpivot_series(op.pivot_series(_shares(spark, sf), r.BRANDS), r.BRANDS)


@query("mix_with_others", ctes(*AI_CTES, "adoption") + """, ranked AS (
    SELECT *, row_number() OVER (ORDER BY ai_pr_count DESC, primary_language) AS r FROM adoption),
mix AS (
    SELECT primary_language, ai_pr_count FROM ranked WHERE r <= 8
    UNION ALL SELECT 'Others', CAST(sum(ai_pr_count) AS BIGINT) FROM ranked WHERE r > 8
    HAVING sum(ai_pr_count) > 0),
shared AS (
    SELECT *, ai_pr_count / CAST((SELECT sum(ai_pr_count) FROM mix) AS DOUBLE) * 100 AS share FROM mix)
SELECT *, printf('%s (%.1f%%)', primary_language, share) AS label FROM shared""")
def mix_with_others(spark, sf):
    return plans.ai_language_mix(r.ai_repos(spark, sf))


@query("activity_vs_adoption", ctes(*SUMMARY_CTES, "monthly", *AI_CTES, "adoption") + """, activity AS (
    SELECT primary_language, CAST(sum(total_commits) AS BIGINT) AS total_commits
    FROM monthly GROUP BY 1)
SELECT primary_language, total_commits, ai_pr_count FROM activity JOIN adoption USING (primary_language)
WHERE total_commits > 0 AND ai_pr_count > 0""")
def activity_vs_adoption(spark, sf):
    return plans.activity_comparison(_summary(spark, sf), r.ai_repos(spark, sf), r.BRANDS)


# --- coverage --------------------------------------------------------------------------

_CALENDAR = """
WITH months AS (
    SELECT unnest(generate_series(date_trunc('month', min(o_orderdate)),
                                  date_trunc('month', max(o_orderdate)), INTERVAL 1 MONTH)) AS month
    FROM orders),
expected AS (
    SELECT CAST(month AS DATE) + day - 1 AS snapshot_date FROM months, (VALUES (2), (9), (16), (23)) d(day)),
named AS (
    SELECT snapshot_date, strftime(snapshot_date, '%Y-%m-%d-15.json.gz') AS file_name FROM expected)"""


@query("snapshot_calendar", _CALENDAR + "SELECT * FROM named", dates="snapshot_date")
def snapshot_calendar(spark, sf):
    """Four snapshots in every month that the orders span."""
    return op.snapshot_calendar(op.span_of(r.table(spark, sf, "orders"), "o_orderdate"), (2, 9, 16, 23))


@query("snapshot_gaps", _CALENDAR + """
SELECT * FROM named WHERE file_name NOT IN (
    SELECT strftime(o_orderdate, '%Y-%m-%d-15.json.gz') FROM orders WHERE o_orderstatus = 'F')""", dates="snapshot_date")
def snapshot_gaps(spark, sf):
    """Expected snapshots on whose day no finished order exists."""
    orders = r.table(spark, sf, "orders")
    held = orders.filter(F.col("o_orderstatus") == "F").select(
        fn.snapshot_file_name(F.col("o_orderdate")).alias("file_name")
    )
    return plans.snapshot_coverage(op.span_of(orders, "o_orderdate"), held, (2, 9, 16, 23))


# --- whole jobs over stored files -------------------------------------------------------

_USERS = """
users AS (
    SELECT DISTINCT user_id, ['Go', 'Rust', 'Python'][user_id % 3 + 1] AS language,
           ['add ', 'fix ', 'refactor ', 'docs ', 'chore '][user_id % 5 + 1]
           || CASE WHEN user_id % 2 = 0 THEN 'by Claude ' ELSE '' END || CAST(user_id AS VARCHAR) AS commit_message
    FROM events)"""


def _stored_metadata(spark, sf, events=None):
    """Monthly metadata files, JSON arrays that together hold all repositories first seen in the month."""
    path = src.scratch_path(spark, "metadata")
    events = events or r.table(spark, sf, "events")
    users = events.groupBy("user_id").agg(F.date_format(F.min("ts"), "yyMM").alias("yymm"))
    task = F.element_at(F.array(*map(F.lit, ("add ", "fix ", "refactor ", "docs ", "chore "))),
                        (F.col("user_id") % 5 + 1).cast("int"))
    by = F.when(F.col("user_id") % 2 == 0, "by Claude ").otherwise("")
    rows = users.select(
        "yymm", F.concat(F.lit("org/r"), F.col("user_id")).alias("repo_name"),
        F.concat(task, by, F.col("user_id")).alias("commit_message"),
        F.element_at(F.array(*map(F.lit, ("Go", "Rust", "Python"))),
                     (F.col("user_id") % 3 + 1).cast("int")).alias("primary_language"),
    )
    _write_metadata(rows, ("repo_name", "commit_message", "primary_language"), path)
    return path + "/*"


_JOB_SQL = """
SELECT substr(created_at, 1, 4) AS year, substr(created_at, 6, 2) AS month, language AS primary_language,
       count(*) AS total_commits, count(DISTINCT repo_name) AS unique_repos,
       count(*) FILTER (user_id % 2 = 0) AS ai_commits,
       count(*) FILTER (user_id % 2 = 0 AND user_id % 5 = 0) AS feat_commits,
       count(*) FILTER (user_id % 2 = 0 AND user_id % 5 = 1) AS fix_commits,
       count(*) FILTER (user_id % 2 = 0 AND user_id % 5 = 2) AS refactor_commits,
       count(*) FILTER (user_id % 2 = 0 AND user_id % 5 = 3) AS docs_commits,
       count(*) FILTER (user_id % 2 = 0 AND user_id % 5 = 4) AS chore_commits
FROM log JOIN users ON repo_name = 'org/r' || CAST(user_id AS VARCHAR)
GROUP BY 1, 2, 3"""


@query("enriched_pushes_job", "WITH log AS (" + _PUSH_SQL + ")," + _USERS + """
SELECT repo_name, event_id, log.event_type, head_sha, created_at, commit_message,
       CAST(NULL AS VARCHAR) AS author_email,
       language AS primary_language
FROM log LEFT JOIN users ON repo_name = 'org/r' || CAST(user_id AS VARCHAR)""")
def enriched_pushes_job(spark, sf):
    """Event files and metadata files to enriched pushes."""
    return plans.enriched_pushes(spark, r.stored_log(spark, sf), _stored_metadata(spark, sf))


@query("activity_job", "WITH log AS (" + _PUSH_SQL + ")," + _USERS + _JOB_SQL)
def activity_job(spark, sf):
    """Event and metadata files to stored pushes, enriched pushes and monthly summary."""
    return plans.run_activity(
        spark, r.stored_log(spark, sf), _stored_metadata(spark, sf), src.scratch_path(spark, "activity")
    )


@query("activity_rerun_job", "WITH log AS (" + _PUSH_SQL + ")," + _USERS + _JOB_SQL)
def activity_rerun_job(spark, sf):
    """The job over half of the event files, and again when the others have arrived."""
    log, out = src.scratch_path(spark, "log"), src.scratch_path(spark, "activity")
    meta = _stored_metadata(spark, sf)
    for half in range(2):
        r.event_log(spark, sf).filter(F.pmod(F.hash("value"), F.lit(2)) == half).write.mode("append").option(
            "compression", "gzip").text(log)
        summary = plans.run_activity(spark, log, meta, out)
    return summary


@query("head_match_summary", ctes("pushes", "metadata") + f""",
enriched AS (SELECT p.*, m.commit_message, m.author_email, m.primary_language
             FROM pushes p LEFT JOIN metadata m USING (repo_name, head_sha)),
classified AS ({ROLE_SQL["classified"]}),
summary AS ({ROLE_SQL["summary"]}) SELECT * FROM summary""")
def head_match_summary(spark, sf):
    """The summary over pushes that match metadata by repository and head."""
    return plans.monthly_summary(r.pushes(spark, sf), r.metadata(spark, sf), match="head", **r.RULES)


@query("ai_pr_repos_job", ctes("source_prs") + "SELECT * FROM source_prs")
def ai_pr_repos_job(spark, sf):
    """Event files to matching pull requests per repository."""
    return plans.ai_pr_repos(spark, r.stored_log(spark, sf), r.TERMS)


@query("ai_repos_with_language_job", ctes("source_prs", "source_bytes", "source_language") + """
SELECT repo_name, ai_pr_count, coalesce(language, 'Other') AS primary_language
FROM (SELECT * FROM source_prs ORDER BY ai_pr_count DESC, repo_name LIMIT 12)
LEFT JOIN source_language USING (repo_name)""")
def ai_repos_with_language_job(spark, sf):
    """The same, with the top repositories' dominant language."""
    repos = plans.ai_pr_repos(spark, r.stored_log(spark, sf), r.TERMS)
    return plans.ai_repos_with_language(repos, r.language_bytes(spark, sf), 12, ("de", "es", "fr"))


# --- stages that follow their files ------------------------------------------------------

_ORDER_USERS = _USERS.replace("FROM events)", "FROM (SELECT o_custkey AS user_id FROM orders))")
_ORDER_LOG = """
SELECT 'org/r' || CAST(o_custkey AS VARCHAR) AS repo_name, strftime(o_orderdate, '%Y-%m-%d') AS created_at
FROM orders"""


@query("activity_follows_files_job", "WITH log AS (" + _ORDER_LOG + ")," + _ORDER_USERS + _JOB_SQL)
def activity_follows_files_job(spark, sf):
    """The job over half the lines of the finished months; then those files are written anew under
    their old names and the other months' files come."""
    log, out = src.scratch_path(spark, "log"), src.scratch_path(spark, "activity")
    lines = r.order_lines(spark, sf)
    users = r.table(spark, sf, "orders").select(F.col("o_custkey").alias("user_id"), F.col("o_orderdate").alias("ts"))
    meta = _stored_metadata(spark, sf, users)
    r.write_named_files(spark, lines.filter("o_orderstatus = 'F' AND o_orderkey % 2 = 0"), log)
    plans.run_activity(spark, log, meta, out, keep_enriched=False)
    r.write_named_files(spark, lines, log)
    return plans.run_activity(spark, log, meta, out, keep_enriched=False)


@query("lookup_list_job", ctes("heads", "latest") + """
SELECT yymm, repo_name, head_sha FROM (
    SELECT *, row_number() OVER (PARTITION BY yymm ORDER BY md5('7' || repo_name), repo_name) AS r
    FROM (SELECT yymm, 'org/r' || CAST(repo_name AS VARCHAR) AS repo_name, head_sha FROM latest)) WHERE r <= 100""")
def lookup_list_job(spark, sf):
    """Repositories to look up, from event files under their real names: first of the months before 1998,
    then of the rest, with the remains of a killed run beside them."""
    log, out = src.scratch_path(spark, "log"), src.scratch_path(spark, "targets")
    lines = r.order_lines(spark, sf)
    r.write_named_files(spark, lines.filter("file < '1998'"), log)
    first = plans.metadata_lookup_list(spark, log, out, seed="7")
    first.select(F.lit("killed").alias("repo_name"), "head_sha", F.lit("9801").alias("yymm")).write.partitionBy(
        "yymm").parquet(f"{out}/rows/attempt=killed")
    r.write_named_files(spark, lines.filter("file >= '1998'"), log)
    return plans.metadata_lookup_list(spark, log, out, seed="7")


@query("folder_gaps", _CALENDAR + """
SELECT * FROM named WHERE file_name NOT IN (
    SELECT strftime(o_orderdate, '%Y-%m-02-15.json.gz') FROM orders WHERE o_orderstatus = 'F')""", dates="snapshot_date")
def folder_gaps(spark, sf):
    """Expected snapshots that a folder of event files lacks, from a listing of it."""
    log = src.scratch_path(spark, "log")
    r.write_named_files(spark, r.order_lines(spark, sf).filter("o_orderstatus = 'F'"), log)
    return plans.folder_coverage(spark, log, op.span_of(r.table(spark, sf, "orders"), "o_orderdate"), (2, 9, 16, 23))


@query("folder_files_per_month", """
SELECT strftime(o_orderdate, '%y%m') AS yymm, max(strftime(o_orderdate, '%Y-%m-02-15.json.gz')) AS files
FROM orders GROUP BY 1""")
def folder_files_per_month(spark, sf):
    log = src.scratch_path(spark, "log")
    r.write_named_files(spark, r.order_lines(spark, sf), log)
    return op.files_per_month(src.list_files(spark, log)).withColumn("files", F.array_join("files", " "))


@query("distinct_by_increments", """
SELECT year(l_shipdate) AS year, month(l_shipdate) AS month, count(DISTINCT l_partkey) AS unique_repos
FROM lineitem GROUP BY 1, 2""", )
def distinct_by_increments(spark, sf):
    """Distinct parts of each month, from bitmaps that two increments left; the second never sees the
    first one's rows."""
    lines = r.table(spark, sf, "lineitem").select(
        F.year("l_shipdate").cast("long").alias("year"), F.month("l_shipdate").cast("long").alias("month"),
        F.col("l_partkey").cast("string").alias("repo"), (F.col("l_orderkey") % 2).alias("half"))
    kept, ids = src.scratch_path(spark, "bitmaps"), src.scratch_path(spark, "ids")
    for half in range(2):
        own = lines.filter(F.col("half") == half)
        numbers = src.extend_dictionary(own.select("repo"), ids)
        op.distinct_bitmaps(own, numbers, "repo", "year", "month").write.mode("append").parquet(kept)
    return op.distinct_count_of_bitmaps(spark.read.parquet(kept), "year", "month")


@query("written_row_counts", """
SELECT 'pushes' AS name, count(*) AS n_rows FROM lineitem
UNION ALL SELECT 'metadata', count(*) FROM part""")
def written_row_counts(spark, sf):
    """Rows of a job's outputs, counted while they are written."""
    out = src.scratch_path(spark, "counted")
    return src.write_counted(pushes=(r.pushes(spark, sf), f"{out}/pushes"),
                             metadata=(r.metadata(spark, sf), f"{out}/metadata"))


@query("pruned_summary", ctes(*SUMMARY_CTES) + "SELECT * FROM summary")
def pruned_summary(spark, sf):
    """The summary with pushes without metadata dropped at the scan."""
    return plans.monthly_summary(r.pushes(spark, sf), r.metadata(spark, sf), prune=True, **r.RULES)


@query("rows_with_partner", """
SELECT o_orderkey, o_custkey FROM orders
WHERE o_custkey IN (SELECT c_custkey FROM customer WHERE c_mktsegment = 'BUILDING')""")
def rows_with_partner(spark, sf):
    """Pruned by key bits, then joined: the join decides."""
    orders = r.table(spark, sf, "orders").select("o_orderkey", "o_custkey")
    chosen = r.table(spark, sf, "customer").filter("c_mktsegment = 'BUILDING'").select(
        F.col("c_custkey").alias("o_custkey"))
    return op.matching_rows(orders, chosen, ["o_custkey"]).join(chosen, "o_custkey", "left_semi").select(
        "o_orderkey", "o_custkey")


_BROKEN_SQL = """
SELECT left(line, length(line) - 12) AS broken_line, true AS named FROM (
    SELECT '{"id":"' || event_id || '","type":"PushEvent","repo":{"name":"org/r' || user_id
           || '"},"payload":{"head":""},"created_at":"' || strftime(ts, '%Y-%m-%dT%H:%M:%SZ') || '"}' AS line
    FROM events WHERE event_type = 'error')"""


@query("broken_lines", _BROKEN_SQL)
def broken_lines(spark, sf):
    """Lines of the log that don't parse, byte for byte, from the parse that stores the events."""
    _, broken = src.store_events(spark, r.stored_log(spark, sf), src.scratch_path(spark, "events"))
    return broken.select("broken_line", F.col("file_name").endswith(".gz").alias("named"))


@query("stored_event_pushes", _PUSH_SQL)
def stored_event_pushes(spark, sf):
    """Pushes of the events stored beside the broken lines."""
    events, _ = src.store_events(spark, r.stored_log(spark, sf), src.scratch_path(spark, "events"))
    return op.push_events(events)


@query("input_report", """
SELECT 'log' AS name, (SELECT count(*) FROM events) + (SELECT count(*) FROM documents) AS n_rows
UNION ALL SELECT 'absent', NULL
UNION ALL SELECT 'languages', count(*) FROM (SELECT DISTINCT source, lang FROM documents)""")
def input_report(spark, sf):
    """Inputs that are there, and one that isn't."""
    log, languages = r.stored_log(spark, sf), src.scratch_path(spark, "languages")
    r.language_bytes(spark, sf).write.parquet(languages)
    return src.input_report(
        spark, log=(src.read_event_lines, log), absent=(src.read_events, log + "/no-such-folder"),
        languages=(src.read_language_bytes, languages))


# --- pushes that lie by repository ---------------------------------------------------------

@query("bucketed_join", ctes("pushes", "metadata", "enriched") + """
SELECT repo_name, event_id, event_type, head_sha, created_at, commit_message, author_email, primary_language
FROM enriched""")
def bucketed_join(spark, sf):
    """Pushes land in buckets, month by month in two writes; the join with the metadata shuffles none of them."""
    pushes = r.pushes(spark, sf)
    rows = pushes.withColumn("yymm", F.concat(F.substring("created_at", 3, 2), F.substring("created_at", 6, 2)))
    table = src.BucketedTable(
        spark, src.scratch_path(spark, "bucketed"), rows.schema, ["repo_name"], 8, hot_rows=10_000)
    for year in ("created_at < '1995'", "created_at >= '1995'"):
        table.write(rows.filter(year))
    return table.join(r.metadata(spark, sf).drop("head_sha")).drop("yymm")


@query("activity_bucketed_job", "WITH log AS (" + _PUSH_SQL + ")," + _USERS + _JOB_SQL)
def activity_bucketed_job(spark, sf):
    """The job with pushes in buckets, run with other metadata first: the second run shuffles metadata only."""
    log, out = r.stored_log(spark, sf), src.scratch_path(spark, "activity")
    for events in (r.table(spark, sf, "events").filter("event_type = 'click'"), None):
        meta = _stored_metadata(spark, sf, events)
        plans.run_activity(spark, log, meta, out, buckets=8)
    return op.monthly_language_summary(plans.stored_enriched(spark, out))

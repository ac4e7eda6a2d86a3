"""Schemas and fixed values shared by every job."""

from pyspark.sql import types as T

# They decide the results and must stay as they are.
TARGET_LANGUAGES = (
    "Python", "JavaScript", "TypeScript", "Java", "Go",
    "C#", "Kotlin", "Swift", "PHP", "Shell",
    "Ruby", "Rust", "C++", "Dart",
)
PR_TERMS = ("claude", "copilot", "gpt", "openai", "anthropic", "gemini", "codex")
COMMIT_TERMS = ("claude", "copilot", "codex", "openclaw")
EMAIL_TERMS = ("anthropic",)
TASK_BUCKETS = (
    ("feat", ("feat", "add")),
    ("fix", ("fix", "bug")),
    ("refactor", ("refactor",)),
    ("docs", ("docs",)),
)
DEFAULT_TASK = "chore"
UNKNOWN_LANGUAGE = "Unknown"
OTHER_LANGUAGE = "Other"
REST_LABEL = "Others"
PUSH_EVENT = "PushEvent"
PULL_REQUEST_EVENT = "PullRequestEvent"
FILE_MONTH_PATTERN = r"^(\d{4})-(\d{2})-"
TOP_REPOS = 5000
TOP_LANGUAGES = 8
SAMPLE_PER_MONTH = 100


def _strings(*names):
    return [T.StructField(n, T.StringType()) for n in names]


# Raw push log line. `payload.commits` is left out on purpose: the source stopped
# sending it, so this schema holds for the whole time range.
EVENT = T.StructType(
    _strings("id", "type")
    + [
        T.StructField("repo", T.StructType(_strings("name"))),
        T.StructField("payload", T.StructType(_strings("head"))),
    ]
    + _strings("created_at")
)

# The part of a log line that the pull-request job reads.
PULL_REQUEST_LINE = T.StructType(
    _strings("type")
    + [
        T.StructField("repo", T.StructType(_strings("name"))),
        T.StructField("payload", T.StructType([
            T.StructField("pull_request", T.StructType(
                _strings("title", "body")
                + [T.StructField("head", T.StructType(_strings("ref")))]
            )),
        ])),
    ]
)

PUSH = T.StructType(_strings("event_id", "event_type", "repo_name", "head_sha", "created_at"))
PULL_REQUEST = T.StructType(_strings("repo_name", "title", "body", "head_ref"))
METADATA = T.StructType(
    _strings("repo_name", "head_sha", "commit_message", "author_email", "primary_language")
)
ENRICHED = T.StructType(
    _strings(
        "repo_name", "event_id", "event_type", "head_sha", "created_at",
        "commit_message", "author_email", "primary_language",
    )
)
SUMMARY_KEYS = ("year", "month", "primary_language")
SUMMARY = T.StructType(
    _strings(*SUMMARY_KEYS)
    + [
        T.StructField(n, T.LongType())
        for n in (
            "total_commits", "unique_repos", "ai_commits", "feat_commits",
            "fix_commits", "refactor_commits", "docs_commits", "chore_commits",
        )
    ]
)
# The tables that the activity job keeps by the month of the files (`yymm`).
PUSHES_BY_MONTH = T.StructType(PUSH.fields + _strings("yymm"))
ENRICHED_BY_MONTH = T.StructType(ENRICHED.fields + _strings("yymm"))
SUMMARY_PARTS = T.StructType(
    _strings("yyyymm", "primary_language")
    + [T.StructField("block", T.LongType()), T.StructField("repos", T.BinaryType())]
    + [f for f in SUMMARY.fields[3:] if f.name != "unique_repos"] + _strings("yymm")
)
AI_REPOS = T.StructType(_strings("repo_name") + [T.StructField("ai_pr_count", T.LongType())])
AI_REPOS_WITH_LANGUAGE = T.StructType(AI_REPOS.fields + _strings("primary_language"))
LANGUAGE_BYTES = T.StructType(
    _strings("repo_name", "language") + [T.StructField("bytes", T.LongType())]
)

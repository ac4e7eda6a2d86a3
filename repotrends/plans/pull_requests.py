"""Pull requests that name an assistant: event files in, repositories with language out."""

from pyspark.sql import DataFrame, SparkSession, functions as F

from ..operators import (
    ai_pull_requests, attach_dominant, count_by, dominant_category, pull_request_events, top_rows,
)
from ..schemas import PR_TERMS, TARGET_LANGUAGES, TOP_REPOS
from ..sources import read_pull_request_events, require_rows, write_once


def ai_pr_repos(spark: SparkSession, log_path, terms=PR_TERMS) -> DataFrame:
    """Matching pull requests per repository, most first."""
    prs = pull_request_events(read_pull_request_events(spark, log_path))
    return count_by(ai_pull_requests(prs, terms)).orderBy(F.desc("ai_pr_count"), "repo_name")


def ai_repos_with_language(ai_repos: DataFrame, languages: DataFrame, top: int = TOP_REPOS,
                           allowed=TARGET_LANGUAGES) -> DataFrame:
    """The top repositories with their dominant language. The list picks its rows out of the
    language table before anything is grouped."""
    best = top_rows(ai_repos, top, F.desc("ai_pr_count"), "repo_name")
    rows = languages.join(best.select("repo_name"), "repo_name", "left_semi")
    return attach_dominant(best, dominant_category(rows, allowed=allowed))


def run_pull_requests(spark: SparkSession, log_path, languages: DataFrame, out: str,
                      terms=PR_TERMS, top: int = TOP_REPOS) -> DataFrame:
    """Store the repository counts and the top list with languages; return the latter in order.
    A stage is redone if files or options differ from what it was made from."""
    log = require_rows(read_pull_request_events(spark, log_path), "the event log")
    made_from = [sorted(log.inputFiles()), list(terms)]
    repos = write_once(ai_pr_repos(spark, log_path, terms), f"{out}/ai_repos", made_from=made_from)
    known = sorted(languages.inputFiles()) or languages.semanticHash()
    named = write_once(ai_repos_with_language(repos, languages, top), f"{out}/ai_repos_with_language",
                       made_from=[*made_from, known, top])
    return named.orderBy(F.desc("ai_pr_count"), "repo_name")

"""Name -> (Spark job, SQL text or None)."""

from pyspark.sql import functions as F

QUERIES = {}
ORACLES = {}


def _text_dates(df):
    """Dates as ISO text, so that the comparison does not hang on either side's date type."""
    return df.select(*(
        F.col(f"`{name}`").cast("string").alias(name) if kind == "date" else F.col(f"`{name}`")
        for name, kind in df.dtypes
    ))


def query(name, sql=None, dates=None):
    """Register a job. `dates` names the date column that both sides return as text."""
    def add(fn):
        QUERIES[name] = (lambda spark, sf: _text_dates(fn(spark, sf))) if dates else fn
        if sql:
            ORACLES[name] = (
                f"SELECT * REPLACE (CAST({dates} AS VARCHAR) AS {dates}) FROM ({sql})" if dates else sql
            )
        return fn
    return add


def ctes(*names):
    """A WITH clause over the named role tables, in order."""
    return "WITH " + ",\n".join(f"{n} AS ({ROLE_SQL[n]})" for n in names)


_BRANDS = ", ".join(f"'Brand#{i}'" for i in range(1, 15))
_COUNTS = ("feat", "fix", "refactor", "docs", "chore")

ROLE_SQL = {
    "pushes": """
        SELECT concat_ws('-', l_orderkey, l_linenumber) AS event_id, 'PushEvent' AS event_type,
               l_partkey AS repo_name, CAST(l_suppkey AS VARCHAR) AS head_sha,
               CAST(CAST(l_shipdate AS DATE) AS VARCHAR) AS created_at
        FROM lineitem""",
    "metadata": """
        SELECT p_partkey AS repo_name, CAST(p_partkey % 100 AS VARCHAR) AS head_sha,
               p_name AS commit_message, p_type AS author_email,
               CASE WHEN p_size < 4 THEN 'Unknown' WHEN p_size = 5 THEN '' ELSE p_brand END
               AS primary_language
        FROM part""",
    "messages": """
        SELECT doc_id, source AS repo_name,
               CASE WHEN quality = 0 THEN NULL ELSE text END AS commit_message,
               'Toxic' || CAST(toxic AS VARCHAR) AS author_email,
               CASE WHEN quality = 1 THEN lang WHEN quality = 0 THEN '' END AS primary_language
        FROM documents LEFT JOIN labels USING (doc_id)""",
    "heads": """
        SELECT strftime(o_orderdate, '%y%m') AS yymm, o_custkey AS repo_name,
               CAST(o_orderkey AS VARCHAR) AS head_sha, o_orderdate, o_orderkey
        FROM orders""",
    "latest": """
        SELECT yymm, repo_name, head_sha FROM (
            SELECT *, row_number() OVER (PARTITION BY yymm, repo_name
                                         ORDER BY o_orderdate DESC, o_orderkey DESC) AS r
            FROM heads) WHERE r = 1""",
    "sampled": """
        SELECT yymm, repo_name, head_sha FROM (
            SELECT *, row_number() OVER (PARTITION BY yymm ORDER BY
                                         md5('7' || CAST(repo_name AS VARCHAR)), repo_name) AS r
            FROM latest) WHERE r <= 100""",
    "enriched": """
        SELECT p.*, m.commit_message, m.author_email, m.primary_language
        FROM pushes p LEFT JOIN metadata m USING (repo_name)""",
    "classified": """
        SELECT substr(created_at, 1, 4) AS year, substr(created_at, 6, 2) AS month,
               primary_language, repo_name,
               CASE WHEN lower(commit_message) LIKE '%red%' OR lower(commit_message) LIKE '%cold%'
                      OR lower(author_email) LIKE '%promo%' THEN 1 ELSE 0 END AS is_ai,
               CASE WHEN lower(commit_message) LIKE '%ring%' OR lower(commit_message) LIKE '%gear%'
                      THEN 'feat'
                    WHEN lower(commit_message) LIKE '%bolt%' THEN 'fix'
                    WHEN lower(commit_message) LIKE '%widget%' THEN 'refactor'
                    WHEN lower(commit_message) LIKE '%plate%' THEN 'docs'
                    ELSE 'chore' END AS task_type
        FROM enriched
        WHERE primary_language IS NOT NULL AND primary_language NOT IN ('Unknown', '')""",
    "summary": """
        SELECT year, month, primary_language, count(*) AS total_commits,
               count(DISTINCT repo_name) AS unique_repos,
               CAST(sum(is_ai) AS BIGINT) AS ai_commits, """ + ", ".join(
        f"CAST(sum(CASE WHEN is_ai = 1 AND task_type = '{t}' THEN 1 ELSE 0 END) AS BIGINT)"
        f" AS {t}_commits" for t in _COUNTS) + """
        FROM classified GROUP BY year, month, primary_language""",
    "monthly": f"""
        SELECT CAST(year || '-' || lpad(month, 2, '0') || '-01' AS DATE) AS date, primary_language,
               CAST(sum(total_commits) AS BIGINT) AS total_commits
        FROM summary WHERE primary_language IN ({_BRANDS}) GROUP BY ALL""",
    "shares": """
        SELECT m.date, primary_language, total_commits, month_total,
               total_commits / CAST(month_total AS DOUBLE) * 100 AS share
        FROM monthly m JOIN (
            SELECT date, CAST(sum(total_commits) AS BIGINT) AS month_total
            FROM monthly GROUP BY date) t ON m.date = t.date""",
    "top8": """
        SELECT primary_language, CAST(sum(total_commits) AS BIGINT) AS total_commits
        FROM monthly GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 8""",
    "trend": "SELECT * FROM shares WHERE primary_language IN (SELECT primary_language FROM top8)",
    "growth": """
        SELECT date, primary_language, share, share / first_value(share) OVER (
                   PARTITION BY primary_language ORDER BY date) * 100 AS growth_index
        FROM trend""",
    "part_brand": f"""
        SELECT p_partkey, CASE WHEN p_brand IN ({_BRANDS}) THEN p_brand ELSE 'Other' END
               AS primary_language
        FROM part""",
    "ai_repos": """
        SELECT l_partkey, ai_pr_count, primary_language FROM (
            SELECT l_partkey, count(*) AS ai_pr_count
            FROM lineitem JOIN orders ON l_orderkey = o_orderkey
            WHERE o_orderpriority = '1-URGENT' GROUP BY 1)
        JOIN part_brand ON l_partkey = p_partkey""",
    "adoption": """
        SELECT primary_language, CAST(sum(ai_pr_count) AS BIGINT) AS ai_pr_count
        FROM ai_repos GROUP BY 1""",
    "source_prs": """
        SELECT source AS repo_name, count(*) AS ai_pr_count FROM documents
        WHERE regexp_matches(lower(lang || ' ' || text || ' ' || source), 'license|apache|mit')
        GROUP BY 1""",
    "source_bytes": """
        SELECT source AS repo_name, lang AS language, CAST(sum(n_chars) AS BIGINT) AS bytes
        FROM documents GROUP BY ALL""",
    "source_language": """
        SELECT repo_name, language FROM (
            SELECT *, row_number() OVER (PARTITION BY repo_name ORDER BY bytes DESC, language) AS r
            FROM source_bytes WHERE language IN ('de', 'es', 'fr')) WHERE r = 1""",
}
SUMMARY_CTES = ("pushes", "metadata", "enriched", "classified", "summary")
SHARE_CTES = (*SUMMARY_CTES, "monthly", "shares")
TREND_CTES = (*SHARE_CTES, "top8", "trend")
AI_CTES = ("part_brand", "ai_repos")

"""Plan shapes that matter once no side is small: run with broadcasts off and tiny thresholds."""

import hashlib
import re

import pytest
from pyspark.sql import functions as F

from repotrends import functions as fn, operators as op, plans, sources as src
from repotrends.schemas import METADATA, PUSH

LARGE = {
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "2000",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "2000",
}


@pytest.fixture
def large(spark):
    old = {k: spark.conf.get(k, None) for k in LARGE}
    for k, v in LARGE.items():
        spark.conf.set(k, v)
    yield spark
    for k, v in old.items():
        spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def final_plan(df):
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan")[0]


def first_plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def hot_pushes(spark, n=20_000):
    """One repository holds a third of all pushes."""
    i = F.col("id")
    return spark.range(0, n, 1, 8).select(
        i.cast("string").alias("event_id"), F.lit("PushEvent").alias("event_type"),
        F.when(i % 3 == 0, "hot").otherwise(F.concat(F.lit("r"), i % 500)).alias("repo_name"),
        F.concat(F.lit("h"), i).alias("head_sha"),
        F.concat(F.lit("2026-0"), 1 + i % 5, F.lit("-02T15:00:00Z")).alias("created_at"),
    ).select(*PUSH.fieldNames())


def metadata(spark):
    i = F.col("id")
    return spark.range(400).select(
        F.when(i == 0, "hot").otherwise(F.concat(F.lit("r"), i)).alias("repo_name"),
        F.lit("h").alias("head_sha"), F.concat(F.lit("fix claude "), i).alias("commit_message"),
        F.lit(None).cast("string").alias("author_email"),
        F.when(i % 3 == 0, "Go").otherwise("Rust").alias("primary_language"),
    ).select(*METADATA.fieldNames())


def test_adaptive_join_splits_a_hot_repository(large):
    joined = op.attach_metadata(hot_pushes(large), metadata(large))
    plan = final_plan(joined)
    assert "SortMergeJoin(skew=true)" in plan and "BroadcastHashJoin" not in plan
    assert joined.count() == 20_000


def test_salted_join_spreads_a_hot_repository(large):
    pushes, md = hot_pushes(large), metadata(large)
    salted = op.attach_metadata(pushes, md, skew="salted", hot_rows=500)
    assert re.search(r"SortMergeJoin(\(skew=true\))? \[repo_name#\d+, salt#\d+\]", final_plan(salted))
    plain = op.attach_metadata(pushes, md)
    assert salted.exceptAll(plain).isEmpty() and salted.count() == plain.count()


def test_hot_metadata_key_is_split_as_well(large):
    pushes = metadata(large).select(
        F.col("repo_name"), F.col("repo_name").alias("event_id"), F.lit("PushEvent").alias("event_type"),
        F.lit("h").alias("head_sha"), F.lit("2026-01").alias("created_at"))
    many = hot_pushes(large).select(
        "repo_name", "head_sha", F.col("event_id").alias("commit_message"),
        F.lit(None).cast("string").alias("author_email"), F.lit("Go").alias("primary_language"))
    both = op.attach_metadata(pushes, many, skew="both")
    assert "SortMergeJoin(skew=true)" in final_plan(both)
    plain = op.attach_metadata(pushes, many)
    assert both.exceptAll(plain).isEmpty() and both.count() == plain.count()


def test_bucketed_pushes_are_not_shuffled(large, tmp_path):
    pushes = hot_pushes(large).withColumn("yymm", F.lit("2601"))
    table = src.BucketedTable(large, str(tmp_path / "t"), pushes.schema, ["repo_name"], 6, hot_rows=500)
    table.write(pushes)
    meta = large.createDataFrame([("hot", "Go"), ("hot", "C"), ("r1", "Rust")], "repo_name string, language string")
    joined = table.join(meta)
    plan = joined._jdf.queryExecution().executedPlan().toString()
    left = plan[plan.index("SortMergeJoin"):plan.index("Exchange hashpartitioning")]
    assert "Bucketed: true" in left and "FileScan parquet spark_catalog" in left
    assert sorted(joined.collect()) == sorted(pushes.join(meta, "repo_name", "left").select(joined.columns).collect())
    # The repository with a third of the rows lies in several buckets, none of which holds much more than its share.
    sizes = [r["n"] for r in table._rows().groupBy(F.input_file_name()).agg(F.count(F.lit(1)).alias("n")).collect()]
    assert len(sizes) == 6 and max(sizes) < 2 * pushes.count() / 6


def test_summary_adds_up_before_the_join(large):
    """The hot repository reaches the join as one row per month."""
    summary = op.summary_from_parts(hot_pushes(large), metadata(large))
    plan = final_plan(summary)
    join = plan.index("SortMergeJoin")
    assert "partial_count(1)" in plan[join:] and "BroadcastHashJoin" not in plan
    want = op.monthly_language_summary(op.attach_metadata(hot_pushes(large), metadata(large)))
    assert sorted(map(tuple, summary.collect())) == sorted(map(tuple, want.collect()))


def test_summary_measures_nothing_beforehand(large):
    """No job runs while the summary is planned, and the metadata is grouped once."""
    tracker = large.sparkContext.statusTracker()
    large.sparkContext.setJobGroup("planning", "planning")
    summary = op.summary_from_parts(hot_pushes(large), metadata(large))
    assert not tracker.getJobIdsForGroup("planning")
    large.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    plan = first_plan(summary)
    assert "BroadcastHashJoin" not in plan and "SortMergeJoin" in plan


def test_distinct_count_has_no_expand(large):
    plan = first_plan(op.monthly_language_summary(op.attach_metadata(hot_pushes(large), metadata(large))))
    assert "Expand" not in plan


def test_trend_reuses_the_monthly_volume(large):
    summary = op.summary_from_parts(hot_pushes(large), metadata(large))
    plan = final_plan(plans.language_share_trend(summary))
    assert "ReusedExchange" in plan
    # no date is parsed below the summary's own grouping
    assert "gettimestamp" not in plan[plan.index("SortMergeJoin"):]


def test_top_rows_of_a_group_meet_in_parts(large, monkeypatch):
    from repotrends.operators import sampling

    df = large.range(10_000).select(
        F.concat(F.lit("260"), F.col("id") % 3).alias("yymm"), F.col("id").alias("repo_name"))
    one = op.top_n_per_group(df, "yymm", 50, [F.md5(F.col("repo_name").cast("string")), F.col("repo_name")])
    assert len(re.findall(r"Exchange hashpartitioning\(yymm#\d+, part#\d+", first_plan(one))) == 1
    monkeypatch.setattr(sampling, "FAN", 2)
    two = op.top_n_per_group(df, "yymm", 50, [F.md5(F.col("repo_name").cast("string")), F.col("repo_name")])
    assert len(re.findall(r"Exchange hashpartitioning\(yymm#\d+, part#\d+", first_plan(two))) == 3
    assert sorted(map(tuple, one.collect())) == sorted(map(tuple, two.collect()))


@pytest.mark.parametrize("n", [100, 5000])
def test_samples_are_found_by_counting(large, n):
    """No window is by month alone, and what is ranked is little more than the sample."""
    df = large.range(30_000).select(
        F.when(F.col("id") % 3 == 0, "2601").otherwise(F.concat(F.lit("26"), F.col("id") % 50 + 10)).alias("yymm"),
        F.col("id").alias("repo_name"))
    found = op.seeded_sample(df, "yymm", "repo_name", n)
    plan = final_plan(found)
    assert re.search(r"Exchange hashpartitioning\(of#\d+, step#\d+", plan) and "partial_count(1)" in plan
    by_month = {}
    for r in df.collect():
        by_month.setdefault(r.yymm, []).append(r.repo_name)
    want = {(m, k) for m, ks in by_month.items()
            for k in sorted(ks, key=lambda k: (hashlib.md5(f"0{k}".encode()).hexdigest(), k))[:n]}
    got = list(map(tuple, found.collect()))
    assert len(got) == len(set(got)) and set(got) == want


def test_pushes_without_metadata_are_not_shuffled(large):
    pushes, md = hot_pushes(large), metadata(large).filter("repo_name in ('r7', 'r8')")
    few, all_ = (op.summary_from_parts(pushes, md, prune=p) for p in (True, False))
    assert sorted(map(tuple, few.collect())) == sorted(map(tuple, all_.collect()))
    plan = first_plan(few)
    at = plan.index("bit_get")
    assert "partial_count(1)" in plan[:at] and "Exchange hashpartitioning(repo_name" in plan[:at]
    kept = op.matching_rows(pushes, md, ["repo_name"])
    assert {r.repo_name for r in kept.select("repo_name").distinct().collect()} == {"r7", "r8"}
    few_bits = op.matching_rows(pushes, md, ["repo_name"], bits=64)   # lets more pass, never less
    assert few_bits.join(md, "repo_name", "left_semi").count() == kept.count()


def test_key_bits_of_nothing_and_of_nulls(large):
    df = large.createDataFrame([(None, "x"), ("a", None), ("a", "x"), ("b", "x")], "k string, h string")
    none = df.filter("false")
    assert op.matching_rows(df, none, ["k"]).count() == 0 and op.matching_rows(none, df, ["k"]).count() == 0
    assert [tuple(r) for r in op.matching_rows(df, df.filter("k = 'a'"), ["k", "h"]).collect()] == [("a", "x")]


def test_top_list_never_sorts_everything(large):
    plan = first_plan(op.top_rows(op.count_by(hot_pushes(large)), 5000, F.desc("ai_pr_count"), "repo_name"))
    assert "TakeOrderedAndProject" in plan and "rangepartitioning" not in plan


def test_a_top_list_is_not_broadcast_unmeasured(large):
    repos = op.count_by(hot_pushes(large))
    langs = large.range(10).select(
        F.col("id").cast("string").alias("repo_name"), F.lit("Go").alias("language"), F.col("id").alias("bytes"))
    for n in (5000, 10**7):
        assert "BroadcastHashJoin" not in first_plan(plans.ai_repos_with_language(repos, langs, n))


def test_event_filter_and_columns_reach_the_scan(spark, tmp_path):
    from repotrends.sources import read_events, read_pull_request_events

    spark.range(1).selectExpr("'{}' AS value").write.text(str(tmp_path / "log"))
    plan = first_plan(op.push_events(read_events(spark, str(tmp_path / "log"))))
    assert "PushedFilters: [IsNotNull(type), EqualTo(type,PushEvent)]" in plan
    counted = op.count_by(op.push_events(read_events(spark, str(tmp_path / "log"))))
    assert "ReadSchema: struct<type:string,repo:struct<name:string>>" in first_plan(counted)
    prs = op.pull_request_events(read_pull_request_events(spark, str(tmp_path / "log")))
    assert "PushedFilters: [IsNotNull(type), EqualTo(type,PullRequestEvent)]" in first_plan(prs)
    assert "pull_request" not in first_plan(op.count_by(prs))


def test_each_line_is_parsed_once(spark, tmp_path):
    spark.range(1).selectExpr("'{}' AS value").write.text(str(tmp_path / "log"))
    lines = spark.read.text(str(tmp_path / "log"))
    plan = first_plan(op.ai_pull_requests(op.pull_request_events(op.parse_pull_request_lines(lines))))
    assert plan.count("from_json") == 1


def test_keyword_search_composes_the_text_once(spark):
    df = spark.createDataFrame([("a",)], "t string")
    plan = first_plan(df.filter(fn.matches_any(fn.compose_text("t"))))
    assert plan.count("lower(") == 1

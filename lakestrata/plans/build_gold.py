"""Silver → gold: read the silver tables, compute every gold dataset, write each one.

Seven datasets: the five reports of ``plans.gold`` plus ``event_languages_df`` (comments with
their detected language) and ``language_stats_df`` (type × language counts). The labelled comments
feed both language datasets, so ``event_languages_df`` is written first and the statistics are
computed from the written table: the detector runs once, the text is written once, and a lost
executor re-reads the table instead of re-running the detector.
"""

from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor

from pyspark.errors import AnalysisException
from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakestrata.functions.text import child_table_name, event_table_name
from lakestrata.operators.aggregates import distinct_values
from lakestrata.plans import comments, gold, language
from lakestrata.plans.silver import FACT_TABLE
from lakestrata.sinks.commits import has_log
from lakestrata.sinks.parquet import write_plain
from lakestrata.sources.table import read_table

PUSH = "PushEvent"
COMMENT_TABLES = ("CommitCommentEvent", "IssueCommentEvent", "PullRequestReviewCommentEvent")


# Columns the reports need of each silver table.
FACT_SCHEMA = (
    "created_at string, id string, type string, actor_login string, actor_display_login string, org_login string, "
    "repo_id bigint, repo_name string"
)
PUSH_SCHEMA = "id string, created_at string, push_id bigint, distinct_size bigint, ref string"
COMMENT_SCHEMA = "id string, created_at string, comment_body string"
COMMITS_SCHEMA = "fact_id string, pos int, message string"


def read_silver(
    spark: SparkSession, silver: str, table: str, schema: str | None = None, days: tuple[str, str] | None = None
) -> DataFrame:
    """A silver table. With ``schema`` (DDL of needed columns) a table that was never written, because
    its event type did not occur, is empty, and columns that no row ever filled are typed nulls.
    ``days``: first and last day to read, both included."""
    try:
        path = f"{silver.rstrip('/')}/{table}"
        # files of one table may differ in their columns: the log, or else the files' merged schema, has all
        logged = has_log(spark, path)
        df = read_table(spark, path, days) if logged else spark.read.option("mergeSchema", "true").parquet(path)
        if days is not None and not logged:
            day = F.col("day").cast("string")
            df = df.where((day >= days[0]) & (day <= days[1]))
    except AnalysisException as e:
        if schema is None or e.getCondition() not in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            raise
        df = spark.range(0).drop("id")
    if schema is not None:
        wanted = T.StructType.fromDDL(schema)
        df = df.withColumns({f.name: F.lit(None).cast(f.dataType) for f in wanted if f.name not in df.columns})
    return df


def label_comments(
    fact: DataFrame,
    comment_tables: list[DataFrame],
    push_commits: DataFrame,
    model: PipelineModel,
    threshold: float = 0.1,
) -> DataFrame:
    """``event_languages``: every gathered comment with its detected code and language."""
    sources = [comments.comment_source(t) for t in comment_tables] + [comments.commit_messages(push_commits)]
    gathered = comments.gather_comments(fact, sources)
    # the join has dealt the texts out by event id: no second shuffle
    coded = language.detect_language(gathered, model, "comment", threshold=threshold, spread=False)
    return language.label_languages(coded)


def build_gold(
    spark: SparkSession,
    silver: str,
    dst: str,
    model: PipelineModel | None = None,
    threshold: float = 0.1,
    max_concurrent: int = 4,
    languages: bool = True,
    days: tuple[str, str] | None = None,
) -> dict[str, str]:
    """Write every gold dataset under ``dst``; the language datasets need a fitted ``model``, and
    leaving them out must be asked for (``languages=False``). ``days`` limits the input.

    The five reports and the language chain are independent jobs; up to ``max_concurrent`` run at
    once (one driver thread each) so small reports fill the executors a big one leaves idle.
    """
    if languages and model is None:
        raise ValueError("the language datasets need a model; pass languages=False to leave them out")
    fact = read_silver(spark, silver, FACT_TABLE, FACT_SCHEMA, days)
    push_name = event_table_name(PUSH)
    push = read_silver(spark, silver, push_name, PUSH_SCHEMA, days)
    base = dst.rstrip("/")
    # one small pass finds the pivot columns for both reports by type (a null type is found by the pivot)
    found = [r["type"] for r in distinct_values(fact, "type").collect()]
    types = sorted(found) if None not in found else None

    def write_languages() -> dict[str, str]:
        tables = [read_silver(spark, silver, event_table_name(t), COMMENT_SCHEMA, days) for t in COMMENT_TABLES]
        commits = read_silver(spark, silver, child_table_name(push_name, "commits"), COMMITS_SCHEMA, days)
        labelled = label_comments(fact, tables, commits, model, threshold)
        out = {"event_languages_df": write_plain(labelled, f"{base}/event_languages_df")}
        stats = language.language_stats(spark.read.parquet(out["event_languages_df"]))
        out["language_stats_df"] = write_plain(stats, f"{base}/language_stats_df")
        return out

    with ThreadPoolExecutor(max_workers=max(1, max_concurrent)) as pool:
        reports = {name: pool.submit(write_plain, df, f"{base}/{name}") for name, df in gold.gold_reports(fact, push, types).items()}
        lang = pool.submit(write_languages) if languages else None
        written = {name: f.result() for name, f in reports.items()}
        if lang is not None:
            written.update(lang.result())
    return written

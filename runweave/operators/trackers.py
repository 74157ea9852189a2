"""Projects and trackers: listings, counters, lifecycle and their runs and files."""

from __future__ import annotations

from datetime import datetime
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from runweave.functions.paths import ancestor_folders
from runweave.operators.ordered import spread_join
from runweave.operators.paging import page_offset
from runweave.schemas import COMPLETED, EXPERIMENT, FAILED, LIVE, LOCAL, RUNNING

# Lifecycle events and the status each one leads to, weakest first.
LIFECYCLE = {"created": 0, "log": RUNNING, "end": COMPLETED, "failed": FAILED}


def _window(column: str, after: datetime | None, before: datetime | None) -> list[Column]:
    if after is not None and before is not None and after > before:
        raise ValueError(f"{column}: `after` cannot be greater than `before`")
    out = []
    if after is not None:
        out.append(F.col(column) > F.lit(after))
    if before is not None:
        out.append(F.col(column) < F.lit(before))
    return out


def _where(df: DataFrame, conditions: list[Column]) -> DataFrame:
    return reduce(lambda d, c: d.where(c), conditions, df)


def list_trackers(
    trackers: DataFrame,
    project_id: str | None = None,
    live: bool = False,
    status: int = 0,
    created_after: datetime | None = None,
    created_before: datetime | None = None,
    updated_after: datetime | None = None,
    updated_before: datetime | None = None,
    offset: int = 0,
    limit: int = 0,
) -> DataFrame:
    """Experiment or live trackers in creation order; ``status`` 0 means any."""
    found = [F.col("tracker_type") == (LIVE if live else EXPERIMENT)]
    if project_id:
        found.append(F.col("project_id") == project_id)
    if status:
        found.append(F.col("status") == status)
    found += _window("created_at", created_after, created_before)
    found += _window("updated_at", updated_after, updated_before)
    order = [F.asc_nulls_last("created_at"), F.asc("id")]
    return page_offset(_where(trackers, found), order, offset, limit)


def list_projects(
    projects: DataFrame,
    project_id_or_name: str = "",
    created_after: datetime | None = None,
    created_before: datetime | None = None,
    updated_after: datetime | None = None,
    updated_before: datetime | None = None,
    offset: int = 0,
    limit: int = 0,
) -> DataFrame:
    """Projects by id or name (empty text means all) and time."""
    found = []
    if project_id_or_name:
        found.append(
            (F.col("id") == project_id_or_name) | (F.col("name") == project_id_or_name)
        )
    found += _window("created_at", created_after, created_before)
    found += _window("updated_at", updated_after, updated_before)
    return page_offset(_where(projects, found), ["id"], offset, limit)


def project_counters(projects: DataFrame, trackers: DataFrame) -> DataFrame:
    """Runs and servings of each project, in all and now active."""
    live = F.col("tracker_type") == LIVE
    experiment = F.col("tracker_type") == EXPERIMENT
    running = F.col("status") == RUNNING
    counts = trackers.groupBy("project_id").agg(
        F.count_if(experiment).alias("total_runs"),
        F.count_if(live).alias("total_servings"),
        F.count_if(experiment & running).alias("runs_counter"),
        F.count_if(live & running).alias("live_counter"),
    )
    joined = projects.select(F.col("id").alias("project_id")).join(counts, "project_id", "left")
    return joined.na.fill(0)


def tracker_status(events: DataFrame) -> DataFrame:
    """Status of each tracker from its lifecycle events (tracker_id, kind).

    Failed wins over completed, completed over running. One ``max`` per tracker, combined before
    the shuffle.
    """
    rank = F.create_map(*[F.lit(x) for pair in LIFECYCLE.items() for x in pair])
    return events.groupBy("tracker_id").agg(F.max(rank[F.col("kind")]).alias("status"))


def tracker_agent_runs(trackers: DataFrame, runs: DataFrame, models: DataFrame) -> DataFrame:
    """Each tracker with the state of the job run or served model behind it.

    ``runs``: job_id, run_id, status; ``models``: deployment_id, model_id, status. Local trackers
    have nothing behind them and pass by without a shuffle.
    """
    agents = runs.select(
        F.lit(1).alias("agent_type"),
        F.col("job_id").alias("group_id"),
        F.col("run_id").alias("instance_id"),
        F.col("status").alias("agent_status"),
    ).unionByName(
        models.select(
            F.lit(2).alias("agent_type"),
            F.col("deployment_id").alias("group_id"),
            F.col("model_id").alias("instance_id"),
            F.col("status").alias("agent_status"),
        )
    )
    local = F.coalesce(F.col("agent_type") == LOCAL, F.lit(True))
    # An instance has few trackers, so these keys do not pile up.
    remote = trackers.where(~local).join(
        agents, ["agent_type", "group_id", "instance_id"], "left"
    )
    alone = trackers.where(local).withColumn("agent_status", F.lit(None).cast("string"))
    return remote.unionByName(alone)


def project_artifacts(projects: DataFrame, trackers: DataFrame, files: DataFrame) -> DataFrame:
    """Files of each tracker: those of its project's store at or under its save location.

    Every file is offered under each folder above it, so the prefix test becomes an equality of
    (store, folder) and no file meets trackers of other folders. ``size`` and other file columns
    stay. Files of one hot folder are spread over tasks.
    """
    placed = trackers.join(
        projects.select(F.col("id").alias("project_id"), "relic_id"), "project_id"
    ).select(
        F.col("id").alias("tracker_id"),
        "relic_id",
        F.rtrim("save_location", F.lit("/")).alias("folder"),
    )
    offered = files.withColumn("folder", F.explode(ancestor_folders("name")))
    return spread_join(offered, placed, ["relic_id", "folder"], ["name"], "inner")

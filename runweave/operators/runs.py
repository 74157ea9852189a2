"""Jobs, runs, servings and references to them."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from runweave.operators.ordered import spread_join
from runweave.schemas import MAX_POLLS


def decode_status(
    jobs: DataFrame, names: Mapping[int, str], status: str = "status", created: str = "created_at"
) -> DataFrame:
    """Status numbers as names and epoch seconds as text."""
    lookup = F.create_map(*[F.lit(x) for pair in names.items() for x in pair])
    return jobs.withColumn(status, F.element_at(lookup, F.col(status))).withColumn(
        created, F.date_format(F.timestamp_seconds(created), "yyyy-MM-dd HH:mm:ss")
    )


def last_n_runs(runs: DataFrame, n: int = 10) -> DataFrame:
    """The ``n`` newest runs of every job.

    Spark limits each map task to ``n`` rows per job before the shuffle (window group limit).
    """
    if n < 1:
        raise ValueError("`n` must be positive")
    newest = Window.partitionBy("job_id").orderBy(F.desc("created_at"), F.desc("run_id"))
    return runs.withColumn("position", F.row_number().over(newest)).where(
        F.col("position") <= n
    )


def run_outcome(attempts: DataFrame, max_polls: int = MAX_POLLS) -> DataFrame:
    """Final state of each run from its attempts (run_id, status, retry_count, max_retries, polls)."""
    failed = (F.col("status") == "ERROR") & (F.col("retry_count") == F.col("max_retries"))
    return (
        attempts.groupBy("run_id")
        .agg(
            F.bool_or(F.col("status") == "COMPLETED").alias("done"),
            F.bool_or(failed).alias("failed"),
            F.bool_or(F.col("polls") > max_polls).alias("late"),
            F.max("retry_count").alias("retry_count"),
        )
        .select(
            "run_id",
            "retry_count",
            F.when(F.col("done"), "COMPLETED")
            .when(F.col("failed"), "ERROR")
            .when(F.col("late"), "TIMEOUT")
            .otherwise("PENDING")
            .alias("outcome"),
        )
    )


def map_progress(runs: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Totals of a parallel map from exit codes (null while running)."""
    code = F.col("exit_code")
    return runs.groupBy(*by).agg(
        F.count(F.lit(1)).alias("total"),
        F.count_if(code == 0).alias("success"),
        F.count_if(code != 0).alias("errored"),
        F.count(code).alias("completed"),
    )


def runs_in_invocation(runs: DataFrame, invocation: DataFrame) -> DataFrame:
    """Runs whose id is in the invocation's id table (run_id)."""
    return runs.join(invocation.select("run_id").distinct(), "run_id", "left_semi")


def outputs_ready(tags: DataFrame, files: DataFrame) -> DataFrame:
    """Each expected output (``output`` of ``tags``) with 1 if the file exists, else 0."""
    present = files.select(F.col("name").alias("output"), F.lit(1).alias("output_found"))
    return tags.join(present.distinct(), "output", "left").na.fill(0, ["output_found"])


def all_outputs_ready(ready: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Whether every output of an invocation is there."""
    return ready.groupBy(*by).agg(
        F.count(F.lit(1)).alias("outputs"),
        F.sum("output_found").alias("found"),
        F.bool_and(F.col("output_found") == 1).alias("all_ready"),
    )


def ordered_collect(inputs: DataFrame, outputs: DataFrame) -> DataFrame:
    """Outputs joined to inputs by tag, in input order (``input_idx``)."""
    return inputs.join(outputs, "tag").orderBy("input_idx")


def resolve_refs(refs: DataFrame, targets: DataFrame, archived: int | str) -> DataFrame:
    """Bulk look-up of references, each with exactly one of ``name`` and ``id``.

    Adds ``resolved_id`` (null for archived targets), ``resolved_name``, and ``problem``:
    ``invalid`` (none or both given), ``missing`` or ``ambiguous`` (a name with several targets).
    Targets are reduced to one row per name before they meet the references.
    """
    given_id = F.coalesce(F.col("id") != "", F.lit(False))
    given_name = F.coalesce(F.col("name") != "", F.lit(False))
    valid = given_id != given_name
    by_id = targets.select(
        F.col("id").alias("ref_key"),
        F.lit("id").alias("ref_kind"),
        F.col("id").alias("hit_id"),
        F.col("name").alias("hit_name"),
        F.col("status").alias("hit_status"),
        F.lit(1).cast("bigint").alias("hits"),
    )
    by_name = (
        targets.groupBy(F.col("name").alias("ref_key"))
        .agg(
            F.min("id").alias("hit_id"),
            F.first("name").alias("hit_name"),
            F.min_by("status", "id").alias("hit_status"),
            F.count(F.lit(1)).alias("hits"),
        )
        .withColumn("ref_kind", F.lit("name"))
    )
    keyed = refs.withColumn(
        "ref_key", F.when(valid, F.when(given_id, F.col("id")).otherwise(F.col("name")))
    ).withColumn(
        "ref_kind", F.when(valid, F.when(given_id, "id").otherwise("name"))
    )
    joined = spread_join(
        keyed, by_id.unionByName(by_name), ["ref_kind", "ref_key"], ["ref_id"]
    )
    single = F.col("hits") == 1
    live = single & (F.col("hit_status") != archived)
    return joined.select(
        *refs.columns,
        F.when(live, F.col("hit_id")).alias("resolved_id"),
        F.when(single, F.col("hit_name")).alias("resolved_name"),
        F.when(F.col("ref_key").isNull(), "invalid")
        .when(F.col("hits").isNull(), "missing")
        .when(~single, "ambiguous")
        .alias("problem"),
    )


def pinned_model(servings: DataFrame, models: DataFrame) -> DataFrame:
    """Servings with their first model (lowest ``position``), null when there is none.

    ``models``: serving_id, position, model_id, model_name, model_created_at.
    """
    first = models.groupBy(F.col("serving_id").alias("id")).agg(
        F.min_by(
            F.struct("model_id", "model_name", "model_created_at"),
            F.struct("position", "model_id"),
        ).alias("m")
    )
    return servings.join(first, "id", "left").select(
        *servings.columns,
        F.col("m.model_id").alias("pinned_id"),
        F.col("m.model_name").alias("pinned_name"),
        F.date_format("m.model_created_at", "yyyy-MM-dd HH:mm:ss").alias("pinned_last_updated"),
    )


def machine_lookup(refs: DataFrame, machines: DataFrame, name: str = "machine") -> DataFrame:
    """Machine specs by ``cloud.machine`` name, letter case aside.

    ``problem`` is ``invalid`` for a name of the wrong form, ``unknown`` for one not listed.
    """
    valid = F.col(name).rlike(r"(?dU)^\w+\.\w+$")
    keyed = refs.withColumn("machine_key", F.when(valid, F.lower(name)))
    specs = machines.withColumn("machine_key", F.lower("name")).drop("name")
    # A machine catalog has some thousand rows: Spark measures it and broadcasts it.
    joined = keyed.join(specs.withColumn("known", F.lit(True)), "machine_key", "left")
    return joined.withColumn(
        "problem",
        F.when(F.col("machine_key").isNull(), "invalid").when(F.col("known").isNull(), "unknown"),
    ).drop("machine_key", "known")


def checkpoint_location(runs: DataFrame, files: DataFrame) -> DataFrame:
    """Path of each run's newest checkpoint, from its config, and whether the file exists.

    ``runs``: experiment_id, config (JSON text). A run without one gets ``problem`` ``missing``.
    """
    name = F.get_json_object("config", "$.latest_checkpoint")
    placed = runs.withColumn("checkpoint", name).withColumn(
        "path", F.when(name.isNotNull(), F.concat_ws("/", "experiment_id", name))
    )
    present = files.select(F.col("name").alias("path"), F.lit(True).alias("exists")).distinct()
    return (
        placed.join(present, "path", "left")
        .withColumn("exists", F.coalesce("exists", F.lit(False)))
        .withColumn("problem", F.when(F.col("checkpoint").isNull(), "missing"))
        .drop("config")
    )

"""Batch inference: the one place where rows leave the JVM."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def in_slices(df: DataFrame, owner: Column, slice_rows: int, out: str = "slice") -> tuple[DataFrame, int]:
    """Give every row the number of a slice of about ``slice_rows`` rows; returns the rows and the count of slices.

    The number is a digest of ``owner``, so rows of one owner are in the same slice (which may exceed ``slice_rows`` for
    it). Other digits of the digest than in ``spread_over_models``, so a slice is asked of all tasks.
    """
    slices = max(1, -(-df.count() // max(slice_rows, 1)))
    digest = F.conv(F.substring(F.md5(F.coalesce(owner.cast("string"), F.lit(""))), 18, 15), 16, 10).cast("long")
    placed = df.withColumn(out, F.pmod(digest, F.lit(slices)).cast("int"))
    return placed.repartitionById(slices, F.col(out)), slices


def spread_over_models(
    df: DataFrame, key: str, models: int, tasks_per_model: int | None = None, out: str = "model_no"
) -> DataFrame:
    """Give every row one of ``models`` endpoints, by a digest of its key as text, in ``tasks_per_model`` partitions each.

    The digest spreads rows evenly whatever the keys are, and a task that is run again asks the same model.
    More tasks per model mean less work to repeat when an executor is lost. Unless given, the session's shuffle
    partitions are shared by the models.
    """
    if tasks_per_model is None:
        tasks_per_model = max(1, int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")) // models)
    tasks = models * tasks_per_model
    digest = F.substring(F.md5(F.coalesce(F.col(key).cast("string"), F.lit(""))), 1, 15)
    placed = df.withColumn("_task", F.pmod(F.conv(digest, 16, 10).cast("long"), F.lit(tasks)).cast("int"))
    spread = placed.repartitionById(tasks, F.col("_task"))
    return spread.withColumn(out, F.pmod(F.col("_task"), F.lit(models))).drop("_task")


def slices_over_models(df: DataFrame, slices: int, models: int, column: str = "slice", out: str = "model_no") -> DataFrame:
    """One task per slice, and one of ``models`` endpoints for each."""
    return df.repartitionById(slices, F.col(column)).withColumn(out, F.pmod(F.col(column), F.lit(models)))


def infer(
    df: DataFrame,
    predict_factory: Callable,
    keep: list[str],
    prompt: str = "prompt",
    model: str | None = None,
    stop: str | None = None,
    batch_rows: int = 256,
) -> DataFrame:
    """Add ``output`` and ``error``: exactly one of them is NULL.

    ``predict_factory(model_no)`` is called once per task and model and returns
    ``predict(list[str]) -> list[str]``, asked for up to ``batch_rows`` prompts at a time. A batch that
    fails is asked again row by row, so only the failing rows carry an error; they stay pending for the
    next run. Only the ``keep`` columns and the prompt travel to Python. A model need not be
    deterministic: write the result once, then read it.
    """
    sent = df.select(*keep, prompt, *([model] if model and model not in keep else []))
    kept = [field for field in sent.schema.fields if field.name in keep]
    schema = T.StructType(
        [*kept, T.StructField("output", T.StringType()), T.StructField("error", T.StringType())]
    )

    def run(batches):
        predictors = {}

        def ask(number, prompts):
            answers = list(predictors[number](prompts))
            if len(answers) != len(prompts):
                raise ValueError("the model returned another number of answers than prompts")
            return answers

        def ask_each(number, prompts):
            for text in prompts:
                try:
                    yield ask(number, [text])[0], None
                except Exception as failure:
                    yield None, f"{type(failure).__name__}: {failure}"

        for batch in batches:
            groups = batch.groupby(model, sort=False) if model else [(0, batch)]
            for number, rows in groups:
                if number not in predictors:
                    predictors[number] = predict_factory(number)  # a model that does not load fails the task
                prompts = rows[prompt].tolist()
                results = []
                for start in range(0, len(prompts), batch_rows):
                    chosen = prompts[start : start + batch_rows]
                    try:
                        results += [(answer, None) for answer in ask(number, chosen)]
                    except Exception:
                        results += ask_each(number, chosen)
                answered = rows[keep].copy()
                answered["output"] = [answer for answer, _ in results]
                answered["error"] = [error for _, error in results]
                yield answered

    answered = sent.mapInPandas(run, schema)
    if stop is not None:
        answered = answered.withColumn("output", F.substring_index("output", stop, 1))
    return answered

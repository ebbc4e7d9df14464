"""Rewrite of a stored table under a new schema, some days at a time, that can be interrupted and resumed.

A step takes the days of one stretch of the calendar. Their rows are changed, written beside the store, counted
and noted as staged; then they replace the folders of these days and the step is noted as done. A run that comes
after an interruption first swaps what is staged and not done: a swap may have been cut off between removing
a day's folder and putting the new one there, and the staged rows are the only whole ones. It then takes the
days that no step has done.

While a rewrite is unfinished the store takes no appends (``store.write_append`` refuses them). It can be read
all the time: ``read_evolved`` reads old and new days together, with nulls for columns that a file lacks, wider
types for narrower stored ones, and renamed columns under their new name.

Cost: rows are read once and written twice; no day is held by one task.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping
from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import store as st
from .counters import counted

DAYS_PER_STEP = 32
EPOCH = date(1970, 1, 1)
STEP = "step string, days array<date>, n_rows long"


def stored_days(spark: SparkSession, path: str) -> list[date]:
    """The days of a store, from the names of its folders."""
    return [date.fromisoformat(name[4:]) for name in st.folders(spark, path) if name.startswith("day=") and name[4:5].isdigit()]


def _old_names(schema: T.StructType, renamed: Mapping[str, str]) -> list[T.StructField]:
    return [T.StructField(old, schema[new].dataType) for old, new in renamed.items()]


def _under_new_names(rows: DataFrame, schema: T.StructType, renamed: Mapping[str, str]) -> DataFrame:
    """Each renamed column is taken under its new name, or under the old one where a file lacks the new."""
    old = {new: old for old, new in renamed.items()}
    return rows.select(*(F.coalesce(c, old[c]).alias(c) if c in old else F.col(c) for c in schema.names), "day")


def read_evolved(spark: SparkSession, path: str, schema: T.StructType, renamed: Mapping[str, str] | None = None) -> DataFrame:
    """A store whose days may be under the old or the new schema, in the columns of ``schema`` and ``day``; ``renamed`` maps old names to new."""
    renamed = renamed or {}
    read = T.StructType([*schema.fields, *_old_names(schema, renamed), T.StructField("day", T.DateType())])
    if not st.exists(spark, path):
        return spark.createDataFrame([], T.StructType([*schema.fields, T.StructField("day", T.DateType())]))
    return _under_new_names(spark.read.schema(read).parquet(path), schema, renamed)


def rewrite_store(
    spark: SparkSession,
    path: str,
    schema: T.StructType,
    change: Callable[[DataFrame], DataFrame],
    name: str,
    renamed: Mapping[str, str] | None = None,
    ts: str = "timestamp",
    days_per_step: int = DAYS_PER_STEP,
    steps: int | None = None,
) -> DataFrame:
    """Bring every day of a store under ``schema`` (without ``day``); gives the steps noted so far (step, days, n_rows).

    ``change`` works row by row, on the columns of ``schema`` and ``day``, and keeps the number of rows and their days;
    a step that loses or adds rows is an error and leaves the store as it was. ``name`` names the rewrite: a later
    call goes on where it ended, and does nothing once all days are done. ``steps`` bounds the steps of this call.
    """
    work, mark = f"{path}.rewrite/{name}", st.rewrite_mark(path)
    whole = T.StructType([*schema.fields, T.StructField("day", T.DateType())])
    if others := [x for x in st.folders(spark, mark) if x != name]:
        raise ValueError(f"{path} is being rewritten by {others[0]}: finish that first")

    def noted(kind: str = "done") -> DataFrame:
        return spark.read.schema(STEP).parquet(f"{work}/{kind}/*") if st.folders(spark, f"{work}/{kind}") else spark.createDataFrame([], STEP)

    def note(kind: str, step: str, days: list[date], n: int) -> None:
        spark.createDataFrame([(step, days, n)], STEP).coalesce(1).write.mode("overwrite").parquet(f"{work}/{kind}/{step}")

    def stage(step: str, days: list[date]) -> None:
        rows, before = counted(read_evolved(spark, path, schema, renamed).filter(F.col("day").isin(days)), n=F.count("*"))
        new = change(rows).select(*(F.col(f.name).cast(f.dataType) for f in schema.fields), "day")
        new, after = counted(new, n=F.count("*"), moved=F.count_if(~F.to_date(ts).eqNullSafe(F.col("day"))))
        new.write.mode("overwrite").partitionBy("day").parquet(f"{work}/rows/{step}")
        was, now = before.get.get("n") or 0, after.get.get("n") or 0
        if was != now or after.get.get("moved"):
            raise ValueError(f"rewrite {name}, {step}: {was} rows became {now}, {after.get.get('moved')} of them on other days")
        note("staged", step, days, now)

    def swap(step: str, days: list[date]) -> None:
        staged = spark.read.schema(whole).parquet(f"{work}/rows/{step}").drop("day")
        rows, seen = counted(st.by_day(staged, ts), n=F.count("*"))
        rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("day").parquet(path)
        note("done", step, days, seen.get.get("n") or 0)

    st.make_folder(spark, f"{mark}/{name}")
    for x in noted("staged").join(noted(), "step", "left_anti").collect():
        swap(x.step, x.days)
    finished = {d for x in noted().select("days").collect() for d in x.days}
    stretches: dict[int, list[date]] = {}
    for d in stored_days(spark, path):
        if d not in finished:
            stretches.setdefault((d - EPOCH).days // days_per_step, []).append(d)
    for i, days in enumerate(stretches.values()):
        if i == steps:
            return noted()
        step = f"{days[0]}_{days[-1]}_{len(days)}"
        try:
            stage(step, days)
        except ValueError:
            if noted().isEmpty():
                st.remove_folder(spark, mark)
            raise
        swap(step, days)
    st.remove_folder(spark, mark)
    return noted()

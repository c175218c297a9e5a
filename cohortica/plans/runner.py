"""Runs registered stages in order, with resume, skip and a status table."""

from __future__ import annotations

import time
import traceback
import warnings
from collections.abc import Callable
from dataclasses import dataclass, field
from datetime import UTC, datetime

from pyspark.sql import DataFrame, SparkSession

from cohortica.sources.readers import exists
from cohortica.sources.writers import write_table


@dataclass(frozen=True)
class Stage:
    """run: tables by name -> tables by name. outputs: those that it writes."""

    number: int
    name: str
    run: Callable[[SparkSession, dict[str, DataFrame]], dict[str, DataFrame]]
    outputs: tuple[str, ...] = ()
    required: bool = True


@dataclass
class Options:
    resume_from: int | None = None
    stop_after: int | None = None
    continue_on_error: bool = False
    force_rerun: bool = True
    warnings_are_errors: bool = False
    overwrite_log: bool = True
    echo: bool = False
    tables: dict[str, DataFrame] = field(default_factory=dict)


STATUS = "stage int, name string, required boolean, status string, started double, seconds double, duration string, n_warnings int, error string, outputs array<string>, outputs_complete boolean"


def duration(seconds: float) -> str:
    if seconds < 60:
        return f"{seconds:.1f} s"
    return f"{seconds / 60:.1f} min" if seconds < 3600 else f"{seconds / 3600:.1f} h"


LOG = "at string, line string"


def write_log(spark: SparkSession, path: str, *parts: object, echo: bool = True, overwrite: bool = False) -> str:
    """Adds a line, "time | text", to the log in the folder path, and gives it. Each line is a file of its own, since shared stores can't append to one."""
    at = datetime.now(UTC).isoformat(timespec="microseconds")
    line = f"{at} | {''.join(map(str, parts))}"
    spark.createDataFrame([(at, line)], LOG).coalesce(1).write.mode("overwrite" if overwrite else "append").json(path)
    if echo:
        print(line)
    return line


def read_log(spark: SparkSession, path: str) -> DataFrame:
    """at, line in order of time; a log that isn't there has no lines."""
    lines = spark.read.schema(LOG).json(path) if exists(spark, path) else spark.createDataFrame([], LOG)
    return lines.orderBy("at", "line")


def run_stages(spark: SparkSession, stages: list[Stage], folder: str, options: Options | None = None) -> DataFrame:
    """One status row per stage. Outputs are Parquet under folder, and later stages read them from there, so a lost executor never costs an earlier stage.

    The log (read_log of folder/run_log) has a line when the run and each stage begin and end, and one for each warning.
    """
    o = options or Options()
    chosen = [s for s in sorted(stages, key=lambda s: s.number) if (o.resume_from is None or s.number >= o.resume_from) and (o.stop_after is None or s.number <= o.stop_after)]
    if not chosen:
        raise ValueError("no stage is left to run")
    path = lambda n: f"{folder.rstrip('/')}/{n}.parquet"
    log = lambda *parts, first=False: write_log(spark, f"{folder.rstrip('/')}/run_log", *parts, echo=o.echo, overwrite=first)
    log(f"{len(chosen)} stages from {chosen[0].number} to {chosen[-1].number}", first=o.overwrite_log)
    tables, rows, failed = dict(o.tables), [], None
    for s in stages:
        if s not in chosen:
            tables |= {n: spark.read.parquet(path(n)) for n in s.outputs if exists(spark, path(n))}
    for s in chosen:
        began, error, found = time.time(), None, []
        log(f"stage {s.number} ({s.name}) begins")
        done = bool(s.outputs) and all(exists(spark, path(n)) for n in s.outputs)
        if done and not o.force_rerun:
            status = "SKIPPED_OUTPUTS_EXIST"
        else:
            try:
                with warnings.catch_warnings(record=True) as found:
                    warnings.simplefilter("always")
                    for n, df in s.run(spark, tables).items():
                        write_table(df, path(n))
                if found and o.warnings_are_errors:
                    raise RuntimeError(str(found[0].message))
                status = "SUCCESS"
            except Exception as e:  # noqa: BLE001  what a stage raises is its status
                status, error = "FAILED", "".join(traceback.format_exception_only(e)).strip()
        complete = all(exists(spark, path(n)) for n in s.outputs)
        if status != "FAILED":
            tables |= {n: spark.read.parquet(path(n)) for n in s.outputs if exists(spark, path(n))}
        took = time.time() - began
        for w in found:
            log(f"stage {s.number} ({s.name}) warns: {w.message}")
        log(f"stage {s.number} ({s.name}) {status} after {duration(took)}", f": {error}" if error else "")
        rows.append((s.number, s.name, s.required, status, began, took, duration(took), len(found), error, list(s.outputs), complete))
        if status == "FAILED" and s.required:
            failed = s
            if not o.continue_on_error:
                break
    out = spark.createDataFrame(rows, STATUS)
    write_table(out, path("pipeline_status"))
    log("the run ", "failed" if failed is not None else "has ended")
    if failed is not None and not o.continue_on_error:
        raise RuntimeError(f"stage {failed.number} ({failed.name}) failed: {rows[-1][8]}")
    return out


def status_counts(status: DataFrame) -> DataFrame:
    return status.groupBy("status").count()

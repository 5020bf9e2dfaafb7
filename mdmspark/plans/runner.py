"""All jobs of a date in one run.

Jobs name the jobs they need. Those that need nothing more are handed to Spark
at the same time, each from a thread that carries its own fair pool, so a small
dimension does not wait behind the fact. A blocked gate or an error stops only
the jobs that need it. What came of each is one row of a report.
"""

from __future__ import annotations

import datetime as dt
import re
from collections.abc import Callable, Mapping, Sequence
from concurrent.futures import FIRST_COMPLETED, ThreadPoolExecutor, wait
from dataclasses import dataclass

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, SparkSession

from mdmspark.operators.quality import QualityGateError
from mdmspark.plans.publish import ENTITIES, PublishError, process_snapshot
from mdmspark.plans.staging import ReconcileError, stage_table
from mdmspark.sources.files import parse_snapshot_date

DONE, BLOCKED, FAILED, SKIPPED = "done", "blocked", "failed", "skipped"
REPORT = "job string, status string, rows long, failed_rule string"


@dataclass(frozen=True)
class Job:
    name: str
    run: Callable[[], int]
    """does the work and gives the rows it wrote"""
    needs: tuple[str, ...] = ()


@dataclass(frozen=True)
class JobResult:
    job: str
    status: str
    rows: int | None = None
    failed_rule: str | None = None
    """the first error rule of a blocked gate, or the kind of error"""
    error: BaseException | None = None


def _order(jobs: Sequence[Job]) -> None:
    """Raise for a name twice, an unknown need or a circle."""
    names = [j.name for j in jobs]
    if len(set(names)) != len(names):
        raise ValueError(f"job names occur twice: {sorted({n for n in names if names.count(n) > 1})}")
    open_ = {j.name: set(j.needs) for j in jobs}
    if unknown := sorted(set().union(*open_.values(), ()) - set(names)):
        raise ValueError(f"unknown jobs are needed: {unknown}")
    while open_:
        free = [n for n, needs in open_.items() if not needs & open_.keys()]
        if not free:
            raise ValueError(f"jobs need each other in a circle: {sorted(open_)}")
        for n in free:
            del open_[n]


def _outcome(job: Job, error: BaseException | None, rows: int | None) -> JobResult:
    if error is None:
        return JobResult(job.name, DONE, rows)
    if isinstance(error, QualityGateError):
        return JobResult(job.name, BLOCKED, None, re.split("[=]", error.result.errors[0])[0], error)
    if isinstance(error, (ReconcileError, PublishError)):
        return JobResult(job.name, BLOCKED, None, type(error).__name__, error)
    return JobResult(job.name, FAILED, None, type(error).__name__, error)


def run_jobs(spark: SparkSession, jobs: Sequence[Job], at_once: int = 4) -> list[JobResult]:
    """Run ``jobs``, at most ``at_once`` at a time, each after those it needs;
    their results in the order given. Errors are results, too, so that one
    job's failure stops only the jobs that need it (``skipped``)."""
    _order(jobs)
    done: dict[str, JobResult] = {}
    waiting = list(jobs)
    running = {}

    def start(job: Job):
        def work() -> int:
            # The pool is a property of this thread (it counts where spark.scheduler.mode is FAIR).
            spark.sparkContext.setLocalProperty("spark.scheduler.pool", job.name)
            return job.run()

        return inheritable_thread_target(spark)(work)

    with ThreadPoolExecutor(max_workers=at_once) as threads:
        while waiting or running:
            for job in list(waiting):
                before = [done.get(n) for n in job.needs]
                if any(b is not None and b.status != DONE for b in before):
                    done[job.name] = JobResult(job.name, SKIPPED, None, next(b.job for b in before if b is not None and b.status != DONE))
                    waiting.remove(job)
                elif all(b is not None for b in before):
                    running[threads.submit(start(job))] = job
                    waiting.remove(job)
            if running:
                for future in wait(running, return_when=FIRST_COMPLETED).done:
                    job, error = running.pop(future), future.exception()
                    done[job.name] = _outcome(job, error, None if error else future.result())
    return [done[j.name] for j in jobs]


def daily_jobs(
    spark: SparkSession,
    sources: Mapping[str, Callable[[], DataFrame]],
    stg_root: str,
    prc_root: str,
    snapshot_date: str | dt.date,
    entities: Sequence[str] | None = None,
    **options,
) -> list[Job]:
    """A staging job for each source table and a processing job for each entity
    whose table is among them; ``options`` go to the processing jobs."""
    d = parse_snapshot_date(snapshot_date)

    def stage(table: str) -> Callable[[], int]:
        return lambda: stage_table(spark, sources[table](), f"{stg_root.rstrip('/')}/{table}", d, table=table).snapshot_rows

    def process(entity: str) -> Callable[[], int]:
        return lambda: process_snapshot(spark, entity, stg_root, prc_root, d, **options).written_rows

    chosen = [e for e in (ENTITIES if entities is None else entities) if ENTITIES[e].source_table in sources]
    return [*(Job(f"stage {t}", stage(t)) for t in sources), *(Job(e, process(e), (f"stage {ENTITIES[e].source_table}",)) for e in chosen)]


def report(spark: SparkSession, results: Sequence[JobResult]) -> DataFrame:
    """One row a job."""
    return spark.createDataFrame([(r.job, r.status, r.rows, r.failed_rule) for r in results], REPORT)

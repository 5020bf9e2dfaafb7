"""Entity pipelines (E1-E6): projection, de-duplication, quality gates and
publication of the master-data tables."""

from mdmspark.plans.cards import build_cards
from mdmspark.plans.entity import Entity
from mdmspark.plans.mcc_codes import build_mcc_codes
from mdmspark.plans.merchant import build_merchant
from mdmspark.plans.publish import ENTITIES, PublishError, PublishReport, process_snapshot, publish_entity
from mdmspark.plans.runner import Job, JobResult, daily_jobs, report, run_jobs
from mdmspark.plans.staging import ReconcileError, StageReport, stage_from_jdbc, stage_table
from mdmspark.plans.sub_transactions import build_sub_transactions
from mdmspark.plans.users import build_users

__all__ = [
    "ENTITIES",
    "Entity",
    "Job",
    "JobResult",
    "PublishError",
    "PublishReport",
    "ReconcileError",
    "StageReport",
    "build_cards",
    "build_mcc_codes",
    "build_merchant",
    "build_sub_transactions",
    "build_users",
    "daily_jobs",
    "process_snapshot",
    "publish_entity",
    "report",
    "run_jobs",
    "stage_from_jdbc",
    "stage_table",
]

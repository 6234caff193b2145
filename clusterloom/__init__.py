"""Cleaning, checking and clustering of numeric tables as Spark jobs."""

from clusterloom.config import JobConfig
from clusterloom.database import JdbcTable
from clusterloom.plans.job import JobResult, run_job

__all__ = ["JdbcTable", "JobConfig", "JobResult", "run_job"]

"""The monthly job (``job``) and the registry of queries over it (``registry``)."""

from zerobill.plans.job import AlarmPlan, run_month

__all__ = ["AlarmPlan", "run_month"]

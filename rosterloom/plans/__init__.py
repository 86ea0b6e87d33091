"""The people-data job: contract, flows, rules and the consolidated run."""

from rosterloom.plans.config import CheckLimits, ConfigError, Enrichment, FlowConfig, JobConfig
from rosterloom.plans.flows import FLOWS, Built, Flow, register
from rosterloom.plans.people import PEOPLE_CONTRACT
from rosterloom.plans.rules import RuleResult, Severity
from rosterloom.plans.job import RunError, RunResult, run

__all__ = [
    "FLOWS",
    "PEOPLE_CONTRACT",
    "Built",
    "CheckLimits",
    "ConfigError",
    "Enrichment",
    "Flow",
    "FlowConfig",
    "JobConfig",
    "RuleResult",
    "RunError",
    "RunResult",
    "Severity",
    "register",
    "run",
]

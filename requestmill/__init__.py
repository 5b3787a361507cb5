"""Cleaning, merging and reporting of service-request records on Spark."""

from requestmill.plans.increment import RunConfig, run_increment
from requestmill.plans.transform import transform
from requestmill.session import build_session, session_conf

__all__ = ["RunConfig", "build_session", "run_increment", "session_conf", "transform"]

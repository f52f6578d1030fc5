"""Composite jobs: the daily run as a plan, its publish step and its audit."""

from dimflow.plans.daily_run import Inputs, Outputs, Targets, audit, inputs_from_store, plan, publish, publish_audited

__all__ = ["Inputs", "Outputs", "Targets", "audit", "inputs_from_store", "plan", "publish", "publish_audited"]

"""Dataset graph of the three pipelines (run risk, account risk, run/cluster/warehouse metrics)."""

from costlens.plans.pipeline import Pipeline

__all__ = ["Pipeline"]

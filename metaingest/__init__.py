"""Metadata-driven ingestion on Spark: manifests, payloads, typed upserts."""

from .plans.inputs import LandedInputs, LiveInputs
from .plans.run import ProcessResult, run
from .plans.workspace import Workspace
from .ship import ship_package
from .specs import ApiSpec, BucketSpec, ColumnSpec, ProcessSpec, SpecError

__all__ = [
    "ApiSpec",
    "BucketSpec",
    "ColumnSpec",
    "LandedInputs",
    "LiveInputs",
    "ProcessResult",
    "ProcessSpec",
    "SpecError",
    "Workspace",
    "run",
    "ship_package",
]

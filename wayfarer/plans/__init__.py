"""Jobs (one per warehouse table), their parameters and the layered pipeline runner."""

from wayfarer.plans import jobs
from wayfarer.plans.params import FIXTURE_PARAMS, REFERENCE_PARAMS, Params

__all__ = ["jobs", "Params", "REFERENCE_PARAMS", "FIXTURE_PARAMS"]

"""Imports every plan module so that the registry is complete."""
from loupeline.plans import calibration, gate, lifecycle, masks, metrics, reports, review, splits, streams, validation, vectors  # noqa: F401
from loupeline.plans.registry import PLANS, SQL, callables  # noqa: F401

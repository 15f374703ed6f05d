"""Imports every module of derived tables, so that the registry is complete."""

from vitalgrid.plans import aps, catheter, comorbidity, cookbook, demographics, firstday, measurement, medication, older, older_aps, older_billing, older_hourly, older_lines, older_measurement, older_scores, older_stays, saps, scores, treatment  # noqa: F401
from vitalgrid.plans.registry import CONCEPTS  # noqa: F401

"""Imports every module that registers queries."""

from tidewater.plans import (  # noqa: F401
    alerts,
    arrays,
    rentals,
    reports,
    sampling,
    scalars,
    statistics,
    trips,
    warehouse,
)

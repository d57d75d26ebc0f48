"""Column expressions."""

from terrace.functions.columns import (
    POSTAL_US,
    any_present,
    bad_postal,
    coordinate,
    coordinate_malformed,
    masked,
    percentage,
    present,
)

__all__ = [
    "POSTAL_US",
    "any_present",
    "bad_postal",
    "coordinate",
    "coordinate_malformed",
    "masked",
    "percentage",
    "present",
]

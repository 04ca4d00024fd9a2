"""The default quality checks of the site lake."""

from __future__ import annotations

from lakeweir.operators.quality import Check

# Constraints of the curated site table.
SITE_CHECK = (
    Check("Data quality checks")
    .is_unique("id")
    .is_complete("id", "name", "brewery_type", "city", "country", "state", "postal_code")
    .has_data_type("String", "id", "country", "state", "city")
    .has_data_type("Fractional", "latitude", "longitude")
)

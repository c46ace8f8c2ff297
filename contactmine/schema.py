"""The contact record: column names, types and output labels."""

from __future__ import annotations

from pyspark.sql import types as T

CONTACT_FIELDS = [
    "full_name",
    "phone_number",
    "location",
    "company",
    "email",
    "source_url",
    "notes",
]

# Output labels, in output order.
OUTPUT_LABELS = {
    "full_name": "Full Name",
    "phone_number": "Phone Number",
    "email": "Email Address",
    "location": "Location (City, State)",
    "company": "Company",
    "source_url": "URL",
    "notes": "Notes (URL Link)",
}

MISSING = "N/A"

PAGE_SCHEMA = T.StructType(
    [
        T.StructField("page_id", T.LongType()),
        T.StructField("url", T.StringType()),
        T.StructField("html", T.StringType()),
    ]
)

"""What differs between the four directory layouts, as data."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field, replace

from contactmine.functions.locations import LocationRule
from contactmine.functions.urls import (
    PROFILE_URL_ASPX,
    PROFILE_URL_NUMBERED,
    profile_url_slug,
)
from contactmine.sinks.tables import APPEND_ONLY, FULL, PARTIAL

# Keyword lists, in matching order.
WASH_KEYWORDS = [
    "express car wash",
    "express wash",
    "tunnel wash",
    "car wash",
    "carwash",
    "conveyor wash",
]
BIO_KEYWORDS = ["Car Wash", "Express Wash", "Tunnel Wash", "Wash Concepts"]
PROPERTY_KEYWORDS = [
    *WASH_KEYWORDS,
    "owner-user sale",
    "owner-user",
    "pad site",
    "retail pad site",
    "underperforming asset",
    "automotive real estate",
    "stand-alone building",
    "stand-alone retail",
    "service station",
    "gas station",
    "oil change",
    "lube center",
    "tire shop",
    "sale leaseback",
    "slb",
]

# Labels of location and prose blocks, in order.
ADDRESS_LABELS = ["Address", "Location", "City", "Office"]
BIO_LABELS = ["Specialty", "Specialties", "Bio", "About", "Areas of Expertise"]

# Phone numbers of the directories themselves.
HEADER_PHONE_C = "8886864222"
BLOCKED_PHONE_D = "8882730423"


@dataclass(frozen=True)
class SourceProfile:
    """One source: how links are found, what is matched, how fields are read.

    ``layout`` picks the field rules: ``tabs`` (A), ``state_page`` (B),
    ``cards`` (C) or ``listings`` (D).
    """

    name: str
    layout: str
    keywords: Sequence[str]
    url_pattern: str = ""
    min_slug: int = 0
    excluded_urls: Sequence[str] = ()
    skip_links: int = 0
    any_element_links: bool = False
    start_page: int = 1
    max_pages: int | None = None
    stop_when_nothing_new: bool = False
    sorted_visits: bool = False
    seen_scope: Sequence[str] = ()
    max_profiles: int | None = None
    final_url_holds: str | None = None
    location: LocationRule = field(default_factory=LocationRule)
    blocked_phones: Sequence[str] = ()
    blocked_emails: Sequence[str] = ()
    headers: dict[str, str] = field(default_factory=dict)
    sink_modes: Sequence[str] = (FULL, PARTIAL)
    write_empty: bool = True


SOURCE_A = SourceProfile(
    name="A",
    layout="tabs",
    keywords=WASH_KEYWORDS,
    url_pattern=PROFILE_URL_NUMBERED,
    stop_when_nothing_new=True,
    sorted_visits=True,
    location=LocationRule(zip_codes=False, upper=False, names=True, edge=True),
)

SOURCE_B = SourceProfile(
    name="B",
    layout="state_page",
    keywords=WASH_KEYWORDS,
    url_pattern=PROFILE_URL_ASPX,
    excluded_urls=["brokers.aspx", "florida.aspx", "new-york.aspx"],
    location=LocationRule(title=True),
)

SOURCE_C = SourceProfile(
    name="C",
    layout="cards",
    keywords=BIO_KEYWORDS,
    seen_scope=["region"],
    location=LocationRule(edge=True),
    blocked_phones=[HEADER_PHONE_C],
    headers={"Notes (URL Link)": "Notes (Keywords Found)"},
    sink_modes=(FULL,),
)


def source_d(host: str, start_page: int = 1, max_pages: int | None = None) -> SourceProfile:
    """The listings layout on a given host, whose own support address is blocked."""
    return SourceProfile(
        name="D",
        layout="listings",
        keywords=PROPERTY_KEYWORDS,
        url_pattern=profile_url_slug(host),
        min_slug=3,
        any_element_links=True,
        start_page=start_page,
        max_pages=max_pages,
        final_url_holds=f"{host}/profile",
        location=LocationRule(title=True),
        blocked_phones=[BLOCKED_PHONE_D],
        blocked_emails=[f"support@{host}"],
        sink_modes=(APPEND_ONLY,),
        write_empty=False,
    )


# Limits that the four crawls ran under. No profile has them by itself.
_LIMITS = {
    "A": {"max_pages": 60, "location": {"max_scope_chars": 2000}},
    "B": {"location": {"max_chars": 10_000}},
    "C": {"location": {"max_chars": 50_000, "cutoff": 0.75}},
    "D": {"max_pages": 50, "skip_links": 3},
}


def limited(profile: SourceProfile) -> SourceProfile:
    """The profile with the limits of the original crawl: it then reads parts of texts and directories."""
    limits = dict(_LIMITS[profile.name])
    if profile.max_pages is not None:
        limits.pop("max_pages", None)
    location = replace(profile.location, **limits.pop("location", {}))
    return replace(profile, location=location, **limits)


# The alternative directory of the listings layout holds one page, number 21.
ALTERNATIVE_START_PAGE_D = 21
ALTERNATIVE_MAX_PAGES_D = 1

"""Where campaign-day records come from."""

from adloom.sources.insights import (  # noqa: F401
    GOOGLE_FLAT,
    GOOGLE_SAMPLE,
    META_FLAT,
    META_NESTED,
    META_SAMPLE,
    LandedSource,
    Source,
)

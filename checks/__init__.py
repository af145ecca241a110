"""Every registered query with its SQL twin."""

from checks import (  # noqa: F401
    calendars,
    curves,
    durability,
    fills,
    history,
    ingest,
    keys,
    mutations,
    options,
    reference,
    requests,
    sources,
    streams,
)
from checks.base import REGISTRY  # noqa: F401

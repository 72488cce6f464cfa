"""Loads every binding module, so that the registry is complete."""

from tablewarden.plans import (  # noqa: F401
    cleaning,
    exchange,
    governing,
    profiles,
    quarantines,
    recon,
    reporting,
    rules,
    streams,
)
from tablewarden.plans.registry import QUERIES  # noqa: F401

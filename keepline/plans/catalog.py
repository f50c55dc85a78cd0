"""All named queries."""

from . import (  # noqa: F401
    choosing, cleaning, drifting, features, profile, stored, streams, training, value,
)
from .registry import CHECKS, QUERIES  # noqa: F401

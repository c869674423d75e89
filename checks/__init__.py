"""Check queries over the test tables, each with an SQL form for comparison."""

from . import audits, extracts, requests, scalars, sinks, streams, transfers  # noqa: F401
from .registry import ORACLES, QUERIES  # noqa: F401

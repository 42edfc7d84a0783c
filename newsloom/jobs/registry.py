"""All queries of the library (without the training-data operators) and their SQL."""

from __future__ import annotations

from . import brief, feeds, more

QUERIES = {**brief.QUERIES, **more.QUERIES, **feeds.QUERIES}
ORACLES = {**brief.ORACLES, **more.ORACLES, **feeds.ORACLES}

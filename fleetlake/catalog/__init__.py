"""All registered queries; importing the modules fills the registry."""

from fleetlake.catalog.registry import ORACLES, QUERIES, bind  # noqa: F401
from fleetlake.catalog import sources, relational, windowing, queries, kpis, dq, etl, streams, stats, sketched  # noqa: F401,E402

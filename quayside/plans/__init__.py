"""The registered queries and their reference SQL."""

from quayside.plans import exports, passthrough, scans, scripts
from quayside.plans.common import Query


def _merged(attribute: str) -> dict:
    merged: dict = {}
    for module in (scans, exports, scripts, passthrough):
        merged |= getattr(module.catalog, attribute)
    return merged


QUERIES: dict[str, Query] = _merged("queries")
ORACLES: dict[str, str] = _merged("oracles")

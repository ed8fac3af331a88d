"""cxlake: customer-service analytics on Spark DataFrames.

Two data products, both built as lazy DataFrame plans:

* claim detail and its monthly / per-class rollups (``cxlake.operators.claims``)
* the per-session-day conversation dashboard (``cxlake.operators.dashboard``)

plus a table-definition layer that writes results by overwrite, append or
keyed merge (``cxlake.plans`` and ``cxlake.sinks``).
"""

from cxlake.session import ensure_session_defaults, get_or_create_session

__all__ = ["ensure_session_defaults", "get_or_create_session"]

"""Transport event analytics on Spark: vehicle tracks, parcel journeys and last-mile delivery.

Every operator is a ``DataFrame -> DataFrame`` function built from Catalyst-visible column
expressions; the same functions serve batch tables and, where stateless, streams.
"""

from routeline.session import build_session

__all__ = ["build_session"]

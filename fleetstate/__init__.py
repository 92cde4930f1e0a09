"""Asset-availability analytics on PySpark.

Status snapshots of a fleet of assets (rides in parks) go in; outage events, reliability marts, report queries and
data-quality results come out. Every transformation is a function from DataFrame to DataFrame.
"""

from fleetstate.params import Params, Scope

__all__ = ["Params", "Scope"]

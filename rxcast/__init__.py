"""rxcast: claims analytics and sales forecasting as Spark DataFrame jobs.

Every operator is a function ``DataFrame(s) -> DataFrame``; nothing collects
to the driver except the one model fit of the optional learned multiplier.
"""

from rxcast.session import build_session, checkpoint_dir

__all__ = ["build_session", "checkpoint_dir"]

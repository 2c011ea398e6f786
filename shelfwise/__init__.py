"""shelfwise: demand and promotion analytics as Spark DataFrame jobs.

Star-schema warehouse build, product x store x week panels, descriptive
aggregates, fixed-effects price/promotion regressions with robust errors,
response curves, discount optimisation and small result marts. Every step
is a lazy DataFrame; only coefficient-sized tables reach the driver.
"""

from shelfwise.session import build_session, ensure_checkpoint_dir

__all__ = ["build_session", "ensure_checkpoint_dir"]

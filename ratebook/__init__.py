"""ratebook: exchange-rate jobs expressed as Spark DataFrame plans.

Quotes come in (files, captured converter pages or tables), mid and cross
rates are derived in exact decimal arithmetic, joined with a reference table
of per-pair factors, and laid out for two receiving systems.  Every step is a
lazy ``DataFrame -> DataFrame`` function; actions happen only in the guards
and the sinks.
"""

from ratebook.session import build_session, checkpoint_dir

__all__ = ["build_session", "checkpoint_dir"]

"""corridor: road-traffic analytics expressed as Spark DataFrame plans.

Every operator is a function ``DataFrame... -> DataFrame`` (or
``Column -> Column``) that stays lazy; Catalyst plans the work.
"""

from corridor.session import checkpoint_dir, get_session

__all__ = ["get_session", "checkpoint_dir"]

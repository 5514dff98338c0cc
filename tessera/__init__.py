"""tessera: layered retail-sales tables on Spark DataFrames.

Every operator is a plain function over DataFrames; Catalyst plans the work.
"""

from tessera.session import configure_session, checkpoint_root, scratch_dir

__all__ = ["configure_session", "checkpoint_root", "scratch_dir"]

"""barmarts: keyed daily price bars -> cleaned bars -> marts, as PySpark DataFrame operators.

Every operator is a ``DataFrame -> DataFrame`` function; nothing is collected to the
driver except the gate verdicts (one aggregate row each) and partition counts.
"""

from barmarts.session import build_session, shared_dir

__all__ = ["build_session", "shared_dir"]

"""gridloom — Spark-native preparation of gridded and time-series sensor data.

Every public function takes and returns a DataFrame (or a Column) so that
Catalyst plans the whole chain: dedup, completeness, scaffold alignment,
gap filling, physical features, tensor packing and training windows.
"""

from gridloom.session import build_session, checkpoint_root, scratch_path  # noqa: F401

__all__ = ["build_session", "checkpoint_root", "scratch_path"]

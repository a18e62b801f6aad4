"""thermoflux — keyed, windowed and stateful sensor-stream operators on PySpark.

Every operator takes and returns DataFrames.  Each has a deterministic batch
form (Spark SQL expressions, analytic windows, joins) and, where the semantics
are stateful, a Structured Streaming form in :mod:`thermoflux.streaming`.
"""

from thermoflux.session import ensure_checkpoint_dir, get_session

__all__ = ["get_session", "ensure_checkpoint_dir"]

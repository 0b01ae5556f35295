"""ledgerline: a retail-orders lakehouse built from Spark DataFrame, SQL and
Structured Streaming operators.

Layers: raw (CSV or driver tables) -> bronze -> silver -> gold (plain tables or
version history) -> reports.  Every public function takes and returns a
``pyspark.sql.DataFrame``; nothing is collected to the driver except bounded
metadata (for example the list of hot keys found by a sample).
"""

from ledgerline.session import build_session, scratch_path

__all__ = ["build_session", "scratch_path"]
__version__ = "0.1.0"

"""newsflow: Spark-native news ingestion and enrichment operators.

Every operator is a DataFrame -> DataFrame function; nothing is computed
row-at-a-time on the driver.  See README.md for the module map.
"""

from newsflow.session import get_spark, checkpoint_dir

__all__ = ["get_spark", "checkpoint_dir"]

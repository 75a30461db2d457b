"""docweave: document, vector-store and knowledge-graph analytics on Spark.

Every public function is DataFrame -> DataFrame or Column -> Column.
"""

from docweave.session import get_spark, ensure_checkpoint_dir, load_table

__all__ = ["get_spark", "ensure_checkpoint_dir", "load_table"]

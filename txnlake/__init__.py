"""txnlake: retail invoice lines -> classified, de-duplicated star schema ->
49 business views, as Spark DataFrame plans."""

from .operators.transform import Processed, transform
from .plans.catalog import BY_ID, BY_NAME, VIEWS, export_all, register_views
from .plans.warehouse import Warehouse, build, load, open_warehouse
from .session import checkpoint_dir, get_spark

__all__ = [
    "Processed", "transform", "VIEWS", "BY_ID", "BY_NAME", "export_all", "register_views",
    "Warehouse", "build", "load", "open_warehouse", "checkpoint_dir", "get_spark",
]

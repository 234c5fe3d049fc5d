from .curated import curated_360, rebalanced, vehicle_owner
from .inspection import drop_table, preview, total_rows

__all__ = ["curated_360", "drop_table", "preview", "rebalanced", "total_rows", "vehicle_owner"]

from . import roles
from .roles import role
from .tables import (append_metrics, capped_by_key, read_csv, read_table, shape,
                     write_table)

__all__ = ["roles", "role", "append_metrics", "capped_by_key", "read_csv", "read_table",
           "shape", "write_table"]

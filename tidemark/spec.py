"""TableSpec: everything the merge needs to know about one dataset.

A spec is resolved from the metadata tables (see ``plans.config``) or built
directly in code.  It is a small immutable value that travels to the driver
only; no data passes through it.
"""

from __future__ import annotations

from dataclasses import dataclass, field, replace
from typing import Any

# Default change-header column names and codes of the landed
# change tables, and the default names of the SCD2 validity columns.
DEFAULT_OP_COL = "header__change_oper"
DEFAULT_SEQ_COL = "header__change_seq"
DEFAULT_DELETE_CODE = "D"
DEFAULT_IS_DELETED_COL = "is_deleted"
START_COL = "__START_AT"
END_COL = "__END_AT"

# Columns added by the library; never stored in a target.
FRAMEWORK_COLS = ("_op", "_seq", "_ingest_source", "_ingest_file", "_ingest_ts")


@dataclass(frozen=True)
class TableSpec:
    name: str
    keys: tuple[str, ...] = ()
    op_col: str = DEFAULT_OP_COL
    seq_col: str = DEFAULT_SEQ_COL
    delete_code: str = DEFAULT_DELETE_CODE
    delete_mode: str = "hard"            # 'hard' | 'soft'
    is_deleted_col: str = DEFAULT_IS_DELETED_COL
    scd_types: tuple[int, ...] = (1,)    # (1,), (2,) or (1, 2)
    merge_mode: str = "cdc"              # 'cdc' | 'append'
    seed_seq: Any = None                 # sequence given to snapshot rows
    seq_type: str | None = None          # Spark SQL type of the sequence
    keep_last_values: bool = False       # soft delete keeps previous payload
    cluster_by: tuple[str, ...] = ()
    include_full_flow: bool = False
    full_path: str | None = None
    ct_path: str | None = None
    file_format: str = "parquet"
    extra: dict = field(default_factory=dict, hash=False, compare=False)

    def __post_init__(self):
        if self.delete_mode not in ("hard", "soft"):
            raise ValueError(f"delete_mode must be hard|soft, got {self.delete_mode!r}")
        if self.merge_mode not in ("cdc", "append"):
            raise ValueError(f"merge_mode must be cdc|append, got {self.merge_mode!r}")
        if self.merge_mode == "cdc" and not self.keys:
            raise ValueError(f"{self.name}: cdc merge needs primary keys")

    @property
    def soft(self) -> bool:
        return self.delete_mode == "soft"

    def with_(self, **kw) -> "TableSpec":
        return replace(self, **kw)

    def except_columns(self) -> list[str]:
        """Columns dropped from stored targets: ours and the raw change header."""
        return sorted({self.op_col, self.seq_col}.union(FRAMEWORK_COLS))

"""Writers: the TSV export and its reader, and the overwrite of a table."""

from churnlens.sinks.overwrite import remove_old_versions, swap_overwrite
from churnlens.sinks.writers import export_tsv, read_tsv

__all__ = ["export_tsv", "read_tsv", "remove_old_versions", "swap_overwrite"]

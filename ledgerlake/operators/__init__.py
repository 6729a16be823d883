"""Parametric DataFrame -> DataFrame operators used by the Silver layer."""

from ledgerlake.operators.audit import stamp
from ledgerlake.operators.dedupe import keep_first
from ledgerlake.operators.integrity import orphans, reference_flag, require_reference
from ledgerlake.operators.position import file_position, has_file_positions
from ledgerlake.operators.rejects import first_failed_rule, reject_table
from ledgerlake.operators.rules import (
    in_domain,
    is_positive,
    normalize_text,
    require_in,
    require_not_null,
    require_positive,
)

__all__ = [
    "file_position",
    "first_failed_rule",
    "has_file_positions",
    "in_domain",
    "is_positive",
    "keep_first",
    "normalize_text",
    "orphans",
    "reference_flag",
    "reject_table",
    "require_in",
    "require_not_null",
    "require_positive",
    "require_reference",
    "stamp",
]

"""Domain constants shared by every layer.

Everything under "Fixed values" must stay exactly as written: Silver keeps
only these values, Gold groups by them and the quality report prints these
texts, so a change here changes results.
"""

from __future__ import annotations

# ---------------------------------------------------------------------------
# Fixed values (must equal the behaviour being reproduced)
# ---------------------------------------------------------------------------

# Valid transaction statuses after lower-casing and stripping.
VALID_STATUSES = ("success", "failed")
SUCCESS = "success"
FAILED = "failed"

# Valid payment methods and channels of a transaction detail.
PAYMENT_METHODS = ("card", "pse", "cash", "nequi", "daviplata")
CHANNELS = ("web", "mobile", "api")

# Replacement for a missing optional field when null_policy="unknown".
UNKNOWN = "unknown"

# Value of the `_source` audit column of every Silver table.
SOURCE_BRONZE = "bronze"

# Entities and layers, in dependency order.
ENTITIES = ("users", "transactions", "transaction_details")
LAYERS = ("bronze", "silver", "gold")

# Quality report texts. {n}, {b}, {s}, {col} and {ts} are filled per check.
MSG_RECORD_COUNT = "{n} registros en Silver"
MSG_TRACE_TX = "Bronze={b} → Silver={s} (se eliminaron {d} invalidos)"
MSG_TRACE_DETAILS = "Bronze={b} → Silver={s}"
MSG_NULLS = "{n} nulls en columna {col}"
MSG_AMOUNT = "{n} transacciones con amount <= 0"
MSG_STATUS = "{n} registros con status invalido"
MSG_DUPES = "{n} duplicados encontrados"
MSG_ORPHAN_TX = "{n} transacciones sin usuario valido"
MSG_ORPHAN_DETAILS = "{n} detalles sin transaccion valida"
MSG_FRESHNESS = "Transaccion mas reciente: {ts}"
MSG_NO_TIMESTAMP = "NaT"
MSG_GATE = "Quality checks fallaron: {failed}/{total}. Pass rate: {rate}%"
PASS = "PASS"
FAIL = "FAIL"

# Freshness window of the newest transaction.
FRESHNESS_DAYS = 365

# ---------------------------------------------------------------------------
# Derived values
# ---------------------------------------------------------------------------

# Characters removed by "strip" on both ends of a text value: every code point
# that Python's str.isspace() accepts, derived from the Unicode database
# instead of being listed by hand (the last one is U+3000).
WHITESPACE = "".join(ch for ch in map(chr, range(0x3001)) if ch.isspace())

"""Bronze -> Silver cleaning, one function per entity.

Order of operations per entity (deduplication always first, so an invalid
first copy removes its key even when a later copy would have been valid):

* users: keep-first on user_id -> required user_id, name, email -> email
  lower-cased and stripped -> audit columns.
* transactions: keep-first on transaction_id -> amount > 0 -> status
  normalised and in {success, failed} -> user exists in Silver users ->
  created_at parsed -> audit columns.
* transaction_details: keep-first on detail_id -> transaction exists in
  Silver transactions -> payment_method and channel normalised and in their
  domains -> processing_time_ms > 0 -> audit columns.

Every step is a native expression or join, so the whole cleaning of an
entity is one Spark plan; filters sit above the dedupe aggregate and below
the semi-join.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerlake.constants import CHANNELS, PAYMENT_METHODS, UNKNOWN, VALID_STATUSES
from ledgerlake.functions.text import normalize
from ledgerlake.functions.timefmt import parse_timestamp
from ledgerlake.operators.audit import stamp
from ledgerlake.operators.dedupe import keep_first
from ledgerlake.operators.integrity import reference_flag, require_reference
from ledgerlake.operators.rejects import first_failed_rule, reject_table
from ledgerlake.operators.rules import (
    in_domain,
    is_positive,
    require_in,
    require_not_null,
    require_positive,
)
from ledgerlake.schemas import SEQ
from ledgerlake.sources.tables import LazyFrames

USER_KEY = "user_id"
TX_KEY = "transaction_id"
DETAIL_KEY = "detail_id"
USER_REQUIRED = ("user_id", "name", "email")

# Keep-first ordering per entity: arrival order, then the columns that break
# a tie between copies that arrived together.
DEDUPE_ORDER = {
    "users": (SEQ,),
    "transactions": (SEQ,),
    "transaction_details": (SEQ, "processing_time_ms", "channel", "payment_method"),
}
DEDUPE_KEY = {"users": USER_KEY, "transactions": TX_KEY, "transaction_details": DETAIL_KEY}


def dedupe(entity: str, bronze: DataFrame, copies_col: str | None = None) -> DataFrame:
    """Keep-first on the entity key (rows without ``_seq`` keep the lowest full row)."""
    order = [c for c in DEDUPE_ORDER[entity] if c in bronze.columns]
    return keep_first(bronze, [DEDUPE_KEY[entity]], order, copies_col=copies_col)


def _drop_seq(df: DataFrame) -> DataFrame:
    return df.drop(SEQ)


# --------------------------------------------------------------------------- steps
#
# Each cleaner is an ordered list of (rule, transform) steps; the rule names
# the rows the step removes. ``silver_rejects`` counts what each rule rejects.

Step = tuple[str, Callable[[DataFrame], DataFrame]]


def user_steps() -> list[Step]:
    return [
        ("duplicate_key", lambda df: dedupe("users", df)),
        ("missing_required_field", lambda df: require_not_null(df, USER_REQUIRED)),
    ]


def transaction_steps(users_silver: DataFrame | None) -> list[Step]:
    steps: list[Step] = [
        ("duplicate_key", lambda df: dedupe("transactions", df)),
        ("amount_not_positive", lambda df: require_positive(df, "amount")),
        ("invalid_status", lambda df: require_in(df, "status", VALID_STATUSES)),
    ]
    if users_silver is not None:
        steps.append(("unknown_user", lambda df: require_reference(df, users_silver, USER_KEY)))
    return steps


def detail_steps(tx_silver: DataFrame | None, null_policy: str = "drop") -> list[Step]:
    return [
        ("duplicate_key", lambda df: dedupe("transaction_details", df)),
        ("unknown_transaction", lambda df: require_reference(df, tx_silver, TX_KEY)),
        ("invalid_payment_method", lambda df: require_in(df, "payment_method", PAYMENT_METHODS, null_policy)),
        ("invalid_channel", lambda df: require_in(df, "channel", CHANNELS, null_policy)),
        ("processing_time_not_positive", lambda df: require_positive(df, "processing_time_ms")),
    ]


def apply_steps(df: DataFrame, steps: list[Step]) -> DataFrame:
    """Run the steps in order."""
    for _, transform in steps:
        df = transform(df)
    return df


# --------------------------------------------------------------------------- users

def users_valid(users_bronze: DataFrame) -> DataFrame:
    """Deduplicated users with every required field present."""
    return apply_steps(users_bronze, user_steps())


def clean_users(users_bronze: DataFrame, processed_at: str | None = None) -> DataFrame:
    df = users_valid(users_bronze).withColumn("email", normalize("email"))
    return stamp(_drop_seq(df), processed_at)


# --------------------------------------------------------------------------- transactions

def transactions_candidates(tx_bronze: DataFrame) -> DataFrame:
    """Deduplicated transactions passing the row rules (amount, status), before the user check."""
    return apply_steps(tx_bronze, transaction_steps(None))


def clean_transactions(
    tx_bronze: DataFrame, users_silver: DataFrame, processed_at: str | None = None,
) -> DataFrame:
    df = apply_steps(tx_bronze, transaction_steps(users_silver))
    df = df.withColumn("created_at", parse_timestamp("created_at"))
    return stamp(_drop_seq(df), processed_at)


def transactions_unlinked(tx_bronze: DataFrame) -> DataFrame:
    """Clean transactions but for the user check (and audit columns), for consumers that join the users anyway."""
    return _drop_seq(transactions_candidates(tx_bronze).withColumn("created_at", parse_timestamp("created_at")))


# --------------------------------------------------------------------------- details

def details_unlinked(details_bronze: DataFrame, null_policy: str = "drop") -> DataFrame:
    """Clean details but for the transaction check (and audit columns), for consumers that join the
    transactions anyway: what they fold per transaction first need not be shuffled row by row."""
    steps = detail_steps(None, null_policy)
    return _drop_seq(apply_steps(details_bronze, [s for s in steps if s[0] != "unknown_transaction"]))


def details_with_transaction(details_bronze: DataFrame, tx_silver: DataFrame) -> DataFrame:
    """Deduplicated details whose transaction is in Silver."""
    return apply_steps(details_bronze, detail_steps(tx_silver)[:2])


def details_valid(
    details_bronze: DataFrame, tx_silver: DataFrame, null_policy: str = "drop",
) -> DataFrame:
    return apply_steps(details_bronze, detail_steps(tx_silver, null_policy))


def clean_transaction_details(
    details_bronze: DataFrame,
    tx_silver: DataFrame,
    processed_at: str | None = None,
    null_policy: str = "drop",
) -> DataFrame:
    """``null_policy="drop"`` (default) drops missing payment_method/channel with
    the invalid values; ``"unknown"`` keeps them as "unknown"."""
    if null_policy not in ("drop", "unknown"):
        raise ValueError(f"null_policy must be 'drop' or 'unknown', not {null_policy!r}")
    df = details_valid(details_bronze, tx_silver, null_policy)
    return stamp(_drop_seq(df), processed_at)


def build_silver(
    bronze, processed_at: str | None = None, null_policy: str = "drop"
) -> LazyFrames:
    """The three Silver tables as plans, each built when first used.

    Transactions reference the Silver users and details the Silver
    transactions (integrity order), so asking for details builds all three.
    """
    frames: LazyFrames = LazyFrames({
        "users": lambda: clean_users(bronze["users"], processed_at),
        "transactions": lambda: clean_transactions(bronze["transactions"], frames["users"], processed_at),
        "transaction_details": lambda: clean_transaction_details(
            bronze["transaction_details"], frames["transactions"], processed_at, null_policy),
    })
    return frames


# --------------------------------------------------------------------------- rejects

_RULE = "_rule"
_PRE = "_row_rule"
_KNOWN = "_ref_ok"
_COPIES = "_copies"
_ROWS = "_rows"
_REMOVED = "_removed"

MALFORMED_RULE = "malformed_record"
USER_RULES = ("missing_required_field",)
TX_RULES = ("amount_not_positive", "invalid_status", "unknown_user")
DETAIL_RULES = ("unknown_transaction", "invalid_payment_method", "invalid_channel",
                "processing_time_not_positive")


def silver_rejects(
    bronze: dict[str, DataFrame],
    silver_users: DataFrame,
    silver_transactions: DataFrame,
    null_policy: str = "drop",
    malformed: dict[str, int] | None = None,
) -> DataFrame:
    """Rows removed per entity and rule: (entity, rule, rejected).

    ``malformed`` gives the lines per entity that never became rows (text sources); they
    are a rule of their own, ``malformed_record``.

    A row is charged to the first rule it fails, in the order the cleaning
    applies them; ``duplicate_key`` counts the copies removed by keep-first.
    The row rules are evaluated per row; rows are then counted per
    (foreign key, outcome) before the reference lookup, so the join sees one
    row per key and outcome however many rows share a key.
    """
    u = dedupe("users", bronze["users"], copies_col=_COPIES).withColumn(_RULE, _user_rule())

    t = dedupe("transactions", bronze["transactions"], copies_col=_COPIES)
    t = t.withColumn(_PRE, _tx_row_rule(t, normalize("status")))
    t = reference_flag(_per_key(t, USER_KEY), silver_users, USER_KEY, _KNOWN).withColumn(_RULE, _tx_rule())

    d = dedupe("transaction_details", bronze["transaction_details"], copies_col=_COPIES)
    d = d.withColumn(_PRE, _detail_row_rule(d, _coded("payment_method", null_policy), _coded("channel", null_policy),
                                            null_policy))
    d = reference_flag(_per_key(d, TX_KEY), silver_transactions, TX_KEY, _KNOWN).withColumn(_RULE, _detail_rule())

    weighted = {"weight_col": _ROWS, "removed_col": _REMOVED}
    return _with_malformed(
        reject_table("users", u, _RULE, USER_RULES, _COPIES)
        .unionByName(reject_table("transactions", t, _RULE, TX_RULES, **weighted))
        .unionByName(reject_table("transaction_details", d, _RULE, DETAIL_RULES, **weighted)), malformed)


def _with_malformed(rejects: DataFrame, malformed: dict[str, int] | None) -> DataFrame:
    if not malformed:
        return rejects
    lines = [(e, MALFORMED_RULE, n) for e, n in malformed.items()]
    return rejects.unionByName(rejects.sparkSession.createDataFrame(lines, rejects.schema))


def _user_rule() -> Column:
    required = F.lit(True)
    for c in USER_REQUIRED:
        required = required & F.col(c).isNotNull()
    return first_failed_rule([(USER_RULES[0], required)])


def _tx_row_rule(t: DataFrame, status: Column) -> Column:
    return first_failed_rule([
        ("amount_not_positive", is_positive(t, "amount")),
        ("invalid_status", in_domain(status, VALID_STATUSES)),
    ])


def _tx_rule() -> Column:
    return F.coalesce(F.col(_PRE), F.when(~F.col(_KNOWN), F.lit("unknown_user")))


def _coded(col: str, null_policy: str) -> Column:
    value = normalize(col)
    return F.coalesce(value, F.lit(UNKNOWN)) if null_policy == "unknown" else value


def _detail_row_rule(d: DataFrame, method: Column, channel: Column, null_policy: str) -> Column:
    unknown = [UNKNOWN] if null_policy == "unknown" else []
    return first_failed_rule([
        ("invalid_payment_method", in_domain(method, [*PAYMENT_METHODS, *unknown])),
        ("invalid_channel", in_domain(channel, [*CHANNELS, *unknown])),
        ("processing_time_not_positive", is_positive(d, "processing_time_ms")),
    ])


def _detail_rule() -> Column:
    return F.when(~F.col(_KNOWN), F.lit("unknown_transaction")).otherwise(F.col(_PRE))


def _per_key(df: DataFrame, key: str) -> DataFrame:
    """Rows and removed copies per (key, row-rule outcome): partial aggregation before the shuffle."""
    return df.groupBy(key, _PRE).agg(
        F.count(F.lit(1)).alias(_ROWS),
        F.sum(F.col(_COPIES) - 1).alias(_REMOVED),
    )


# --------------------------------------------------------------------------- clean rows and rejects in one pass

RULES = {"users": USER_RULES, "transactions": TX_RULES, "transaction_details": DETAIL_RULES}


def classify(entity: str, bronze: DataFrame, parent: DataFrame | None = None, null_policy: str = "drop") -> DataFrame:
    """Every row that keep-first leaves, normalised, with the first rule it fails (NULL: none) and its copies.

    Stored once, it gives both the Silver rows (``accepted``) and the reject counts
    (``rejects_of``), so Bronze is deduplicated and looked up once for the two. ``parent`` is the stored
    Silver parent, unique on its key: nothing stands between its exchange and the join, which
    can therefore split a hot key.
    """
    if null_policy not in ("drop", "unknown"):
        raise ValueError(f"null_policy must be 'drop' or 'unknown', not {null_policy!r}")
    df = _drop_seq(dedupe(entity, bronze, copies_col=_COPIES))
    if entity == "users":
        return df.withColumns({"email": normalize("email"), _RULE: _user_rule()})
    if entity == "transactions":
        df = df.withColumn("status", normalize("status"))
        df = df.withColumn(_PRE, _tx_row_rule(df, F.col("status")))
        return _flagged(df, parent, USER_KEY).withColumn(_RULE, _tx_rule()).drop(_PRE, _KNOWN)
    df = df.withColumns({c: _coded(c, null_policy) for c in ("payment_method", "channel")})
    df = df.withColumn(_PRE, _detail_row_rule(df, F.col("payment_method"), F.col("channel"), null_policy))
    return _flagged(df, parent, TX_KEY).withColumn(_RULE, _detail_rule()).drop(_PRE, _KNOWN)


def _flagged(df: DataFrame, parent: DataFrame, key: str) -> DataFrame:
    """``df`` with ``_KNOWN``: is ``key`` in ``parent``, which is unique on it."""
    marked = parent.select(key).where(F.col(key).isNotNull()).withColumn(_KNOWN, F.lit(True))
    return df.join(marked, key, "left").select(*df.columns, F.coalesce(F.col(_KNOWN), F.lit(False)).alias(_KNOWN))


def accepted(entity: str, classified: DataFrame, processed_at: str | None = None) -> DataFrame:
    """The Silver rows of an entity from its ``classify`` rows."""
    df = classified.where(F.col(_RULE).isNull()).drop(_RULE, _COPIES)
    if entity == "transactions":
        df = df.withColumn("created_at", parse_timestamp("created_at"))
    return stamp(df, processed_at)


def rejects_of(classified: dict[str, DataFrame], malformed: dict[str, int] | None = None) -> DataFrame:
    """``silver_rejects`` from the ``classify`` rows of the three entities."""
    out = None
    for entity, rows in classified.items():
        part = reject_table(entity, rows, _RULE, RULES[entity], _COPIES)
        out = part if out is None else out.unionByName(part)
    return _with_malformed(out, malformed)

"""Error classes of upstream answers and their effect on accounts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from chatlog import fixed
from chatlog.functions.text import as_col
from chatlog.operators.changes import apply_changes
from chatlog.operators.scan import block_scan
from chatlog.session import settled


def outcome_type(status) -> Column:
    status = as_col(status)
    out = None
    for code, (kind, _) in fixed.OUTCOMES.items():
        out = F.when(status == code, kind) if out is None else out.when(status == code, kind)
    return F.when(status.isNotNull(), out.otherwise(fixed.OTHER_OUTCOME[0]))


def outcome_message(status, service: str = "API") -> Column:
    status = as_col(status)
    out = None
    for code, (_, text) in fixed.OUTCOMES.items():
        text = text.format(service=service, status=code)
        out = F.when(status == code, text) if out is None else out.when(status == code, text)
    other = fixed.OTHER_OUTCOME[1].format(service=service, status="")
    return F.when(status.isNotNull(), out.otherwise(F.concat(F.lit(other), status.cast("string"))))


def client_status(kind) -> Column:
    kind = as_col(kind)
    out = None
    for name, code in fixed.CLIENT_STATUS.items():
        out = F.when(kind == name, code) if out is None else out.when(kind == name, code)
    return F.when(kind.isNotNull(), out.otherwise(fixed.OTHER_CLIENT_STATUS))


def classify_outcomes(logs: DataFrame, service: str = "API") -> DataFrame:
    """Add outcome_type, outcome_message, client_status and deactivates to error rows.

    An error without an HTTP status is an exception: `api_error` with its own text,
    which counts against the account if it mentions 401 or 403.
    """
    failed = F.col("status") == "error"
    thrown = failed & F.col("http_status").isNull()
    text = F.col("error")
    kind = F.when(thrown, "api_error").when(failed, outcome_type("http_status"))
    denied = thrown & (F.contains(text, F.lit("401")) | F.contains(text, F.lit("403")))
    return logs.withColumns({
        "outcome_type": kind,
        "outcome_message": F.when(thrown, text).when(failed, outcome_message("http_status", service)),
        "client_status": client_status(kind),
        "deactivates": F.coalesce(kind.isin("auth", *fixed.BAN_STATUS) | denied, F.lit(False)),
    })


def account_changes(outcomes: DataFrame) -> DataFrame:
    """Change rows (id, seq, op, is_active, banned_status, fields) of classified logs."""
    ban = None
    for kind, status in fixed.BAN_STATUS.items():
        hit = F.col("outcome_type") == kind
        ban = F.when(hit, status) if ban is None else ban.when(hit, status)
    hits = outcomes.filter(F.col("deactivates") & F.col("account_id").isNotNull())
    return hits.select(
        F.col("account_id").alias("id"),
        F.struct(F.col("created_at").alias("at"), F.col("id").alias("tie")).alias("seq"),
        F.lit("update").alias("op"),
        F.lit(False).alias("is_active"),
        ban.alias("banned_status"),
        F.when(ban.isNotNull(), F.array(F.lit("is_active"), F.lit("banned_status")))
        .otherwise(F.array(F.lit("is_active"))).alias("fields"),
    )


def account_state(accounts: DataFrame, outcomes: DataFrame, as_of=None, patches: DataFrame | None = None) -> DataFrame:
    """Accounts after the outcomes (and admin patches) up to `as_of`.

    A patch row has the columns of `account_changes`; it touches the columns named
    in `fields` only, so re-activating a banned account leaves its ban status.
    """
    if as_of is not None:
        outcomes = outcomes.filter(F.col("created_at") <= as_of)
        patches = patches.filter(F.col("seq.at") <= as_of) if patches is not None else None
    changes = account_changes(outcomes)
    if patches is not None:
        changes = changes.unionByName(patches, allowMissingColumns=True)
    return apply_changes(accounts, changes, sets=["is_active", "banned_status"], insert=False)


def account_state_history(outcomes: DataFrame, patches: DataFrame | None = None) -> DataFrame:
    """Validity intervals of account states: (id, valid_from, valid_to, is_active, banned_status).

    Null state columns mean: as before the first change. Blocks keep a much changed
    account from being ordered in one task.
    """
    changes = account_changes(outcomes)
    if patches is not None:
        changes = changes.unionByName(patches, allowMissingColumns=True)
    flat = changes.select("id", F.col("seq.at").alias("at"), F.col("seq.tie").alias("tie"), "is_active", "banned_status")
    flat = settled(flat)  # the few log rows that matter, read by each pass below
    columns = {"active": F.col("is_active"), "banned": F.col("banned_status")}
    run = block_scan(
        flat, ["id"], ["at", "tie"],
        lasts=columns, lasts_before={f"{c}_before": v for c, v in columns.items()}, lags={"earlier": F.lit(1)},
    )
    same = F.col("active").eqNullSafe(F.col("active_before")) & F.col("banned").eqNullSafe(F.col("banned_before"))
    steps = run.filter(F.col("earlier").isNull() | ~same).select("id", "at", "tie", "active", "banned")
    steps = settled(steps)
    spans = block_scan(steps, ["id"], ["at", "tie"], leads={"valid_to": F.col("at")})
    return spans.select(
        "id", F.col("at").alias("valid_from"), "valid_to",
        F.col("active").alias("is_active"), F.col("banned").alias("banned_status"),
    )

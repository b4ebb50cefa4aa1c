"""Record rules as columns: versions, order, outcomes, readiness, attention, back-off. Batch and streams share them."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Formats and limits that records are held to.
DOCUMENT_ID = r"^[A-Za-z0-9][A-Za-z0-9._:-]{0,127}$"
METADATA_KEY = r"^[a-z][a-z0-9_]{0,63}$"
SHA256 = r"^[0-9a-f]{64}$"
INTEGER_VERSION = r"^[0-9]{1,18}$"
INSTANT_VERSION = r"^\d{4}-\d{2}-\d{2}T\d{2}:\d{2}:\d{2}(\.\d{1,6})?(Z|[+-]\d{2}:\d{2})$"
BACKOFF_CAP_S = 60
QUOTA, QUOTA_A_MINUTE = 50.0, 50.0
VISIBLE_DAYS = 30
# end of fixed values


def first_failure(*rules: tuple[Column, str]) -> Column:
    """The reason of the first rule that fails; null if none does."""
    return F.coalesce(*[F.when(broken, F.lit(reason)) for broken, reason in rules])


def version(text: Column) -> Column:
    """A source version as a tagged value: an integer of at most 18 digits, or an instant; null for anything else."""
    number = F.when(text.rlike(INTEGER_VERSION), text.cast("long"))
    instant = F.when(text.rlike(INSTANT_VERSION), F.unix_micros(F.try_to_timestamp(text)))
    kind = F.when(number.isNotNull(), "integer").when(instant.isNotNull(), "instant")
    return F.struct(kind.alias("kind"), F.coalesce(number, instant).alias("at"))


def order_rule(new: Column, old: Column, same_content: Column, old_rejected: Column) -> Column:
    """How a submission stands to the recorded revision: none, same, newer, STALE, CONFLICT or INVALID."""
    mixed = (new["kind"] != old["kind"]) | new["kind"].isNull()
    return (
        F.when(old["kind"].isNull() & new["kind"].isNotNull(), "none")
        .when(mixed, "INVALID")
        .when(same_content & (new["at"] >= old["at"]), "same")
        .when(new["at"] > old["at"], "newer")
        .when(new["at"] < old["at"], "STALE")
        .when(old_rejected, "newer")
        .otherwise("CONFLICT")
    )


def outcome(succeeded: Column, cause: Column) -> Column:
    """What an ended request makes of its revision."""
    return F.when(succeeded, "pending").when(cause == "source", "rejected").otherwise("failed")


def error_message(cause: Column, message: Column) -> Column:
    """Only a Source's own errors are shown to it."""
    return F.when(cause == "source", message).otherwise("The platform could not process this document.")


def backoff_seconds(attempts: Column) -> Column:
    return F.least(F.lit(BACKOFF_CAP_S).cast("double"), F.pow(F.lit(2.0), F.least(attempts, F.lit(30))))


def effective_status(item_status: Column, request_state: Column, expired: Column) -> Column:
    """A queued item shows its request's state; a declared one of an expired batch shows that."""
    return F.when((item_status == "queued") & request_state.isNotNull(), request_state).when((item_status == "declared") & expired, "expired").otherwise(item_status)


def readiness(deleted: Column, required: Column, serving: Column, stale: Column) -> Column:
    """deleted, not_ready, ready_stale or ready; required and serving are arrays of projections."""
    return F.when(deleted, "deleted").when(F.size(F.array_except(required, serving)) > 0, "not_ready").when(stale, "ready_stale").otherwise("ready")


def attention(rejected: Column, failed: Column, active: Column, stalled: Column) -> Column:
    """The reasons for which a document needs someone."""
    return F.array_compact(F.array(F.when(rejected, "rejected"), F.when(failed & ~active, "failed"), F.when(active & stalled, "stalled")))


def token_bucket(requests: Column, capacity: float = QUOTA, a_minute: float = QUOTA_A_MINUTE) -> Column:
    """Fold requests (array of struct<at: seconds, n>) in time order: granted, refused and the tokens left."""
    start = F.struct(F.lit(None).cast("double").alias("at"), F.lit(capacity).alias("tokens"), F.lit(0).cast("long").alias("granted"), F.lit(0).cast("long").alias("refused"))

    def step(acc: Column, r: Column) -> Column:
        filled = F.least(F.lit(capacity), acc["tokens"] + F.coalesce((r["at"] - acc["at"]) * (a_minute / 60), F.lit(0.0)))
        ok = filled >= r["n"]
        return F.struct(r["at"].alias("at"), F.when(ok, filled - r["n"]).otherwise(filled).alias("tokens"), (acc["granted"] + ok.cast("long")).alias("granted"), (acc["refused"] + (~ok).cast("long")).alias("refused"))

    return F.aggregate(F.array_sort(requests), start, step)


def wait_seconds(needed: Column, tokens: Column, a_minute: float = QUOTA_A_MINUTE) -> Column:
    return F.greatest(F.lit(1).cast("long"), F.ceil((needed - tokens) / (a_minute / 60)).cast("long"))

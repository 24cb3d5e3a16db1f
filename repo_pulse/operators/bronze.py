"""Raw lines to typed Bronze rows.

Errors are data: a raising expression in a column nobody selects never fires, so every row
carries `_error` and the load decides per source. Each line is parsed once for its fields and
once for the payload text; everything stays in one generated stage.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from repo_pulse.functions import instants, strict_json

ERROR = "_error"


def with_coordinates(message: Column) -> Column:
    """`<file>:<line>: <message>`, null without a message."""
    return F.concat(
        F.col("source_file"),
        F.lit(":"),
        F.col("source_line_number").cast("string"),
        F.lit(": "),
        message,
    )


_COORDINATES = ("value", "archive_hour", "source_file", "source_line_number")

# Variants, as reading one never fails: of a repeated key the last value counts, whatever its
# kind, where a typed member of the wrong kind would leave an earlier value in place.
_MEMBERS = (
    "id: variant, type: variant, created_at: variant, public: variant,"
    "actor: variant, repo: variant, org: variant, payload: string"
)

# Required members in the order their errors are reported: column, object, key, kind.
_REQUIRED = (
    ("event_id", "event", "id", "STRING"),
    ("event_type", "event", "type", "STRING"),
    ("created_text", "event", "created_at", "STRING"),
    ("is_public", "event", "public", "BOOLEAN"),
    ("actor_id", "actor", "id", "BIGINT"),
    ("actor_login", "actor", "login", "STRING"),
    ("repo_id", "repo", "id", "BIGINT"),
    ("repo_name", "repo", "name", "STRING"),
    ("org_id", "org", "id", "BIGINT"),
    ("org_login", "org", "login", "STRING"),
)


def _open(lines: DataFrame) -> DataFrame:
    """Parse each line once and take its members; a member of another kind is null."""
    parsed, checksum, event = F.col("parsed"), F.col("checksum"), F.col("event")
    once = lines.select(*_COORDINATES, F.xxhash64("value").alias("checksum")).select(
        "*", strict_json.parse_line(F.col("value"), checksum, _MEMBERS).alias("parsed")
    )
    opened = once.select(
        *_COORDINATES,
        (strict_json.is_whole(parsed, checksum) & F.is_valid_utf8("value")).alias("whole"),
        F.try_element_at(parsed, F.lit(1)).alias("event"),
    ).select(
        "*",
        strict_json.shallow(event["actor"], "$", "id", "login").alias("actor"),
        strict_json.shallow(event["repo"], "$", "id", "name").alias("repo"),
        strict_json.shallow(event["org"], "$", "id", "login").alias("org"),
        # Compact, key order kept; the contract is equality as JSON.
        event["payload"].alias("payload_json"),
    )
    members = [
        strict_json.taken(F.col(owner)[key], sql_kind).alias(column)
        for column, owner, key, sql_kind in _REQUIRED
    ]
    typed = opened.select("*", *members)
    return typed.select("*", instants.parse_instant(F.col("created_text")).alias("created_at"))


def _all_right() -> Column:
    """The short test nearly every row passes, so that messages are worked out for few."""
    present = ("event_id", "event_type", "created_at", "is_public", "actor_id", "actor_login")
    condition = F.col("whole")
    for column in (*present, "repo_id", "repo_name"):
        condition = condition & F.col(column).isNotNull()
    org = F.col("event.org")
    no_org = org.isNull() | F.is_variant_null(org)
    has_org = F.col("org_id").isNotNull() & F.col("org_login").isNotNull()
    payload = strict_json.object_text(F.col("payload_json"), F.col("value"), "payload")
    return condition & (no_org | has_org) & payload


def _errors(again: Column) -> list[Column]:
    """What can be wrong with a line, parsed once more as `again`, in the order of reporting.
    A row that was not taken for another reason is refused all the same."""
    objects = {
        "event": strict_json.shallow(again, "$", "id", "type", "created_at", "public", "org"),
        "actor": strict_json.shallow(again, "$.actor", "id", "login"),
        "repo": strict_json.shallow(again, "$.repo", "id", "name"),
        "org": strict_json.shallow(again, "$.org", "id", "login"),
    }
    errors = [
        F.when(again.isNull() | ~F.is_valid_utf8("value"), F.lit(strict_json.INVALID)),
        F.when(objects["event"].isNull(), F.lit("event must be a JSON object")),
        strict_json.object_error(again, "$.actor", "actor"),
        strict_json.object_error(again, "$.repo", "repo"),
        strict_json.object_error(again, "$.payload", "payload"),
        strict_json.optional_object_error(objects["event"]["org"], "org"),
    ]
    for _, owner, key, sql_kind in _REQUIRED:
        member = objects[owner][key]
        path = key if owner == "event" else f"{owner}.{key}"
        error = strict_json.member_error(member, sql_kind, path)
        if owner == "org":
            error = F.when(objects["org"].isNotNull(), error)
        errors.append(error)
        if path == "created_at":
            text = F.try_variant_get(member, "$", "string")
            errors.append(F.when(F.col("created_at").isNull(), instants.instant_error(text)))
    return [*errors, F.lit(strict_json.INVALID)]


def parse_events(lines: DataFrame, located: bool = True) -> DataFrame:
    """`value, archive_hour, source_file, source_line_number` to Bronze columns plus `_error`, which
    starts with the coordinates unless `located` is false.

    The error is the first one in the order: text, object, actor, repo, payload, org, then
    the fields from id to org.login.
    """
    wrong = ~F.coalesce(_all_right(), F.lit(False))
    tested = _open(lines).select("*", wrong.alias("wrong"))
    again = strict_json.whole_variant(F.col("value"))
    message = strict_json.bind(again, lambda value: strict_json.first_error(_errors(value)))
    message = F.when(F.col("wrong"), message)
    error = strict_json.opaque(with_coordinates(message) if located else message)
    return tested.select(
        "event_id",
        "event_type",
        "created_at",
        "is_public",
        "actor_id",
        "actor_login",
        "repo_id",
        "repo_name",
        "org_id",
        "org_login",
        "payload_json",
        "archive_hour",
        "source_file",
        "source_line_number",
        error.alias(ERROR),
    )


def rejects(parsed: DataFrame) -> DataFrame:
    """The rows that failed, with their coordinates and message."""
    return parsed.where(F.col(ERROR).isNotNull()).select(
        "source_file", "source_line_number", F.col(ERROR).alias("error")
    )

"""Bronze rows to typed Silver rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from repo_pulse.functions import strict_json
from repo_pulse.operators.bronze import ERROR, with_coordinates
from repo_pulse.schema import BRONZE

PUSH = "PushEvent"
PULL_REQUEST = "PullRequestEvent"

# Variants, as in Bronze: the last value of a repeated key counts, whatever its kind.
_MEMBERS = "action: variant, size: variant, pull_request: variant"


def to_silver(bronze: DataFrame) -> DataFrame:
    """Bronze columns to Silver columns plus `_error`.

    `action` is text for any event type; a push must carry an integer `size`, a pull request
    an object with a boolean `merged`. `event_date` is the UTC date of `created_at`.
    """
    is_push = F.col("event_type") == PUSH
    is_pull_request = F.col("event_type") == PULL_REQUEST
    payload = strict_json.members(F.col("payload_json"), _MEMBERS)
    opened = bronze.select(*BRONZE.names, payload.alias("payload"))
    action, size = F.col("payload.action"), F.col("payload.size")
    pull_request = F.col("payload.pull_request")
    merged = F.try_variant_get(pull_request, "$.merged", "variant")
    is_action = strict_json.kind(action) == "STRING"
    is_size = is_push & F.coalesce(strict_json.kind(size) == "BIGINT", F.lit(False))
    is_merged = is_pull_request & F.coalesce(strict_json.kind(merged) == "BOOLEAN", F.lit(False))
    message = F.coalesce(
        F.when(
            action.isNotNull() & ~F.is_variant_null(action) & ~is_action,
            F.lit("field 'payload.action' must be str"),
        ),
        F.when(is_push & ~is_size, "field 'payload.size' must be int"),
        F.when(
            is_pull_request & ~strict_json.is_object(pull_request),
            "field 'payload.pull_request' must be dict",
        ),
        F.when(
            is_pull_request & ~is_merged, "field 'payload.pull_request.merged' must be bool"
        ),
    )
    return opened.select(
        "event_id",
        "event_type",
        F.to_date("created_at").alias("event_date"),
        "created_at",
        "actor_id",
        "actor_login",
        "repo_id",
        "repo_name",
        "org_id",
        "org_login",
        F.when(is_action, F.try_variant_get(action, "$", "string")).alias("action"),
        F.when(is_size, F.try_variant_get(size, "$", "bigint")).alias("commit_count"),
        F.when(is_merged, F.try_variant_get(merged, "$", "boolean")).alias("is_merged"),
        "archive_hour",
        "source_file",
        "source_line_number",
        strict_json.opaque(with_coordinates(message)).alias(ERROR),
    )

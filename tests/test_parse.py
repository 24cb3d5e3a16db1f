import datetime as dt
import json

import pytest
from pyspark.sql import functions as F

from repo_pulse import schema
from repo_pulse.functions import instants, text
from repo_pulse.functions.text import normalize
from repo_pulse.operators import bronze, silver
from tests.conftest import EVENT, event, line


def parsed(lines_frame, *lines):
    rows = bronze.parse_events(lines_frame(lines)).orderBy("source_line_number").collect()
    return [row.asDict() for row in rows]


def test_fields_are_mapped(lines_frame):
    row = parsed(lines_frame, line())[0]
    assert row["_error"] is None
    assert (row["event_id"], row["event_type"], row["is_public"]) == ("90210077", "PushEvent", True)
    assert (row["actor_id"], row["actor_login"]) == (7001, "noor")
    assert (row["repo_id"], row["repo_name"]) == (555, "fern/seed-sorter")
    assert (row["org_id"], row["org_login"]) == (42, "fern")
    assert row["created_at"].isoformat() == "2024-05-02T03:41:07"
    assert json.loads(row["payload_json"]) == EVENT["payload"]
    assert (row["source_file"], row["source_line_number"]) == ("2024-05-02-3.json.gz", 1)


@pytest.mark.parametrize("org", [None, ...])
def test_organisation_may_be_absent_or_null(lines_frame, org):
    row = parsed(lines_frame, line(org=org))[0]
    assert row["_error"] is None and row["org_id"] is None and row["org_login"] is None


ERRORS = [
    (line(id=1), "field 'id' must be str, got int"),
    (line(id=None), "field 'id' must be str, got NoneType"),
    (line(id=...), "field 'id' is required"),
    (line(type=["x"]), "field 'type' must be str, got list"),
    (line(type=True), "field 'type' must be str, got bool"),
    (line(public="true"), "field 'public' must be bool, got str"),
    (line(public=1), "field 'public' must be bool, got int"),
    (line(created_at=5), "field 'created_at' must be str, got int"),
    (line(created_at="2024-05-02T03:15:00"), "datetime must be timezone-aware"),
    (line(created_at="2024-05-02"), "datetime must be timezone-aware"),
    (line(created_at="soon"), "Invalid isoformat string: 'soon'"),
    (line(actor=...), "field 'actor' is required"),
    (line(actor=None), "field 'actor' must be dict"),
    (line(actor=[1]), "field 'actor' must be dict"),
    (line(actor={"id": True, "login": "x"}), "field 'actor.id' must be int, got bool"),
    (line(actor={"id": 5.0, "login": "x"}), "field 'actor.id' must be int, got float"),
    (line(actor={"id": "5", "login": "x"}), "field 'actor.id' must be int, got str"),
    (line(actor={"id": 2**63, "login": "x"}), "field 'actor.id' must be int, got float"),
    (line(actor={"id": 1}), "field 'actor.login' is required"),
    (line(repo={"id": 1, "name": {"a": 1}}), "field 'repo.name' must be str, got dict"),
    (line(repo={"name": "a/b"}), "field 'repo.id' is required"),
    (line(payload=...), "field 'payload' is required"),
    (line(payload=None), "field 'payload' must be dict"),
    (line(payload=[1]), "field 'payload' must be dict"),
    (line(payload="{}"), "field 'payload' must be dict"),
    (line(payload='{"a":1}'), "field 'payload' must be dict"),
    (line(payload="{x"), "field 'payload' must be dict"),
    (
        line().replace(json.dumps(EVENT["payload"]), '"\\u007b\\u0022a\\u0022:1}"'),
        "field 'payload' must be dict",
    ),
    (line(org=5), "field 'org' must be dict"),
    (line(org={}), "field 'org.id' is required"),
    (line(org={"id": 1}), "field 'org.login' is required"),
    (line(org={"id": None, "login": "x"}), "field 'org.id' must be int, got NoneType"),
    ("", "invalid JSON"),
    ("   ", "invalid JSON"),
    ("{", "invalid JSON"),
    (line()[:-3], "invalid JSON"),
    (line() + " x", "invalid JSON"),
    (line() + "]", "invalid JSON"),
    (line() + "}", "invalid JSON"),
    (line() + "," + line(), "invalid JSON"),
    (line() + ',"x":1', "invalid JSON"),
    (line() + line(), "invalid JSON"),
    (line().replace('"', "'"), "invalid JSON"),
    ("[]", "event must be a JSON object"),
    ("5", "event must be a JSON object"),
    ("null", "event must be a JSON object"),
    ('"text"', "event must be a JSON object"),
]


def test_every_error_has_its_text_and_coordinates(lines_frame):
    rows = parsed(lines_frame, *[text for text, _ in ERRORS])
    assert len(rows) == len(ERRORS)
    for row, (text, message) in zip(rows, ERRORS, strict=True):
        number = row["source_line_number"]
        assert row["_error"] == f"2024-05-02-3.json.gz:{number}: {message}", text


def test_first_error_follows_the_order_of_evaluation(lines_frame):
    rows = parsed(
        lines_frame,
        line(id=1, actor=...),
        line(id=1, payload=None),
        line(org=5, type=1),
        line(id=1, created_at="x"),
        line(created_at="x", public=1),
        line(actor={"id": "x"}, repo={}),
    )
    assert [row["_error"].split(": ", 1)[1] for row in rows] == [
        "field 'actor' is required",
        "field 'payload' must be dict",
        "field 'org' must be dict",
        "field 'id' must be str, got int",
        "Invalid isoformat string: 'x'",
        "field 'actor.id' must be int, got str",
    ]


def test_unusual_but_valid_lines(lines_frame):
    tricky = event(payload={"m": 'say "{x}" \\u007b', "q": ["{", '{"'], "n": None, "e": "é😀"})
    given = [
        json.dumps(tricky, ensure_ascii=False),
        json.dumps(tricky),
        line(payload={}),
        "  " + line() + " \t",
        json.dumps(event(), indent=None, separators=(" , ", " : ")),
        line().replace('"id": "90210077"', '"id": 1, "id": "last"'),
        line().replace('"payload": {', '"payload": 5, "payload": {'),
        line(created_at="2024-05-02 05:45:00.5+02:30"),
    ]
    rows = parsed(lines_frame, *given)
    assert [row["_error"] for row in rows] == [None] * len(given)
    assert json.loads(rows[0]["payload_json"]) == tricky["payload"]
    assert json.loads(rows[1]["payload_json"]) == tricky["payload"]
    assert rows[2]["payload_json"] == "{}"
    assert rows[4]["payload_json"] == '{"push_id":8,"size":3,"ref":"refs/heads/trunk"}'
    assert rows[5]["event_id"] == "last"
    assert json.loads(rows[6]["payload_json"]) == EVENT["payload"]
    assert rows[7]["created_at"].isoformat() == "2024-05-02T03:15:00.500000"


def test_invalid_utf8_is_refused(spark, lines_frame):
    rows = lines_frame([line()]).withColumn(
        "value", F.expr("cast(concat(cast(value as binary), X'20FF') as string)")
    )
    assert bronze.rejects(bronze.parse_events(rows)).first().error.endswith("invalid JSON")


def test_exhaustive_kinds_against_a_plain_implementation(lines_frame):
    """Every member replaced by every kind of value, compared with the rule written out."""
    values = ["x", "", 1, -7, 2.5, True, None, [], [1], {}, {"id": 1}]
    names = {str: "str", int: "int", bool: "bool", float: "float", list: "list", dict: "dict"}
    names[type(None)] = "NoneType"
    required = {"id": str, "type": str, "public": bool}
    given, expected = [], []
    for member, wanted in required.items():
        for value in values:
            given.append(line(**{member: value}))
            right = type(value) is wanted
            found = names[type(value)]
            text = f"field '{member}' must be {names[wanted]}, got {found}"
            expected.append(None if right else text)
    for owner, member, wanted in (
        ("actor", "id", int),
        ("actor", "login", str),
        ("repo", "id", int),
        ("repo", "name", str),
        ("org", "id", int),
        ("org", "login", str),
    ):
        for value in values:
            given.append(line(**{owner: {**EVENT[owner], member: value}}))
            right = type(value) is wanted
            found = names[type(value)]
            text = f"field '{owner}.{member}' must be {names[wanted]}, got {found}"
            expected.append(None if right else text)
    rows = parsed(lines_frame, *given)
    found = [row["_error"] and row["_error"].split(": ", 1)[1] for row in rows]
    assert found == expected


def typed(lines_frame, *lines):
    rows = silver.to_silver(bronze.parse_events(lines_frame(lines)))
    return [row.asDict() for row in rows.orderBy("source_line_number").collect()]


def test_silver_values_by_event_type(lines_frame):
    push, merged, opened, star, late = typed(
        lines_frame,
        line(payload={"size": 3, "action": None}),
        line(
            type="PullRequestEvent",
            payload={"action": "closed", "pull_request": {"merged": True}},
        ),
        line(type="PullRequestEvent", payload={"pull_request": {"merged": False}}),
        line(type="WatchEvent", payload={"action": "started", "size": "ignored"}),
        line(created_at="2024-05-01T23:59:59Z", type="ForkEvent", payload={}),
    )
    assert (push["commit_count"], push["action"], push["is_merged"]) == (3, None, None)
    assert (merged["is_merged"], merged["action"], merged["commit_count"]) == (True, "closed", None)
    assert (opened["is_merged"], opened["action"]) == (False, None)
    assert (star["action"], star["commit_count"]) == ("started", None)
    # The date is that of the event, not of the archive.
    assert late["event_date"].isoformat() == "2024-05-01"
    assert all(row["_error"] is None for row in (push, merged, opened, star, late))


def test_whole_texts_however_long(lines_frame):
    """A string longer than the JSON reader's usual bound, with and without escapes in it."""
    rows = lines_frame([line(payload={"size": 1, "t": "@"}), line(payload={"size": 1, "t": "@{"})])
    text = F.when(F.col("source_line_number") == 1, F.lit("abcdefghij")).otherwise(
        F.lit('abcdefg\\"')
    )
    long = rows.withColumn("value", F.replace("value", F.lit("@"), F.repeat(text, 2_500_000)))
    parsed = bronze.parse_events(long)
    for row in parsed.select("_error", F.length("payload_json").alias("n")).collect():
        assert row._error is None and row.n > 22_000_000
    found = silver.to_silver(parsed).select("commit_count", "_error").collect()
    assert [tuple(row) for row in found] == [(1, None), (1, None)]


def test_silver_errors(lines_frame):
    cases = [
        (line(payload={"action": 1, "size": 1}), "field 'payload.action' must be str"),
        (line(payload={}), "field 'payload.size' must be int"),
        (line(payload={"size": None}), "field 'payload.size' must be int"),
        (line(payload={"size": 1.0}), "field 'payload.size' must be int"),
        (line(payload={"size": True}), "field 'payload.size' must be int"),
        (line(payload={"size": "not-an-integer"}), "field 'payload.size' must be int"),
        (line(type="PullRequestEvent", payload={}), "field 'payload.pull_request' must be dict"),
        (
            line(type="PullRequestEvent", payload={"pull_request": None}),
            "field 'payload.pull_request' must be dict",
        ),
        (
            line(type="PullRequestEvent", payload={"pull_request": {}}),
            "field 'payload.pull_request.merged' must be bool",
        ),
        (
            line(type="PullRequestEvent", payload={"pull_request": {"merged": 1}}),
            "field 'payload.pull_request.merged' must be bool",
        ),
    ]
    rows = typed(lines_frame, *[text for text, _ in cases])
    for number, (row, (text, message)) in enumerate(zip(rows, cases, strict=True), start=1):
        assert row["_error"] == f"2024-05-02-3.json.gz:{number}: {message}", text


def test_contracts(lines_frame):
    rows = bronze.parse_events(lines_frame([line()]))
    stored = schema.enforce(rows, schema.BRONZE)
    assert stored.schema.names == schema.BRONZE.names and len(schema.BRONZE) == 14
    assert [f.dataType for f in stored.schema] == [f.dataType for f in schema.BRONZE]
    assert len(schema.SILVER) == 16 and len(schema.GOLD) == 12
    assert rows.where(schema.broken(schema.BRONZE)).count() == 0


def test_normalize_strips_and_folds(spark):
    rows = spark.createDataFrame(
        [(" Apache/Airflow\t\n",), (" 　X/Y ",), ("a b/c",)], "x string"
    )
    assert [r[0] for r in rows.select(normalize(F.col("x"))).collect()] == [
        "apache/airflow",
        "x/y",
        "a b/c",
    ]


ISO_TEXTS = [
    "20240502T034107Z", "20240502T03:41:07Z", "2024-05-02T034107.25+0200", "2024-05-02T0341Z",
    "20240502T03+05:30", "2024-W18-4T03:41:07Z", "2024W184T034107Z", "2024-W18T03:41:07Z",
    "2024W18T0341-0100", "2020-W53-7T23:59:59Z", "2021-W53-1T00:00:00Z", "2021-W00-1T00:00:00Z",
    "2024-W18-8T00:00:00Z", "2024-W18-0T00:00:00Z", "2015-W01-1T00:00:00Z", "2024-W18-4",
    "20240502", "20240502T034107", "20241302T034107Z", "2024-W1-4T03:41:07Z", "2024-05-02T03:41:07Z",
    "2024-05-02 03:41:07.123456+01:00", "20240230T000000Z", "2009-W53-7T12:00Z", "2024W", "W18",
]


def test_every_spelling_of_a_date_is_read_as_python_reads_it(spark):
    rows = spark.createDataFrame([(t,) for t in ISO_TEXTS], "text string")
    found = rows.select(
        "text",
        instants.parse_instant(F.col("text")).alias("at"),
        instants.instant_error(F.col("text")).alias("why"),
    ).collect()
    for row in found:
        try:
            at = dt.datetime.fromisoformat(row.text)
        except ValueError:
            assert row["at"] is None and row.why.startswith("Invalid isoformat string"), row
            continue
        if at.tzinfo is None:
            assert row["at"] is None and row.why == instants.NAIVE, row
        else:
            assert row["at"] == at.astimezone(dt.UTC).replace(tzinfo=None), row


def test_case_folding_equals_that_of_python(spark):
    every = [chr(c) for c in range(0x110000) if chr(c).casefold() != chr(c) and chr(c).isprintable()]
    texts = ["Straße/x", " STRASSE/X\u2003", "ΣΑΣ", "İx", "plain/Name", "", "\u00a0Ǆ ﬃ ẞ\n"]
    texts += ["a" + "".join(every[i : i + 40]) + "Z" for i in range(0, len(every), 40)]
    rows = spark.createDataFrame([(t,) for t in texts], "text string")
    for row in rows.select("text", text.normalize(F.col("text")).alias("folded")).collect():
        assert row.folded == row.text.strip().casefold(), row.text

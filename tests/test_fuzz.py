"""Thousands of damaged lines, judged by the parser and by the contract written out in Python."""

import datetime as dt
import json
import random
import re

from repo_pulse.operators import bronze, silver
from tests.conftest import EVENT, event

NAMES = {str: "str", int: "int", bool: "bool", float: "float", list: "list", dict: "dict"}
NAMES[type(None)] = "NoneType"


class Refused(Exception):
    pass


# Object, key and type of every required member, in the order they are looked at.
MEMBERS = [
    ("", "id", str),
    ("", "type", str),
    ("", "created_at", str),
    ("", "public", bool),
    ("actor", "id", int),
    ("actor", "login", str),
    ("repo", "id", int),
    ("repo", "name", str),
    ("org", "id", int),
    ("org", "login", str),
]


def judge(text):
    """Members of a line by path, or the reason it is refused."""
    try:
        whole = json.loads(text)
    except ValueError:
        raise Refused("invalid JSON") from None
    if type(whole) is not dict:
        raise Refused("event must be a JSON object")
    objects = {"": whole}
    for name in ("actor", "repo", "payload", "org"):
        if name == "org" and whole.get(name) is None:
            continue
        if name not in whole:
            raise Refused(f"field '{name}' is required")
        if type(whole[name]) is not dict:
            raise Refused(f"field '{name}' must be dict")
        objects[name] = whole[name]
    found = {"payload": objects["payload"]}
    for name, key, wanted in MEMBERS:
        path = f"{name}.{key}".lstrip(".")
        if name not in objects:
            found[path] = None
            continue
        if key not in objects[name]:
            raise Refused(f"field '{path}' is required")
        value = found[path] = objects[name][key]
        if type(value) is not wanted:
            got = NAMES[type(value)]
            raise Refused(f"field '{path}' must be {NAMES[wanted]}, got {got}")
        if path == "created_at":
            try:
                at = dt.datetime.fromisoformat(value)
            except ValueError:
                raise Refused(f"Invalid isoformat string: '{value}'") from None
            if at.tzinfo is None:
                raise Refused("datetime must be timezone-aware")
            found[path] = at.astimezone(dt.UTC).replace(tzinfo=None)
    return found


# Path of a member to the column that holds it.
COLUMNS = {
    "id": "event_id",
    "type": "event_type",
    "created_at": "created_at",
    "public": "is_public",
    **{f"{name}.{key}": f"{name}_{key}" for name, key, _ in MEMBERS if name},
}


VALUES = [
    "x", "", "{", "{}", '{"a":1}', "[", "1", "null", "é😀", 'q"{\\', 0, -1, 7, 2**62, 1.5, 5.0,
    True, False, None, [], [1, {}], {}, {"id": 1, "login": "l", "name": "n/m"}, {"size": 3},
]
INSERTS = [
    " ", "x", ",", "}", "]", "{", "[", '"', "\\", ":", "1", "null", '{"id":1}', ',"x":1', "\t",
    ',"payload":"{}"', '"payload":{},', "\\u0041", "é",
]


def damaged(rng):
    made = event()
    if rng.random() < 0.3:
        made["type"] = rng.choice(["PullRequestEvent", "WatchEvent", "PushEvent"])
    for _ in range(rng.choice([0, 0, 1, 1, 2])):
        where = rng.choice([made, made["actor"], made["repo"], made["org"], made["payload"]])
        key = rng.choice([*where, "extra"])
        if rng.random() < 0.3:
            where.pop(key, None)
        else:
            where[key] = rng.choice(VALUES)
        if not all(isinstance(made.get(k), dict) for k in ("actor", "repo", "org", "payload")):
            break
    text = json.dumps(
        made,
        ensure_ascii=rng.random() < 0.5,
        separators=rng.choice([(",", ":"), (", ", ": "), (" , ", " : ")]),
    )
    if rng.random() < 0.2:
        key = rng.choice(list(EVENT))
        text = text[:-1] + f',"{key}":{json.dumps(rng.choice(VALUES))}' + "}"
    for _ in range(rng.choice([0, 0, 0, 1, 1, 2])):
        at = rng.choice([rng.randrange(len(text) + 1), len(text), 0])
        if rng.random() < 0.5:
            text = text[:at] + rng.choice(INSERTS) + text[at:]
        else:
            text = text[:at] + text[at + rng.choice([1, 1, 2, 10]) :]
    return text


def test_damaged_lines_are_judged_alike(lines_frame):
    rng = random.Random(20250102)
    lines = [damaged(rng) for _ in range(6000)]
    # An ISO text the parser does not take by design is left out, see the README.
    lines = [t for t in lines if not re.search(r'"created_at" ?: ?"(?!2024-05-02T03:41:07Z")', t)]
    rows = bronze.parse_events(lines_frame(lines)).orderBy("source_line_number").collect()
    accepted = 0
    for row, text in zip(rows, lines, strict=True):
        try:
            expected, why = judge(text), None
        except Refused as refused:
            expected, why = None, str(refused)
        found = row["_error"] and row["_error"].split(": ", 1)[1]
        assert found == why, text
        if expected is None:
            continue
        accepted += 1
        assert json.loads(row["payload_json"]) == expected.pop("payload"), text
        assert {path: row[COLUMNS[path]] for path in expected} == expected, text
    assert 500 < accepted < len(lines) - 500


def judge_silver(kind, payload):
    """Action, commits and merge of a payload, or the reason it is refused."""
    requests = payload.get("pull_request")
    merged = requests.get("merged") if type(requests) is dict else None
    rules = [
        (type(payload.get("action")) in (str, type(None)), "payload.action", "str"),
        (kind != "PushEvent" or type(payload.get("size")) is int, "payload.size", "int"),
        (kind != "PullRequestEvent" or type(requests) is dict, "payload.pull_request", "dict"),
        (
            kind != "PullRequestEvent" or type(merged) is bool,
            "payload.pull_request.merged",
            "bool",
        ),
    ]
    for holds, path, wanted in rules:
        if not holds:
            raise Refused(f"field '{path}' must be {wanted}")
    return (
        payload.get("action"),
        payload["size"] if kind == "PushEvent" else None,
        merged if kind == "PullRequestEvent" else None,
    )


def test_payloads_are_judged_alike(lines_frame):
    rng = random.Random(3)
    cases = []
    for _ in range(1500):
        payload = {}
        for key in ("action", "size", "pull_request", "other"):
            if rng.random() < 0.6:
                payload[key] = rng.choice(VALUES)
        if rng.random() < 0.5:
            payload["pull_request"] = {"merged": rng.choice([True, False, *VALUES])}
        kind = rng.choice(["PushEvent", "PullRequestEvent", "WatchEvent"])
        cases.append((kind, payload))
    lines = [json.dumps(event(type=kind, payload=payload)) for kind, payload in cases]
    rows = silver.to_silver(bronze.parse_events(lines_frame(lines)))
    accepted = 0
    for row, (kind, payload) in zip(
        rows.orderBy("source_line_number").collect(), cases, strict=True
    ):
        try:
            expected, why = judge_silver(kind, payload), None
        except Refused as refused:
            expected, why = None, str(refused)
        assert (row["_error"] and row["_error"].split(": ", 1)[1]) == why, payload
        if expected is not None:
            accepted += 1
            assert (row["action"], row["commit_count"], row["is_merged"]) == expected
    assert accepted > 100

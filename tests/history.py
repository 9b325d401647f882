"""Random message histories and a plain row-by-row decoder to compare with."""

from __future__ import annotations

import datetime as dt
import json
import random
import re
from decimal import Decimal

from cdclake.schema import MESSAGE

UTC = dt.timezone.utc
START = dt.datetime(2026, 5, 9, 23, 50, tzinfo=UTC)
FIELDS = MESSAGE.fieldNames()


def msg(**fields):
    return tuple(fields.get(name) for name in FIELDS)


def text(value):
    return ("t", value, None)


NULL, TOAST = ("n", None, None), ("u", None, None)

TEXTS = {
    23: ["7", "-12", "+5", "007", "x1", "99999999999999999999", ""],
    1700: ["9999999999999999.99", "1250.00", "-0.000000000000001", "NaN", "Infinity", "-Infinity"],
    701: ["1.5", "NaN", "1e3", "-Infinity", "2.", "abc"],
    16: ["t", "false", "1", "yes"],
    25: ["plain", 'q"uote', "back\\slash", "tab\t", "uni é", "", "[x]", "a,b"],
}


def random_history(seed: int, slots: int = 1, txns: int = 40):
    """Messages in arrival order, with sessions that replay, and rolled-back ids."""
    rng = random.Random(seed)
    out = []
    for slot in [f"slot{i}" for i in range(slots)]:
        seq, lsn, now = 0, 1000, START
        log = []
        for x in range(txns):
            shared = rng.random() < 0.3
            rows = []
            for _ in range(rng.randint(1, 12 if shared else 4)):
                lsn += 0 if shared and rows else rng.randint(1, 9)
                rows.append((rng.choice("IUD"), rng.choice([1, 2, 3, 9]), lsn, rng.random()))
            lsn += 5
            now += dt.timedelta(seconds=rng.randint(0, 90))
            log.append((x, rows, lsn, now))
        session, position, known = 1, 0, {}
        while position < len(log):
            x, rows, end, commit_time = log[position]
            received = commit_time + dt.timedelta(seconds=session)

            def emit(**fields):
                nonlocal seq
                seq += rng.randint(1, 3)
                out.append(msg(slot=slot, session=session, seq=seq, received_at=received, **fields))

            if not (x == 0 and rng.random() < 0.5):
                emit(kind="B", xid=x, commit_time=commit_time, wal_start=rows[0][2])
            broken = rng.random() < 0.1
            for i, (op, relation, at, salt) in enumerate(rows):
                if relation != 9 and (relation not in known or rng.random() < 0.05):
                    oids = rng.sample([23, 1700, 701, 16, 25], 4)
                    columns = [(f"c{rng.randint(0, 99):02d}_{k}", oid) for k, oid in enumerate(oids)]
                    known[relation] = columns
                    emit(
                        kind="R", relation_id=relation, namespace="public", relation_name=f"t{relation}",
                        columns=columns, wal_start=0,
                    )
                cell_rng = random.Random(salt)
                columns = known.get(relation, [("none", 25)] * 3)

                def cells():
                    picked = [
                        cell_rng.choice([NULL, TOAST, ("b", None, 7), ("?", None, None)] + [text(cell_rng.choice(TEXTS[oid]))] * 8)
                        for _, oid in columns
                    ]
                    return picked + [text("extra")] * cell_rng.randint(0, 1)

                old = cell_rng.choice(["K", "O", None]) if op != "I" else None
                emit(
                    kind=op, relation_id=relation, wal_start=at, old_type=old,
                    old_tuple=cells() if old else None,
                    new_tuple=cells() if op != "D" else None,
                )
                if broken and i == len(rows) // 2:
                    break
            else:
                if rng.random() < 0.1:
                    emit(kind="T", relation_id=1, wal_start=end)
                emit(kind="C", commit_time=commit_time, end_lsn=end, wal_start=end - 5)
                position += 1
                if rng.random() > 0.1:
                    continue
            session, known = session + 1, {}
            position = max(0, position - rng.randint(0, 3))
    return out


NUMBER = re.compile(r"-?(0|[1-9]\d*)(\.\d+)?([eE][+-]?\d+)?")


def plain_value(oid, kind, value, size):
    if kind == "n":
        return None
    if kind == "u":
        return "<TOAST>"
    if kind == "b":
        return f"binary({size} bytes)"
    if oid == 23 and re.fullmatch(r"[+-]?\d+", value) and -(2**63) <= int(value) < 2**63:
        return int(value)
    if oid == 1700 and NUMBER.fullmatch(value):
        return Decimal(value)
    if oid == 701 and re.fullmatch(r"[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?", value):
        return float(value)
    if oid == 16 and value in ("t", "true", "1", "f", "false", "0"):
        return value in ("t", "true", "1")
    return value


def plain_image(columns, cells, key_only=False):
    image = {}
    for (name, oid), (kind, value, size) in zip(columns or [], cells or []):
        if kind in "nutb" and not (key_only and kind == "n"):
            image[name] = plain_value(oid, kind, value, size)
    return image


def plain_decode(messages):
    """Expected change rows: (slot, seq) -> (table, operation, lsn, before, after, commit_time)."""
    out, relations, commit_time = {}, {}, {}
    for m in sorted((dict(zip(FIELDS, m)) for m in messages), key=lambda m: (m["slot"], m["seq"])):
        slot, at = m["slot"], (m["slot"], m["session"], m["relation_id"])
        name, columns = relations.get(at, (f"unknown-{m['relation_id']}", []))
        old = None
        if m["old_type"] in ("K", "O"):
            old = plain_image(columns, m["old_tuple"], m["old_type"] == "K")
        new = plain_image(columns, m["new_tuple"])
        key, began = (slot, m["seq"]), commit_time.get(slot)
        if m["kind"] == "R":
            relations[at] = (m["relation_name"], m["columns"])
        elif m["kind"] == "B":
            commit_time[slot] = m["commit_time"]
        elif m["kind"] == "I":
            out[key] = (name, "insert", m["wal_start"], None, new, began)
        elif m["kind"] == "U":
            out[key] = (name, "update", m["wal_start"], old, new, began)
        elif m["kind"] == "D":
            out[key] = (name, "delete", m["wal_start"], old, None, began)
        elif m["kind"] == "C":
            out[key] = ("_transaction", "commit", m["end_lsn"], None, None, m["commit_time"])
    return out


def parse(image):
    """A stored image with exact numbers; integers and floats as they are."""
    if image is None:
        return None

    def number(text):
        return Decimal(text)

    return json.loads(image, parse_float=number, parse_int=number)


def comparable(image):
    """Numbers of a plain image as exact decimals."""
    if image is None:
        return None
    exact = {}
    for name, value in image.items():
        is_number = isinstance(value, (int, float)) and not isinstance(value, bool)
        exact[name] = Decimal(str(value)) if is_number else value
    return exact


def frame(spark, messages):
    return spark.createDataFrame(messages, MESSAGE)


def decoded_rows(changes):
    """Change rows in the shape of :func:`plain_decode`."""
    out = {}
    for r in changes.collect():
        commit = r.commit_time and r.commit_time.astimezone(UTC)
        assert (r.slot, r.seq) not in out
        out[(r.slot, r.seq)] = (r.table, r.operation, r.lsn, parse(r.before), parse(r.after), commit)
    return out


def expected_rows(messages):
    return {
        k: (t, op, lsn, comparable(b), comparable(a), c) for k, (t, op, lsn, b, a, c) in plain_decode(messages).items()
    }

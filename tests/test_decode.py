import json
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from cdclake.functions.images import DEFAULT_TYPES, image, layout
from cdclake.operators.decode import decode, select_tables
from cdclake.schema import COLUMNS, TUPLE
from tests import history


def one_image(spark, columns, cells, key_only=False, registry=DEFAULT_TYPES):
    df = spark.createDataFrame([(columns, cells)], f"c {COLUMNS.simpleString()}, t {TUPLE.simpleString()}")
    return df.select(image(layout(F.col("c")), F.col("t"), registry, key_only)).first()[0]


@pytest.mark.parametrize(
    ("oid", "text", "literal"),
    [
        (1700, "9999999999999999.99", "9999999999999999.99"),
        (1700, "1250.00", "1250.00"),
        (1700, "-0.000000000000001", "-0.000000000000001"),
        (1700, "123456789012345678901234567890123456789012.5", "123456789012345678901234567890123456789012.5"),
        (1700, "NaN", '"NaN"'),
        (1700, "Infinity", '"Infinity"'),
        (1700, "-Infinity", '"-Infinity"'),
        (20, "-5", "-5"),
        (21, "+5", "5"),
        (23, "007", "7"),
        (20, "9223372036854775807", "9223372036854775807"),
        (20, "9223372036854775808", '"9223372036854775808"'),
        (20, " 12 ", '" 12 "'),
        (701, "1.5", "1.5"),
        (701, ".5", "0.5"),
        (701, "NaN", '"NaN"'),
        (700, "1e400", '"1e400"'),
        (16, "t", "true"),
        (16, "0", "false"),
        (16, "yes", '"yes"'),
        (16, "T", '"T"'),
        (25, "", '""'),
        (25, 'a"b\\c\n[x]', '"a\\"b\\\\c\\n[x]"'),
        (3802, '{"k": 1}', '"{\\"k\\": 1}"'),
        (1007, "{1,2,3}", '"{1,2,3}"'),
        (99999, "5", '"5"'),
    ],
)
def test_cell_text(spark, oid, text, literal):
    assert one_image(spark, [("v", oid)], [history.text(text)]) == f'{{"v":{literal}}}'


def test_markers_keys_and_positions(spark):
    columns = [('b"x', 25), ("a", 23), ("n", 25), ("t", 25), ("z", 25)]
    cells = [history.text("x"), history.text("1"), history.NULL, history.TOAST, ("b", None, 12), history.text("past")]
    built = one_image(spark, columns, cells)
    assert built == '{"a":1,"b\\"x":"x","n":null,"t":"<TOAST>","z":"binary(12 bytes)"}'
    assert json.loads(one_image(spark, columns, cells, key_only=True)) == {
        "a": 1, 'b"x': "x", "t": "<TOAST>", "z": "binary(12 bytes)",
    }
    # Fewer cells than columns, an unknown marker, no cells, no columns.
    assert one_image(spark, columns, cells[:1]) == '{"b\\"x":"x"}'
    assert one_image(spark, columns[:1], [("?", "x", None)]) == "{}"
    assert one_image(spark, columns, None) == "{}"
    assert one_image(spark, columns, []) == "{}"
    assert one_image(spark, None, cells) == "{}"


def test_registered_handler(spark):
    registry = DEFAULT_TYPES.with_handler(3802, lambda t: t).with_handler(23, lambda t: F.when(t == "1", "one_"))
    cells = [history.text('{"k": 1}'), history.text("2")]
    assert one_image(spark, [("j", 3802), ("i", 23)], cells, registry=registry) == '{"i":"2","j":{"k": 1}}'


@pytest.mark.parametrize("seed", range(6))
def test_random_histories(spark, seed):
    """Chunks far smaller than a session give what one pass in order gives."""
    messages = history.random_history(seed, slots=1 + seed % 3)
    got = history.decoded_rows(decode(history.frame(spark, messages).repartition(3), chunk_bits=2 + seed % 4))
    assert got == history.expected_rows(messages)


def test_carry_continues_a_history(spark):
    messages = history.random_history(11)
    cut = len(messages) // 2
    state = [m for m in messages[:cut] if m[history.FIELDS.index("kind")] in ("R", "B")]
    rest = decode(history.frame(spark, messages[cut:]), carry=history.frame(spark, state), chunk_bits=4)
    expected = history.expected_rows(messages)
    seqs = {m[history.FIELDS.index("seq")] for m in messages[cut:]}
    assert history.decoded_rows(rest) == {k: v for k, v in expected.items() if k[1] in seqs}


def test_commit_time_survives_reconnect_but_relations_do_not(spark):
    columns = [("id", 20)]
    row = dict(kind="I", relation_id=5, new_tuple=[history.text("1")], wal_start=1)
    when = history.START
    messages = [
        history.msg(slot="s", session=1, seq=1, kind="B", commit_time=when),
        history.msg(slot="s", session=1, seq=2, kind="R", relation_id=5, relation_name="t", columns=columns),
        history.msg(slot="s", session=1, seq=3, **row),
        history.msg(slot="s", session=2, seq=4, **row),
    ]
    got = history.decoded_rows(decode(history.frame(spark, messages)))
    assert got[("s", 3)] == ("t", "insert", 1, None, {"id": Decimal(1)}, when)
    assert got[("s", 4)] == ("unknown-5", "insert", 1, None, {}, when)


def test_commit_position_is_the_end_of_its_record(spark):
    commit = history.msg(slot="s", session=1, seq=1, kind="C", wal_start=100, end_lsn=148, commit_time=history.START)
    assert history.decoded_rows(decode(history.frame(spark, [commit])))[("s", 1)][2] == 148


def test_table_selection_keeps_commits(spark):
    changes = decode(history.frame(spark, history.random_history(3)))
    chosen = {r.table for r in select_tables(changes, ["t1"]).select("table").distinct().collect()}
    assert chosen == {"t1", "_transaction"}
    assert select_tables(changes).count() == changes.count()

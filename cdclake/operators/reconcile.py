"""Data-quality checks that compare the lake with what it should hold."""

from __future__ import annotations

import json
import re
from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cdclake.functions.positions import commit_date
from cdclake.operators.scan import CHUNK_BITS, Running, chunk_of, ordered_scan
from cdclake.session import materialized

_BLOCK = 10_000

#: Field type for numbers of any length: the digits as text, cut from the image.
EXACT = "exact"


_NUMBER = r'^"?(-?[0-9][-+.0-9eE]*|NaN|-?Infinity)"?$'
_TOKEN = r'"[^"]*+"|[{}\[\],:]|[^"{}\[\],:\s]+'


_TEXT = '"[^"]*+"'
_BRACKET = r"[\[\]{}]"
_NESTED = rf'({_TEXT})|[\[{{](?:[^"\[\]{{}}]++|{_TEXT})*+[\]}}]'

#: Levels of nested values that are cut out of an image before its members are looked for, and the longest
#: image to do so with: the pattern needs stack for every text in a nested value.
_LEVELS, _LONGEST = 2, 4000


def _unescaped_quotes(text):
    """Give escaped backslashes and quotes other characters, which cannot stand in JSON, so that a quote ends a string."""
    pairs = (("\\\\", "\x01\x01"), ('\\"', "\x01\x02"))
    for old, new in pairs:
        text = text.replace(old, new) if isinstance(text, str) else F.replace(text, F.lit(old), F.lit(new))
    return text


def _member_by_tokens(image: Column, name: str) -> Column:
    """The value of a member of the image itself, as it stands there; null for nested values."""
    wanted = F.lit(_unescaped_quotes(json.dumps(name, ensure_ascii=False)))
    tokens = F.regexp_extract_all(_unescaped_quotes(image), F.lit(_TOKEN), F.lit(0))
    nothing = F.lit(None).cast("string")

    def step(acc: Column, token: Column) -> Column:
        depth, key, value = acc["depth"], acc["key"], acc["value"]
        deeper = F.when(token.isin("{", "["), depth + 1).when(token.isin("}", "]"), depth - 1).otherwise(depth)
        mark = token.isin("{", "[", "}", "]", ":")
        here = (depth == 1) & ~mark
        return F.struct(
            deeper.alias("depth"),
            F.when(here & (token == ","), nothing).when(here & key.isNull(), token).otherwise(key).alias("key"),
            F.when(here & (token != ",") & (key == wanted) & value.isNull(), token).otherwise(value).alias("value"),
        )

    start = F.struct(F.lit(0).alias("depth"), nothing.alias("key"), nothing.alias("value"))
    return F.aggregate(tokens, start, step)["value"]


def _member_text(image: Column, name: str) -> Column:
    """The value of a member of the image itself, as it stands there; null or empty for nested values.

    Nested values are cut out and the member is found by one expression; in long images
    and where nesting is deeper, it is found token by token.
    """
    if not re.match(r"\w", name):  # could follow the end of a text
        return _member_by_tokens(image, name)
    wanted = "".join(c if c.isascii() and c.isalnum() else f"\\x{{{ord(c):x}}}" for c in _unescaped_quotes(json.dumps(name, ensure_ascii=False)))
    pattern = rf'(?:\A|,)\s*{wanted}\s*:\s*({_TEXT}|[^"{{}}\[\],:\s]++)'
    members = F.regexp_replace(_unescaped_quotes(image), r"\A\s*\{|\}\s*\z", "")
    for _ in range(_LEVELS):
        members = F.regexp_replace(members, _NESTED, "$1")

    def found(own: Column) -> Column:
        flat = (F.length(image) <= _LONGEST) & ~F.regexp_replace(own, _TEXT, "").rlike(_BRACKET)
        return F.when(flat, F.regexp_extract(own, pattern, 1)).otherwise(_member_by_tokens(image, name))

    # Bound to a variable: as an expression it would be worked out at each of its uses.
    return F.get(F.transform(F.array(members), found), F.lit(0))


#: With options given, all members come from one parse of the image; without, Spark parses it anew for each.
_JSON_OPTIONS = {"mode": "PERMISSIVE"}


def _parsed(image: Column, fields: Mapping[str, T.DataType]) -> Column:
    return F.from_json(image, T.StructType([T.StructField(n, t) for n, t in fields.items()]), _JSON_OPTIONS)


def expand_image(image: Column, fields: Mapping[str, T.DataType | str]) -> dict[str, Column]:
    """Typed columns of a row image, by field name.

    Use decimal types for NUMERIC: they keep up to 38 digits exact.  A number of
    any length can be read as ``EXACT`` text.  Spark's JSON string accessors round
    numbers, so ``EXACT`` takes the text out of the image instead.  Only members of
    the image itself are read, never those of JSON that is embedded in it.
    """
    parsed = _parsed(image, {n: t for n, t in fields.items() if t != EXACT})
    out = {}
    for name, kind in fields.items():
        if kind == EXACT:
            out[name] = F.get(F.regexp_extract_all(_member_text(image, name), F.lit(_NUMBER), F.lit(1)), F.lit(0))
        else:
            out[name] = parsed[name]
    return out


def row_image() -> Column:
    """The image that identifies a row: after, or before where there is no after."""
    return F.when(F.col("after").isNull(), F.col("before")).otherwise(F.col("after"))


def row_identity(lake: DataFrame, field: str = "id", kind: T.DataType | str = T.LongType()) -> DataFrame:
    """``lake`` with the row's key from its identifying image."""
    return lake.withColumn(field, expand_image(row_image(), {field: kind})[field])


def _change_key(deleted: Column, values: Mapping[str, Column]) -> list[Column]:
    """Deletes are known by operation and id, other changes by their values too."""
    return [F.when(~deleted, v).alias(n) for n, v in values.items()]


def missing_changes(
    expected: DataFrame,
    lake: DataFrame,
    fields: Mapping[str, T.DataType | str],
    key: str = "id",
) -> DataFrame:
    """Rows of ``expected`` (``operation``, ``key``, ``fields``) not in the lake.

    Inserts and updates must match in all fields of their after image; deletes
    in their key.  A stored value that its type cannot hold, as a number of too many
    digits, is no null: it equals nothing.  Equal rows are counted before the join on either side, so that
    a change that comes many times is one row in it; the expected rows are
    restored afterwards, each as often as it was given.
    """
    values = [n for n in fields if n != key]
    after = expand_image(F.col("after"), {n: fields[n] for n in values})
    text = _parsed(F.col("after"), dict.fromkeys(values, T.StringType()))
    unreadable = F.lit(False)
    for name in values:
        unreadable |= after[name].isNull() & text[name].isNotNull()
    seen = (
        row_identity(lake, key, fields[key])
        .filter(F.col("operation").isin("insert", "update", "delete"))
        .filter((F.col("operation") == "delete") | ~F.coalesce(unreadable, F.lit(False)))
        .select("operation", key, *_change_key(F.col("operation") == "delete", after))
        .distinct()
        .select(*[F.col(c).alias(f"__{c}") for c in ("operation", key, *values)])
    )
    deleted = F.col("operation") == "delete"
    same = (F.col("operation") == F.col("__operation")) & (F.col(key) == F.col(f"__{key}"))
    for name in values:
        same &= F.when(~deleted, F.col(name)).eqNullSafe(F.col(f"__{name}"))
    counted = expected.groupBy(*expected.columns).agg(F.count(F.lit(1)).alias("__times"))
    missing = counted.join(seen, same, "left_anti")
    # In two steps, so that no row holds an array as long as a change comes often.
    blocks = missing.withColumn("__block", F.explode(F.sequence(F.lit(0), F.floor((F.col("__times") - 1) / _BLOCK))))
    here = F.least(F.lit(_BLOCK), F.col("__times") - F.col("__block") * _BLOCK)
    return blocks.select(*expected.columns, F.explode(F.sequence(F.lit(1).cast("bigint"), here)).alias("__n")).drop("__n")


def rolled_back_leaks(
    lake: DataFrame, rolled_back_ids: DataFrame, key: str = "id", kind: T.DataType | str = T.LongType()
) -> DataFrame:
    """Lake rows whose key was only ever in a rolled-back transaction.

    The ids are joined as they are: a plain shuffle on both sides lets Spark split
    a key that holds many lake rows, which it cannot do behind a distinct.
    """
    return row_identity(lake, key, kind).join(rolled_back_ids.select(key), key, "left_semi")


def misplaced_rows(lake: DataFrame) -> DataFrame:
    """Rows in the folder of another day than their commit day, with that day."""
    day = commit_date(F.col("commit_time"), F.col("timestamp"))
    return lake.withColumn("expected_date", day).filter(F.col("expected_date") != F.col("commit_date"))


def mixed_day_files(lake: DataFrame, file: Column | None = None) -> DataFrame:
    """Files that hold more than one commit day."""
    day = commit_date(F.col("commit_time"), F.col("timestamp"))
    source = F.col("_metadata.file_path") if file is None else file
    return (
        lake.select(source.alias("file"), day.alias("day"))
        .groupBy("file")
        .agg(F.min("day").alias("first_day"), F.max("day").alias("last_day"), F.count(F.lit(1)).alias("rows"))
        .filter(F.col("first_day") != F.col("last_day"))
    )


def duplicate_keys(manifest: DataFrame, key: str = "key") -> DataFrame:
    """File keys used more than once, with how often."""
    return manifest.filter(F.col(key).isNotNull()).groupBy(key).count().filter(F.col("count") > 1)


def conservation(changes: DataFrame, lake: DataFrame, chunk_bits: int = CHUNK_BITS) -> DataFrame:
    """Events not stored exactly as often as they were decoded.

    Chunks of positions are compared first, by their number of events and sums of two
    hashes of them, which do not depend on order and are added up before they are
    shuffled.  Only events of chunks that differ are then counted one by one, so what is
    shuffled grows with the differences and the number of chunks, not with the events.
    Sums of different events agree by chance in one of 2**64 chunks or so.
    """
    event = ["slot", "session", "seq"]
    chunk = ["slot", "session", "__chunk"]

    def summed(rows: DataFrame, sign: int) -> DataFrame:
        marks = [F.xxhash64(F.lit(k), *event).cast("decimal(20,0)") * sign for k in (1, 2)]
        return rows.select(*event, chunk_of(F.col("seq"), chunk_bits).alias("__chunk")).select(
            *chunk, F.lit(sign).alias("__n"), *(m.alias(f"__s{k}") for k, m in enumerate(marks))
        )

    sums = summed(changes, 1).unionByName(summed(lake, -1)).groupBy(*chunk)
    uneven = sums.agg(*(F.sum(c).alias(c) for c in ("__n", "__s0", "__s1"))).filter("__n <> 0 OR __s0 <> 0 OR __s1 <> 0")
    uneven = materialized(uneven.select(*chunk), "uneven-chunks")  # its size decides how the rows are joined

    def counted(rows: DataFrame, decoded: int) -> DataFrame:
        placed = rows.select(*event, chunk_of(F.col("seq"), chunk_bits).alias("__chunk"))
        return placed.join(uneven, chunk, "left_semi").select(*event, F.lit(decoded).alias("d"), F.lit(1 - decoded).alias("s"))

    return (
        counted(changes, 1)
        .unionByName(counted(lake, 0))
        .groupBy(*event)
        .agg(F.sum("d").alias("decoded"), F.sum("s").alias("stored"))
        .filter(F.col("decoded") != F.col("stored"))
    )


def order_breaks(lake: DataFrame, order: tuple[str, ...] = ("timestamp", "lsn", "seq")) -> DataFrame:
    """Rows that come before their predecessor in the same file.

    Needs rows read from Parquet, whose row positions give the order in a file;
    files are cut into chunks of positions, so a large file is not one task.
    """
    rows = lake.select(
        *order,
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.row_index").alias("row_index"),
        F.struct(*order).alias("__key"),
    )
    scanned = ordered_scan(rows, ["file"], "row_index", {"__before": Running("lag", F.col("__key"))})
    return scanned.filter(F.col("__key") < F.col("__before")).drop("__key", "__before")


def dedup_replays(changes: DataFrame, chunk_bits: int = CHUNK_BITS) -> DataFrame:
    """One row per source change; the earliest arrival of each is kept.

    A replay sends a transaction again in a later session.  The position alone is
    no key (the rows of a bulk load share one), so a change is known by its
    position, whether it is a commit, and its place among the rows of its session
    with that position.

    The rows of one position stand together in their session, so a place is counted
    from where the position last changed, by scans over chunks of the session.
    Which rows to keep is found from the positions alone, without the images; the
    rows themselves are shuffled once, by their own identity.  First arrivals come
    from a partial aggregate, so neither a bulk load of any size nor a change
    replayed any number of times is gathered in one task.
    """
    session = ["slot", "session", "commit"]
    positions = changes.select("slot", "session", (F.col("operation") == "commit").alias("commit"), "lsn", "seq")
    counted = ordered_scan(
        positions, session, "seq",
        {"before": Running("lag", F.col("lsn")), "idx": Running("sum", F.lit(1).cast("bigint"))}, chunk_bits,
    )
    begins = F.when(~F.col("lsn").eqNullSafe(F.col("before")), F.col("idx"))
    placed = ordered_scan(counted, session, "seq", {"start": Running("max", begins)}, chunk_bits)
    place = (F.col("idx") - F.col("start")).alias("place")
    first = placed.groupBy("slot", "lsn", "commit", place).agg(F.min("seq").alias("seq"))
    return changes.join(first.select("slot", "seq"), ["slot", "seq"], "left_semi").select(*changes.columns)

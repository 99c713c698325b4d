"""Message parsing.

Two policies, as in the reference:

* lenient (`parse_lenient`): ip from the record key, bad fields become
  null and the row is kept - the detector then counts it as unknown;
* strict (`parse_strict`): ip from the body, a row is kept only when the
  body is one JSON object, nothing after it, with all four fields of their
  JSON type (three strings, an integer) and the type is `click` or `watch`.
  Quoted or fractional numbers are no integers, and an object that repeats a
  key is malformed. `quarantine` returns the rejected rows with the reason.

A `unix_time` outside the years 1 to 9999 is no time: null when lenient, an
invalid field when strict. All of it is built-in expressions; nothing leaves
the JVM.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from clickguard.schema import MESSAGE

# 0001-01-01 00:00:00 to 9999-12-31 23:59:59 UTC, in epoch seconds.
EARLIEST_S, LATEST_S = -62_135_596_800, 253_402_300_799

# The JSON type of each message field, as `schema_of_variant` names it.
_JSON_TYPE = {T.StringType(): "STRING", T.LongType(): "BIGINT"}

# The event types the detector recognises.
KNOWN_TYPES = ("click", "watch")

# Fixed value: the key-extraction pattern of the spool agent (group 1 = ip).
IP_KEY_PATTERN = r'"ip":.?"([^"]+)"'


def _text(c: str | Column) -> Column:
    c = F.col(c) if isinstance(c, str) else c
    return c.cast("string")


def parse_message(value: str | Column = "value") -> Column:
    """`from_json` of a message body; ill-typed fields are null."""
    return F.from_json(_text(value), MESSAGE, {"mode": "PERMISSIVE"})


def event_time(unix_time: Column) -> Column:
    """Epoch seconds as a timestamp; null outside the years 1 to 9999 (any
    client can send any number, and the cast would fail the job)."""
    return F.when(unix_time.between(EARLIEST_S, LATEST_S), F.timestamp_seconds(unix_time))


def _pinned(records: DataFrame, keep: tuple[str, ...], **cols: Column) -> DataFrame:
    """`records` plus `cols`, computed once per row below any later filter.

    A filter on a parsed field (the detector's ``eventTime IS NOT NULL``,
    the strict acceptance test) would otherwise be pushed below the
    projection with `from_json` inlined into it, parsing every message
    twice or more. A generator output cannot be pushed through, so `inline`
    of a one-element array pins the parse.
    """
    row = F.struct(*[c.alias(n) for n, c in cols.items()])
    return records.select(*keep, F.inline(F.array(row)))


def parse_lenient(records: DataFrame, key: str = "key", value: str = "value",
                  keep: tuple[str, ...] = ()) -> DataFrame:
    """Kafka-shaped records -> `(ip, action, eventTime)`; ip from the key."""
    m = F.col("_m")
    return (_pinned(records, keep, _k=_text(key), _m=parse_message(value))
            .select(*keep, F.col("_k").alias("ip"),
                    m.getField("type").alias("action"),
                    event_time(m.getField("unix_time")).alias("eventTime")))


def _only_value(raw: Column) -> Column:
    """The one JSON value that the text is, as a variant; null for anything
    else. The variant parser stops after the first value, so the text is read
    as the head of an array that ends in the text's own hash: junk, a second
    value or a closing bracket in the text would keep the hash from its place.
    """
    mark = F.xxhash64(raw)
    pair = F.try_parse_json(F.concat(F.lit("["), raw, F.lit(","), mark.cast("string"), F.lit("]")))
    return F.when(F.try_variant_get(pair, "$[1]", "bigint") == mark,
                  F.try_variant_get(pair, "$[0]", "variant"))


_TEXT_MEMBER = r'"(?:type|ip|url)"\s*:\s*"[^"\\\x00-\x1f]*"'
_MEMBER = rf'(?:{_TEXT_MEMBER}|"unix_time"\s*:\s*-?(?:0|[1-9][0-9]{{0,17}}))'
#: An object of four members, each a message field of its JSON type, and nothing
#: else. With no field missing it has each of them once.
_PLAIN_MESSAGE = rf"^\s*\{{\s*{_MEMBER}(?:\s*,\s*{_MEMBER}){{3}}\s*\}}\s*$"


def _checked(records: DataFrame, value: str, keep: tuple[str, ...]) -> DataFrame:
    """`_raw` text, `_object` (whether it is one JSON object) and per field
    its JSON type `_t_<field>` and value `_<field>`; the parse is pinned, the
    fields are read from it once. A plain message, as agents send it, is told by
    its text and read as the lenient parser reads it; only others become
    variants, whose types are asked field by field."""
    raw = F.col("_raw")  # a column of its own: a generator computes each mention of an expression
    parsed = _pinned(records.select(*keep, _text(value).alias("_raw")), (*keep, "_raw"),
                     _m=F.when(raw.rlike(_PLAIN_MESSAGE), F.from_json(raw, MESSAGE)))
    m, doc = F.col("_m"), F.col("_doc")
    plain = F.lit(True)
    for f in MESSAGE.fields:
        plain = plain & m.getField(f.name).isNotNull()
    parsed = _pinned(parsed, (*keep, "_raw", "_m"), _plain=plain,
                     _doc=F.when(~plain, _only_value(F.col("_raw"))))
    plain = F.col("_plain")
    cols = {"_object": plain | F.coalesce(F.schema_of_variant(doc).startswith("OBJECT<"), F.lit(False))}
    for f in MESSAGE.fields:
        asked = F.schema_of_variant(F.try_variant_get(doc, f"$.{f.name}", "variant"))
        cols[f"_t_{f.name}"] = F.when(plain, F.lit(_JSON_TYPE[f.dataType])).otherwise(asked)
        cols[f"_{f.name}"] = F.when(plain, m.getField(f.name)).otherwise(
            F.try_variant_get(doc, f"$.{f.name}", f.dataType.simpleString()))
    return _pinned(parsed, (*keep, "_raw"), **cols)


def _well_typed(f: T.StructField) -> Column:
    ok = F.col(f"_t_{f.name}") == _JSON_TYPE[f.dataType]
    if f.name == "unix_time":
        ok = ok & F.col("_unix_time").between(EARLIEST_S, LATEST_S)
    return F.coalesce(ok, F.lit(False))


def _accepted() -> Column:
    ok = F.col("_object")
    for f in MESSAGE.fields:
        ok = ok & _well_typed(f)
    return ok & F.coalesce(F.col("_type").isin(*KNOWN_TYPES), F.lit(False))


def parse_strict(records: DataFrame, value: str = "value",
                 keep: tuple[str, ...] = ()) -> DataFrame:
    """Kafka-shaped records -> `(ip, action, eventTime)`, ip from the body,
    rejects dropped."""
    return (_checked(records, value, keep)
            .filter(_accepted())
            .select(*keep, F.col("_ip").alias("ip"), F.col("_type").alias("action"),
                    F.timestamp_seconds("_unix_time").alias("eventTime")))


def _field_problem(f: T.StructField) -> Column:
    kind = F.col(f"_t_{f.name}")
    return (F.when(kind.isNull() | (kind == "VOID"), F.lit(f"missing field: {f.name}"))
            .when(~_well_typed(f), F.lit(f"invalid field: {f.name}")))


def reject_reason() -> Column:
    """Why a record fails the strict parse (null when it passes). The first
    problem wins: empty, not a JSON object, a field (in declared order),
    then an unknown type."""
    return (F.when(F.col("_raw").isNull(), F.lit("empty message"))
            .when(~F.col("_object"), F.lit("malformed json"))
            .otherwise(F.coalesce(
                *[_field_problem(f) for f in MESSAGE.fields],
                F.when(~F.col("_type").isin(*KNOWN_TYPES),
                       F.concat(F.lit("unknown type: "), F.col("_type"))))))


def quarantine(records: DataFrame, value: str = "value",
               keep: tuple[str, ...] = ()) -> DataFrame:
    """The records `parse_strict` rejects, with `raw` text and `reason`."""
    return (_checked(records, value, keep)
            .filter(~_accepted())
            .select(*keep, F.col("_raw").alias("raw"), reject_reason().alias("reason")))


def judged(records: DataFrame, value: str = "value", keep: tuple[str, ...] = ()) -> DataFrame:
    """Every record with its `raw` text and why the strict parse rejects it
    (`reason`, null where it passes)."""
    return _checked(records, value, keep).select(*keep, F.col("_raw").alias("raw"), reject_reason().alias("reason"))


def normalise_action(action: str | Column = "action") -> Column:
    """The event-type enum: a known type stays, anything else (including
    null) becomes ``unknown``."""
    a = F.col(action) if isinstance(action, str) else action
    return F.when(a.isin(*KNOWN_TYPES), a).otherwise(F.lit("unknown"))


def extract_key(line: str | Column = "value") -> Column:
    """The ip a spool agent puts into the record key: the first
    ``"ip":"..."`` of the line; null when there is none."""
    k = F.regexp_extract(_text(line), IP_KEY_PATTERN, 1)
    return F.when(k != "", k)

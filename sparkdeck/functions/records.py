"""Log lines and JSON messages to columns."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

_MARK, _ESCAPE = "\u0001", "\u0002"

# Combined access log line, nine captured fields.
ACCESS_LINE = (
    r'^(\S+) (\S+) (\S+) \[([^\]]+)\] "(?:(\w+) (\S+)(?: HTTP/[\d.]+)?|[^"]*)" (\d+) (\d+|-)'
    r' "([^"]*)" "([^"]*)".*$'
)
ACCESS_FIELDS = ["clientip", "ident", "auth", "timestamp", "verb", "request", "response", "bytes", "referrer", "agent"]
ERROR_LINE = r"^\[([^\]]+)\] \[([^:\]]*):([^\]]*)\] \[pid (\d+)[^\]]*\] (\w+): (.*)$"
ERROR_FIELDS = ["timestamp", "module", "level", "pid", "code", "message"]

EVENT_SCHEMA = (
    "idsite string, idgoal string, _pks string, _id string, uid string, current_ts string, "
    "ec_id string, ec_items string"
)


def _groups(line: Column, pattern: str, names: list[str], build) -> Column:
    """`build` applied to the named groups of a match, null without a match.

    The line is matched once: the groups are written into one marked text and cut apart. Binding the
    parts in a one-element array keeps the match from being repeated for every field. Marks that stand in
    the line itself are escaped before and restored after.
    """
    escaped = F.replace(F.replace(line, F.lit(_ESCAPE), F.lit(f"{_ESCAPE}b")), F.lit(_MARK), F.lit(f"{_ESCAPE}a"))
    rare = F.contains(line, F.lit(_MARK)) | F.contains(line, F.lit(_ESCAPE))
    marked = F.regexp_replace(F.when(rare, escaped).otherwise(line), pattern, _MARK.join(f"${i}" for i in range(1, len(names) + 1)))

    def restored(part):
        plain = F.replace(F.replace(part, F.lit(f"{_ESCAPE}a"), F.lit(_MARK)), F.lit(f"{_ESCAPE}b"), F.lit(_ESCAPE))
        return F.when(F.contains(part, F.lit(_ESCAPE)), plain).otherwise(part)

    found = F.filter(F.array(F.split(marked, _MARK)), lambda parts: F.size(parts) == len(names))
    built = F.transform(found, lambda parts: build({n: restored(parts[i]) for i, n in enumerate(names)}))
    return F.get(built, F.lit(0))


def parse_access_log(line: Column) -> Column:
    """Struct of access log fields; null when the line does not match."""

    def build(field):
        field["timestamp"] = F.try_to_timestamp(field["timestamp"], F.lit("dd/MMM/yyyy:HH:mm:ss Z"))
        field["response"] = field["response"].try_cast("int")
        field["bytes"] = field["bytes"].try_cast("bigint")
        return F.struct(*[c.alias(n) for n, c in field.items()])

    return _groups(line, ACCESS_LINE, ACCESS_FIELDS, build)


def parse_error_log(line: Column) -> Column:
    """Struct of error log fields; an unmatched line keeps its whole text as the message."""

    def build(field):
        # the weekday name is not needed and not every parser accepts it
        stamp = F.regexp_replace(field["timestamp"], r"^\w+ ", "")
        field["timestamp"] = F.try_to_timestamp(stamp, F.lit("MMM d HH:mm:ss.SSSSSS yyyy"))
        field["pid"] = field["pid"].try_cast("int")
        return F.struct(*[c.alias(n) for n, c in field.items()])

    kinds = {"timestamp": "timestamp", "pid": "int"}
    bare = F.struct(
        *[(line if n == "message" else F.lit(None).cast(kinds.get(n, "string"))).alias(n) for n in ERROR_FIELDS]
    )
    return F.coalesce(_groups(line, ERROR_LINE, ERROR_FIELDS, build), bare)


def route_events(df: DataFrame, json_col: str = "value") -> DataFrame:
    """One row per message with `kind` page, cart or purchase; unreadable messages act as empty ones.

    Goal other than "0" is a page view; goal "0" is a cart, or a purchase when an order id is present.
    """
    e = F.col("_e")
    goal = F.coalesce(e["idgoal"], F.lit("-1"))
    kind = F.when(goal != "0", "page").when(e["ec_id"].isNull(), "cart").otherwise("purchase")
    # parsed once in a step of its own, then read field by field
    parsed = df.withColumn("_e", F.from_json(F.col(json_col), EVENT_SCHEMA))
    return parsed.withColumns(
        {
            "kind": kind,
            "idsite": F.coalesce(e["idsite"], F.lit("0")),
            "idgoal": goal,
            "pks": F.coalesce(e["_pks"], F.lit("0")),
            "visitor": F.coalesce(e["_id"], F.lit("none")),
            "uid": F.coalesce(e["uid"], F.lit("0")),
            "current_ts": F.coalesce(e["current_ts"], F.lit("none")),
            "items": F.when(kind != "page", F.from_json(e["ec_items"], "array<array<string>>")),
        }
    ).drop("_e")

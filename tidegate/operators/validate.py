"""Row and event validation: problems become columns, never exceptions."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce
from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidegate.functions.scalars import int_ok, numeric_ok
from tidegate.operators.shape import compute_once, union_all
from tidegate.schemas import EVENT_POSITIVE, EVENT_REQUIRED, EVENT_TYPE, PASSENGERS_MAX, PASSENGERS_MIN

NUMBER_TYPES = "^(BIGINT|INT|SMALLINT|TINYINT|DECIMAL.*|DOUBLE|FLOAT)$"


# --- events ---------------------------------------------------------------


def event_error(
    required: Sequence[str] = EVENT_REQUIRED,
    event_type: str = EVENT_TYPE,
    positive: Sequence[str] = EVENT_POSITIVE,
    count: tuple[str, int, int] | None = ("passenger_count", PASSENGERS_MIN, PASSENGERS_MAX),
    timestamps: Sequence[str] = ("pickup_datetime",),
    misfit: Column | None = None,
) -> Column:
    """First broken rule of an event whose fields are text, NULL for a valid event.

    Order: required fields, event type, positive numbers, count range, timestamps, and last
    ``misfit``, the names of the fields that their table types don't hold.
    """
    rules = [(F.col(f).isNull(), F.lit(f"Required field '{f}' is missing or null")) for f in required]
    rules.append(
        (F.col("event_type") != event_type, F.concat(F.lit("Unknown event_type '"), F.col("event_type"), F.lit("'")))
    )
    for f in positive:
        value = F.col(f)
        rules.append((value.isNotNull() & ~numeric_ok(f), _text(f"Field '{f}' must be numeric, got '", value)))
        rules.append((value.try_cast("double") <= 0, _text(f"Field '{f}' must be > 0, got '", value)))
    if count is not None:
        f, lo, hi = count
        value = F.col(f)
        rules.append((value.isNotNull() & ~int_ok(f), _text(f"{f} must be an integer, got '", value)))
        rules.append((~value.try_cast("double").between(lo, hi), _text(f"{f} must be between {lo} and {hi}, got '", value)))
    for f in timestamps:
        bad = F.col(f).isNotNull() & F.col(f).try_cast("timestamp").isNull()
        rules.append((bad, _text(f"Field '{f}' must be a timestamp, got '", F.col(f))))
    if misfit is not None:
        rules.append((F.size(misfit) > 0, F.concat(F.lit("Outside the table's type: "), F.array_join(misfit, ", "))))
    chain = reduce(lambda acc, rule: acc.when(rule[0], rule[1]), rules, F)
    return chain.otherwise(F.lit(None).cast("string"))


def _text(start: str, value: Column) -> Column:
    return F.concat(F.lit(start), value, F.lit("'"))


def validate_events(df: DataFrame, **rules: Any) -> DataFrame:
    """Add ``error``; an error already present (bad JSON) stays first."""
    found = event_error(**rules)
    return df.withColumn("error", F.coalesce("error", found) if "error" in df.columns else found)


# --- row payloads ---------------------------------------------------------


@dataclass(frozen=True)
class Field:
    """One payload field. ``kind`` is ``number``, ``int`` or ``string``."""

    name: str
    kind: str
    required: bool = False
    nullable: bool = False
    minimum: float | None = None
    maximum: float | None = None
    default: Any = None

    @property
    def type(self) -> str:
        return {"number": "double", "int": "bigint", "string": "string"}[self.kind]


def partial(fields: Sequence[Field]) -> list[Field]:
    """The update form of a payload: nothing is required."""
    return [Field(f.name, f.kind, False, f.nullable, f.minimum, f.maximum, None) for f in fields]


def _problems(problems: Sequence[tuple[str, str, Column]]) -> Column:
    entries = [
        F.when(bad, F.struct(F.lit(path).alias("path"), F.lit(message).alias("message")))
        for path, message, bad in problems
    ]
    return F.array_compact(F.array(*entries))


def _bounds(f: Field, number: Column) -> list[tuple[str, str, Column]]:
    found = []
    if f.minimum is not None:
        found.append((f.name, f"must be at least {f.minimum:g}", F.coalesce(number < f.minimum, F.lit(False))))
    if f.maximum is not None:
        found.append((f.name, f"must be at most {f.maximum:g}", F.coalesce(number > f.maximum, F.lit(False))))
    return found


def validate_rows(df: DataFrame, fields: Sequence[Field]) -> DataFrame:
    """Add ``errors`` (path, message) to rows that are already columns. A NULL counts as not given."""
    problems = []
    for f in fields:
        if f.name not in df.columns:
            if f.required:
                problems.append((f.name, "is required", F.lit(True)))
            continue
        value = F.col(f.name)
        if f.required and not f.nullable:
            problems.append((f.name, "is required", value.isNull()))
        if f.kind != "string":
            number = value.try_cast("double")
            problems.append((f.name, "must be a number", value.isNotNull() & (number.isNull() | F.isnan(number))))
            if f.kind == "int":
                problems.append((f.name, "must be an integer", F.coalesce(number != F.floor(number), F.lit(False))))
            problems += _bounds(f, number)
    return df.withColumn("errors", _problems(problems))


def validate_payloads(df: DataFrame, body: str, fields: Sequence[Field]) -> DataFrame:
    """Add ``errors`` to JSON object payloads, checking JSON types (``"2"`` is not a number).

    The parsed payload stays as the variant column ``_payload``.
    """
    df = compute_once(df, {"_payload": F.try_parse_json(body)})
    is_object = F.coalesce(F.schema_of_variant("_payload").startswith("OBJECT"), F.lit(False))
    problems = [("", "must be a JSON object", ~is_object)]
    for f in fields:
        item = F.try_variant_get("_payload", f"$.{f.name}", "variant")
        kind = F.schema_of_variant(item)
        given = item.isNotNull() & (kind != "VOID")
        if f.required:
            problems.append((f.name, "is required", is_object & item.isNull()))
        if not f.nullable:
            problems.append((f.name, "must not be null", F.coalesce(kind == "VOID", F.lit(False))))
        if f.kind == "string":
            problems.append((f.name, "must be text", F.coalesce(given & (kind != "STRING"), F.lit(False))))
            continue
        is_number = F.coalesce(kind.rlike(NUMBER_TYPES), F.lit(False))
        problems.append((f.name, "must be a number", F.coalesce(given & ~is_number, F.lit(False))))
        number = F.when(is_number, F.try_variant_get("_payload", f"$.{f.name}", "double"))
        if f.kind == "int":
            problems.append((f.name, "must be an integer", F.coalesce(number != F.floor(number), F.lit(False))))
        problems += _bounds(f, number)
    return compute_once(df, {"errors": _problems(problems)})


def payload_rows(df: DataFrame, fields: Sequence[Field], keep: Sequence[str] = ()) -> DataFrame:
    """Typed columns of validated payloads with defaults, plus ``set_cols``: the fields each one names."""
    values = []
    for f in fields:
        value = F.try_variant_get("_payload", f"$.{f.name}", f.type)
        values.append((value if f.default is None else F.coalesce(value, F.lit(f.default))).alias(f.name))
    names = F.array_intersect(
        F.json_object_keys(F.to_json("_payload")), F.array(*[F.lit(f.name) for f in fields])
    )
    return df.select(*keep, *values, names.alias("set_cols"))


def insert_validated(
    target: DataFrame, payloads: DataFrame, body: str, fields: Sequence[Field]
) -> tuple[DataFrame, DataFrame]:
    """``(new target, rejected payloads with errors)``."""
    checked = validate_payloads(payloads, body, fields)
    good = payload_rows(checked.where(F.size("errors") == 0), fields).drop("set_cols")
    cast = good.select(*[F.col(c).try_cast(target.schema[c].dataType).alias(c) for c in good.columns if c in target.columns])
    return union_all(target, cast), checked.where(F.size("errors") > 0).drop("_payload")

"""Contract checks as columns: each record yields the list of its violations.

A contract is walked once on the driver and becomes one array expression per table; nothing is interpreted
per row. Typed tables need only the checks their schema leaves open; JSON lines are checked as variants,
which still know a value's own type.
"""

from __future__ import annotations

from collections.abc import Sequence
from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pressgrid.functions.text import let

VIOLATION = "struct<path:string,rule:string,detail:string>"


def _types(contract: dict[str, Any]) -> list[str]:
    kind = contract.get("type", [])
    return [kind] if isinstance(kind, str) else list(kind)


def _violation(path: Column, rule: str, detail: Column) -> Column:
    return F.struct(path.alias("path"), F.lit(rule).alias("rule"), detail.alias("detail"))


def _none() -> Column:
    return F.array().cast(f"array<{VIOLATION}>")


def _when(broken: Column, path: Column, rule: str, detail: Column) -> Column:
    """A list of one violation where ``broken`` holds, otherwise an empty one."""
    return F.when(broken, F.array(_violation(path, rule, detail))).otherwise(_none())


def _child(path: Column, key: str) -> Column:
    return F.concat(path, F.lit(f".{key}"))


def _element(path: Column, index: Column) -> Column:
    return F.concat(path, F.lit("["), index.cast("string"), F.lit("]"))


def _expected(contract: dict[str, Any]) -> str:
    return "expected " + " or ".join(_types(contract))


# --- JSON records -------------------------------------------------------------------------------


def _json_type(value: Column, text: Column) -> Column:
    """The JSON type of a variant. ``text`` is the value as it is written, which tells apart the numbers that a variant
    stores alike: beyond 64 bits, and like ``1.0``. It is looked at for those alone."""
    stored = F.schema_of_variant(value)
    whole = F.trim(text).rlike(r"^-?\d+$")
    return (
        F.when(value.isNull() | F.is_variant_null(value), F.lit("null"))
        .when(stored.startswith("OBJECT"), F.lit("object"))
        .when(stored.startswith("ARRAY"), F.lit("array"))
        .when(stored == "STRING", F.lit("string"))
        .when(stored == "BOOLEAN", F.lit("boolean"))
        .when(stored.isin("BIGINT", "INT", "SMALLINT", "TINYINT"), F.lit("integer"))
        .when(stored.rlike(r"^DECIMAL\(\d+,[1-9]") | ~F.coalesce(whole, F.lit(False)), F.lit("number"))
        .otherwise(F.lit("integer"))
    )


def _accepts(found: Column, kinds: Sequence[str]) -> Column:
    allowed = [*kinds, *(["integer"] if "number" in kinds else [])]
    return found.isin(allowed)


def _json_checks(value: Column, text: Column, contract: dict[str, Any], path: Column) -> Column:
    """All violations at and below one value. Its type and its fields are looked up once."""
    return let(_json_type(value, text), lambda found: _joined(_json_rules(value, text, found, contract, path)))


def _json_rules(value: Column, text: Column, found: Column, contract: dict[str, Any], path: Column) -> list[Column]:
    kinds, checks = _types(contract), []
    if kinds:
        checks.append(_when(
            ~_accepts(found, kinds), path, "type", F.concat(F.lit(f"{_expected(contract)}, got "), found)
        ))
    if "enum" in contract:
        got = F.coalesce(F.try_variant_get(value, "$", "string"), F.lit("null"))
        allowed = ["null" if e is None else str(e) for e in contract["enum"]]
        wrong = ~got.isin(allowed)
        if all(e is None or isinstance(e, str) for e in contract["enum"]):
            # A number that reads like an allowed word is not that word.
            wrong = wrong | ~found.isin("string", "null")
        checks.append(_when(wrong, path, "enum", F.concat(F.lit(f"expected one of {allowed}, got "), got)))
    if "object" in kinds:
        fields = F.try_variant_get(value, "$", "map<string,variant>")
        inside = let(fields, lambda held: _joined(_field_rules(held, text, contract, path)))
        checks.append(F.when(found == "object", inside).otherwise(_none()))
    if "array" in kinds and contract.get("items"):
        per_item = F.transform(
            F.try_variant_get(value, "$", "array<variant>"),
            lambda item, at: _json_checks(
                item, F.get(F.from_json(text, "array<string>"), at), contract["items"], _element(path, at)
            ),
        )
        checks.append(F.when(found == "array", F.flatten(per_item)).otherwise(_none()))
    return checks


def _field_rules(held: Column, text: Column, contract: dict[str, Any], path: Column) -> list[Column]:
    names, checks = F.map_keys(held), []
    known = contract.get("properties", {})
    for key in contract.get("required", []):
        checks.append(_when(~F.array_contains(names, key), path, "required", F.lit(f"missing {key}")))
    if contract.get("additionalProperties", True) is False:
        extra = F.array_sort(F.array_except(names, F.array(*map(F.lit, known)).cast("array<string>")))
        checks.append(let(extra, lambda more: _when(
            F.size(more) > 0, path, "extra", F.concat(F.lit("unexpected "), F.array_join(more, ", "))
        )))
    for key, rule in known.items():
        own = F.try_element_at(F.from_json(text, "map<string,string>"), F.lit(key))
        checks.append(F.when(
            F.array_contains(names, key), _json_checks(F.try_element_at(held, F.lit(key)), own, rule, _child(path, key))
        ).otherwise(_none()))
    return checks


# --- typed tables -------------------------------------------------------------------------------

_TYPE_NAMES = (
    (T.StringType, "string"), (T.BooleanType, "boolean"), (T.IntegralType, "integer"),
    (T.FractionalType, "number"), (T.ArrayType, "array"), (T.StructType, "object"), (T.MapType, "object"),
    (T.DatetimeType, "string"),
)


def _type_name(kind: T.DataType) -> str:
    """The JSON type a column is written as; times are written as text."""
    return next((name for cls, name in _TYPE_NAMES if isinstance(kind, cls)), "string")


def _typed_checks(value: Column, kind: T.DataType, contract: dict[str, Any], path: Column) -> list[Column]:
    kinds, checks = _types(contract), []
    name = _type_name(kind)
    fits = not kinds or name in kinds or (name == "integer" and "number" in kinds)
    # A JSON column holds its object as text.
    fits = fits or (name == "string" and "object" in kinds)
    if not fits:
        checks.append(_when(value.isNotNull(), path, "type", F.lit(f"{_expected(contract)}, got {name}")))
    if kinds and "null" not in kinds:
        checks.append(_when(value.isNull(), path, "type", F.lit(f"{_expected(contract)}, got null")))
    if "enum" in contract:
        allowed = [e for e in contract["enum"] if e is not None]
        wrong = ~value.isin(allowed)
        wrong = F.coalesce(wrong, F.lit(None not in contract["enum"]))
        got = F.coalesce(value.cast("string"), F.lit("null"))
        checks.append(_when(
            wrong, path, "enum", F.concat(F.lit(f"expected one of {list(map(str, allowed))}, got "), got)
        ))
    if isinstance(kind, T.StructType) and "object" in kinds:
        held = [field.name for field in kind]
        for key in contract.get("required", []):
            if key not in held:
                checks.append(_when(value.isNotNull(), path, "required", F.lit(f"missing {key}")))
        extra = sorted(set(held) - set(contract.get("properties", {})))
        if extra and contract.get("additionalProperties", True) is False:
            checks.append(_when(value.isNotNull(), path, "extra", F.lit(f"unexpected {', '.join(extra)}")))
        for key, rule in contract.get("properties", {}).items():
            if key in held:
                inner = _joined(_typed_checks(value[key], kind[key].dataType, rule, _child(path, key)))
                checks.append(F.when(value.isNotNull(), inner).otherwise(_none()))
    if isinstance(kind, T.ArrayType) and contract.get("items"):
        per_item = F.transform(value, lambda item, at: _joined(
            _typed_checks(item, kind.elementType, contract["items"], _element(path, at))
        ))
        checks.append(F.coalesce(F.flatten(per_item), _none()))
    return checks


def _joined(checks: list[Column]) -> Column:
    return F.concat(*checks) if checks else _none()


def _checked(rows: DataFrame, contract: dict[str, Any], json: str | None) -> Column:
    root = F.lit("$")
    if json is None:
        record = F.struct(*rows.columns)
        return _joined(_typed_checks(record, rows.schema, contract, root))
    value = F.try_parse_json(F.col(json))
    unreadable = _when(F.lit(True), root, "json", F.lit("not a JSON value"))
    return let(value, lambda record: F.when(record.isNull(), unreadable).otherwise(
        _json_checks(record, F.col(json), contract, root)
    ))


def violations(
    rows: DataFrame, contract: dict[str, Any], record_id: str, json: str | None = None
) -> DataFrame:
    """All violations as (record_id, path, rule, detail). ``json`` names a column of JSON text to check
    instead of the typed row, in which case ``record_id`` is not part of the record."""
    found = _checked(rows, contract, json)
    return rows.select(F.col(record_id).alias("record_id"), F.inline(found))


def quality_summary(rows: DataFrame, contract: dict[str, Any], contract_name: str, json: str | None = None) -> DataFrame:
    """One row: records checked, records in violation, and whether all passed."""
    found = F.size(_checked(rows, contract, json)) > 0
    return rows.select(found.alias("bad")).agg(
        F.lit(contract_name).alias("contract"),
        F.count("*").alias("records_checked"),
        F.count_if("bad").alias("records_bad"),
        (F.count_if("bad") == 0).alias("validated"),
    )

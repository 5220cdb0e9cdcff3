import pytest
from pyspark.sql.types import (
    ArrayType, BooleanType, DecimalType, IntegerType, LongType, StringType, StructType, TimestampType,
)

from layerflow.functions.types import parse_type, primitive_type, required_columns, schema_from_spec


def test_aliases():
    assert primitive_type("int") == IntegerType()
    assert primitive_type(" Integer ") == IntegerType()
    assert primitive_type("long") == LongType()
    assert primitive_type("bool") == BooleanType()
    assert primitive_type("timestamp") == TimestampType()


def test_decimal_default_and_explicit():
    assert primitive_type("decimal") == DecimalType(38, 2)
    assert primitive_type("decimal(10, 4)") == DecimalType(10, 4)
    assert primitive_type("decimal", default_decimal=(20, 5)) == DecimalType(20, 5)
    with pytest.raises(ValueError):
        primitive_type("decimal(10)")


def test_unknown_type_names_the_field():
    with pytest.raises(ValueError, match="'x'"):
        parse_type({"type": "struct", "fields": [{"name": "x", "type": "interval"}]})
    with pytest.raises(ValueError):
        parse_type({"type": "map", "keyType": "string"})


def test_nested_readings_schema():
    spec = {"type": "struct", "fields": [
        {"name": "id", "type": "integer", "nullable": False},
        {"name": "sensors", "type": {"type": "array", "elementType": {"type": "struct", "fields": [
            {"name": "dates", "type": {"type": "array", "elementType": {"type": "struct", "fields": [
                {"name": "values", "type": {"type": "array", "containsNull": False,
                                            "elementType": {"type": "struct", "fields": [{"name": "mean", "type": "double"}]}}},
            ]}}},
        ]}}},
        {"name": "note"},
    ]}
    s = schema_from_spec(spec)
    assert isinstance(s, StructType)
    assert s["note"].dataType == StringType()
    inner = s["sensors"].dataType.elementType["dates"].dataType.elementType["values"].dataType
    assert isinstance(inner, ArrayType) and inner.containsNull is False
    assert required_columns(s) == ["id"]


def test_root_must_be_struct():
    with pytest.raises(ValueError):
        schema_from_spec({"type": "array", "elementType": "string"})
    with pytest.raises(ValueError):
        schema_from_spec({})

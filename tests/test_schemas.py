import pytest

from feedlake.schemas import FLAT, SILVER, WAREHOUSE, document_schema, flat_schema


def test_flat_has_29_nullable_columns_by_type():
    assert len(FLAT) == 29
    assert all(field.nullable for field in FLAT.fields)
    kinds = {}
    for field in FLAT.fields:
        kinds.setdefault(field.dataType.simpleString(), []).append(field.name)
    assert kinds["float"] == "mag cdi mmi dmin rms gap longitude latitude depth".split()
    assert kinds["int"] == "felt tsunami sig nst".split()
    assert len(kinds["string"]) == 16


def test_silver_and_warehouse_have_31_columns_in_one_order():
    assert SILVER.names == WAREHOUSE.names == [*FLAT.names, "area", "injection_date"]
    assert WAREHOUSE["tz"].dataType.simpleString() == "bigint"
    assert WAREHOUSE["mag"].dataType.simpleString() == "double"
    assert SILVER["injection_date"].dataType.simpleString() == "timestamp"
    assert WAREHOUSE["injection_date"].dataType.simpleString() == "string"


def test_document_schema_declares_only_what_is_asked():
    assert (
        document_schema(("place", "mag"), keep_id=False).simpleString()
        == "struct<features:array<struct<properties:struct<mag:string,place:string>>>>"
    )
    assert (
        document_schema(("depth",), keep_id=False).simpleString()
        == "struct<features:array<struct<geometry:struct<coordinates:array<string>>>>>"
    )


def test_unknown_columns_are_refused():
    with pytest.raises(ValueError, match="nope"):
        flat_schema(("mag", "nope"))

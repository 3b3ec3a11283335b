import pytest
from pyspark.sql import types as T

from cobasket.functions.schema import narrow
from cobasket.schemas import BUYORDER, schema_of


def test_select_keeps_schema_order_and_ignores_unknown_names():
    assert narrow(BUYORDER, ["user_id", "client", "nowhere"]).fieldNames() == ["client", "user_id"]


def test_empty_selection_keeps_everything():
    assert narrow(BUYORDER) == BUYORDER
    assert narrow(BUYORDER, None, None) == BUYORDER


def test_drop_reaches_through_arrays_and_structs_without_touching_the_original():
    before = BUYORDER.json()
    product = narrow(BUYORDER, drop=["items.product.specs"])["items"].dataType.elementType["product"].dataType
    assert product.fieldNames() == ["id", "price"]
    assert BUYORDER.json() == before


def test_drop_of_a_top_level_field_and_of_several_paths():
    out = narrow(BUYORDER, drop=["total", "items.product.price", "items.product.specs"])
    assert "total" not in out.fieldNames()
    assert out["items"].dataType.elementType["product"].dataType.fieldNames() == ["id"]


def test_array_nullability_survives():
    schema = T.StructType([T.StructField("a", T.ArrayType(T.StructType().add("x", "long").add("y", "long"), False))])
    assert narrow(schema, drop=["a.x"])["a"].dataType.containsNull is False


def test_bad_paths_and_names_are_reported():
    with pytest.raises(ValueError, match="no field 'nowhere'"):
        narrow(BUYORDER, drop=["nowhere.x"])
    with pytest.raises(ValueError, match="not inside a struct"):
        narrow(BUYORDER, drop=["total.x"])
    with pytest.raises(ValueError, match="known are"):
        schema_of("event", "clicks")


def test_schema_of_narrows():
    assert schema_of("event", "buyorder", ["client", "items"]).fieldNames() == ["client", "items"]
    assert schema_of("catalog", "products").fieldNames() == ["client", "product_id", "status"]

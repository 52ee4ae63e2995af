"""Key discovery of open maps: odd key names, mixed types, empty maps."""

import pytest

from gridmeter.operators import pivot


def test_key_names_and_types(spark):
    odd = {"a b": "1", "c`d": "x", "OBJECT<q: r>": "2", "": "3", "12": "1e3", "n": "7", "a.b": "z", "x\ny": "1",
           "k: STRING, z": "1", "`": "3", ">": "t", "é": None}
    rows = spark.createDataFrame([(odd,), ({"n": "x"},), (None,), ({},), ({"A": "1", "a": "q"},)], "m map<string,string>")
    found = pivot.discover_keys(rows, "m")
    text = {"c`d", "a.b", ">", "n", "a"}
    assert found == {k: "string" if k in text else "double" for k in {*odd, "A", "a"}}
    assert list(found) == sorted(found)


def test_maps_apart_and_without_keys(spark):
    rows = spark.createDataFrame([({"k": "1"}, {"k": "x"}), (None, {})], "a map<string,string>, b map<string,string>")
    assert pivot.discover_keys_of({n: rows.select(n) for n in ("a", "b")}) == {"a": {"k": "double"}, "b": {"k": "string"}}
    none = {"a": rows.where("false").select("a"), "b": rows.where("a is null").select("b")}
    assert pivot.discover_keys_of(none) == {"a": {}, "b": {}}


def test_too_many_keys(spark, monkeypatch):
    monkeypatch.setattr(pivot, "MAX_KEYS", 2)
    rows = spark.createDataFrame([({"a": "1", "b": "1"},), ({"c": "1"},)], "m map<string,string>")
    with pytest.raises(ValueError, match="more than 2 different keys"):
        pivot.discover_keys(rows, "m")

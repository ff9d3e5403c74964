"""One test per pinned rule (tiny frames: nulls, '', ties, zero divisor, key 0/-1)."""

import datetime as dt
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from fincrime import functions as fn
from fincrime.operators import (code_lookup, decode, dedup, first_per_key, latest_per_key,
                                latest_snapshot, semi_join_keys)
from fincrime.sources.catalog import Warehouse


def one(df, col):
    return [r[col] for r in df.collect()]


def test_n3_age_is_integer_division(spark):
    df = spark.createDataFrame([(dt.date(2000, 7, 16),)], "b date")
    assert one(df.select(fn.age_years("b", "2024-07-15").alias("a")), "a") == [24]


def test_n5_date_keys(spark):
    df = spark.createDataFrame([(20240614,), (0,), (-1,), (None,)], "k int")
    assert one(df.select(fn.date_from_key("k").alias("d")), "d") == [dt.date(2024, 6, 14), None, None, None]


def test_n6_slash_dates(spark):
    df = spark.createDataFrame([(dt.datetime(2023, 4, 4, 12, 0),), (dt.datetime(2023, 4, 5, 0, 0),)],
                               "t timestamp_ntz")
    assert df.filter(fn.day_filter("t", "2023/04/04")).count() == 1


def test_n8_concat_propagates_null(spark):
    df = spark.createDataFrame([("a", None), ("a", "b")], "x string, y string")
    assert one(df.select(fn.cat(F.col("x"), "-", F.col("y")).alias("c")), "c") == [None, "a-b"]


def test_n10_length_counts_trailing_blanks(spark):
    df = spark.createDataFrame([("ab  ",)], "s string")
    assert one(df.select(F.length("s").alias("n")), "n") == [4]


def test_n13_n14_minor_units(spark):
    df = spark.createDataFrame([("",), ("0",), ("12345",), (None,), ("abc",), ("00",)], "t string")
    got = one(df.select(fn.minor_units("t").alias("a")), "a")
    assert got == [Decimal("0.00"), Decimal("0.00"), Decimal("123.45"), None, None, Decimal("0.00")]
    assert df.select(fn.minor_units("t")).schema.fields[0].dataType.simpleString() == "decimal(23,2)"


def test_n15_n16_ratio(spark):
    df = spark.createDataFrame([(Decimal("5"), Decimal("40")), (Decimal("1"), Decimal("0"))],
                               "a decimal(18,2), b decimal(18,2)")
    assert one(df.select(fn.arrears_ratio("a", "b").alias("r")), "r") == ["13.00 %", None]


def test_n2_latest_per_key_requires_ties_and_is_total(spark):
    df = spark.createDataFrame([(1, 20240101, 5), (1, 20240101, 7), (1, None, 9), (2, None, 1)],
                               "k int, d int, v int")
    with pytest.raises(TypeError):
        latest_per_key(df, ["k"], ["d"])  # ties is required
    got = sorted(tuple(r) for r in latest_per_key(df, ["k"], ["d"], ties=["v"]).collect())
    assert got == [(1, 20240101, 7), (2, None, 1)]  # nulls last: a null date is never newest
    got = sorted(tuple(r) for r in first_per_key(df, ["k"], ["d"], ties=["v"]).collect())
    assert got == [(1, 20240101, 5), (2, None, 1)]


def test_latest_per_key_one_row_per_key_and_idempotent(spark):
    df = spark.range(0, 200).select((F.col("id") % 7).alias("k"), F.col("id").alias("d"))
    top = latest_per_key(df, ["k"], ["d"], ties=[])
    assert top.count() == 7 == top.select("k").distinct().count()
    assert sorted(map(tuple, latest_per_key(top, ["k"], ["d"], ties=[]).collect())) == \
        sorted(map(tuple, top.collect()))


def test_latest_snapshot_global_max(spark):
    df = spark.createDataFrame([(1, 1), (2, 3), (3, 3)], "a int, s int")
    assert sorted(one(latest_snapshot(df, "s"), "a")) == [2, 3]


def test_n12_set_of_one_key_equals_scalar_form(spark):
    df = spark.createDataFrame([(1, "x"), (1, "y"), (2, "z")], "k int, v string")
    assert sorted(one(semi_join_keys(df, "k", [1]), "v")) == sorted(one(df.filter("k = 1"), "v"))
    keys = spark.createDataFrame([(1,), (1,)], "k int")  # duplicate keys never duplicate rows
    assert sorted(one(semi_join_keys(df, "k", keys), "v")) == ["x", "y"]
    many = list(range(0, 5000)) + [2]
    assert sorted(one(semi_join_keys(df, "k", many), "v")) == ["x", "y", "z"]


def test_dedup_idempotent(spark):
    df = spark.createDataFrame([(1, "a"), (1, "a"), (2, "b")], "k int, v string")
    once = dedup(df)
    assert once.count() == 2 and dedup(once).count() == 2


def test_code_lookup_no_doubling_and_decode(spark):
    facts = spark.createDataFrame([("00",), ("01",), ("99",)], "c string")
    dim = spark.createDataFrame([("00", "Purchase", 1), ("00", "Purchase", 1), ("01", "Refund", 0)],
                                "code string, name string, rowiscurrent int")
    out = code_lookup(facts, dim, "c", "code", ["name"], current_only=True)
    assert sorted((r.c, r.name) for r in out.collect()) == [("00", "Purchase"), ("01", None), ("99", None)]
    out = decode(facts, "c", {"00": "NAD", "01": "POS"}, "device")
    assert sorted((r.c, r.device) for r in out.collect()) == [("00", "NAD"), ("01", "POS"), ("99", None)]


def test_n22_non_numeric_teller_does_not_match(spark):
    df = spark.createDataFrame([("000007",), ("00A1",)], "t string")
    assert one(df.select(fn.try_int("t").alias("n")), "n") == [7, None]


def test_labels(spark):
    df = spark.createDataFrame([("000120", "ANN", " A ", "", None)], "t string, f string, m1 string, m2 string, m3 string")
    r = df.select(fn.teller_label("t", "f").alias("tl"), fn.full_name("f", "m1", "m2").alias("fnm"),
                  fn.full_name("f", "m1", "m2", "m3").alias("fn_null"),
                  fn.full_name_raw("f", "m1", "m2", F.lit("")).alias("raw"),
                  fn.ltrim_zeros(F.lit("000")).alias("z")).first()
    assert (r.tl, r.fnm, r.fn_null, r.raw, r.z) == ("120 - ANN", "ANN A", None, "ANN  A   ", "")
    df = spark.createDataFrame([(dt.datetime(2024, 1, 1, 9, 5),)], "t timestamp_ntz")
    assert one(df.select(fn.hour_label("t").alias("h")), "h") == ["9h5"]


def test_home_address_forms(spark):
    df = spark.createDataFrame([("1 RD", "", "", "CITY", "7000", "1 RD", "PCITY"),
                                ("1 RD", "X", "", "CITY", "7000", "1 RD", "PCITY"),
                                ("1 RD", None, "", "CITY", "7000", "2 RD", "PCITY")],
                               "r1 string, r2 string, r3 string, rc string, rp string, p1 string, pc string")
    got = one(df.select(fn.home_address("r1", "r2", "r3", "rc", "rp", "p1", "pc").alias("a")), "a")
    assert got == ["1 RD, PCITY", "1 RD, X, , CITY, 7000", None]


def test_catalogue_validation(spark):
    df = spark.createDataFrame([(1, "x")], "ClientKey bigint, CifNumber string")
    w = Warehouse(spark, {"core.DimClient": df})
    assert w["DIMCLIENT"].columns == ["clientkey", "cifnumber"]  # any case, schema prefix ignored
    w.validate({"dimclient": ["clientkey"]})
    with pytest.raises(ValueError):
        w.validate({"dimclient": ["birthdate"], "dimcard": ["cardkey"]})


def test_search_keys_take_one_path_at_every_length(spark):
    import datetime
    from decimal import Decimal
    df = spark.range(20).selectExpr("id as n", "cast(id as string) as s", "date_add(date'2024-01-01', cast(id as int)) as d",
                                    "cast(id as decimal(12,2)) as m")
    day = datetime.date(2024, 1, 4)
    for extra in (0, 999, 1000, 4999):
        more = [10 ** 6 + i for i in range(extra)]
        for col, keys in (("n", [3, *more]), ("n", ["3", "x", *map(str, more)]), ("s", ["3", *map(str, more)]),
                          ("s", [3, *more]), ("d", [day, *[day + datetime.timedelta(days=1000 + i) for i in range(extra)]]),
                          ("d", [str(day), *["not a day"] * extra]), ("m", [Decimal(3), *map(Decimal, more)]), ("n", [None, 3, *more])):
            assert [r["n"] for r in semi_join_keys(df, col, keys).collect()] == [3], (col, extra)
    assert semi_join_keys(df, "n", []).count() == 0


def test_catalogue_keeps_schemas_apart(spark):
    from fincrime.sources import Warehouse
    a, b = spark.range(1).toDF("a"), spark.range(1).toDF("b")
    wh = Warehouse(spark, {"core.dimclient": a, "mis.DIMCLIENT": b, "core.x": a})
    assert wh["core.DimClient"].columns == ["a"] and wh["mis.dimclient"].columns == ["b"] and wh["x"].columns == ["a"]
    with pytest.raises(ValueError):
        wh["dimclient"]
    assert not wh.has("other.x")

from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from nestloom.functions.clean import mask_columns, safe_cast, transform_columns
from nestloom.functions.codec import item_bytes, to_typed_json
from nestloom.functions.items import full_name, iso_text, key, money, number, percentage, present, sparse, text


def values(df, *columns):
    return [tuple(r[c] for c in columns) for r in df.collect()]


def test_sparse_leaves_out_null_empty_and_zero(rows):
    df = rows("id int, Composer string, Milliseconds bigint", (1, None, 0), (2, "", 5), (3, "x", None))
    got = df.orderBy("id").select(sparse(df, "Composer"), sparse(df, "Milliseconds"))
    assert values(got, "Composer", "Milliseconds") == [(None, None), (None, 5), ("x", None)]
    assert values(df.orderBy("id").select(number("Milliseconds", keep_zero=True).alias("m")), "m") == [(0,), (5,), (None,)]


def test_present_is_never_null(rows):
    df = rows("a bigint, b string", (None, None), (0, ""), (1, "x"))
    got = df.select(present("a", df.schema["a"].dataType).alias("a"), present("b").alias("b"))
    assert values(got, "a", "b") == [(False, False), (False, False), (True, True)]


def test_key_with_missing_part_is_missing(rows):
    df = rows("a bigint, b string", (0, "x"), (1, None))
    assert values(df.select(key("K", "a", "b").alias("k")), "k") == [("K#0#x",), (None,)]


def test_keys_sort_as_text(rows):
    df = rows("a bigint", (2,), (10,)).select(key("ALBUM", "a").alias("k")).orderBy("k")
    assert values(df, "k") == [("ALBUM#10",), ("ALBUM#2",)]


def test_full_name_needs_both_parts(rows):
    df = rows("f string, l string", ("Jane", "Doe"), ("Jane", None), ("", "Doe"))
    assert values(df.select(full_name("f", "l").alias("n")), "n") == [("Jane Doe",), (None,), (None,)]


def test_money_sums_exactly(rows):
    df = rows("t double", *[(v,) for v in (1.98, 3.96, 5.94, 0.99, 1.98, 13.86, 8.91)])
    assert df.agg(F.sum(money("t"))).first()[0] == Decimal("37.62")


def test_dates_as_text(rows):
    df = rows("a string", ("2009-01-01 00:00:00",)).withColumn("t", F.col("a").cast("timestamp_ntz"))
    assert values(df.select(iso_text(df, "a").alias("a"), iso_text(df, "t").alias("t")), "a", "t") == [
        ("2009-01-01 00:00:00", "2009-01-01T00:00:00Z")
    ]


def test_percentage_of_nothing_is_zero(rows):
    df = rows("a bigint, b bigint", (1, 4), (0, 0))
    assert values(df.select(percentage(F.col("a"), F.col("b")).alias("p")), "p") == [(25.0,), (0.0,)]


def test_typed_json_tags_every_kind(rows):
    df = rows(
        "s string, n bigint, b boolean, l array<struct<x:int,y:string>>, m struct<z:double>",
        ("é", 5, True, [(1, None)], (1.5e7,)),
        (None, None, None, [], None),
    )
    got = [r.item for r in to_typed_json(df).collect()]
    assert got[0] == (
        '{"s":{"S":"é"},"n":{"N":"5"},"b":{"BOOL":true},"l":{"L":[{"M":{"x":{"N":"1"}}}]},"m":{"M":{"z":{"N":"15000000"}}}}'
    )
    assert got[1] == '{"l":{"L":[]}}'


def test_item_bytes_counts_bytes_not_letters(rows):
    df = rows("a string", ("é",))
    assert df.select(item_bytes(df).alias("n")).first().n == len('{"a":"é"}'.encode())


def test_column_rules_and_masks(spark, rows):
    df = rows("mail string, phone string, n string, raw binary", ("Ab@X.org", "+1 (30) 22-1", "12", "São".encode("latin1")))
    got = transform_columns(df, [("mail", "lowercase"), ("phone", "format_phone"), ("n", "to_long"), ("raw", "latin1")]).first()
    assert (got.mail, got.phone, got.n, got.raw) == ("ab@x.org", "+130221", 12, "São")
    masked = mask_columns(df, [("mail", "characters"), ("phone", "digits"), ("n", "remove")]).first()
    assert (masked.mail, masked.phone, masked.n) == ("Xx@X.xxx", "+n (nn) nn-n", None)
    with pytest.raises(ValueError):
        transform_columns(df, [("mail", "unheard of")])


@pytest.mark.parametrize("dtype", ["int", "bigint", "float", "double", "decimal(18,2)"])
def test_guarded_cast_equals_plain_try_cast(rows, dtype):
    texts = (
        "1| 2 |+3|-4|5.|5.5|.5|-.5|1e5|1E-2|1d|2F|NaN|nan|inf|-Infinity|+INF|abc|||5-LOW|0x1f|1_000|１|\t7\n|1 2|--1|1e|.|+"
    ).split("|")
    df = rows("v string", *[(t,) for t in texts], (None,))
    got = df.select(F.col("v").try_cast(dtype).cast("string").alias("a"), safe_cast(F.col("v"), dtype).cast("string").alias("b"))
    assert all(r.a == r.b for r in got.collect())


def test_text_rule(rows):
    assert values(rows("a string", ("",), ("b",)).select(text("a").alias("a")), "a") == [(None,), ("b",)]

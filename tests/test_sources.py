from __future__ import annotations

import json
import random
from datetime import datetime
from decimal import Decimal
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from ledger import block, contract, scam, tx
from ledgerloom.sources import (
    BLOCKS,
    CONTRACTS,
    SCAMS,
    TRANSACTIONS,
    load_table,
    parse,
    pick,
    read_lines,
    read_pairs,
    s3a_options,
    save_table,
    valid_lines,
    write_result,
)


def values(df, name):
    return sorted(row[name] for row in df.collect())


def test_arity_decides(lines):
    good = [tx(), tx()[: -len("f")], contract()]  # a trailing empty field still counts
    bad = [tx(extra=1), tx().rsplit(",", 1)[0], '"a,b",' + tx().split(",", 1)[1], "", ","]
    kept = valid_lines(lines(*good, *bad), 15)
    assert values(kept, "line") == sorted(good[:2])


def test_integer_fields_decide(lines):
    good = tx(value=" 1_000 ", ts="+7")
    bad = [tx(value="1.5"), tx(ts=""), tx(value="x", ts="y")]
    assert values(valid_lines(lines(good, *bad), 15, [7, 11]), "line") == [good]


def test_unchecked_integers_do_not(lines):
    line = tx(value="bad", gas="1.5")
    assert values(valid_lines(lines(line), 15, [11]), "line") == [line]


@pytest.mark.parametrize(
    "table, header, kept",
    [
        (TRANSACTIONS, "h,n,b,c3,i,f,address,value,gas,price,input,ts,x,y,z", 0),
        (SCAMS, "id,name,url,coin,category,sub,address,status", 0),
        (BLOCKS, "a,b,c,d,e,f,g,h,i,miner,k,l,size,n,o,p,q,r,s", 0),
        (CONTRACTS, "address,byte,c,d,e,f", 1),
    ],
)
def test_header_goes_only_where_an_integer_fails(lines, table, header, kept):
    assert pick(lines(header), table, *table.columns).count() == kept


def test_typed_fields(lines):
    row = pick(
        lines(tx(address="", value="9" * 38, gas="-1", price="007", c3="1_0")),
        TRANSACTIONS, *TRANSACTIONS.columns,
    ).first()
    assert row.asDict() == {
        "c3": Decimal(10), "address": "", "value": Decimal("9" * 38), "gas_used": Decimal(-1),
        "gas_price": Decimal(7), "ts": 1438387199,
    }
    assert pick(lines(scam("3", "Fake ICO", "0xb")), SCAMS, "id", "category", "address").first() == (
        Decimal(3), "Fake ICO", "0xb",
    )
    assert pick(lines(block("m1", "12")), BLOCKS, "miner", "size").first() == ("m1", Decimal(12))


def test_seconds_of_any_year_are_kept(lines):
    seconds = ["-62135596801", "1438387199000", "253402300800"]
    kept = pick(lines(*[tx(ts=s) for s in seconds]), TRANSACTIONS, "ts")
    assert values(kept, "ts") == [-62135596801, 253402300800, 1438387199000]


def test_a_checked_field_may_have_any_length(lines):
    raw = lines(tx(gas="1" * 39, c3="9" * 50), tx(gas="x"), tx(c3="1.5"))
    assert pick(raw, TRANSACTIONS, "address", "value", checked=["gas_used", "c3"]).count() == 1


@pytest.mark.parametrize("seed", range(3))
def test_random_lines_against_python(lines, seed):
    draw = random.Random(seed)
    texts = ["1", " 12", "+3", "-04", "1_0", "", "1.5", "x", "1__0", "9" * 20, '"a', "1e3"]
    made = {
        ",".join(draw.choice(texts) for _ in range(draw.choice([5, 6, 6, 6, 7]))) for _ in range(500)
    }

    def integer(text):
        try:
            return isinstance(int(text), int)
        except ValueError:
            return False

    for wanted in ([], [0], [2, 5], [5, 1, 3]):
        expected = []
        for line in made:
            parts = line.split(",")
            if len(parts) == 6 and all(integer(parts[i]) for i in wanted):
                expected.append(line)
        assert values(valid_lines(lines(*made), 6, wanted), "line") == sorted(expected)


def test_text_files(spark, tmp_path):
    (tmp_path / "a.csv").write_bytes(b"one\r\ntwo\n\n")
    (tmp_path / "b.csv").write_text('"x,y",z')
    assert values(read_lines(spark, str(tmp_path)), "line") == sorted(["one", "two", "", '"x,y",z'])


def test_typed_copy_serves_every_choice_of_columns(spark, lines, tmp_path):
    raw = lines(tx(), tx(value="bad"), tx(gas="1.5", ts="x"), tx(address=""), tx(extra=2), "junk")
    path = str(tmp_path / "typed")
    save_table(raw, TRANSACTIONS, path)
    typed = load_table(spark, TRANSACTIONS, path)
    assert typed.count() == 4
    for columns in (["ts"], ["value", "ts"], ["address", "gas_used"], ["address"], ["c3", "value"]):
        a = pick(raw, TRANSACTIONS, *columns)
        b = pick(typed, TRANSACTIONS, *columns)
        assert sorted(map(tuple, a.collect())) == sorted(map(tuple, b.collect()))


LONG = "1" * 39


def test_long_integers_stay_lines_of_the_typed_copy(spark, lines, tmp_path):
    raw = lines(
        tx(value="1"), tx(c3=LONG, value="2"), tx(gas=f" +{LONG}_0 ", value="3"), tx(c3=LONG, gas=LONG, value="4"),
        tx(price=LONG, gas="bad", value="5"), tx(ts="9" * 20, value="6"), tx(c3="x", value="7"), tx(extra=1),
    )
    path = str(tmp_path / "typed")
    save_table(raw, TRANSACTIONS, path)
    typed = load_table(spark, TRANSACTIONS, path)
    assert typed.count() == 7
    for checked, kept in (
        (["c3"], [1, 2, 3, 4, 5, 6]), (["gas_used"], [1, 2, 3, 4, 6, 7]), (["ts"], [1, 2, 3, 4, 5, 6, 7]),
        (["c3", "gas_used", "gas_price", "ts"], [1, 2, 3, 4, 6]), ([], [1, 2, 3, 4, 5, 6, 7]),
    ):
        for source in (raw, typed):
            assert values(pick(source, TRANSACTIONS, "value", checked=checked), "value") == kept, checked


def test_a_used_long_integer_raises_from_the_typed_copy(spark, lines, tmp_path):
    path = str(tmp_path / "typed")
    save_table(lines(tx(value="7"), tx(gas=LONG)), TRANSACTIONS, path)
    typed = load_table(spark, TRANSACTIONS, path)
    assert values(pick(typed, TRANSACTIONS, "value", checked=["gas_used"]), "value") == [1, 7]
    with pytest.raises(Exception, match="too long"):
        pick(typed, TRANSACTIONS, "gas_used").collect()
    # A line that is dropped for another field does not raise.
    save_table(lines(tx(value="7"), tx(gas=LONG, value="bad")), TRANSACTIONS, path + "2")
    assert pick(load_table(spark, TRANSACTIONS, path + "2"), TRANSACTIONS, "value", "gas_used").count() == 1


def test_a_long_integer_in_a_line_of_another_arity_does_not_raise(lines):
    raw = lines(tx(value="7"), tx(value=LONG, ts=LONG, extra=1), tx(value=LONG).rsplit(",", 1)[0])
    assert values(pick(raw, TRANSACTIONS, "value", "ts"), "value") == [7]
    with pytest.raises(Exception, match="NUMERIC_"):
        pick(lines(tx(value=LONG)), TRANSACTIONS, "value").collect()


def test_typed_copies_of_no_lines_and_of_an_older_layout(spark, lines, tmp_path):
    none = lines("junk")
    save_table(none, TRANSACTIONS, str(tmp_path / "none"))
    assert load_table(spark, TRANSACTIONS, str(tmp_path / "none")).count() == 0
    parse(lines(tx(), tx(value="x")), TRANSACTIONS).write.parquet(str(tmp_path / "old"))
    old = load_table(spark, TRANSACTIONS, str(tmp_path / "old"))
    assert old.columns == TRANSACTIONS.columns and pick(old, TRANSACTIONS, "value").count() == 1


def test_writing_a_typed_copy_sorts_no_rows(spark, lines, tmp_path):
    seen = spark.conf.get("spark.sql.maxConcurrentOutputFileWriters")
    save_table(lines(tx(), tx(c3=LONG)), TRANSACTIONS, str(tmp_path / "typed"))
    assert spark.conf.get("spark.sql.maxConcurrentOutputFileWriters") == seen
    assert {p.name for p in (tmp_path / "typed").glob("beyond=*")} == {"beyond=none", "beyond=c3"}


def test_result_round_trip(spark, tmp_path):
    df = spark.createDataFrame(
        [("08 2015", 1.5), ("09 2015", 1e16), ('a"b', -2.0)], "month string, average double"
    ).orderBy("month")
    path = write_result(df, str(tmp_path), "average", now=datetime(2024, 3, 1, 14, 5, 9))
    assert path == f"{tmp_path}/average01-03-2024_14-05-09"
    text = spark.read.text(path).collect()
    assert sorted(r.value for r in text)[0] == '["08 2015", 1.5]' and len(text) == 3
    saved = read_pairs(spark, path).orderBy("key").collect()
    assert [tuple(r) for r in saved] == [("08 2015", 1.5), ("09 2015", 1e16), ('a"b', -2.0)]


def test_result_keeps_order_limit_and_exact_integers(spark, tmp_path):
    df = spark.range(500).select(
        F.col("id").cast("decimal(38,0)").alias("id"),
        (F.lit(10**18).cast("decimal(38,0)") * 10**10 + F.col("id")).alias("total"),
    ).orderBy(F.desc("id"))
    path = write_result(df, str(tmp_path), "ids")
    text = [json.loads(line)[0] for p in sorted(Path(path).glob("part*")) for line in p.open()]
    assert [int(i) for i in text] == list(range(499, -1, -1))
    saved = {int(r.key): int(r.value) for r in read_pairs(spark, path, "decimal(38,0)").collect()}
    assert saved == {i: 10**28 + i for i in range(500)}
    some = read_pairs(spark, write_result(df, str(tmp_path), "some", limit=3), "decimal(38,0)")
    assert sorted(int(r.key) for r in some.collect()) == [497, 498, 499]


@pytest.mark.parametrize("split", [None, "64"])
def test_a_result_is_read_back_in_the_order_it_was_written(spark, tmp_path, split):
    df = spark.range(0, 400, 1, 8).select(
        F.concat(F.lit("k"), F.pmod(F.col("id") * 7919, F.lit(400))).alias("key"), F.col("id").alias("value")
    )
    path = write_result(df, str(tmp_path), "r")
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", split or before)  # also where files are split
    try:
        saved = read_pairs(spark, path, "bigint", ordered=True).collect()
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    assert len(list(Path(path).glob("part*"))) == 8
    assert [r["value"] for r in saved] == list(range(400))


def test_empty_result(spark, tmp_path):
    df = spark.createDataFrame([], "k string, v double")
    path = write_result(df, str(tmp_path), "none")
    assert read_pairs(spark, path).count() == 0


def test_results_of_two_runs_do_not_mix(spark, tmp_path):
    df = spark.createDataFrame([("a", 1.0)], "k string, v double")
    now = datetime(2024, 1, 1)
    write_result(df, str(tmp_path), "r", now=now)
    with pytest.raises(Exception, match="(?i)exist"):
        write_result(df, str(tmp_path), "r", now=now)


def test_saved_pairs_from_elsewhere(spark, tmp_path):
    file = tmp_path / "saved.txt"
    file.write_text('[["08 2015", 1.5], ["09 2015", 2], ["10 2015", 3e5]]')
    assert [tuple(r) for r in read_pairs(spark, str(file)).collect()] == [
        ("08 2015", 1.5), ("09 2015", 2.0), ("10 2015", 300000.0),
    ]
    file.write_text("not pairs")
    with pytest.raises(Exception, match="(?i)malformed"):
        read_pairs(spark, str(file)).collect()


ENV = {
    "S3_ENDPOINT_URL": "store.example.org", "BUCKET_PORT": "80",
    "AWS_ACCESS_KEY_ID": "id", "AWS_SECRET_ACCESS_KEY": "hidden",
}


def test_object_store_options():
    assert s3a_options({}) == {}
    assert s3a_options(ENV) == {
        "spark.hadoop.fs.s3a.endpoint": "store.example.org:80",
        "spark.hadoop.fs.s3a.access.key": "id",
        "spark.hadoop.fs.s3a.secret.key": "hidden",
        "spark.hadoop.fs.s3a.path.style.access": "true",
        "spark.hadoop.fs.s3a.connection.ssl.enabled": "false",
    }
    assert s3a_options(ENV, ssl=True)["spark.hadoop.fs.s3a.connection.ssl.enabled"] == "true"


def test_object_store_errors_name_no_secret():
    env = {k: v for k, v in ENV.items() if k != "BUCKET_PORT"}
    with pytest.raises(KeyError, match="BUCKET_PORT") as error:
        s3a_options(env)
    assert "hidden" not in str(error.value)


def test_parse_reads_only_what_is_asked(lines):
    plan = parse(lines(tx()), TRANSACTIONS, ["address"])._jdf.queryExecution().toString()
    assert "rlike" not in plan.lower()

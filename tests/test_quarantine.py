import pytest
from pyspark.sql import types as T

from basketry.session import new_path
from basketry.sources import quarantine, readers
from basketry.streaming import jobs

SCHEMA = T.StructType(
    [T.StructField("id", T.LongType()), T.StructField("name", T.StringType()), T.StructField("at", T.TimestampType()),
     T.StructField("price", T.DoubleType()), T.StructField("ok", T.BooleanType())]
)
LONG = "x" * 300_000
GOOD = [
    "1,plain,2024-01-01 10:00:00,1.5,true",
    '2,"with, comma and ""quotes""",2024-01-01 10:00:00,2.5,false',
    "3,,,,",
    f"4,{LONG},2024-01-01 10:00:00,,true",
    "3,,,,",
]
BROKEN = {
    "5,short,2024-01-01 10:00:00": quarantine.FIELDS,
    "6,long,2024-01-01 10:00:00,1.0,true,more": quarantine.FIELDS,
    "seven,text,2024-01-01 10:00:00,1.0,true": "id: not of type bigint",
    "8,text,yesterday,1.0,true": "at: not of type timestamp",
    "9,text,2024-01-01 10:00:00,1.0.0,maybe": "price: not of type double",
    f"10,{LONG},2024-01-01 10:00:00,1.0,maybe": "ok: not of type boolean",
    ",no id,2024-01-01 10:00:00,1.0,true": "id: missing",
}


@pytest.fixture()
def folder(tmp_path):
    lines = [*GOOD, *BROKEN]
    for i in range(3):
        (tmp_path / f"part-{i}.csv").write_text("\n".join(["id,name,at,price,ok", *lines[i::3]]) + "\n")
    (tmp_path / "part-empty.csv").write_text("")
    return str(tmp_path)


def check(good, broken):
    rows = good.collect()
    assert sorted(r["id"] for r in rows) == [1, 2, 3, 3, 4] and good.columns == SCHEMA.names
    by_id = {r["id"]: r for r in rows}
    assert by_id[2]["name"] == 'with, comma and "quotes"' and by_id[4]["name"] == LONG and by_id[3]["price"] is None
    found = broken.collect()
    assert len(found) == len(BROKEN)
    reasons = {r["line"]: r["reason"] for r in found}
    for line, reason in BROKEN.items():
        if reason == "id: missing":  # such a line was read without a fault and is put together again
            assert [k for k, v in reasons.items() if v == reason and "no id" in k]
        else:
            assert reasons[line] == reason
    assert all(".csv" in r["file"] for r in found)


def test_every_line_ends_on_one_side(spark, folder):
    check(*quarantine.read_csv_apart(spark, folder, SCHEMA, ["id"]))


def test_the_same_lines_as_a_stream(spark, folder):
    place = new_path(spark, "t-apart")
    check(*jobs.csv_stream_apart(spark, folder, SCHEMA, ["id"], bytes_per_trigger=1, folder=place))
    # Run again in the same place: nothing is read twice.
    check(*jobs.csv_stream_apart(spark, folder, SCHEMA, ["id"], bytes_per_trigger=1, folder=place))


def test_without_requirements_and_without_lines(spark, folder, tmp_path):
    good, broken = quarantine.read_csv_apart(spark, folder, SCHEMA)
    assert good.count() == 6 and broken.count() == len(BROKEN) - 1
    (tmp_path / "none").mkdir()
    (tmp_path / "none" / "a.csv").write_text("id,name,at,price,ok\n")
    good, broken = quarantine.read_csv_apart(spark, str(tmp_path / "none"), SCHEMA, ["id"])
    assert good.count() == 0 and broken.count() == 0


def test_written_again_a_folder_holds_the_same(spark, folder):
    place = new_path(spark, "t-again")
    for _ in range(2):
        good, broken = quarantine.read_csv_apart(spark, folder, SCHEMA, ["id"], folder=place)
    check(good, broken)


def test_plain_reader_does_not_turn_broken_lines_into_nulls(spark, folder):
    with pytest.raises(Exception, match="(?i)malformed|failfast"):
        readers.read_csv(spark, folder, SCHEMA).collect()


def test_reserved_column_name(spark):
    with pytest.raises(ValueError):
        quarantine.with_line(T.StructType([T.StructField(quarantine.LINE, T.StringType())]))

from __future__ import annotations

from datetime import date, datetime

import pytest

from shelfmark import schemas
from shelfmark.sources.csv_files import literal_path, read_csv, write_csv

SALES = "order_id,customer_id,product_id,quantity,price,order_date\n"
PROMOS = "promo_id,promo_name,discount_pct,start_date,end_date,target_segment,status\n"


def write(folder, name, text):
    folder.mkdir(exist_ok=True)
    (folder / name).write_text(text)
    return str(folder)


@pytest.mark.parametrize("infer", [False, True])
def test_directory_of_files_is_one_frame(spark, tmp_path, infer):
    path = write(tmp_path / "in", "sales_1.csv", SALES + "O1,C1,P1,2,9.5,2024-03-05 13:30:01.250\n")
    write(tmp_path / "in", "sales_2.csv", SALES + 'O2,"C, 2",P2,3,1.25,2024-03-06\n')
    df = read_csv(spark, path, schemas.BRONZE_SALES, infer=infer)
    assert df.schema == schemas.BRONZE_SALES.raw_schema
    assert {tuple(r) for r in df.collect()} == {
        ("O1", "C1", "P1", 2.0, 9.5, datetime(2024, 3, 5, 13, 30, 1, 250000)),
        ("O2", "C, 2", "P2", 3.0, 1.25, datetime(2024, 3, 6)),
    }


def test_glob_takes_matching_files_only(spark, tmp_path):
    path = write(tmp_path / "in", "sales_1.csv", SALES + "O1,C1,P1,2,9.5,2024-03-05\n")
    write(tmp_path / "in", "sales_2.csv", SALES + "O2,C1,P1,2,9.5,2024-03-05\n")
    write(tmp_path / "in", "other.csv", "a,b\n1,2\n")
    df = read_csv(spark, f"{path}/sales_*.csv", schemas.BRONZE_SALES)
    assert {r.order_id for r in df.collect()} == {"O1", "O2"}


@pytest.mark.parametrize("infer", [False, True])
def test_columns_are_found_by_header(spark, tmp_path, infer):
    text = "price,order_date,quantity,product_id,order_id,customer_id\n9.5,2024-03-05,2,P1,O1,C1\n"
    df = read_csv(spark, write(tmp_path / "in", "a.csv", text), schemas.BRONZE_SALES, infer=infer)
    assert tuple(df.first()) == ("O1", "C1", "P1", 2.0, 9.5, datetime(2024, 3, 5))


def test_empty_fields_are_null(spark, tmp_path):
    path = write(tmp_path / "in", "a.csv", SALES + "O1,,P1,,,\n")
    assert tuple(read_csv(spark, path, schemas.BRONZE_SALES).first()) == (
        "O1", None, "P1", None, None, None,
    )


def test_wrong_columns_are_refused(spark, tmp_path):
    path = write(tmp_path / "in", "a.csv", "order_id,colour\nO1,red\n")
    with pytest.raises(ValueError, match="colour"):
        read_csv(spark, path, schemas.BRONZE_SALES)


def test_second_file_with_another_header_is_refused(spark, tmp_path):
    path = write(tmp_path / "in", "a.csv", SALES + "O1,C1,P1,2,9.5,2024-03-05\n")
    swapped = SALES.replace("order_id,customer_id", "customer_id,order_id")
    write(tmp_path / "in", "b.csv", swapped + "C2,O2,P1,2,9.5,2024-03-05\n")
    with pytest.raises(Exception, match="(?i)header"):
        read_csv(spark, path, schemas.BRONZE_SALES).collect()


def test_malformed_date_fails_unless_permitted(spark, tmp_path):
    text = PROMOS + "X,n,10.0,2024-03-01,soon,All,Active\n"
    path = write(tmp_path / "in", "a.csv", text)
    with pytest.raises(Exception, match="MALFORMED"):
        read_csv(spark, path, schemas.BRONZE_PROMOTIONS).collect()
    row = read_csv(spark, path, schemas.BRONZE_PROMOTIONS, mode="PERMISSIVE").first()
    assert (row.start_date, row.end_date) == (date(2024, 3, 1), None)


def test_written_files_come_back(spark, tmp_path):
    rows = [("R1", None, "C1", "P1", datetime(2024, 3, 5, 1, 2, 3), 'odd "reason", quoted', 1.5)]
    df = spark.createDataFrame(rows, schemas.BRONZE_RETURNS.raw_schema)
    write_csv(df, str(tmp_path / "out"))
    assert read_csv(spark, str(tmp_path / "out"), schemas.BRONZE_RETURNS).collect() == df.collect()


def test_one_file_with_an_odd_name_is_read_alone(spark, tmp_path):
    """Names with glob characters, spaces and per cent signs."""
    for name in ("a[1] b.csv", "a1 b.csv", "c%20{d}.csv", "e*.csv"):
        (tmp_path / name).write_text("v\n1\n")
    files = spark.read.option("header", True).csv(str(tmp_path)).inputFiles()
    assert len(files) == 4
    for uri in files:
        assert spark.read.option("header", True).csv([literal_path(uri)]).count() == 1

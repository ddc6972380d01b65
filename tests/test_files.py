from pathlib import Path

import pytest
from pyspark.errors import AnalysisException

from shelfwise.operators.cleaning import clean_sales
from shelfwise.schema import FACT_SCHEMA, FEED_COLUMNS
from shelfwise.sources import files

HEADER = ",".join(FEED_COLUMNS)


def feed(tmp_path, lines, header=HEADER):
    path = tmp_path / "feed.csv"
    path.write_text("\n".join([header, *lines]) + "\n", encoding="utf-8")
    return str(path)


def line(day="2022-01-01", units="25.0", stock="61"):
    return f"{day},TIENDA_01,PROD_001,Alimentación,{units},{stock},1,5,1,52,1"


def test_feed_has_the_declared_schema(spark, tmp_path):
    df = files.read_sales_csv(spark, feed(tmp_path, [line()]))
    assert [(f.name, f.dataType) for f in df.schema] == [(f.name, f.dataType) for f in FACT_SCHEMA]
    row = df.collect()[0]
    assert (row.sale_date.isoformat(), row.category, row.units, row.stock) == ("2022-01-01", "Alimentación", 25.0, 61)


def test_unreadable_values_become_null(spark, tmp_path):
    df = files.read_sales_csv(spark, feed(tmp_path, [line("2022-13-01", "abc", "2.5")]))
    row = df.collect()[0]
    assert (row.sale_date, row.units, row.stock, row.store) == (None, None, None, "TIENDA_01")


def test_raw_feed_keeps_text_for_cleaning(spark, tmp_path):
    lines = [line("2022-01-01", "abc", "2.5"), line("2022-01-02", "-3", "NaN"), line("2022-01-03", "", "7")]
    raw = files.read_sales_csv(spark, feed(tmp_path, lines), raw=True)
    out = clean_sales(raw).orderBy("sale_date").collect()
    assert [(r.units, r.stock) for r in out] == [(0.0, 2.5), (0.0, 0.0), (0.0, 7.0)]


def test_the_first_line_of_a_key_wins_across_splits(spark, tmp_path):
    lines = [line(f"2022-01-{1 + i % 28:02d}", str(5000 - i), "1") for i in range(4000)]
    path = feed(tmp_path, lines)
    spark.conf.set("spark.sql.files.maxPartitionBytes", "8KB")
    try:
        raw = files.read_sales_csv(spark, path, raw=True, positions=True)
        assert raw.rdd.getNumPartitions() > 4
        kept = clean_sales(raw, files.FEED_POSITION).orderBy("sale_date").collect()
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    assert [r.units for r in kept] == [5000.0 - i for i in range(28)]


@pytest.mark.parametrize(("short", "long"), [("a", "b"), ("b", "a")])
@pytest.mark.parametrize("split", ["2KB", "1MB"])
def test_the_first_file_by_name_wins_whatever_its_size(spark, tmp_path, short, long, split):
    for name, units, more in ((short, "1", 0), (long, "2", 2000)):
        lines = [line("2022-01-01", units, "1")] + [line(f"2021-01-{1 + i % 28:02d}", "5", "1") for i in range(more)]
        (tmp_path / f"{name}.csv").write_text("\n".join([HEADER, *lines]) + "\n")
    spark.conf.set("spark.sql.files.maxPartitionBytes", split)
    try:
        raw = files.read_sales_csv(spark, str(tmp_path), raw=True, positions=True)
        kept = clean_sales(raw, files.FEED_POSITION).where("sale_date = '2022-01-01'").collect()
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    assert [r.units for r in kept] == [1.0 if short == "a" else 2.0]


def test_staged_tables_go_and_have_a_file_a_bucket_at_most(spark):
    rows = spark.range(4000).selectExpr("cast(id % 50 as string) as store", "cast(id % 3 as string) as product", "id")
    table = files.staged(rows.repartition(16, "id"), "bucketed", ["store", "product"])
    stored = table.inputFiles()
    assert table.count() == 4000 and len(stored) <= int(spark.conf.get("spark.sql.shuffle.partitions"))
    files.forget_staged(spark)
    assert not any(Path(f.removeprefix("file:").replace("///", "/")).exists() for f in stored)


def test_swapped_headers_fail_instead_of_loading_wrongly(spark, tmp_path):
    swapped = HEADER.replace("tienda,producto", "producto,tienda")
    with pytest.raises(Exception, match="header|FAILED_READ_FILE"):
        files.read_sales_csv(spark, feed(tmp_path, [line()], swapped)).collect()


def test_missing_path_is_an_error(spark, tmp_path):
    with pytest.raises(AnalysisException, match="PATH_NOT_FOUND"):
        files.read_sales_csv(spark, str(tmp_path / "absent.csv"))


def test_csv_round_trip(spark, tmp_path):
    df = files.read_sales_csv(spark, feed(tmp_path, [line(), line("2022-01-02", "", "")]))
    path = files.write_sales_csv(df, str(tmp_path / "out"))
    assert path == str(tmp_path / "out")
    assert sorted(files.read_sales_csv(spark, path).collect(), key=str) == sorted(df.collect(), key=str)


def test_absent_results_read_as_none(spark, sales, tmp_path):
    assert files.read_if_exists(spark, str(tmp_path / "absent")) is None
    path = files.write_table(sales([("S", "P", "2022-01-01", 1, 1)]), str(tmp_path / "out"))
    assert files.read_if_exists(spark, path).count() == 1


def test_tables_are_partitioned_by_month(spark, sales, tmp_path):
    df = sales([("S", "P", d, 1, 1) for d in ("2022-01-01", "2022-01-31", "2022-02-01")])
    path = files.write_table(df, str(tmp_path / "out"), month_of="sale_date")
    assert sorted(p.name for p in (tmp_path / "out").iterdir() if p.is_dir()) == [
        "sale_month=2022-01", "sale_month=2022-02",
    ]
    assert spark.read.parquet(path).drop("sale_month").orderBy("sale_date").collect() == df.orderBy("sale_date").collect()


def test_staged_table_keeps_schema_and_rows(spark, sales):
    df = sales([("S", "P", "2022-01-01", 1, 1), ("S", "Q", "2022-01-01", 2, 1)])
    stored = files.staged(df, "test")
    assert stored.schema == df.schema
    assert stored.orderBy("product").collect() == df.orderBy("product").collect()
    assert files.shared_dir(spark) in stored.inputFiles()[0]


class FakeSession:
    """A session on the given master that names no shared folder."""

    def __init__(self, master):
        self.conf = self
        self.sparkContext = self
        self.master = master
        self.folder = None

    def get(self, key, default):
        return default

    def getCheckpointDir(self):
        return self.folder

    def setCheckpointDir(self, path):
        self.folder = path


def test_a_session_must_name_a_shared_folder():
    for master in ("yarn", "local[2]"):
        with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
            files.shared_dir(FakeSession(master))
    stored = FakeSession("yarn")
    stored.get = lambda key, default: "/warehouse/" if key == "spark.sql.warehouse.dir" else default
    assert files.shared_dir(stored) == "/warehouse"


def test_the_session_names_the_shared_folder():
    named = FakeSession("yarn")
    named.get = lambda key, default: "/shared/folder/" if key == "spark.checkpoint.dir" else default
    assert files.shared_dir(named) == "/shared/folder" and named.folder is None


def test_folder_state_follows_its_files(spark, tmp_path):
    spark.range(3).write.parquet(str(tmp_path / "a.parquet"))
    before = files.folder_state(spark, str(tmp_path))
    assert files.folder_state(spark, str(tmp_path)) == before
    spark.range(4).write.mode("overwrite").parquet(str(tmp_path / "a.parquet"))
    assert files.folder_state(spark, str(tmp_path)) != before


def test_shared_results_follow_rewritten_files(spark, tmp_path):
    from shelfwise.plans.queries import shared

    made = []
    for rows in (3, 3, 5):
        if len(made) != 1:
            spark.range(rows).write.mode("overwrite").parquet(str(tmp_path / "t.parquet"))
        made.append(shared(spark, str(tmp_path), "rows", lambda: spark.read.parquet(str(tmp_path / "t.parquet")).count()))
    assert made == [3, 3, 5]


def test_input_bytes_are_those_of_all_files(spark, tmp_path):
    spark.range(1000).repartition(3).write.parquet(str(tmp_path / "t"))
    want = sum(f.stat().st_size for f in (tmp_path / "t").rglob("*") if not f.name.endswith(".crc"))
    assert files.input_bytes(spark, str(tmp_path / "t")) == want > 0
    assert files.input_bytes(spark, str(tmp_path / "nothing")) == 0

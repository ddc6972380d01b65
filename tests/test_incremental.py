"""Feeds one after the other against one run over all, and keys seen before."""

import datetime as dt
import random
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from shelfwise.operators import bloom
from shelfwise.operators.bloom import marked, unseen, words_for
from shelfwise.plans import incremental
from shelfwise.plans.batch import run_batch
from shelfwise.plans.incremental import update_batch
from shelfwise.plans.run import main
from shelfwise.schema import FEED_COLUMNS

START = dt.date(2022, 1, 1)


def line(store, product, day, units, stock):
    d = START + dt.timedelta(days=day)
    return f"{d},{store},{product},Hogar,{units},{stock},0,{d.weekday()},{d.month},{d.isocalendar().week},{(d.month + 2) // 3}"


@pytest.fixture(scope="module")
def lines():
    """Dense, thin and short series over a year and a half, across a change of year."""
    rng = random.Random(4)
    out = []
    for store, product, days in (("A", "x", range(500)), ("A", "y", range(10, 480, 9)), ("B", "x", range(0, 490, 41)), ("B", "z", [3, 200])):
        out += [(day, line(store, product, day, rng.randrange(1, 60), rng.randrange(0, 40))) for day in days]
    return out


def write_feed(folder, name, lines):
    folder.mkdir(parents=True, exist_ok=True)
    (folder / name).write_text("\n".join([",".join(FEED_COLUMNS), *lines]) + "\n", encoding="utf-8")
    return str(folder / name)


def table(spark, path):
    rows = spark.read.parquet(path)
    columns = sorted(c for c in rows.columns if c != "sale_month")
    shown = lambda x: f"{x:.9g}" if isinstance(x, float) else str(x)  # noqa: E731  sums in another order differ in the last digits
    return sorted(tuple(shown(x) for x in r) for r in rows.select(*columns).collect())


OUTPUTS = ["clean_sales", "daily_store_aggregates", "weekly_category_stats", "top_products_by_store", "stock_alerts"]


def whole(spark, tmp_path, lines):
    write_feed(tmp_path / "all", "all.csv", lines)
    run_batch(spark, str(tmp_path / "all"), str(tmp_path / "once"))
    return {name: table(spark, str(tmp_path / "once" / name)) for name in OUTPUTS}


def found(spark, out):
    return {name: table(spark, f"{out}/{name}") for name in OUTPUTS}


@pytest.mark.parametrize("cut", [[(0, 300), (290, 500)], [(100, 300), (0, 110), (300, 500)]])
def test_feeds_in_a_row_equal_one_run(spark, tmp_path, lines, cut):
    """In order, and with an old feed that comes late."""
    out, seen = str(tmp_path / "out"), set()
    for k, (low, high) in enumerate(cut):
        part = [text for day, text in lines if low <= day < high]
        result = update_batch(spark, write_feed(tmp_path / f"feed{k}", "feed.csv", part), out)
        fresh = set(part) - seen
        assert (result.lines, result.rejected, result.copies) == (len(part), 0, 0)
        assert (result.added, result.seen_before) == (len(fresh), len(part) - len(fresh))
        seen |= set(part)
    assert found(spark, out) == whole(spark, tmp_path, [text for _, text in lines])


def test_command_line_updates(spark, tmp_path, lines, capsys):
    main(["update", "--feed", write_feed(tmp_path / "a", "feed.csv", [t for d, t in lines if d < 40]), "--out", str(tmp_path / "out")])
    assert "added=" in capsys.readouterr().out
    assert spark.read.parquet(str(tmp_path / "out" / "clean_sales")).count() > 0


def files(out, name):
    return {str(p): p.stat().st_mtime_ns for p in Path(out, name).rglob("*.parquet")}


def test_untouched_months_keep_their_files(spark, tmp_path, lines):
    out = str(tmp_path / "out")
    update_batch(spark, write_feed(tmp_path / "a", "feed.csv", [t for d, t in lines if d < 400]), out)
    before = {name: files(out, name) for name in ("clean_sales", "stock_alerts", "daily_store_aggregates", "series_tails")}
    late = [line("A", "new", day, 5, 9) for day in (35, 36)]  # a new series within February
    result = update_batch(spark, write_feed(tmp_path / "b", "feed.csv", late), out)
    assert result.months == ("2022-02",) and result.alert_months == ("2022-02",)
    for name, old in before.items():
        new = files(out, name)
        kept = {p for p in old if new.get(p) == old[p]}
        assert kept == {p for p in old if "sale_month=2022-02" not in p}, name
    assert found(spark, out) == whole(spark, tmp_path, [t for d, t in lines if d < 400] + late)


def test_a_change_reaches_later_months_of_thin_series(spark, tmp_path, lines):
    out = str(tmp_path / "out")
    update_batch(spark, write_feed(tmp_path / "a", "feed.csv", [t for _, t in lines]), out)
    late = [line("B", "x", 1, 900, 9)]
    result = update_batch(spark, write_feed(tmp_path / "b", "feed.csv", late), out)
    assert result.months == ("2022-01",) and len(result.alert_months) > 6
    assert found(spark, out) == whole(spark, tmp_path, [t for _, t in lines] + late)


def test_a_feed_given_twice_adds_nothing(spark, tmp_path, lines):
    out = str(tmp_path / "out")
    feed = write_feed(tmp_path / "a", "feed.csv", [t for d, t in lines if d < 90] + ["soon,A,x,Hogar,1,1,0,1,1,1,1", lines[0][1]])
    first = update_batch(spark, feed, out)
    assert (first.rejected, first.copies) == (1, 1)
    before = {name: files(out, name) for name in OUTPUTS}
    again = update_batch(spark, feed, out)
    assert (again.added, again.months, again.seen_before) == (0, (), first.added)
    assert before == {name: files(out, name) for name in OUTPUTS}


def test_a_run_that_ended_early_is_made_up_for(spark, tmp_path, lines, monkeypatch):
    out, part = str(tmp_path / "out"), [t for d, t in lines if d < 120]
    update_batch(spark, write_feed(tmp_path / "a", "feed.csv", [t for d, t in lines if d < 60]), out)
    feed = write_feed(tmp_path / "b", "feed.csv", part)
    with monkeypatch.context() as broken:
        broken.setattr(incremental, "_write_reports", lambda *_: 1 / 0)
        with pytest.raises(ZeroDivisionError):
            update_batch(spark, feed, out)
    result = update_batch(spark, feed, out)
    assert result.added == 0 and result.months == ()
    assert found(spark, out) == whole(spark, tmp_path, part)


def test_filter_never_misses_and_spares_most(spark):
    stored = spark.range(5000).selectExpr("id * 3 as a", "cast(id as string) as b")
    rows = spark.range(5000).selectExpr("id * 3 as a", "cast(id + if(id % 2 = 0, 0, 100000) as string) as b", "id")
    asked = marked(rows, stored, ["a", "b"], 5000)
    assert asked.where("id % 2 = 0 and not maybe_stored").count() == 0
    assert asked.where("id % 2 = 1 and maybe_stored").count() < 500
    assert sorted(r.id for r in unseen(rows, stored, ["a", "b"], 5000).collect()) == list(range(1, 5000, 2))


def test_a_full_filter_changes_nothing(spark, monkeypatch):
    monkeypatch.setattr(bloom, "MOST_WORDS", 1)
    assert words_for(10**9) == 1
    stored = spark.createDataFrame([(k, None if k % 5 else "x") for k in range(200)], "a int, b string")
    rows = spark.createDataFrame([(k, None) for k in range(150, 260)], "a int, b string")
    want = [k for k in range(150, 260) if k >= 200 or k % 5 == 0]
    assert sorted(r.a for r in unseen(rows, stored, ["a", "b"], 200).collect()) == want
    assert unseen(rows, stored.limit(0), ["a", "b"], 0).count() == rows.count()
    assert unseen(rows.limit(0), stored, ["a", "b"], 200).agg(F.count("*")).first()[0] == 0

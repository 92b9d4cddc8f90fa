import pytest
from conftest import COMPLETE, SMALL, rows_of
from pyspark.sql import functions as F

from retailmart.plans import audits
from retailmart.plans.adhoc import ADHOC
from retailmart.plans.jobs import (
    WAVES,
    build_marts,
    build_star,
    database_staging,
    database_star,
    export_marts,
    export_star,
    ingest,
    read_mart,
    read_star,
    run,
)
from retailmart.plans.marts import BREAKDOWNS, MART_PLANS
from retailmart.schemas import MARTS, STAGING, STAR
from retailmart.sources.jdbc import Database
from retailmart.sources.store import Store
from retailmart.trial.oracle import ORACLE
from retailmart.trial.queries import reader


@pytest.fixture(scope="module")
def built(spark, tmp_path_factory):
    target = str(tmp_path_factory.mktemp("target"))
    written = run(spark, reader(spark, SMALL), target)
    return target, written


def test_both_jobs_write_every_table_once(spark, built):
    target, written = built
    assert list(written) == [*[name for wave in WAVES for name in wave], *MART_PLANS]
    assert set(written) == {*STAR, *MARTS}
    stored = read_star(spark, target)
    assert {n: stored.table(n).count() for n in STAR} == {n: written[n] for n in STAR}
    assert {n: read_mart(spark, target, n).count() for n in MARTS} == {n: written[n] for n in MARTS}


def test_sale_keys_are_unique(spark, built):
    fact = read_star(spark, built[0]).table("fact_sales", "sale_key")
    assert fact.distinct().count() == built[1]["fact_sales"]
    assert fact.where("sale_key is null or sale_key < 1").isEmpty()


@pytest.mark.parametrize("name", [*MART_PLANS, *BREAKDOWNS, *ADHOC])
def test_stored_star_gives_the_reports(spark, built, database, name):
    """Against the SQL, as the same plans on the derived star are in test_oracle: so both stars agree."""
    found = database.execute(ORACLE[name])
    columns = [d[0] for d in found.description]
    plan = {**MART_PLANS, **BREAKDOWNS, **ADHOC}[name]
    expected = sorted(repr(tuple(r)) for r in found.fetchall())
    assert sorted(repr(tuple(r)) for r in plan(read_star(spark, built[0])).select(*columns).collect()) == expected
    assert expected


def test_stored_references_are_sound(spark, built):
    checks = audits.references(read_star(spark, built[0])).where("column_name != 'date_key'")
    assert checks.agg(F.sum("orphans"), F.min("checked")).first()[0] == 0
    assert audits.unique_keys(read_star(spark, built[0])).where("repeated_keys > 0").isEmpty()


def test_sums_agree_between_reports(spark, built):
    target = built[0]
    totals = read_star(spark, target).totals().first()
    by = {n: read_mart(spark, target, n) for n in MARTS}
    customers = by["report_customers_sales"].agg(F.sum("total_purchases"), F.sum("order_count")).first()
    assert tuple(customers) == (totals.revenue, totals.sales)
    lost = {r.report: r.lost for r in audits.lost_in_reports(read_star(spark, target)).collect()}
    for name in ("report_products_sales", "report_stores_sales", "report_suppliers_sales", "report_time_sales"):
        assert by[name].agg(F.sum("sales_count")).first()[0] + lost[name] == totals.sales
    star = read_star(spark, target)
    days = by["report_time_sales"].agg(F.sum("daily_revenue"), F.sum("sales_count")).first()
    for name, revenue in (("monthly", "monthly_revenue"), ("quarterly", "quarterly_revenue"), ("yearly", "yearly_revenue")):
        trend = BREAKDOWNS[f"{name}_trends"](star).agg(F.sum(revenue), F.sum("sales_count")).first()
        assert tuple(trend) == tuple(days)


def test_unpublished_run_is_not_seen(spark, built, tmp_path):
    read = reader(spark, SMALL)
    first = build_star(spark, read, str(tmp_path))
    store = Store(spark, str(tmp_path), "star")
    seen = store.latest()
    store.write(spark.range(3), store.new_run(), "fact_sales")
    assert store.latest() == seen
    assert read_star(spark, str(tmp_path)).table("fact_sales").count() == first["fact_sales"]
    assert build_star(spark, read, str(tmp_path)) == first
    assert store.latest() > seen


def test_old_runs_go(spark, tmp_path):
    store = Store(spark, str(tmp_path), "kind", keep=2)
    runs = [store.new_run() for _ in range(4)]
    for run_name in runs:
        store.write(spark.range(2), run_name, "rows")
        store.publish(run_name)
    assert sorted(p.name for p in (tmp_path / "kind").iterdir()) == sorted([*runs[2:], "runs"])
    assert store.latest() == runs[-1]


def test_password_is_not_shown():
    assert "secret" not in repr(Database("jdbc:x:y", {"password": "secret"}))


def test_job_choice(spark, tmp_path):
    with pytest.raises(ValueError):
        run(spark, reader(spark, SMALL), str(tmp_path), "nothing")
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        build_marts(spark, str(tmp_path))


def test_csv_to_marts(spark, tmp_path):
    source = tmp_path / "in"
    source.mkdir()
    for name in ("MOCK_DATA.csv", "MOCK_DATA (1).csv"):
        lines = [",".join(STAGING.names), ",".join(str(COMPLETE[c]) for c in STAGING.names)]
        (source / name).write_text("\n".join(lines) + "\n")
    read = ingest(spark, str(source), str(tmp_path / "out"))
    written = run(spark, read, str(tmp_path / "out"))
    assert written["fact_sales"] == 2 and written["dimension_customers"] == 1
    mart = read_mart(spark, str(tmp_path / "out"), "report_products_sales")
    assert rows_of(mart, "product_name", "total_quantity_sold", "sales_count") == [("Ball", 4, 2)]


def test_database_options():
    """Options only: no database is started here."""
    base = Database("jdbc:x:y", {"user": "u"}, connections=4, rows_per_batch=500)
    assert base.scan_options("t") == {"url": "jdbc:x:y", "dbtable": "t", "fetchsize": "500", "user": "u"}
    split = base.scan_options("t", "id", 1, 9)
    assert (split["partitionColumn"], split["lowerBound"], split["upperBound"], split["numPartitions"]) == ("id", "1", "9", "4")
    assert base.write_options("t")["batchsize"] == "500"


class Folder(Database):
    """Stands in for a database: keeps its tables in memory."""

    def __init__(self):
        super().__init__("none")
        object.__setattr__(self, "tables", {})

    def scan(self, spark, table, column=None):
        assert column in self.tables[table].columns
        return self.tables[table]

    def refresh(self, df, table, cascade=False):
        self.tables[table] = df


def test_star_and_marts_by_way_of_a_database(spark, built):
    database = Folder()
    export_star(spark, built[0], database)
    export_marts(spark, built[0], database)
    assert set(database.tables) == {*STAR, *MARTS}
    name = "report_stores_sales"
    assert rows_of(MART_PLANS[name](database_star(spark, database))) == rows_of(database.tables[name])
    database.refresh(reader(spark, SMALL)(), "staging")
    assert database_staging(spark, database, "staging")("id", "store_name").count() == 6000

"""The two jobs: staging to star, star to marts."""

from __future__ import annotations

import argparse
from collections.abc import Callable, Iterable, Mapping
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, StructField, StructType

from retailmart.operators.contract import enforce
from retailmart.plans.marts import MART_PLANS
from retailmart.plans.star import MEASURES, SALE_MONTH, DerivedStar, GrownStar, StagingReader, StoredStar, SummedStar
from retailmart.schemas import MART_ORDER, MARTS, STAGING, STAR, SUMS
from retailmart.session import hashed_joins, wide_steps
from retailmart.sources.csv_files import (
    FILE_NUMBER,
    FILE_PATTERN,
    ID_STRIDE,
    REJECTS,
    check_stride,
    ingest_csv,
    ingest_tolerant,
    require_rows,
    require_share,
)
from retailmart.sources.jdbc import Database
from retailmart.sources.store import Commit, Conflict, Store

# Parents before children, the fact last. Tables of one wave do not need each other,
# so their jobs run side by side and fill cores that the tail of one job leaves idle.
WAVES = (
    (
        "dimension_pet_breeds",
        "dimension_store_locations",
        "dimension_product_categories",
        "dimension_suppliers",
        "dimension_sellers",
        "dimension_dates",
    ),
    ("dimension_pets", "dimension_stores", "dimension_products"),
    ("dimension_customers",),
    ("fact_sales",),
)
JOBS_AT_ONCE = 2
MOST_PARTS = 16  # folders of stored sums before they are merged into one
MOST_TRIES = 5  # of an update that other writers overtake
# A dictionary of a staging column grows no larger than this: with fifty columns at a time, larger ones do not stay in a processor's cache.
DICTIONARY = {"parquet.dictionary.page.size": 64 << 10}
FACT_BY_MONTH = StructType([*STAR["fact_sales"].fields, StructField(SALE_MONTH, IntegerType())])


def stored_staging(spark: SparkSession, path: str) -> StagingReader:
    """Reader of staging kept as Parquet; a table reads only the columns it needs."""

    def read(*columns: str) -> DataFrame:
        return spark.read.schema(STAGING).parquet(path).select(*columns)

    return read


def ingest(spark: SparkSession, folder: str, target: str, append: bool = False, tolerate: float | None = None, **options) -> StagingReader:
    """CSV files to stored staging, once, so that no later step parses text again; returns a reader of all of it.

    Staging is published like star and marts: a build that still reads the last one goes on
    undisturbed, and a failed ingest is never seen. ``append`` adds the files to staging as a batch of its own. Identifiers
    that collide between files are an error. So are faulty lines, unless ``tolerate`` names the share of lines that may
    be: they are then stored and published with the batch (``rejected_lines``).
    """
    if tolerate is not None:
        found = ingest_tolerant(spark, folder, **options)
        return add_staging(spark, found.rows, target, append, options.get("stride", ID_STRIDE), found.rejects, tolerate)
    rows = require_rows(ingest_csv(spark, folder, **options))
    return add_staging(spark, rows, target, append, options.get("stride", ID_STRIDE))


def add_staging(
    spark: SparkSession, rows: DataFrame, target: str, append: bool = True, stride: int | None = None,
    rejects: DataFrame | None = None, tolerate: float = 0.0,
) -> StagingReader:
    """Store staging rows as a batch, beside the earlier ones or in their place, and the lines rejected on the way."""
    store = Store(spark, target, "staging")
    before = store.last_commit() if append else None
    run = store.new_run(before)
    with wide_steps(spark):
        kept = store.write(rows, run, "rows", options=DICTIONARY)
    if rejects is not None:
        require_share(store.write(rejects, run, "rejects"), kept, tolerate)
        if not kept:
            raise ValueError("staging is empty")
    if stride:
        check_stride(store.read(run, "rows", STAGING), stride)
    store.publish(run, before)
    return latest_staging(spark, target)


def latest_staging(spark: SparkSession, target: str) -> StagingReader:
    """Reader of the last published staging."""
    store = Store(spark, target, "staging")
    return _reader(store, store.commit().parts["rows"])


def rejected_lines(spark: SparkSession, target: str) -> DataFrame:
    """``file_path, line, reason, record`` of the lines that the published batches of staging leave out."""
    store = Store(spark, target, "staging")
    return store.read_parts(store.commit().parts.get("rejects", []), REJECTS)


def _reader(store: Store, parts: list[str]) -> StagingReader:
    rows = store.read_parts(parts, STAGING)
    return lambda *columns: rows.select(*columns)


def build_star(spark: SparkSession, read: StagingReader, target: str, notes: dict | None = None) -> dict[str, int]:
    """Write all star tables as a new run and publish it; returns rows per table.

    Each table is written once and read back by its children, with its real size known.
    """
    store = Store(spark, target, "star")
    run = store.new_run()
    star = DerivedStar(spark, read)
    written = _load_waves(store, run, star, star.table)
    store.publish(run, notes=notes)
    return written


def update_star(spark: SparkSession, target: str) -> dict[str, int]:
    """Add the staging batches that the star does not have yet; returns rows added per table, none if nothing is new.

    Stored rows keep their keys; only the new rows are written. A star that was made from other staging is built anew. If
    another writer commits first, the batches that are then left are added to its star.
    """
    for _ in range(MOST_TRIES):
        try:
            return _update_star(spark, target)
        except Conflict:
            continue
    raise Conflict(f"{target}: overtaken {MOST_TRIES} times")


def _update_star(spark: SparkSession, target: str) -> dict[str, int]:
    staging, store = Store(spark, target, "staging"), Store(spark, target, "star")
    batches = staging.commit().parts["rows"]
    before = store.last_commit()
    seen = before.notes.get("staging") if before else None
    notes = {"staging": batches}
    if seen is None or not set(seen) <= set(batches):
        return build_star(spark, _reader(staging, batches), target, notes)
    fresh = [b for b in batches if b not in seen]
    if not fresh:
        return {}
    known = _Tables(store, before)
    star = GrownStar(spark, _reader(staging, fresh), known)
    star.adopt("dimension_dates", known["dimension_dates"])
    run = store.new_run(before)
    above = known["fact_sales"].agg(F.coalesce(F.max("sale_key"), F.lit(0))).first()[0]
    written = _load_waves(store, run, star, star.added, above, skip=("dimension_dates",))
    store.publish(run, before, notes)
    return written


def _load_waves(store: Store, run: str, star: DerivedStar, rows_of: Callable[[str], DataFrame], above: int = 0, skip: tuple[str, ...] = ()) -> dict[str, int]:
    """Write each table and let the star use it as it then is; sale keys start above the given one."""

    def load(name: str) -> int:
        table = rows_of(name)
        if name == "fact_sales":
            # Unique and final once written; sequences of a database have gaps too.
            table = laid_out(table).withColumn("sale_key", F.monotonically_increasing_id() + F.lit(above + 1))
            rows = store.write(enforce(table, FACT_BY_MONTH), run, name, (SALE_MONTH, "date_key", "product_key"), (SALE_MONTH,))
        else:
            rows = store.write(enforce(table, STAR[name]), run, name)
        star.adopt(name, store.read(run, name, STAR[name]))
        return rows

    written = {}
    with hashed_joins(store.spark):
        for wave in WAVES:
            written |= _side_by_side(load, [n for n in wave if n not in skip])
    return written


def laid_out(fact: DataFrame) -> DataFrame:
    """The fact with its month, dealt out by ranges of month and product: a task writes few months, and a large month goes to many tasks."""
    rows = fact.withColumn(SALE_MONTH, F.floor(F.col("date_key") / 100).cast("int"))
    return rows.repartitionByRange(SALE_MONTH, "product_key", "customer_key")


class _Tables(Mapping):
    """The star tables of a commit; a table's folders are listed when it is first asked for."""

    def __init__(self, store: Store, commit: Commit):
        self._store, self._commit, self._read = store, commit, {}

    def __getitem__(self, name: str) -> DataFrame:
        if name not in self._read:
            schema = FACT_BY_MONTH if name == "fact_sales" else STAR[name]
            self._read[name] = self._store.read_parts(self._commit.parts[name], schema)
        return self._read[name].select(*STAR[name].names)

    def by_month(self) -> DataFrame:
        self["fact_sales"]
        return self._read["fact_sales"]

    def __iter__(self):
        return iter(STAR)

    def __len__(self) -> int:
        return len(STAR)


def _side_by_side(load: Callable[[str], int], names: Iterable[str]) -> dict[str, int]:
    with ThreadPoolExecutor(JOBS_AT_ONCE) as pool:
        return dict(zip(names, pool.map(load, names)))


def read_star(spark: SparkSession, target: str) -> StoredStar:
    """The latest published star."""
    store = Store(spark, target, "star")
    tables = _Tables(store, store.commit())
    return StoredStar(tables, tables.by_month)


def build_marts(spark: SparkSession, target: str, anew: bool = False) -> dict[str, int]:
    """Write the six marts of the latest star as a new run and publish it; returns rows per mart.

    Sales are summed per key first, and the sums are stored. If the star has only grown since the last run, just the sales
    that were added are summed and stored beside the earlier sums; the marts are made from all of them, which are
    one row per key and batch instead of the fact. ``anew`` sums all sales again. The run notes the star it was made from.
    """
    stars, store = Store(spark, target, "star"), Store(spark, target, "marts")
    star, before = stars.commit(), store.last_commit()
    sales = star.parts["fact_sales"]
    covered = before.notes.get("sales", []) if before else []
    if anew or not covered or not set(covered) <= set(sales):
        before, covered = None, []
    run = store.new_run(before)
    tables = _Tables(stars, star)
    added = StoredStar({"fact_sales": stars.read_parts([p for p in sales if p not in covered], STAR["fact_sales"])})

    def summed(key: str) -> int:
        rows = added.totals(key)
        whole = len(store.parts(run, f"sums_{key}")) >= MOST_PARTS
        if whole:
            rows = _merged(store.read(run, f"sums_{key}", SUMS[key]).unionByName(rows), key)
        return store.write(enforce(rows, SUMS[key]), run, f"sums_{key}", (key,), replace=whole)

    if len(covered) < len(sales):
        _side_by_side(summed, tuple(SUMS))
    sums = {key: _merged(store.read(run, f"sums_{key}", schema), key) for key, schema in SUMS.items()}
    whole = SummedStar(tables, sums)
    written = _side_by_side(lambda n: store.write(MART_PLANS[n](whole), run, n, MART_ORDER[n], replace=True), tuple(MART_PLANS))
    store.publish(run, before, {"star": star.number, "sales": sales})
    return written


def _merged(rows: DataFrame, key: str) -> DataFrame:
    """Sums of several batches as one row per key."""
    kinds = {f.name: f.dataType for f in SUMS[key].fields}
    return rows.groupBy(key).agg(*[F.sum(m).cast(kinds[m]).alias(m) for m in MEASURES])


def read_mart(spark: SparkSession, target: str, name: str) -> DataFrame:
    """A mart of the latest published run."""
    store = Store(spark, target, "marts")
    return store.read(store.latest(), name, MARTS[name])


def database_staging(spark: SparkSession, database: Database, table: str) -> StagingReader:
    """Reader of staging kept in a database, split by ``id``; selected columns are all it fetches."""
    rows = enforce(database.scan(spark, table, "id"), STAGING)
    return lambda *columns: rows.select(*columns)


def database_star(spark: SparkSession, database: Database) -> StoredStar:
    """A star kept in a database, each table split by its primary key."""
    return StoredStar({n: enforce(database.scan(spark, n, s.fields[0].name), s) for n, s in STAR.items()})


def export_star(spark: SparkSession, target: str, database: Database) -> None:
    """Replace the rows of all star tables of a database by those of the latest star, parents first."""
    star = read_star(spark, target)
    for name in (n for wave in WAVES for n in wave):
        database.refresh(star.table(name), name, cascade=True)


def export_marts(spark: SparkSession, target: str, database: Database) -> None:
    """Replace the rows of all mart tables of a database by those of the latest marts."""
    for name in MARTS:
        database.refresh(read_mart(spark, target, name), name)


def run(spark: SparkSession, read: StagingReader, target: str, job: str = "both") -> dict[str, int]:
    """``transform`` builds the star, ``reports`` the marts, ``both`` one after the other."""
    if job not in ("transform", "reports", "both"):
        raise ValueError(f"unknown job {job}")
    written = {}
    if job != "reports":
        written |= build_star(spark, read, target)
    if job != "transform":
        written |= build_marts(spark, target)
    return written


def update(spark: SparkSession, target: str, job: str = "both") -> dict[str, int]:
    """As ``run``, but adds what staging has and the star has not: rows added per star table, rows per mart."""
    if job not in ("transform", "reports", "both"):
        raise ValueError(f"unknown job {job}")
    written = update_star(spark, target) if job != "reports" else {}
    return written | (build_marts(spark, target) if job != "transform" else {})


def main(arguments: list[str] | None = None) -> None:
    parser = argparse.ArgumentParser(prog="python -m retailmart.plans.jobs", description=__doc__)
    parser.add_argument("--csv", help="folder of CSV files to ingest first")
    parser.add_argument("--target", required=True, help="folder for staging, star and marts")
    parser.add_argument("--pattern", default=FILE_PATTERN, help="names of the CSV files")
    parser.add_argument("--number", default=FILE_NUMBER, help="regular expression for the number in a file's name")
    parser.add_argument("--stride", type=int, default=ID_STRIDE, help="what a file's number shifts identifiers by; at least the rows of a file")
    parser.add_argument("--mixed-headers", action="store_true", help="files may lack columns or order them differently")
    parser.add_argument("--multi-line", action="store_true", help="quoted cells may hold line breaks")
    parser.add_argument("--tolerate", type=float, help="share of lines that may be faulty; they are stored as rejects, and headers may differ")
    parser.add_argument("--append", action="store_true", help="add to staging, star and marts instead of building them anew")
    parser.add_argument("--job", choices=("transform", "reports", "both"), default="both")
    options = parser.parse_args(arguments)

    spark = SparkSession.builder.appName("retailmart").getOrCreate()
    if options.csv:
        names = ["append", "pattern", "number", "stride"]
        names += ["mixed_headers", "multi_line"] if options.tolerate is None else ["tolerate"]
        ingest(spark, options.csv, options.target, **{n: getattr(options, n) for n in names})
    done = update(spark, options.target, options.job) if options.append else run(spark, latest_staging(spark, options.target), options.target, options.job)
    for name, rows in done.items():
        print(f"{name}: {rows} rows")


if __name__ == "__main__":
    main()

"""The star schema, derived from staging or read from stored tables.

Reports ask a star for two things:

``table(name, *columns)``
    a dimension with just these columns. Parents and surrogate keys are worked
    out only when one of their columns is asked for.
``totals(*keys)``
    quantity, revenue and number of sales per combination of surrogate keys.
    Sales are summed before they meet a dimension, so what is shuffled is one
    row per key and task, not the fact table, however uneven the keys are.
"""

from __future__ import annotations

from abc import ABC, abstractmethod
from collections import ChainMap
from collections.abc import Callable, Iterable, Mapping

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from retailmart.functions.dates import calendar, date_key, parse_date
from retailmart.functions.text import blank_to_null, clean, email, not_blank, or_unknown
from retailmart.operators.dedup import first_by, unknown
from retailmart.operators.joins import lookup, lowest_key
from retailmart.operators.keys import number_rows
from retailmart.schemas import STAR

StagingReader = Callable[..., DataFrame]

# surrogate key -> order its numbers follow (the natural key, or the whole row)
KEY_ORDER = {
    "dimension_pet_breeds": ("breed_name",),
    "dimension_pets": ("pet_name", "breed_key", "pet_type"),
    "dimension_customers": ("email",),
    "dimension_sellers": ("email",),
    "dimension_store_locations": ("city", "state", "country"),
    "dimension_stores": ("store_name",),
    "dimension_product_categories": ("category_name",),
    "dimension_suppliers": ("email",),
    "dimension_products": ("product_name", "color", "size", "price"),
}

# fact key -> dimension, and the natural key as {sales column: dimension column}
FACT_KEYS = {
    "customer_key": ("dimension_customers", {"customer_email": "email"}),
    "seller_key": ("dimension_sellers", {"seller_email": "email"}),
    "product_key": (
        "dimension_products",
        {"product_name": "product_name", "product_color": "color", "product_size": "size", "unit_price": "price"},
    ),
    "store_key": ("dimension_stores", {"store_name": "store_name"}),
}
NULL_SAFE = ("product_color", "product_size")
DIMENSION_OF = {**{key: dimension for key, (dimension, _) in FACT_KEYS.items()}, "date_key": "dimension_dates"}
MEASURES = ("quantity", "revenue", "sales")


def primary_key(name: str) -> str:
    return STAR[name].fields[0].name


# --- dimensions in natural form: deduplicated, parents still by name ---------
#
# Only the key is cleaned on every row. The attributes of the row that is kept are
# cleaned afterwards, once per dimension row. Rows whose key is in ``known`` are left out.


def pet_breeds(read: StagingReader, known: DataFrame | None = None) -> DataFrame:
    rows = read("id", "customer_pet_breed", "customer_pet_type")
    rows = rows.where(not_blank("customer_pet_breed") & F.col("customer_pet_type").isNotNull())
    rows = rows.select("id", clean("customer_pet_breed").alias("breed_name"), "customer_pet_type")
    return first_by(rows, ["breed_name"], ["id"], known).select("breed_name", clean("customer_pet_type").alias("pet_type"))


def pets(read: StagingReader, breeds: DataFrame, known: DataFrame | None = None) -> DataFrame:
    """Distinct after the breed lookup: a NULL and an unknown breed are the same pet."""
    rows = read("customer_pet_name", "customer_pet_breed", "customer_pet_type")
    rows = rows.where(not_blank("customer_pet_name")).select(
        clean("customer_pet_name").alias("pet_name"),
        clean("customer_pet_breed").alias("pet_breed"),
        clean("customer_pet_type").alias("pet_type"),
    )
    found = lookup(rows.distinct(), breeds, {"pet_breed": "breed_name"}, ["breed_key"], "left")
    rows = found.select("pet_name", "breed_key", "pet_type").distinct()
    return rows if known is None else unknown(rows, known, KEY_ORDER["dimension_pets"])


def customers(read: StagingReader, known: DataFrame | None = None) -> DataFrame:
    attributes = (
        "sale_customer_id", "customer_first_name", "customer_last_name", "customer_age", "customer_country",
        "customer_postal_code", "customer_pet_name",
    )
    rows = read("id", "customer_email", *attributes).where(not_blank("customer_email"))
    rows = rows.select("id", email("customer_email").alias("email"), *attributes)
    return first_by(rows, ["email"], ["id"], known).select(
        F.col("sale_customer_id").alias("customer_id"),
        clean("customer_first_name").alias("first_name"),
        clean("customer_last_name").alias("last_name"),
        F.col("customer_age").alias("age"),
        "email",
        clean("customer_country").alias("country"),
        clean("customer_postal_code").alias("postal_code"),
        clean("customer_pet_name").alias("pet_name"),
    )


def sellers(read: StagingReader, known: DataFrame | None = None) -> DataFrame:
    attributes = ("sale_seller_id", "seller_first_name", "seller_last_name", "seller_country", "seller_postal_code")
    rows = read("id", "seller_email", *attributes).where(not_blank("seller_email"))
    rows = rows.select("id", email("seller_email").alias("email"), *attributes)
    return first_by(rows, ["email"], ["id"], known).select(
        F.col("sale_seller_id").alias("seller_id"),
        clean("seller_first_name").alias("first_name"),
        clean("seller_last_name").alias("last_name"),
        "email",
        clean("seller_country").alias("country"),
        clean("seller_postal_code").alias("postal_code"),
    )


def store_locations(read: StagingReader, known: DataFrame | None = None) -> DataFrame:
    rows = read("store_city", "store_state", "store_country").where(not_blank("store_country"))
    rows = rows.select(
        or_unknown("store_city").alias("city"),
        clean("store_state").alias("state"),
        or_unknown("store_country").alias("country"),
    ).distinct()
    return rows if known is None else unknown(rows, known, KEY_ORDER["dimension_store_locations"])


def stores(read: StagingReader, known: DataFrame | None = None) -> DataFrame:
    attributes = ("store_location", "store_city", "store_state", "store_country", "store_phone", "store_email")
    rows = read("id", "store_name", *attributes).where(not_blank("store_name"))
    rows = rows.select("id", clean("store_name").alias("store_name"), *attributes)
    return first_by(rows, ["store_name"], ["id"], known).select(
        "store_name",
        clean("store_location").alias("location"),
        or_unknown("store_city").alias("city"),
        clean("store_state").alias("state"),
        or_unknown("store_country").alias("country"),
        clean("store_phone").alias("phone"),
        clean("store_email").alias("email"),
    )


def product_categories(read: StagingReader, known: DataFrame | None = None) -> DataFrame:
    rows = read("id", "product_category", "pet_category").where(not_blank("product_category"))
    rows = rows.select("id", clean("product_category").alias("category_name"), "pet_category")
    return first_by(rows, ["category_name"], ["id"], known).select("category_name", clean("pet_category").alias("pet_category"))


def suppliers(read: StagingReader, known: DataFrame | None = None) -> DataFrame:
    attributes = (
        "supplier_name", "supplier_contact", "supplier_phone", "supplier_address", "supplier_city", "supplier_country",
    )
    rows = read("id", "supplier_email", *attributes).where(not_blank("supplier_email"))
    rows = rows.select("id", email("supplier_email").alias("email"), *attributes)
    return first_by(rows, ["email"], ["id"], known).select(
        clean("supplier_name").alias("supplier_name"),
        clean("supplier_contact").alias("contact_name"),
        "email",
        clean("supplier_phone").alias("phone"),
        clean("supplier_address").alias("address"),
        clean("supplier_city").alias("city"),
        clean("supplier_country").alias("country"),
    )


def products(read: StagingReader, known: DataFrame | None = None) -> DataFrame:
    attributes = (
        "sale_product_id", "product_category", "supplier_email", "product_weight", "product_brand", "product_material",
        "product_description", "product_rating", "product_reviews", "product_release_date", "product_expiry_date",
    )
    rows = read("id", "product_name", "product_color", "product_size", "product_price", *attributes)
    rows = rows.where(not_blank("product_name")).select(
        "id",
        clean("product_name").alias("product_name"),
        blank_to_null("product_color").alias("color"),
        blank_to_null("product_size").alias("size"),
        F.col("product_price").alias("price"),
        *attributes,
    )
    return first_by(rows, KEY_ORDER["dimension_products"], ["id"], known).select(
        F.col("sale_product_id").alias("product_id"),
        "product_name",
        clean("product_category").alias("category"),
        email("supplier_email").alias("supplier"),
        "price",
        F.col("product_weight").alias("weight"),
        "color",
        "size",
        clean("product_brand").alias("brand"),
        clean("product_material").alias("material"),
        F.col("product_description").alias("description"),
        F.col("product_rating").alias("rating"),
        F.col("product_reviews").alias("reviews_count"),
        parse_date("product_release_date").alias("release_date"),
        parse_date("product_expiry_date").alias("expiry_date"),
    )


NATURAL = {
    "dimension_pet_breeds": pet_breeds,
    "dimension_customers": customers,
    "dimension_sellers": sellers,
    "dimension_store_locations": store_locations,
    "dimension_stores": stores,
    "dimension_product_categories": product_categories,
    "dimension_suppliers": suppliers,
    "dimension_products": products,
}


# --- sales ------------------------------------------------------------------


def complete_sale() -> Column:
    """Rows with a date text, a quantity and a total."""
    return F.col("sale_date").isNotNull() & F.col("sale_quantity").isNotNull() & F.col("sale_total_price").isNotNull()


def known_parties() -> Column:
    """Rows whose customer, seller, product and store all have a dimension row.

    The dimensions are made from the same staging rows, with one row per natural
    key. A sale therefore finds a partner exactly when its natural key can be a
    dimension key, and needs no join to learn it.
    """
    return (
        not_blank("customer_email")
        & not_blank("seller_email")
        & not_blank("product_name")
        & F.col("product_price").isNotNull()
        & not_blank("store_name")
    )


def sales(read: StagingReader) -> DataFrame:
    """The rows that become facts, with the natural keys of their dimensions."""
    rows = read(
        "customer_email", "seller_email", "product_name", "product_color", "product_size", "product_price", "store_name",
        "sale_date", "sale_quantity", "sale_total_price",
    )
    return rows.where(complete_sale() & known_parties()).select(
        date_key(parse_date("sale_date")).alias("date_key"),
        email("customer_email").alias("customer_email"),
        email("seller_email").alias("seller_email"),
        clean("product_name").alias("product_name"),
        blank_to_null("product_color").alias("product_color"),
        blank_to_null("product_size").alias("product_size"),
        clean("store_name").alias("store_name"),
        F.col("sale_quantity").alias("quantity"),
        F.col("product_price").alias("unit_price"),
        F.col("sale_total_price").alias("total_price"),
    )


def _summed(rows: DataFrame, keys: list[str]) -> DataFrame:
    return rows.groupBy(*keys).agg(
        F.sum("quantity").alias("quantity"), F.sum("total_price").alias("revenue"), F.count("*").alias("sales")
    )


# --- the two kinds of star --------------------------------------------------


class Star(ABC):
    """What a report may ask of a star schema."""

    @abstractmethod
    def table(self, name: str, *columns: str) -> DataFrame:
        """A dimension, or the fact, with the given columns (all when none is given)."""

    @abstractmethod
    def totals(self, *keys: str) -> DataFrame:
        """``quantity, revenue, sales`` per combination of fact keys."""

    def sold(self, key: str, *attributes: str) -> DataFrame:
        """``totals`` of one fact key with attributes of its dimension."""
        return self.totals(key).join(self.table(DIMENSION_OF[key], key, *attributes), key)


SALE_MONTH = "sale_month"  # year and month of a sale as one number: the folders of a stored fact


class StoredStar(Star):
    """A star schema that was written before.

    ``by_month`` gives the fact with its month, if it is stored by month.
    """

    def __init__(self, tables: Mapping[str, DataFrame], by_month: Callable[[], DataFrame] | None = None):
        self._tables = tables
        self._by_month = by_month

    def during(self, first: int, last: int) -> StoredStar:
        """The star with the sales from one day to another (``yyyymmdd``); of a fact stored by month other months are not read."""
        sales = self._by_month() if self._by_month else self._tables["fact_sales"]
        sales = sales.where(F.col("date_key").between(first, last))
        if self._by_month:
            sales = sales.where(F.col(SALE_MONTH).between(first // 100, last // 100))
        return StoredStar(ChainMap({"fact_sales": sales.select(*self._tables["fact_sales"].columns)}, self._tables))

    def table(self, name: str, *columns: str) -> DataFrame:
        return self._tables[name].select(*(columns or ["*"]))

    def totals(self, *keys: str) -> DataFrame:
        return _summed(self._tables["fact_sales"], list(keys))


class DerivedStar(Star):
    """A star schema computed from staging when asked for.

    ``read(*columns)`` gives staging with these columns. Dimensions in ``dense`` have
    numbers 1..n as surrogate keys; they are written once per star (``number_rows``)
    and reused. All others are keyed by their natural key, which sorts and matches
    alike and costs no lookup: reports that do not show a key need no number.
    """

    def __init__(self, spark: SparkSession, read: StagingReader, dense: Iterable[str] = tuple(KEY_ORDER)):
        self._spark = spark
        self._read = read
        self._dense = set(dense)
        self._numbered: dict[str, DataFrame] = {}
        self._stored: dict[str, DataFrame] = {}

    def adopt(self, name: str, table: DataFrame) -> None:
        """Use ``table``, now stored, wherever ``name`` is needed from here on."""
        self._stored[name] = table

    def table(self, name: str, *columns: str) -> DataFrame:
        if not columns:
            columns = tuple(c for c in STAR[name].names if c != "sale_key")
        if name in self._stored:
            return self._stored[name].select(*columns)
        if name == "fact_sales":
            return self._with_fact_keys(sales(self._read), columns).select(*columns)
        if name == "dimension_dates":
            return calendar(self._spark).select(*columns)
        rows = self._with_key(name) if primary_key(name) in columns else self._natural(name)
        return self._with_parents(name, rows, columns).select(*columns)

    def totals(self, *keys: str) -> DataFrame:
        return self._with_fact_keys(self._natural_totals(keys), keys).select(*keys, *MEASURES)

    def sold(self, key: str, *attributes: str) -> DataFrame:
        if not self._needs_lookup(key):
            return super().sold(key, *attributes)
        # One join finds the number and the attributes but those that came with the sales.
        dimension, on = FACT_KEYS[key]
        keyed = self.table(dimension, *dict.fromkeys((key, *on.values(), *attributes)))
        take = [key, *[a for a in attributes if on.get(a) != a]]
        found = lookup(self._natural_totals((key,)), keyed, on, take, null_safe=NULL_SAFE)
        return found.select(key, *MEASURES, *attributes)

    def _natural_totals(self, keys: tuple[str, ...]) -> DataFrame:
        natural = [c for k in keys for c in (FACT_KEYS[k][1] if k in FACT_KEYS else (k,))]
        return _summed(sales(self._read), natural)

    def _needs_lookup(self, key: str) -> bool:
        return key in FACT_KEYS and FACT_KEYS[key][0] in self._dense

    def _with_fact_keys(self, rows: DataFrame, keys: tuple[str, ...]) -> DataFrame:
        for key in self._smallest_first(keys):
            if key in FACT_KEYS:
                dimension, on = FACT_KEYS[key]
                if self._needs_lookup(key):
                    rows = lookup(rows, self.table(dimension, key, *on.values()), on, [key], null_safe=NULL_SAFE)
                else:
                    rows = rows.withColumn(key, _natural_key(on))
        return rows

    def _smallest_first(self, keys: tuple[str, ...]) -> list[str]:
        """The order of lookups: rows that are shuffled for a large dimension then carry the numbers of the small ones, not their texts."""
        looked_up = [k for k in keys if self._needs_lookup(k)]
        if len(looked_up) < 2:
            return list(keys)
        # numbered dimensions are written, so they are only counted here
        sizes = {k: self.table(FACT_KEYS[k][0], k).count() for k in looked_up}
        return sorted(keys, key=lambda k: sizes.get(k, 0))

    def _natural(self, name: str, known: DataFrame | None = None) -> DataFrame:
        if name == "dimension_pets":
            return pets(self._read, self.table("dimension_pet_breeds", "breed_key", "breed_name"), known)
        return NATURAL[name](self._read, known)

    def _with_key(self, name: str) -> DataFrame:
        key, order = primary_key(name), KEY_ORDER[name]
        if name not in self._dense:
            return self._natural(name).withColumn(key, _natural_key({c: c for c in order}))
        if name not in self._numbered:
            self._numbered[name] = number_rows(self._natural(name), order, key)
        return self._numbered[name]

    def _with_parents(self, name: str, rows: DataFrame, columns: tuple[str, ...]) -> DataFrame:
        if name == "dimension_customers" and "pet_key" in columns:
            pet = lowest_key(self.table("dimension_pets", "pet_key", "pet_name"), ["pet_name"], "pet_key")
            return lookup(rows, pet, {"pet_name": "pet_name"}, ["pet_key"], "left")
        if name == "dimension_stores" and "location_key" in columns:
            places = self.table("dimension_store_locations", "location_key", "city", "state", "country")
            places = places.withColumn("state", F.coalesce("state", F.lit("")))
            place = lowest_key(places, ["city", "state", "country"], "location_key")
            rows = rows.withColumn("state", F.coalesce("state", F.lit("")))
            return lookup(rows, place, {c: c for c in ("city", "state", "country")}, ["location_key"], "left")
        if name == "dimension_products":
            if "category_key" in columns:
                rows = self._with_parent(rows, "category", "dimension_product_categories", "category_name")
            if "supplier_key" in columns:
                rows = self._with_parent(rows, "supplier", "dimension_suppliers", "email")
        return rows

    def _with_parent(self, rows: DataFrame, column: str, parent: str, natural: str) -> DataFrame:
        """Key of a parent that exists for every text that is not blank."""
        key = primary_key(parent)
        if parent in self._dense:
            return lookup(rows, self.table(parent, key, natural), {column: natural}, [key], "left")
        return rows.withColumn(key, F.nullif(F.col(column), F.lit("")))


class GrownStar(DerivedStar):
    """A stored star and a batch of staging that adds to it.

    Rows that are stored stay as they are, with their numbers. A natural key that is new gets the first of its
    rows in the batch and a number above all numbers given before.
    """

    def __init__(self, spark: SparkSession, read: StagingReader, known: Mapping[str, DataFrame]):
        super().__init__(spark, read)
        self._known = known

    def added(self, name: str) -> DataFrame:
        """The rows that the batch adds to a dimension, or its sales; parents must have been adopted."""
        if name == "fact_sales":
            return self.table(name)
        key, order = primary_key(name), KEY_ORDER[name]
        new = self._natural(name, self._known[name])
        above = self._known[name].agg(F.coalesce(F.max(key), F.lit(0))).first()[0]
        numbered = number_rows(new, order, key).withColumn(key, F.col(key) + F.lit(above))
        columns = tuple(STAR[name].names)
        return self._with_parents(name, numbered, columns).select(*columns)


class SummedStar(StoredStar):
    """A stored star whose sums per key are stored as well."""

    def __init__(self, tables: Mapping[str, DataFrame], sums: Mapping[str, DataFrame]):
        super().__init__(tables)
        self._sums = dict(sums)

    def totals(self, *keys: str) -> DataFrame:
        return self._sums[keys[0]] if len(keys) == 1 and keys[0] in self._sums else super().totals(*keys)


def _natural_key(columns: Mapping[str, str]) -> Column:
    """The natural key as one value: text, or a struct, in which NULL equals NULL."""
    if len(columns) == 1:
        return F.col(*columns)
    return F.struct(*[F.col(c).alias(name) for c, name in columns.items()])

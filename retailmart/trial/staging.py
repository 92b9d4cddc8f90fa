"""Staging made from the TPC-H-like trial tables.

The trial data is clean, so the expressions put in padding, mixed case, blanks,
NULLs and shared names. Each is valid, with equal results, in Spark SQL and in
the checking database. Every line item becomes one staging row; all joins are
N:1 left joins, so a table none of whose columns is wanted is left out without
changing the rows.

Orders are from 1995 to 2001 and the calendar starts in 2010, so dates move by 16
years, which keeps leap days; every 113th order stays where it is, outside the
calendar.

``id`` is not unique, as identifiers of merged files need not be: the first row
per key is then settled by the remaining columns.
"""

from __future__ import annotations

import re
from collections.abc import Callable
from functools import cache

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from retailmart.schemas import STAGING

# fixed values: staging column -> expression over the trial tables
EXPRESSIONS = {
    "id": "l_orderkey * 10 + l_linenumber",
    "customer_first_name": "case when c_custkey % 53 = 0 then null else concat(' ', split_part(c_name, '#', 1)) end",
    "customer_last_name": "split_part(c_name, '#', 2)",
    "customer_age": "18 + (c_custkey + l_linenumber) % 60",
    "customer_email": (
        "case when c_custkey % 97 = 0 then null when c_custkey % 97 = 1 then '   ' "
        "when l_linenumber % 2 = 0 then concat('  ', upper(c_name), '@MAIL.TEST ') else concat(c_name, '@mail.test') end"
    ),
    "customer_country": "concat(cn_name, ' ')",
    "customer_postal_code": "concat('0', 1000 + l_linenumber)",
    "customer_pet_type": (
        "case when c_custkey % 41 = 0 then null when c_custkey % 5 = 0 then ' dog' "
        "when c_custkey % 5 = 1 then 'cat ' else 'bird' end"
    ),
    "customer_pet_name": (
        "case when c_custkey % 41 = 0 then null when c_custkey % 41 = 1 then '' "
        "else concat('Pet ', c_custkey % 200) end"
    ),
    "customer_pet_breed": (
        "case when c_custkey % 12 = 11 then null when c_custkey % 12 = 10 then '' "
        "else concat('Breed ', c_custkey % 12) end"
    ),
    "seller_first_name": "concat('Sell', l_orderkey % 50)",
    "seller_last_name": "case when l_orderkey % 50 = 7 then null else ' Er' end",
    "seller_email": (
        "case when l_orderkey % 50 = 49 then null when l_orderkey % 50 = 48 then ' ' "
        "when l_linenumber % 2 = 0 then concat('SELLER', l_orderkey % 50, '@Shop.Test') "
        "else concat('seller', l_orderkey % 50, '@shop.test ') end"
    ),
    "seller_country": "concat('NATION_', l_orderkey % 25)",
    "seller_postal_code": "concat('0', 2000 + l_linenumber)",
    "product_name": "case when p_partkey % 91 = 0 then '' when p_partkey % 91 = 1 then null else concat(' ', p_name, ' ') end",
    "product_category": "case when p_partkey % 83 = 0 then null when p_partkey % 83 = 1 then ' ' else concat(p_type, ' ') end",
    "product_price": "case when p_partkey % 89 = 0 then null else p_retailprice end",
    "product_quantity": "p_size",
    "sale_date": (
        "case when l_orderkey % 101 = 0 then null when l_orderkey % 103 = 0 then '13/45/2021' else concat("
        "month(o_orderdate), '/', day(o_orderdate), '/', "
        "year(o_orderdate) + case when l_orderkey % 113 = 0 then 0 else 16 end) end"
    ),
    "sale_customer_id": "c_custkey",
    "sale_seller_id": "l_orderkey % 50",
    "sale_product_id": "p_partkey",
    "sale_quantity": "case when l_orderkey % 107 = 0 then null else l_quantity end",
    "sale_total_price": "case when l_orderkey % 109 = 0 then null else l_extendedprice end",
    "store_name": (
        "case when l_orderkey % 40 = 39 then null when l_orderkey % 40 = 38 then ' ' "
        "else concat(' Store ', l_orderkey % 40) end"
    ),
    "store_location": "concat('Unit ', l_linenumber)",
    "store_city": (
        "case when l_orderkey % 40 % 15 = 14 then null when l_orderkey % 40 % 15 = 13 then '' "
        "else concat('City ', l_orderkey % 40 % 15) end"
    ),
    "store_state": (
        "case when l_orderkey % 40 % 3 = 0 then case when l_linenumber % 2 = 0 then null else '' end else 'ST' end"
    ),
    "store_country": "case when l_orderkey % 40 % 20 = 19 then null else concat('NATION_', l_orderkey % 40 % 20) end",
    "store_phone": "concat('555-', l_orderkey % 40)",
    "store_email": "concat('s', l_orderkey % 40, '@store.test')",
    "pet_category": "case when l_linenumber % 2 = 0 then 'Dogs' else 'Cats ' end",
    "product_weight": "concat(p_size, '.5')",
    "product_color": (
        "case when p_partkey % 5 = 0 then '  ' when p_partkey % 5 = 1 then null else split_part(p_name, ' ', 1) end"
    ),
    "product_size": "case when p_partkey % 7 = 0 then '' else concat(p_size, '') end",
    "product_brand": "concat(p_brand, ' ')",
    "product_material": "p_type",
    "product_description": "concat('Item ', p_partkey)",
    "product_rating": "case when p_partkey % 37 = 0 then null else concat(1 + p_partkey % 4, '.', p_partkey % 10) end",
    "product_reviews": "case when p_partkey % 43 = 0 then null else p_partkey * 7 % 1000 end",
    "product_release_date": "concat(1 + p_partkey % 12, '/', 1 + p_partkey % 28, '/', 2010 + p_partkey % 10)",
    "product_expiry_date": (
        "case when p_partkey % 31 = 0 then '13/45/2021' when p_partkey % 31 = 1 then '' "
        "else concat(1 + p_partkey % 12, '/', 1 + p_partkey % 28, '/', 2025 + p_partkey % 5) end"
    ),
    "supplier_name": "concat(s_name, ' ')",
    "supplier_contact": "concat('Contact ', s_suppkey)",
    "supplier_email": (
        "case when s_suppkey % 17 = 0 then null when s_suppkey % 17 = 1 then ' ' "
        "else concat(lower(s_name), '@SUP.test') end"
    ),
    "supplier_phone": "concat('556-', s_suppkey)",
    "supplier_address": "concat('Street ', l_linenumber)",
    "supplier_city": "concat('Town ', s_suppkey % 20)",
    "supplier_country": "sn_name",
}


def _fast(expression: str) -> str:
    """The same with parts of texts found by search; ``split_part`` makes and runs a regular expression per row."""
    expression = re.sub(r"split_part\((\w+), ('.'), 1\)", r"substring_index(\1, \2, 1)", expression)
    second = r"case when instr(\1, \2) = 0 then '' else substring_index(substring_index(\1, \2, 2), \2, -1) end"
    return re.sub(r"split_part\((\w+), ('.'), 2\)", second, expression)


def _sql_type(name: str) -> str:
    return STAGING[name].dataType.simpleString()


def trial_tables(spark: SparkSession, sf_dir: str) -> Callable[[str], DataFrame]:
    """The trial tables by name, each looked up on disk once."""

    @cache
    def table(name: str) -> DataFrame:
        return spark.read.parquet(f"{sf_dir}/{name}.parquet")

    return table


# fixed values: prefix of the columns of a trial table -> the table; two are homes, by nation
PREFIXES = ("l", "o", "c", "cn", "p", "s", "sn")
_TOKEN = re.compile(r"\b(" + "|".join(PREFIXES) + r")_\w+")
_BROADCAST_ROWS = 1_000_000  # suppliers up to here go to every task (80 MB), more are shuffled


def _uses(expression: str) -> frozenset[str]:
    return frozenset(_TOKEN.findall(expression))


def staging(table: Callable[[str], DataFrame], columns: tuple[str, ...] = ()) -> DataFrame:
    """Staging with the given columns (all when none is given), joining only the tables they need.

    Line items shuffle twice, by order and by part, and carry numbers rather than texts where they can: nations and
    suppliers are looked up after the last shuffle. What only a part or a supplier decides is worked out once for each of
    them and comes to a line item as one value: each later step copies all it passes on, a value in one go. The rest is worked out in
    two steps, so that neither has all expressions (code too large for the compiler of the virtual machine is interpreted).
    """
    names = columns or tuple(STAGING.names)
    used = {n: _uses(EXPRESSIONS[n]) for n in names}
    wanted = frozenset().union(*used.values())
    found: dict[str, Column] = {}

    def worked_out(on: frozenset[str], some: frozenset[str] = frozenset()) -> list[Column]:
        """The columns not found yet that need these tables only, and ``some`` of them if given."""
        ready = [n for n in names if n not in found and used[n] <= on and (not some or used[n] & some)]
        found.update({n: F.col(n) for n in ready})
        return [F.expr(f"cast({_fast(EXPRESSIONS[n])} as {_sql_type(n)})").alias(n) for n in ready]

    def packed(rows: DataFrame, on: frozenset[str], name: str) -> DataFrame:
        """The table with the columns that it decides alone as one value, which later steps copy as a whole."""
        ready = worked_out(on)
        if not ready:
            return rows
        found.update({n: F.col(name)[n].alias(n) for n in rows.select(*ready).columns})
        return rows.select("*", F.struct(*ready).alias(name))

    rows = table("lineitem")
    if wanted & {"c", "cn", "o"}:
        orders = table("orders").select("o_orderkey", "o_custkey", "o_orderdate")
        if wanted & {"c", "cn"}:
            # Customers join orders first, so that line items shuffle by order only once.
            buyers = table("customer").select("c_custkey", "c_name", "c_nationkey")
            orders = orders.join(buyers, orders.o_custkey == buyers.c_custkey, "left")
        rows = rows.join(orders, rows.l_orderkey == orders.o_orderkey, "left")
    if "p" in wanted:
        part = packed(table("part"), frozenset("p"), "_part")
        rows = rows.join(part, rows.l_partkey == part.p_partkey, "left")
    if "cn" in wanted:
        homes = table("nation").selectExpr("n_nationkey as cn_key", "n_name as cn_name")
        rows = rows.join(homes, rows.c_nationkey == homes.cn_key, "left")
    if wanted & {"c", "cn"}:
        rows = rows.select("*", *worked_out(frozenset({"l", "c", "cn"}), frozenset({"c", "cn"})))
    if wanted & {"s", "sn"}:
        supplier = table("supplier").select("s_suppkey", "s_name", "s_nationkey")
        small = supplier.count() <= _BROADCAST_ROWS
        if "sn" in wanted:
            homes = table("nation").selectExpr("n_nationkey as sn_key", "n_name as sn_name")
            supplier = supplier.join(homes, supplier.s_nationkey == homes.sn_key, "left")
        supplier = packed(supplier, frozenset({"s", "sn"}), "_supplier")
        rows = rows.join(F.broadcast(supplier) if small else supplier, rows.l_suppkey == supplier.s_suppkey, "left")
    rows = rows.select("*", *worked_out(frozenset(PREFIXES)))
    return rows.select(*[found[n] for n in names])


def staging_sql() -> str:
    """The same relation for the checking database, all columns."""
    columns = ",\n  ".join(f"cast({e} as {_sql_type(n)}) as {n}" for n, e in EXPRESSIONS.items())
    return f"""select
  {columns}
from lineitem
left join (
  select o_orderkey, o_custkey, o_orderdate, c_custkey, c_name, n_name as cn_name
  from orders left join customer on o_custkey = c_custkey left join nation on c_nationkey = n_nationkey
) on l_orderkey = o_orderkey
left join part on l_partkey = p_partkey
left join (
  select s_suppkey, s_name, n_name as sn_name from supplier left join nation on s_nationkey = n_nationkey
) on l_suppkey = s_suppkey"""

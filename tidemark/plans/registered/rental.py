"""Rental reports on the sales tables, mapped onto the names that the reports use.

Actors, staff and stores are suppliers, films are parts, a film's category is
its type, and cities are nations. A supplier acts in the parts it supplies and
stocks one copy of each; a copy is rented once per order and paid by lines.
"""

from __future__ import annotations

import datetime as dt
from decimal import Decimal

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.operators.policy import apply_row_policy
from tidemark.operators.text import string_agg
from tidemark.plans import rental as r
from tidemark.functions.tables import register_rental_functions
from tidemark.registry import Tables, query
from tidemark.session import new_folder
from tidemark.sinks.files import StoredView

AMOUNT_SQL = "CAST(l_extendedprice AS DECIMAL(12,2)) * (1 - CAST(l_discount AS DECIMAL(4,2)))"


def amount():
    """Exact amount of a line in ten-thousandths; money arrives as double in the test tables.

    Cents are whole numbers, so no decimal is built per factor; the product is
    a decimal only for its sum, which would outgrow a long on a hot key.
    """
    cents = F.rint(F.col("l_extendedprice") * 100).cast("long")
    left_per_cent = F.lit(100) - F.rint(F.col("l_discount") * 100).cast("long")
    return (cents * left_per_cent).cast("decimal(18,0)")


def in_units(total):
    """A sum of ``amount()`` in units of money."""
    return total.cast("double") / 10_000


def casts(t: Tables) -> DataFrame:
    """Which supplier supplies which part, each pair once.

    NULL keys join nothing and go here, so that a plan that reads the pairs
    twice finds the same shuffle both times and runs it once.
    """
    known = F.col("l_suppkey").isNotNull() & F.col("l_partkey").isNotNull()
    pairs = t.lineitem.filter(known).select(F.col("l_suppkey").alias("s_suppkey"), F.col("l_partkey").alias("p_partkey"))
    return pairs.distinct()


def catalog(t: Tables) -> dict[str, DataFrame]:
    """The sales tables under the names of the rental schema."""
    pairs = casts(t).select(F.struct("p_partkey", "s_suppkey").alias("inventory_id"), "p_partkey", "s_suppkey")
    copy = F.struct(F.col("l_partkey").alias("p_partkey"), F.col("l_suppkey").alias("s_suppkey"))
    rental_id = F.struct("l_orderkey", "l_partkey", "l_suppkey")
    rented = t.lineitem.select("l_orderkey", "l_partkey", "l_suppkey").distinct()
    seller_name = [F.col("s_name").alias("first_name"), F.concat(F.lit("N"), "s_nationkey").alias("last_name")]
    return {
        "actor": t.supplier.select(F.col("s_suppkey").alias("actor_id"), *seller_name),
        "film": t.part.select(
            F.col("p_partkey").alias("film_id"), F.col("p_name").alias("title"), F.col("p_brand").alias("description"),
            F.col("p_retailprice").alias("rental_rate"), F.col("p_size").alias("length"), F.col("p_brand").alias("rating"),
        ),
        "category": t.part.select(F.col("p_type").alias("category_id"), F.col("p_type").alias("name")).distinct(),
        "film_category": t.part.select(F.col("p_partkey").alias("film_id"), F.col("p_type").alias("category_id")),
        "film_actor": casts(t).select(F.col("s_suppkey").alias("actor_id"), F.col("p_partkey").alias("film_id")),
        "inventory": pairs.select(
            "inventory_id", F.col("p_partkey").alias("film_id"), F.col("s_suppkey").alias("store_id")
        ),
        "rental": rented.join(t.orders.select(F.col("o_orderkey").alias("l_orderkey")), "l_orderkey").select(
            rental_id.alias("rental_id"), copy.alias("inventory_id")
        ),
        "payment": t.lineitem.select(
            rental_id.alias("rental_id"), (amount() * F.lit(Decimal("0.0001"))).alias("amount")
        ),
        "customer": t.customer.select(
            F.col("c_custkey").alias("customer_id"), F.col("c_name").alias("first_name"),
            F.col("c_mktsegment").alias("last_name"), F.col("c_nationkey").alias("address_id"),
            F.col("c_nationkey").alias("store_id"), (F.col("c_acctbal") > 0).alias("activebool"),
            F.when(F.col("c_acctbal") > 0, 1).when(F.col("c_acctbal") < 0, 0).alias("active"),
        ),
        "staff": t.supplier.select(
            F.col("s_suppkey").alias("staff_id"), *seller_name, F.col("s_nationkey").alias("address_id"),
            F.col("s_suppkey").alias("store_id"),
        ),
        "store": t.supplier.select(
            F.col("s_suppkey").alias("store_id"), F.col("s_suppkey").alias("manager_staff_id"),
            F.col("s_nationkey").alias("address_id"),
        ),
        "address": t.nation.select(
            F.col("n_nationkey").alias("address_id"), F.col("n_name").alias("address"),
            F.col("n_nationkey").cast("string").alias("postal_code"), F.col("n_name").alias("phone"),
            F.col("n_nationkey").alias("city_id"),
        ),
        "city": t.nation.select(
            F.col("n_nationkey").alias("city_id"), F.col("n_name").alias("city"), F.col("n_regionkey").alias("country_id")
        ),
        "country": t.region.select(F.col("r_regionkey").alias("country_id"), F.col("r_name").alias("country")),
    }


def _as_double(df: DataFrame, column: str) -> DataFrame:
    return df.withColumn(column, F.col(column).cast("double"))


# An actor and the pairs of actor and film, in SQL.
ACTOR_SQL = "s_suppkey AS actor_id, s_name AS first_name, 'N' || s_nationkey AS last_name"
PAIRS_SQL = "(SELECT DISTINCT l_partkey, l_suppkey FROM lineitem)"
PLACES_SQL = "nation ON {} = n_nationkey JOIN region ON n_regionkey = r_regionkey"
ADDRESS_SQL = (
    'n_name AS address, CAST(n_nationkey AS VARCHAR) AS "zip code", n_name AS phone, n_name AS city, r_name AS country'
)


@query("Q06_parts_per_type", """
SELECT p_type AS name, count(p_partkey) AS film_count FROM part WHERE p_type IS NOT NULL
GROUP BY p_type ORDER BY film_count DESC, name
""")
def q06(t):
    return r.films_per_category(catalog(t))


@query("Q07_supplier_orders", f"""
WITH rented AS (
  SELECT l_partkey, count(*) AS n FROM (SELECT DISTINCT l_orderkey, l_partkey, l_suppkey FROM lineitem)
  JOIN orders ON l_orderkey = o_orderkey GROUP BY l_partkey)
SELECT {ACTOR_SQL}, CAST(sum(n) AS BIGINT) AS rental_count
FROM supplier JOIN {PAIRS_SQL} ON s_suppkey = l_suppkey JOIN rented USING (l_partkey)
GROUP BY s_suppkey, s_name, s_nationkey ORDER BY rental_count DESC, actor_id LIMIT 10
""")
def q07(t):
    return r.actors_by_rentals(catalog(t), 10)


@query("Q08_supplier_parts", f"""
SELECT {ACTOR_SQL}, count(DISTINCT l_partkey) AS film_count
FROM supplier JOIN lineitem ON s_suppkey = l_suppkey
GROUP BY s_suppkey, s_name, s_nationkey ORDER BY film_count DESC, actor_id LIMIT 10
""")
def q08(t):
    return r.actors_by_films(catalog(t), 10)


_SALES_SQL = f"""
SELECT p_type AS name, CAST(sum({AMOUNT_SQL}) AS DOUBLE) AS amount_sum
FROM part JOIN lineitem ON p_partkey = l_partkey JOIN orders ON l_orderkey = o_orderkey
WHERE p_type IS NOT NULL AND l_suppkey IS NOT NULL GROUP BY p_type
"""


@query("Q09_revenue_by_type", _SALES_SQL + "ORDER BY amount_sum DESC, name LIMIT 3")
def q09(t):
    return _as_double(r.revenue_by_category(catalog(t), 3), "amount_sum")


@query("Q10_orders_without_items", """
SELECT o_orderkey AS film_id, o_orderpriority AS title
FROM orders LEFT JOIN lineitem ON o_orderkey = l_orderkey WHERE l_orderkey IS NULL ORDER BY title, film_id
""")
def q10(t):
    """Orders as films and lines as their copies, since every part is stocked."""
    return r.films_without_inventory({
        "film": t.orders.select(F.col("o_orderkey").alias("film_id"), F.col("o_orderpriority").alias("title")),
        "inventory": t.lineitem.select(F.col("l_orderkey").alias("film_id")),
    })


@query("Q10_parts_never_returned_large", """
SELECT p_partkey AS film_id, p_name AS title FROM part
WHERE NOT EXISTS (SELECT 1 FROM lineitem WHERE l_partkey = p_partkey AND l_returnflag = 'R' AND l_quantity > 40)
ORDER BY p_name, p_partkey
""")
def q10_parts(t):
    returned = t.lineitem.filter((F.col("l_returnflag") == "R") & (F.col("l_quantity") > 40))
    return r.films_without_inventory(
        catalog(t) | {"inventory": returned.select(F.col("l_partkey").alias("film_id"))}
    )


_SMALL_SQL = f"""
WITH counts AS (
  SELECT {ACTOR_SQL}, count(DISTINCT p_partkey) AS film_count
  FROM supplier JOIN lineitem ON s_suppkey = l_suppkey JOIN part ON l_partkey = p_partkey
  WHERE p_type = 'SMALL' GROUP BY s_suppkey, s_name, s_nationkey)
"""


@query("Q11_threshold_ties", _SMALL_SQL + """
SELECT actor_id, first_name, last_name, film_count FROM counts
WHERE film_count >= (SELECT min(film_count) FROM (SELECT film_count FROM counts ORDER BY film_count DESC LIMIT 3))
ORDER BY film_count DESC, actor_id
""")
def q11(t):
    return r.top_actors_threshold(catalog(t), "SMALL", 3)


@query("Q12_dense_rank", _SMALL_SQL + """
SELECT first_name, last_name, film_count, rank FROM (
  SELECT *, dense_rank() OVER (ORDER BY film_count DESC) AS rank FROM counts)
WHERE rank <= 3 ORDER BY rank, last_name, first_name
""")
def q12(t):
    return r.top_actors_dense_rank(catalog(t), "SMALL", 3)


@query("Q13_conditional_counts", """
SELECT n_nationkey AS city_id, n_name AS city,
       count(*) FILTER (WHERE c_acctbal > 0) AS active_customers,
       count(*) FILTER (WHERE c_acctbal < 0) AS inactive_customers
FROM customer JOIN nation ON c_nationkey = n_nationkey
GROUP BY n_nationkey, n_name ORDER BY inactive_customers DESC, city_id
""")
def q13(t):
    return r.customers_per_city(catalog(t))


# The two groups of nations and the texts that name them.
NATION_GROUPS = {"ones": "NATION\\_1%", "twos": "%\\_2%"}


def _nation_group_sql(label: str, pattern: str) -> str:
    return f"""
SELECT * FROM (SELECT '{label}' AS group_name, p_type AS name, count(*) AS rentals_count
  FROM part JOIN lineitem ON p_partkey = l_partkey JOIN orders ON l_orderkey = o_orderkey
  JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey
  WHERE n_name LIKE '{pattern}' ESCAPE '\\'
  GROUP BY p_type ORDER BY rentals_count DESC, name LIMIT 1)
"""


@query("Q14_two_patterns", " UNION ALL ".join(_nation_group_sql(k, p) for k, p in NATION_GROUPS.items()))
def q14(t):
    """Nations as cities of one address each, customers as renters, line items as rentals of parts."""
    bought = t.orders.select(F.col("o_orderkey").alias("l_orderkey"), F.col("o_custkey").alias("customer_id"))
    part = F.col("l_partkey").alias("inventory_id")
    tables = catalog(t) | {
        "city": t.nation.select(F.col("n_nationkey").alias("city_id"), F.col("n_name").alias("city")),
        "address": t.nation.select(F.col("n_nationkey").alias("address_id"), F.col("n_nationkey").alias("city_id")),
        "customer": t.customer.select(F.col("c_custkey").alias("customer_id"), F.col("c_nationkey").alias("address_id")),
        "rental": t.lineitem.select("l_orderkey", part).join(bought, "l_orderkey").select("inventory_id", "customer_id"),
        "inventory": t.part.select(F.col("p_partkey").alias("inventory_id"), F.col("p_partkey").alias("film_id")),
    }
    return r.top_category_per_city_group(tables, NATION_GROUPS)


def _places(t: Tables) -> DataFrame:
    return t.nation.join(t.region.withColumnRenamed("r_regionkey", "n_regionkey"), "n_regionkey").select(
        "n_nationkey", F.col("n_name").alias("city"), F.col("r_name").alias("country")
    )


@query("Q15_customer_list", f"""
SELECT c_custkey AS id, c_name || ' ' || c_mktsegment AS name, {ADDRESS_SQL},
       CASE WHEN c_acctbal > 0 THEN 'active' ELSE '' END AS notes, c_nationkey AS sid
FROM customer JOIN {PLACES_SQL.format("c_nationkey")}
""")
def q15(t):
    return r.customer_list(catalog(t))


@query("Q16_staff_list", f"""
SELECT s_suppkey AS id, s_name || ' N' || s_nationkey AS name, {ADDRESS_SQL}, s_suppkey AS sid
FROM supplier JOIN {PLACES_SQL.format("s_nationkey")}
""")
def q16(t):
    return r.staff_list(catalog(t))


def _film_list_sql(actor: str) -> str:
    return f"""
SELECT p_partkey AS fid, p_name AS title, p_brand AS description, p_type AS category, p_retailprice AS price,
       p_size AS length, p_brand AS rating, string_agg({actor}, ', ' ORDER BY {actor}) AS actors
FROM part JOIN {PAIRS_SQL} ON p_partkey = l_partkey JOIN supplier ON l_suppkey = s_suppkey
WHERE p_type IS NOT NULL GROUP BY p_partkey, p_name, p_type, p_retailprice, p_size, p_brand
"""


@query("Q17_film_list", _film_list_sql("(s_name || ' N' || s_nationkey)"))
def q17(t):
    return r.film_list(catalog(t))


@query("Q18_nicer_film_list", _film_list_sql(
    "(upper(substring(s_name, 1, 1)) || lower(substring(s_name, 2)) || 'N' || s_nationkey)"
))
def q18(t):
    return r.film_list_nice_names(catalog(t))


@query("Q19_actor_info", f"""
WITH titles AS (
  SELECT l_suppkey, p_type, string_agg(p_name, ', ' ORDER BY p_name, p_partkey) AS titles
  FROM {PAIRS_SQL} JOIN part ON p_partkey = l_partkey WHERE p_type IS NOT NULL
  GROUP BY l_suppkey, p_type)
SELECT {ACTOR_SQL},
       string_agg(DISTINCT p_type || ': ' || titles, ', ' ORDER BY p_type || ': ' || titles) AS film_info
FROM supplier LEFT JOIN titles ON s_suppkey = l_suppkey GROUP BY s_suppkey, s_name, s_nationkey
""")
def q19(t):
    return r.actor_info(catalog(t))


@query("Q20_sales_by_type", _SALES_SQL.replace("name,", "category,").replace("amount_sum", "total_sales")
       + "ORDER BY total_sales DESC")
def q20(t):
    return _as_double(r.sales_by_film_category(catalog(t)), "total_sales")


@query("Q21_stored_sales_by_type", _SALES_SQL.replace("name,", "category,").replace("amount_sum", "total_sales"))
def q21(t):
    sales = catalog(t)
    view = StoredView(t.spark, new_folder(t.spark, "sales_by_type"), lambda: r.sales_by_film_category(sales))
    view.refresh()
    return _as_double(view.read(), "total_sales")


@query("Q22_sales_by_store", f"""
SELECT n_name || ',' || r_name AS store, s_name || ' N' || s_nationkey AS manager,
       CAST(sum({AMOUNT_SQL}) AS DOUBLE) AS total_sales
FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN supplier ON l_suppkey = s_suppkey
JOIN {PLACES_SQL.format("s_nationkey")}
WHERE l_partkey IS NOT NULL GROUP BY r_name, n_name, s_suppkey, s_name, s_nationkey ORDER BY r_name, n_name, s_suppkey
""")
def q22(t):
    return _as_double(r.sales_by_store(catalog(t)), "total_sales")


# Row functions of the schema, on parts as items and line items as their rentals.

OPEN_SQL = "l_linestatus = 'O' AND l_returnflag = 'N' AND l_quantity >= 40"


def _shop(t: Tables) -> dict[str, DataFrame]:
    is_open = (F.col("l_linestatus") == "O") & (F.col("l_returnflag") == "N") & (F.col("l_quantity") >= 40)
    return {
        "inventory": t.part.select(
            F.col("p_partkey").alias("inventory_id"), F.col("p_size").alias("film_id"),
            F.col("p_brand").alias("store_id"),
        ),
        "rental": t.lineitem.select(
            F.col("l_partkey").alias("inventory_id"), F.col("l_suppkey").alias("customer_id"),
            F.when(~is_open, F.col("l_shipdate")).alias("return_date"),
        ),
    }


@query("G01_in_stock", f"""
SELECT p_partkey AS inventory_id, p_size AS film_id, p_brand AS store_id,
       count(*) FILTER (WHERE {OPEN_SQL}) = 0 AS in_stock
FROM part LEFT JOIN lineitem ON p_partkey = l_partkey GROUP BY p_partkey, p_size, p_brand
""")
def g01(t):
    return r.stock(_shop(t))


_FILM_STOCK_SQL = f"""
SELECT p_partkey AS inventory_id FROM part LEFT JOIN lineitem ON p_partkey = l_partkey
WHERE p_size = 7 AND p_brand = 'Brand#3' GROUP BY p_partkey HAVING count(*) FILTER (WHERE {OPEN_SQL})
"""


@query("G02_film_in_stock", _FILM_STOCK_SQL + " = 0")
def g02(t):
    return r.film_in_stock(_shop(t), 7, "Brand#3")


@query("G03_film_not_in_stock", _FILM_STOCK_SQL + " > 0")
def g03(t):
    return r.film_in_stock(_shop(t), 7, "Brand#3", in_stock=False)


@query("G02_film_in_stock_in_sql", _FILM_STOCK_SQL + " = 0")
def g02_sql(t):
    register_rental_functions(t.spark, _shop(t))
    return t.spark.sql("SELECT inventory_id FROM film_in_stock(7, 'Brand#3')")


@query("G03_film_not_in_stock_in_sql", _FILM_STOCK_SQL + " > 0")
def g03_sql(t):
    register_rental_functions(t.spark, _shop(t))
    return t.spark.sql("SELECT inventory_id FROM film_not_in_stock(7, 'Brand#3')")


@query("G01_in_stock_in_sql", f"""
SELECT p_partkey AS inventory_id, count(*) FILTER (WHERE {OPEN_SQL}) = 0 AS in_stock
FROM part LEFT JOIN lineitem ON p_partkey = l_partkey GROUP BY p_partkey
""")
def g01_sql(t):
    """The function of one item for all items: planned as one join."""
    register_rental_functions(t.spark, _shop(t))
    return t.spark.sql("SELECT inventory_id, inventory_in_stock(inventory_id) AS in_stock FROM rental_shop_inventory")


@query("G04_held_by", f"""
SELECT p_partkey AS inventory_id, min(l_suppkey) FILTER (WHERE {OPEN_SQL}) AS customer_id
FROM part LEFT JOIN lineitem ON p_partkey = l_partkey GROUP BY p_partkey
""")
def g04(t):
    return r.holders(_shop(t))


EFFECTIVE = dt.datetime(1999, 1, 1)


def _accounts(t: Tables) -> dict[str, DataFrame]:
    """Customers who rent parts by the lines of their orders and pay by the order."""
    return {
        "customer": t.customer.select(F.col("c_custkey").alias("customer_id")),
        "film": t.part.select(
            F.col("p_partkey").alias("film_id"), F.col("p_retailprice").cast("decimal(12,2)").alias("rental_rate"),
            F.col("p_size").alias("rental_duration"), F.lit(100).alias("replacement_cost"),
        ),
        "inventory": t.part.select(F.col("p_partkey").alias("inventory_id"), F.col("p_partkey").alias("film_id")),
        "rental": t.lineitem.select(
            "l_orderkey", F.col("l_partkey").alias("inventory_id"), F.col("l_shipdate").alias("return_date")
        ).join(
            t.orders.select(
                F.col("o_orderkey").alias("l_orderkey"), F.col("o_custkey").alias("customer_id"),
                F.col("o_orderdate").alias("rental_date"),
            ),
            "l_orderkey",
        ),
        "payment": t.orders.select(
            F.col("o_custkey").alias("customer_id"), F.col("o_totalprice").cast("decimal(12,2)").alias("amount"),
            F.col("o_orderdate").alias("payment_date"),
        ),
    }


def _balance_sql(extra: str) -> str:
    return f"""
WITH late AS (
  SELECT o_custkey, CAST(p_retailprice AS DECIMAL(12,2)) AS rate, p_size,
         greatest(date_diff('day', o_orderdate, l_shipdate) - p_size, 0) AS over_days
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN part ON l_partkey = p_partkey
  WHERE o_orderdate <= TIMESTAMP '1999-01-01'),
owed AS (SELECT o_custkey, sum(rate + {extra}) AS fees, sum(over_days) AS over_days FROM late GROUP BY o_custkey),
paid AS (SELECT o_custkey, sum(CAST(o_totalprice AS DECIMAL(12,2))) AS paid FROM orders
         WHERE o_orderdate <= TIMESTAMP '1999-01-01' GROUP BY o_custkey)
SELECT c_custkey AS customer_id,
       CAST(coalesce(fees, 0) + coalesce(over_days, 0) - coalesce(paid, 0) AS DOUBLE) AS balance
FROM customer LEFT JOIN owed ON c_custkey = owed.o_custkey LEFT JOIN paid ON c_custkey = paid.o_custkey
"""


@query("G05_customer_balance", _balance_sql("0"))
def g05(t):
    return r.customer_balances(_accounts(t), EFFECTIVE).withColumn("balance", F.col("balance").cast("double"))


@query("G05_balance_with_replacement", _balance_sql("CASE WHEN over_days > 2 * p_size THEN 100 ELSE 0 END"))
def g05_replacement(t):
    return r.customer_balances(_accounts(t), EFFECTIVE, charge_replacement=True).withColumn(
        "balance", F.col("balance").cast("double")
    )


_REWARDS_SQL = """
SELECT customer.* FROM customer WHERE c_custkey IN (
  SELECT o_custkey FROM orders WHERE CAST(o_orderdate AS DATE) BETWEEN DATE '2000-03-01' AND DATE '2000-03-31'
  GROUP BY o_custkey HAVING sum(CAST(o_totalprice AS DECIMAL(12,2))) > 100000 AND count(o_custkey) > 1)
"""


def _paid_orders(t: Tables) -> dict[str, DataFrame]:
    return {
        "customer": t.customer.withColumnRenamed("c_custkey", "customer_id"),
        "payment": t.orders.select(
            F.col("o_custkey").alias("customer_id"), F.col("o_totalprice").cast("decimal(12,2)").alias("amount"),
            F.col("o_orderdate").alias("payment_date"),
        ),
    }


@query("G06_rewards_report", _REWARDS_SQL)
def g06(t):
    return r.rewards_report(_paid_orders(t), 1, 100000, dt.date(2000, 6, 15)).withColumnRenamed("customer_id", "c_custkey")


@query("G06_rewards_report_in_sql", _REWARDS_SQL)
def g06_sql(t):
    register_rental_functions(t.spark, _paid_orders(t))
    return t.spark.sql("SELECT * FROM rewards_report(1, 100000, DATE '2000-06-15')").withColumnRenamed("customer_id", "c_custkey")


def _guarded(t: Tables):
    """Customers with their country, and roles named after the countries plus one that sees all."""
    people = t.customer.join(_places(t), F.col("c_nationkey") == F.col("n_nationkey")).select(
        "c_custkey", "c_name", "city", "country"
    )
    mapping = t.region.select(
        F.concat(F.lit("MANAGER_"), "r_name").alias("role_name"), F.col("r_name").alias("allowed_country")
    )
    admins = t.region.select(F.lit("ADMIN").alias("role_name"), F.lit("ALL").alias("allowed_country"))
    return people, mapping.unionByName(admins)


_GUARDED_SQL = """
SELECT c_custkey, c_name, n_name AS city, r_name AS country
FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey
"""


@query("G10_policy_one_country", _GUARDED_SQL + "WHERE r_name = 'ASIA'")
def g10(t):
    return apply_row_policy(*_guarded(t), "country", "MANAGER_ASIA")


@query("G10_policy_all", _GUARDED_SQL)
def g10_all(t):
    return apply_row_policy(*_guarded(t), "country", "ADMIN")


@query("G10_policy_unmapped", _GUARDED_SQL + "WHERE false")
def g10_none(t):
    return apply_row_policy(*_guarded(t), "country", "NOBODY")


@query("G08_group_concat", """
SELECT p_brand, string_agg(DISTINCT p_name, ', ' ORDER BY p_name) AS names FROM part GROUP BY p_brand
""")
def g08(t):
    return string_agg(t.part, ["p_brand"], "p_name", "names", distinct=True)

"""The rental schema's table functions, for callers who write SQL.

The functions are temporary SQL functions of the session, so a query that uses
one is planned as a whole: a filter or join around the call reaches the
tables, and nothing runs row by row.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

VIEWS = ("inventory", "rental", "payment", "customer")


def _columns(df: DataFrame) -> str:
    return ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema)


def _kind(df: DataFrame, column: str) -> str:
    return df.schema[column].dataType.simpleString()


def register_rental_functions(spark: SparkSession, t: dict[str, DataFrame]) -> list[str]:
    """Make the functions that the given tables allow known to ``spark.sql`` and return their names.

    ``inventory`` and ``rental`` give ``inventory_in_stock(item)``,
    ``film_in_stock(film, store)`` and ``film_not_in_stock(film, store)``; ``payment``
    and ``customer`` give ``rewards_report(purchases, amount, as_of)``. Tables become
    temporary views named ``rental_shop_<table>``. Calling it again replaces
    views and functions.
    """
    for name in VIEWS:
        if name in t:
            t[name].createOrReplaceTempView(f"rental_shop_{name}")
    made = []

    def create(name: str, text: str) -> None:
        spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION {name}{text}")
        made.append(name)

    if "inventory" in t and "rental" in t:
        item, film, store = (_kind(t["inventory"], c) for c in ("inventory_id", "film_id", "store_id"))
        create("inventory_in_stock", f"""(item {item}) RETURNS BOOLEAN RETURN (
            SELECT count(*) = 0 FROM rental_shop_rental r WHERE r.inventory_id = item AND r.return_date IS NULL)""")
        for name, join in (("film_in_stock", "LEFT ANTI"), ("film_not_in_stock", "LEFT SEMI")):
            create(name, f"""(film {film}, store {store}) RETURNS TABLE (inventory_id {item}) RETURN
                SELECT i.inventory_id FROM (SELECT * FROM rental_shop_inventory WHERE film_id = film AND store_id = store) i
                {join} JOIN (SELECT inventory_id FROM rental_shop_rental WHERE return_date IS NULL) r ON i.inventory_id = r.inventory_id""")
    if "payment" in t and "customer" in t:
        create("rewards_report", f"""(purchases INT, amount DECIMAL(20,2), as_of DATE DEFAULT current_date())
            RETURNS TABLE ({_columns(t["customer"])}) RETURN
            SELECT c.* FROM rental_shop_customer c LEFT SEMI JOIN (
                SELECT p.customer_id FROM rental_shop_payment p
                WHERE CASE WHEN purchases = 0 THEN raise_error('purchases has to be at least 1')
                           WHEN amount = 0 THEN raise_error('amount has to be positive') ELSE true END
                  AND p.payment_date >= add_months(trunc(as_of, 'MM'), -3) AND p.payment_date < add_months(trunc(as_of, 'MM'), -2)
                GROUP BY p.customer_id HAVING sum(p.amount) > amount AND count(p.customer_id) > purchases
            ) good ON c.customer_id = good.customer_id""")
    return made

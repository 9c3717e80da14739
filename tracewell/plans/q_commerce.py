"""Events made from order tables, and their users."""

from __future__ import annotations

from pyspark.sql import functions as F

from tracewell.functions.let import computed_once
from tracewell.operators import commerce, filters, shape
from tracewell.plans import inputs
from tracewell.plans.registry import query


@query(
    "cart_events",
    """SELECT l_orderkey AS order_id, l_linenumber AS line_no, 'product_added_to_cart' AS name,
         CAST(p_partkey AS VARCHAR) AS product_id, 'bundle ' || p_name AS product_name, p_retailprice AS price,
         CAST(l_quantity AS BIGINT) AS quantity, round(p_retailprice * l_quantity, 2) AS total_value,
         CASE WHEN p_size % 2 = 0 THEN p_type ELSE 'from extra' END AS category
       FROM lineitem JOIN part ON l_partkey = p_partkey""",
)
def cart_events(spark, folder):
    lines = inputs.load(spark, folder, "lineitem", "l_orderkey").select(
        F.col("l_orderkey").alias("order_id"),
        F.col("l_linenumber").alias("line_no"),
        F.col("l_partkey").alias("product_id"),
        F.col("l_quantity").alias("quantity"),
    )
    products = inputs.load(spark, folder, "part").select(
        F.col("p_partkey").alias("product_id"),
        F.col("p_name").alias("product_name"),
        F.col("p_retailprice").alias("price"),
        F.when(F.col("p_size") % 2 == 0, F.col("p_type")).otherwise("").alias("category"),
    )
    extra = F.to_variant_object(
        F.struct(
            F.concat(F.lit("bundle "), F.col("product_name")).alias("product_name"),
            F.lit("from extra").alias("category"),
        )
    )
    events = commerce.cart_add_events(lines, products, extra, F.col("category"))
    events = computed_once(events.select("order_id", "line_no", "name", "properties"))
    p = F.col("properties")
    return events.select(
        "order_id",
        "line_no",
        "name",
        p.try_cast("map<string,variant>")["product_id"].cast("string").alias("product_id"),
        F.variant_get(p, "$.product_name", "string").alias("product_name"),
        F.variant_get(p, "$.price", "double").alias("price"),
        F.variant_get(p, "$.quantity", "bigint").alias("quantity"),
        F.round(F.variant_get(p, "$.total_value", "double"), 2).alias("total_value"),
        F.variant_get(p, "$.category", "string").alias("category"),
    )


@query(
    "sale_events",
    """WITH lines AS (SELECT l_orderkey, count(*) AS n, CAST(sum(l_quantity) AS BIGINT) AS units,
           string_agg(l_partkey, ',' ORDER BY l_linenumber, l_partkey, l_quantity, l_extendedprice) AS parts
         FROM lineitem GROUP BY l_orderkey)
       SELECT o_orderkey AS order_id, 'sale' AS name, o_totalprice AS total_amount, 'USD' AS currency,
         coalesce(n, 0) AS product_count, coalesce(units, 0) AS units, coalesce(parts, '') AS product_ids
       FROM orders LEFT JOIN lines ON o_orderkey = l_orderkey""",
)
def sale_events(spark, folder):
    orders = inputs.load(spark, folder, "orders").select(
        F.col("o_orderkey").alias("order_id"), F.col("o_totalprice").alias("total_amount")
    )
    lines = inputs.load(spark, folder, "lineitem").select(
        F.col("l_orderkey").alias("order_id"),
        F.col("l_linenumber").alias("line_no"),
        F.col("l_partkey").alias("product_id"),
        F.col("l_quantity").alias("quantity"),
        F.col("l_extendedprice").alias("price"),
    )
    sales = computed_once(commerce.sale_events(orders, lines).select("order_id", "name", "properties"))
    p = F.col("properties")
    sold = sales.select(
        "order_id",
        "name",
        F.variant_get(p, "$.total_amount", "double").alias("total_amount"),
        F.variant_get(p, "$.currency", "string").alias("currency"),
        F.variant_get(p, "$.product_count", "bigint").alias("product_count"),
        F.variant_get(p, "$.products", "array<struct<product_id:string,quantity:bigint>>").alias("products"),
    )
    units = F.aggregate("products", F.lit(0).cast("bigint"), lambda a, x: a + x["quantity"])
    return sold.withColumns(
        {"units": units, "product_ids": F.array_join(F.transform("products", lambda x: x["product_id"]), ",")}
    ).drop("products")


@query(
    "page_view_events",
    """SELECT page_id, 'page_view' AS name,
         '{"lang":"' || regexp_extract(url, '^https?://[^/]+/([^/?#]+)', 1) || '","page_name":"' ||
         regexp_extract(url, '^https?://([^/]+)', 1) || '"}' AS properties FROM pages""",
)
def page_view_events(spark, folder):
    pages = inputs.load(spark, folder, "pages")
    host = F.regexp_extract("url", r"^https?://([^/]+)", 1)
    lang = F.regexp_extract("url", r"^https?://[^/]+/([^/?#]+)", 1)
    views = commerce.page_view_events(pages, host, F.to_variant_object(F.struct(lang.alias("lang"))))
    return views.select("page_id", "name", F.to_json("properties").alias("properties"))


@query(
    "signup_events",
    """SELECT event_id, 'user_registered' AS name, replace(props, ' ', '') AS properties
       FROM events WHERE event_type = 'signup'""",
)
def signup_events(spark, folder):
    e = inputs.load(spark, folder, "events").where("event_type = 'signup'")
    made = commerce.verbatim_events(e, "user_registered", F.parse_json("props"))
    return made.select("event_id", "name", F.to_json("properties").alias("properties"))


@query(
    "standard_event_names",
    """WITH n AS (SELECT CASE event_type WHEN 'signup' THEN 'user_registered' WHEN 'purchase' THEN 'sale'
            WHEN 'view' THEN 'page_view' ELSE event_type END AS name FROM events)
       SELECT name, name IN ('sale', 'user_registered', 'page_view') AS standard, count(*) AS events FROM n GROUP BY ALL""",
)
def standard_event_names(spark, folder):
    from tracewell.functions import text

    kind = F.col("event_type")
    name = (
        F.when(kind == "signup", "user_registered")
        .when(kind == "purchase", "sale")
        .when(kind == "view", "page_view")
        .otherwise(kind)
    )
    named = inputs.load(spark, folder, "events").select(name.alias("name"))
    return (
        named.groupBy("name").agg(F.count(F.lit(1)).alias("events")).withColumn("standard", text.standard_event(F.col("name")))
    )


@query(
    "error_users",
    """SELECT o_orderkey AS order_id,
         CASE WHEN o_orderkey % 4 = 0 THEN 'u' || o_orderkey WHEN c_custkey IS NOT NULL THEN CAST(c_custkey AS VARCHAR) END AS user_id,
         CASE WHEN o_orderkey % 4 = 0 THEN NULL ELSE lower(c_name) || '@example.com' END AS email
       FROM orders LEFT JOIN customer ON o_custkey = c_custkey AND c_mktsegment <> 'BUILDING'""",
)
def error_users(spark, folder):
    """Explicit ids win over the users table; the email travels only when opted in."""
    orders = inputs.load(spark, folder, "orders").select(
        F.col("o_orderkey").alias("order_id"),
        F.col("o_custkey").alias("resolver_key"),
        F.when(F.col("o_orderkey") % 4 == 0, F.concat(F.lit("u"), F.col("o_orderkey").cast("string"))).alias("user_id"),
    )
    users = (
        inputs.load(spark, folder, "customer")
        .where("c_mktsegment <> 'BUILDING'")
        .select(
            F.col("c_custkey").alias("key"),
            F.col("c_custkey").cast("string").alias("id"),
            F.concat(F.lower("c_name"), F.lit("@example.com")).alias("email"),
        )
    )
    with_users = shape.attach_user(orders, users, email_opt_in=True)
    return with_users.select("order_id", F.col("user.id").alias("user_id"), F.col("user.email").alias("email"))


@query(
    "gated_orders",
    """WITH flags AS (SELECT n_nationkey AS tenant, n_nationkey % 5 <> 0 AS enabled,
           CASE WHEN n_nationkey % 7 = 0 THEN '' ELSE 'key' END AS key,
           CASE WHEN n_nationkey % 3 = 0 THEN NULL ELSE n_nationkey % 3 = 1 END AS events,
           CASE WHEN n_nationkey % 2 = 0 THEN NULL ELSE TRUE END AS logs FROM nation),
         c AS (SELECT c_nationkey AS tenant FROM customer)
       SELECT 'events' AS feature, tenant, count(*) AS records FROM c JOIN flags USING (tenant)
       WHERE enabled AND key <> '' AND coalesce(events, TRUE) GROUP BY ALL
       UNION ALL
       SELECT 'logs', tenant, count(*) FROM c JOIN flags USING (tenant)
       WHERE enabled AND key <> '' AND coalesce(logs, FALSE) GROUP BY ALL""",
)
def gated_orders(spark, folder):
    """Records of tenants that have a feature on; unset switches take their defaults."""
    key = F.col("n_nationkey")
    flags = inputs.load(spark, folder, "nation").select(
        key.alias("tenant"),
        (key % 5 != 0).alias("enabled"),
        F.when(key % 7 == 0, "").otherwise("key").alias("key"),
        F.when(key % 3 != 0, key % 3 == 1).alias("events"),
        F.when(key % 2 != 0, True).alias("logs"),
    )
    records = inputs.load(spark, folder, "customer").select(F.col("c_nationkey").alias("tenant"))

    def passing(feature: str):
        gated = filters.gate(records, flags, feature)
        return gated.groupBy("tenant").agg(F.count(F.lit(1)).alias("records")).select(
            F.lit(feature).alias("feature"), "tenant", "records"
        )

    return passing("events").unionByName(passing("logs"))

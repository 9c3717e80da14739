"""Business events from order tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tracewell import contracts as C
from tracewell.functions import sizing
from tracewell.functions.let import let


def merge_properties(base: dict[str, Column], extra: Column | None = None, final: dict[str, Column] | None = None) -> Column:
    """VARIANT object of base properties, overridden by `extra` (VARIANT), then by `final`.

    A base value may be null and stays; a null or empty final value leaves its key alone.
    """
    stated = F.create_map(*[x for k, v in base.items() for x in (F.lit(k), v.cast("variant"))])
    none = F.create_map().cast("map<string,variant>")
    layers = [stated]
    if extra is not None:
        layers.append(F.coalesce(extra.try_cast("map<string,variant>"), none))
    for key, value in (final or {}).items():
        present = F.coalesce(value != "", F.lit(False))
        layers.append(F.when(present, F.create_map(F.lit(key), value.cast("variant"))).otherwise(none))
    if len(layers) == 1:
        return F.to_variant_object(stated)

    def over(below: Column, layer: Column) -> Column:
        kept = F.map_filter(below, lambda k, _: ~F.map_contains_key(layer, k))
        return F.when(F.size(layer) > 0, F.map_concat(kept, layer)).otherwise(below)

    merged = layers[0]
    for layer in layers[1:]:
        pair = F.struct(merged.alias("below"), layer.alias("layer"))
        merged = let(pair, lambda p: over(p["below"], p["layer"]))
    return F.to_variant_object(merged)


def cart_add_events(
    lines: DataFrame,
    products: DataFrame,
    extra: Column | None = None,
    category: Column | None = None,
) -> DataFrame:
    """`product_added_to_cart` events of `lines(product_id, quantity, …)` and
    `products(product_id, product_name, price, …)`.

    The price times the quantity is the total; extra properties override the base ones, a named
    category overrides everything, and an empty one leaves no key.
    """
    joined = lines.join(products, "product_id")
    base = {
        "product_id": F.col("product_id").cast("string"),
        "product_name": F.col("product_name"),
        "price": F.col("price").cast("double"),
        "quantity": F.col("quantity").cast("bigint"),
        "total_value": F.col("price").cast("double") * F.col("quantity"),
    }
    properties = merge_properties(base, extra, {"category": category} if category is not None else None)
    return joined.withColumns({"name": F.lit("product_added_to_cart"), "properties": properties})


def sale_events(
    orders: DataFrame,
    lines: DataFrame,
    currency: str = "USD",
    extra: Column | None = None,
    max_item: int = C.MAX_ITEM_BYTES,
) -> DataFrame:
    """One `sale` event per order of `orders(order_id, total_amount, …)`, its products from
    `lines(order_id, line_no, product_id, quantity, price)`, in line order.

    Orders without lines have an empty product list.  The JSON bytes of each order's list are
    summed up first, combined before they move.  Where the list alone exceeds `max_item`, the
    item budget would replace the properties whole, and that is what they are here: the lines of
    such an order are never gathered.  The lines are read twice for that, the first time as sizes.
    """
    product = F.struct(
        F.col("product_id").cast("string").alias("product_id"),
        F.col("quantity").cast("bigint").alias("quantity"),
        F.col("price").alias("price"),
    )
    # Brackets and commas: one byte more than there are products.
    size = sizing.json_text_bytes(F.to_json(product, {"ignoreNullFields": "false"})) + 1
    vast = lines.groupBy("order_id").agg((F.sum(size) + 1).alias("_bytes")).where(F.col("_bytes") > max_item).select("order_id")
    products = (
        lines.join(vast, "order_id", "left_anti")
        .groupBy("order_id")
        .agg(F.array_sort(F.collect_list(F.struct("line_no", "product_id", "quantity", "price"))).alias("_lines"))
    )
    none = F.array().cast(products.schema["_lines"].dataType)
    listed = F.transform(
        F.coalesce("_lines", none),
        lambda p: F.struct(
            p["product_id"].cast("string").alias("product_id"),
            p["quantity"].cast("bigint").alias("quantity"),
            p["price"].alias("price"),
        ),
    )
    base = {
        "order_id": F.col("order_id").cast("string"),
        "total_amount": F.col("total_amount").cast("double"),
        "currency": F.lit(currency),
        "products": F.to_variant_object(listed),
        "product_count": F.size(listed).cast("bigint"),
    }
    joined = orders.join(products, "order_id", "left").join(vast.withColumn("_vast", F.lit(True)), "order_id", "left")
    properties = F.when(F.col("_vast"), sizing.truncation_marker(C.FIELD_REASON)).otherwise(merge_properties(base, extra))
    return joined.withColumns({"name": F.lit("sale"), "properties": properties}).drop("_lines", "_vast")


def page_view_events(df: DataFrame, page_name: Column, extra: Column | None = None) -> DataFrame:
    return df.withColumns(
        {"name": F.lit("page_view"), "properties": merge_properties({"page_name": page_name}, extra)}
    )


def verbatim_events(df: DataFrame, name: str, properties: Column) -> DataFrame:
    """Events such as `user_registered` that have no base properties: theirs go as they are."""
    none = F.parse_json(F.lit("{}"))
    return df.withColumns({"name": F.lit(name), "properties": F.coalesce(properties, none)})

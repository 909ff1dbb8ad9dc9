"""Relational tables from a nested JSON price snapshot, and vehicle records.

The snapshot is parsed once to VARIANT; keys that are data (model and edition
names) are looked up, never inferred as columns.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import fixed


def snapshot(spark: SparkSession, path: str) -> DataFrame:
    """One row: v (VARIANT, null if the file is no JSON) and snapshot_datetime, the file's time in UTC."""
    raw = spark.read.text(path, wholetext=True).select("value", F.col("_metadata.file_modification_time").alias("t"))
    return raw.select(F.try_parse_json("value").alias("v"), F.concat(F.date_format(F.convert_timezone(None, F.lit("UTC"), F.col("t").cast("timestamp_ntz")), "yyyy-MM-dd HH:mm:ss"), F.lit(" UTC")).alias("snapshot_datetime"))


def _items(s: DataFrame, path: str) -> DataFrame:
    # elements in place: nothing is named in the session
    listed = F.try_variant_get("v", path, "array<variant>")
    return s.select("v", "snapshot_datetime", F.posexplode(listed).alias("pos", "x"))


def _get(c: str, key: str, kind: str = "string") -> Column:
    return F.try_variant_get(c, f"$.{key}", kind)


def catalog(s: DataFrame, manufacturer: str, cars_only: bool = False) -> DataFrame:
    """car_id, car_name, default_product_id, vehicle_type, manufacturer, snapshot_datetime."""
    kinds = [("cars", "Electric Car")] + [("bikes", "Electric Bike")] * (not cars_only)
    out = None
    for name, label in kinds:
        empty = lambda c: F.coalesce(c, F.lit(""))
        part = _items(s, f"$.vehicles.{name}.models").select(empty(_get("x", "id")).alias("car_id"), empty(_get("x", "name")).alias("car_name"), empty(_get("x", "defaultProductID")).alias("default_product_id"), F.lit(label).alias("vehicle_type"), F.lit(manufacturer).alias("manufacturer"), "snapshot_datetime")
        out = part if out is None else out.unionByName(part)
    return out


def price(value: Column, base: Column) -> Column:
    """First of two prices that is neither missing nor zero, as a whole number; 0 if unreadable."""
    first = F.coalesce(F.when(~value.isin("", "0", "0.0"), value), F.when(~base.isin("", "0", "0.0"), base), F.lit("0"))
    return F.coalesce(F.try_to_number(first, F.lit("999999999999999999")).cast("double"), first.try_cast("double"), F.lit(0.0)).cast("long")


def deposit(price_vnd: Column) -> Column:
    return F.when(price_vnd > 1_000_000_000, F.lit(50_000_000)).otherwise(F.lit(15_000_000)).cast("long")


def battery_option(sold: Column) -> Column:
    return F.when(F.coalesce(sold, F.lit(False)), F.lit("Kèm Pin (Mua Pin)")).otherwise(F.lit("Thuê Pin"))


def trims(s: DataFrame, names: DataFrame, cars_only: bool = False, prefix: str = "Products-Car-") -> DataFrame:
    """Prices by trim. ``names``: (car_id, car_name); a model without a name gets its id less ``prefix``."""
    c = _items(s, "$.objects.costs").select("pos", "snapshot_datetime", F.coalesce(_get("x", "model"), F.lit("")).alias("car_id"), F.coalesce(_get("x", "ID"), F.lit("")).alias("trim_name"), price(_get("x", "price"), _get("x", "basePrice")).alias("price_vat_vnd"), _get("x", "isBatterySales", "boolean").alias("sold"), _get("x", "lastModified").alias("m"), _get("x", "UUID").alias("uuid"), F.coalesce(_get("x", "edition"), F.lit("")).alias("product_code"))
    if cars_only:
        c = c.filter(F.contains("car_id", F.lit("Car")))
    named = c.join(names.groupBy("car_id").agg(F.max("car_name").alias("car_name")), "car_id", "left")
    return named.select(
        F.concat_ws("_", "car_id", F.coalesce("uuid", "trim_name")).alias("trim_id"), "car_id", F.coalesce("car_name", F.replace("car_id", F.lit(prefix), F.lit(""))).alias("car_name"), "trim_name",
        battery_option(F.col("sold")).alias("battery_option"), "price_vat_vnd", deposit(F.col("price_vat_vnd")).alias("deposit_amount_vnd"), "product_code",
        F.coalesce(F.nullif("m", F.lit("")), "snapshot_datetime").alias("price_last_updated"), "snapshot_datetime",
    )


def provinces(s: DataFrame) -> DataFrame:
    return _items(s, "$.objects.provinces").select(F.coalesce(_get("x", "id"), F.lit("")).alias("province_id"), F.coalesce(_get("x", "name"), F.lit("")).alias("province_name"), F.coalesce(_get("x", "region"), F.lit("2")).alias("region_code"), "snapshot_datetime")


def fee_rules(s: DataFrame) -> DataFrame:
    rules = s.sparkSession.createDataFrame(fixed.FEE_RULES, "fee_code string, fee_name string, fixed_amount_vnd long, description string")
    return rules.crossJoin(s.select("snapshot_datetime")).select("fee_code", "fee_name", F.lit("0.0").alias("rate_percent"), "fixed_amount_vnd", "description", "snapshot_datetime")


def cost_matrix(priced: DataFrame) -> DataFrame:
    """Priced trims (car_id, car_name, trim_name, battery_option, price_vat_vnd,
    snapshot_datetime) by province, with the parts and the sum of the on-road cost.
    The six provinces are an inline array: no join."""
    where = F.array(*(F.struct(F.lit(n).alias("name"), F.lit(fee).cast("long").alias("plate")) for _, n, fee in fixed.KEY_PROVINCES))
    m = priced.filter("price_vat_vnd > 0").withColumn("p", F.explode(where))
    cost = lambda n: F.lit(n).cast("long")
    total = F.col("price_vat_vnd") + F.col("p.plate") + fixed.INSPECTION_FEE + fixed.ROAD_FEE + fixed.INSURANCE_FEE
    return m.select(
        "car_id", "car_name", "trim_name", "battery_option", F.col("p.name").alias("province_name"), F.col("price_vat_vnd").alias("list_price_vnd"), cost(0).alias("registration_fee_vnd"), F.col("p.plate").alias("license_plate_fee_vnd"),
        cost(fixed.INSPECTION_FEE).alias("inspection_fee_vnd"), cost(fixed.ROAD_FEE).alias("road_fee_vnd"), cost(fixed.INSURANCE_FEE).alias("mandatory_insurance_vnd"), total.alias("total_rolling_cost_vnd"), "snapshot_datetime",
    )


def tables(s: DataFrame, manufacturer: str, cars_only: bool = False) -> dict[str, DataFrame]:
    cars = catalog(s, manufacturer, cars_only)
    t = trims(s, cars, cars_only)
    return {"cars_catalog": cars, "trims_pricing": t, "provinces": provinces(s), "fee_rules": fee_rules(s), "rolling_cost_matrix": cost_matrix(t)}


def vehicles(s: DataFrame, brand: str = "", placed: bool = False) -> DataFrame:
    """Vehicle records with trims, plate fees by zone and a Markdown description; ``placed``: with their ``place``, cars first."""
    out = None
    for name, kind, label, key, plate in (("cars", "car", "Ô tô điện", "carLicenseFee", 20_000_000), ("bikes", "bike", "Xe máy điện", "bikeLicenseFeeMedium", 2_000_000)):
        m = _items(s, f"$.vehicles.{name}.models").select(F.lit(kind).alias("vehicle_type"), "pos", F.coalesce(_get("x", "id"), F.lit("")).alias("vehicle_id"), F.coalesce(_get("x", "name"), F.lit("")).alias("model_name"), F.try_variant_get("v", f"$.vehicles.{name}", "map<string,variant>").alias("d"), F.try_variant_get("v", "$.objects.fees", "array<variant>").alias("fees"))
        m = m.withColumn("d", F.try_variant_get(F.element_at("d", F.col("vehicle_id")), "$", "map<string,variant>"))
        m = m.withColumn("eds", F.coalesce(F.try_variant_get(F.element_at("d", F.lit("listEdition")), "$", "array<string>"), F.array().cast("array<string>")))
        num = lambda x, k: F.try_variant_get(x, f"$.{k}", "bigint")

        def trim(e: Column, m=m) -> Column:
            x = F.element_at(F.col("d"), e)
            value = F.coalesce(num(x, "priceValue"), F.lit(0))
            return F.struct(e.alias("trim_code"), F.coalesce(F.try_variant_get(x, "$.label", "string"), e).alias("label"), F.coalesce(F.try_variant_get(x, "$.price", "string"), F.lit("0")).alias("price_vnd"), value.cast("long").alias("price_value"), F.coalesce(num(x, "priceWithBattery"), value).cast("long").alias("price_with_battery"))

        zone = lambda f: F.coalesce(F.try_variant_get(f, "$.zone", "string"), F.lit("KV1"))
        fees = F.coalesce("fees", F.array().cast("array<variant>"))
        last = F.filter(fees, lambda f, i: ~F.exists(F.slice(fees, i + 2, F.greatest(F.size(fees), F.lit(1))), lambda g: zone(g) == zone(f)))
        costs = F.map_from_entries(F.transform(last, lambda f: F.struct(zone(f), F.struct(F.coalesce(num(f, key), F.lit(plate)).cast("long").alias("license_plate_fee"), F.when(zone(f) == "KV1", "Khu vực 1 (Hà Nội, TP.HCM)").otherwise("Các tỉnh thành khác").alias("description")))))
        m = m.withColumn("trims", F.transform("eds", trim)).withColumn("rolling_costs", costs)
        dong = lambda n: F.concat(F.format_number(n, 0), F.lit(" đ"))
        row = lambda t: F.concat(F.lit("| "), t["label"], F.lit(" | "), F.when(t["price_vnd"] != "", t["price_vnd"]).otherwise(dong(t["price_value"])), F.lit(" | "), F.when(t["price_with_battery"] != 0, dong(t["price_with_battery"])).otherwise(F.lit("Theo chính sách")), F.lit(" |"))
        listed = F.when(F.size("trims") > 0, F.concat(F.lit("| Phiên bản | Giá thuê pin (VNĐ) | Giá kèm pin (VNĐ) |\n|---|---|---|\n"), F.array_join(F.transform("trims", row), "\n"))).otherwise(F.lit("- Liên hệ đại lý hoặc xem thông báo giá mới nhất."))
        named = F.concat_ws(" ", F.lit(label), *([F.lit(brand)] if brand else []), "model_name")
        doc = F.concat_ws(
            "\n", F.concat(F.lit("## "), named), F.lit(f"- **Loại phương tiện**: {label}"), F.concat(F.lit("- **Mã định danh**: `"), "vehicle_id", F.lit("`")), F.lit(""), F.lit("### Các phiên bản và giá niêm yết:"), listed, F.lit(""),
            F.lit("### Lệ phí đăng ký và biển số tham khảo:"), F.lit("- Khu vực 1 (Hà Nội, TP.HCM): 20.000.000 VNĐ (ô tô) / 1.000.000 - 4.000.000 VNĐ (xe máy)"), F.lit("- Khu vực 2, 3: 1.000.000 VNĐ (ô tô) / 50.000 - 150.000 VNĐ (xe máy)"),
            F.lit("- Ô tô điện chạy pin được miễn 100% lệ phí trước bạ theo quy định của Chính phủ."),
        )
        place = [F.struct((F.col("vehicle_type") != "car").alias("kind"), "pos").alias("place")] if placed else []
        part = m.select("vehicle_id", "model_name", "vehicle_type", "trims", "rolling_costs", doc.alias("searchable_markdown"), *place)
        out = part if out is None else out.unionByName(part)
    return out

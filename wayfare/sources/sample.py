"""The platform's raw inputs derived from the order, part and event tables given for testing."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from wayfare.functions.lenient import settle

ORDERS_INGESTED = "2024-03-01 00:00:00"
LATE_COPY = "2024-02-15 00:00:00"
EVENTS_TOPIC = "user.events"


def table(spark: SparkSession, root: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{root.rstrip('/')}/{name}.parquet")


def ntz(text: str) -> Column:
    return F.lit(text).cast("timestamp_ntz")


def _transport(number: Column) -> Column:
    rest = number % 4
    return F.when(rest == 0, "bus").when(rest == 1, "train").when(rest == 2, "ferry").otherwise("flight")


def _route(number: Column) -> Column:
    return F.concat(F.lit("R"), (number % 25).cast("string"))


def raw_bookings(spark: SparkSession, root: str) -> DataFrame:
    """Line items as versions of one booking; key 0 and negative prices occur."""
    items, orders = table(spark, root, "lineitem"), table(spark, root, "orders")
    flag = F.col("l_returnflag")
    price = F.col("l_extendedprice")
    return items.join(orders, items.l_orderkey == orders.o_orderkey).select(
        F.col("l_orderkey").alias("booking_id"),
        F.col("l_suppkey").alias("user_id"),
        _route(F.col("l_partkey")).alias("route"),
        _transport(F.col("l_linenumber")).alias("transport_type"),
        F.when(flag == "A", "paid").when(flag == "N", "created").otherwise("cancelled").alias("status"),
        F.when((F.col("l_linenumber") == 7) & (F.col("l_discount") >= 0.1), -price)
        .otherwise(price)
        .alias("price"),
        F.lit("USD").alias("currency"),
        F.col("o_orderdate").alias("created_at"),
        F.col("l_shipdate").alias("loaded_at"),
        F.col("l_linenumber").cast("string").alias("run_id"),
    )


def booking_records(spark: SparkSession, root: str) -> DataFrame:
    """Bookings as the interface delivers them: JSON text, creation time written in four ways."""
    rows = raw_bookings(spark, root)
    form = F.col("booking_id") % 4
    written = (
        F.when(form == 0, F.date_format("created_at", "yyyy-MM-dd'T'HH:mm:ss.SSS'Z'"))
        .when(form == 1, F.date_format("created_at", "yyyy-MM-dd HH:mm:ss'+02:00'"))
        .when(form == 2, F.date_format("created_at", "yyyy-MM-dd'T'HH:mm:ss'Z'"))
        .otherwise(F.date_format("created_at", "yyyy-MM-dd HH:mm:ss"))
    )
    return rows.select(
        F.to_json(
            F.struct(
                "booking_id", "user_id", "route", "transport_type", "status", "price", "currency",
                written.alias("created_at"),
            )
        ).alias("value"),
        "loaded_at",
        "run_id",
    )


def raw_ads(spark: SparkSession, root: str, platform: str) -> DataFrame:
    """Parts as campaigns, two versions each: even keys on one platform, odd keys on the other."""
    odd = {"google_ads": 0, "meta_ads": 1}[platform]
    v = F.col("v")
    return (
        table(spark, root, "part")
        .where(F.col("p_partkey") % 2 == odd)
        .withColumn("v", F.explode(F.array(F.lit(1), F.lit(2))))
        .select(
            F.col("p_partkey").alias("campaign_id"),
            F.col("p_name").alias("campaign_name"),
            ((F.col("p_size") - 1) * v).cast("bigint").alias("clicks"),
            ((F.col("p_partkey") % 7) * 100 * v).cast("bigint").alias("impressions"),
            F.when(F.col("p_partkey") % 11 == 0, F.lit(0.0)).otherwise(F.col("p_retailprice") * v).alias("spend"),
            F.lit(platform).alias("platform"),
            F.when(v == 1, ntz("2024-01-02 00:00:00")).otherwise(ntz("2024-01-03 00:00:00")).alias("loaded_at"),
        )
    )


def ad_responses(spark: SparkSession, root: str, platform: str) -> DataFrame:
    """Answers of the advertising interface: the campaigns of one load in pages, a JSON array in ``value`` each."""
    page = F.floor(F.col("campaign_id") / 100)
    record = F.struct("campaign_id", "platform", "campaign_name", "impressions", "clicks", "spend")
    calls = raw_ads(spark, root, platform).groupBy("loaded_at", page.alias("page"))
    return calls.agg(F.to_json(F.sort_array(F.collect_list(record))).alias("value")).select("value")


def ad_messages(spark: SparkSession, root: str) -> DataFrame:
    """Campaign records as JSON text; some break a rule, some use the lenient forms."""
    rows = raw_ads(spark, root, "google_ads").unionByName(raw_ads(spark, root, "meta_ads"))
    key = F.col("campaign_id")

    def text(*parts) -> Column:
        return F.concat(*[F.lit(p) if isinstance(p, str) else p.cast("string") for p in parts])

    value = text(
        '{"platform":"', F.when(key % 13 == 0, "other_ads").otherwise(F.col("platform")),
        '","campaign_id":', F.when(key % 31 == 0, text('"', key, '.0"')).otherwise(key.cast("string")),
        ',"campaign_name":"', F.when(key % 17 == 0, "  ").otherwise(text(" ", F.col("campaign_name"), " ")), '"',
        F.when(key % 23 == 0, "").otherwise(text(',"impressions":', F.col("impressions"))),
        ',"clicks":', F.when(key % 19 == 0, text(-F.col("clicks") - 1)).otherwise(text(F.col("clicks"))),
        ',"spend":', F.when(key % 29 == 0, text('"', F.col("spend"), '"')).otherwise(text(F.col("spend"))),
        ',"note":"extra"}',
    )
    return rows.select(value.alias("value"), "loaded_at")


EVENT_TYPE_OF = (("view", "search_performed"), ("click", "booking_started"), ("purchase", "payment_completed"))


def _event_type(other: Column | None = None) -> Column:
    given = F.col("event_type")
    mapped = F
    for source, target in EVENT_TYPE_OF:
        mapped = mapped.when(given == source, target)
    return mapped.otherwise(other) if other is not None else mapped


def raw_user_events(spark: SparkSession, root: str) -> DataFrame:
    """Events of the three valid types; every tenth is ingested again later as another type."""
    events = table(spark, root, "events").where(F.col("event_type").isin("view", "click", "purchase"))

    def copy(rows: DataFrame, event_type: Column, ingested_at: Column) -> DataFrame:
        return rows.select(
            F.col("event_id").cast("string").alias("event_id"),
            "user_id",
            event_type.alias("event_type"),
            F.col("ts").alias("event_time"),
            F.concat(F.lit('{"route":"'), _route(F.col("user_id")), F.lit('"}')).alias("properties"),
            F.lit(EVENTS_TOPIC).alias("source_topic"),
            ingested_at.alias("ingested_at"),
        )

    again = events.where(F.col("event_id") % 10 == 0)
    return copy(events, _event_type(), F.col("ts")).unionByName(
        copy(again, F.lit("booking_started"), ntz(LATE_COPY))
    )


def incoming_events(spark: SparkSession, root: str) -> DataFrame:
    """Event messages as JSON text with their arrival time ``ts``: good, lenient and broken ones."""
    key, user = F.col("event_id"), F.col("user_id").cast("string")
    number = F.concat(F.lit("00000000-0000-4000-8000-"), F.lpad(key.cast("string"), 12, "0"))
    is_error, is_signup = F.col("event_type") == "error", F.col("event_type") == "signup"
    event_id = F.when(is_error & (key % 3 == 0), F.concat(F.lit("evt-"), key.cast("string"))).otherwise(number)
    user_id = F.when(key % 7 == 0, F.concat(F.lit('" '), user, F.lit('.0"'))).otherwise(user)
    event_type = F.when(key % 41 == 0, "page_scrolled").when(is_signup, "payment_completed").otherwise(
        _event_type(F.lit("search_performed"))
    )
    utc = F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'")
    shifted = F.date_format(F.col("ts") - F.expr("INTERVAL 5 HOURS"), "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'-05:00'")
    event_time = F.when(is_error, "not a time").when(key % 5 == 0, shifted).otherwise(utc)
    route = _route(F.col("user_id"))
    properties = (
        F.when(is_signup, F.lit('"{broken"'))
        .when(key % 50 == 0, F.lit('{"page":1}'))
        .when(key % 3 == 1, F.concat(F.lit('"{\\"route\\":\\"'), route, F.lit('\\"}"')))
        .otherwise(F.concat(F.lit('{"route":"'), route, F.lit('","extra":1}')))
    )
    value = F.concat(
        F.lit('{"event_id":"'), event_id, F.lit('","user_id":'), user_id,
        F.lit(',"event_type":"'), event_type, F.lit('","event_time":"'), event_time,
        F.lit('","properties":'), properties, F.lit(',"device_type":"web"}'),
    )
    return table(spark, root, "events").select(value.alias("value"), "ts")


def order_changes(spark: SparkSession, root: str) -> DataFrame:
    """Order changes: snapshot or create, update on every third order, delete on every tenth."""
    key, v = F.col("o_orderkey"), F.col("v")
    state = F.col("o_orderstatus")
    return (
        table(spark, root, "orders")
        .withColumn("v", F.explode(F.array(F.lit(1), F.lit(2), F.lit(3))))
        .where((v == 1) | ((v == 2) & (key % 3 == 0)) | ((v == 3) & (key % 10 == 0)))
        .select(
            key.alias("order_id"),
            F.col("o_custkey").alias("user_id"),
            _route(key).alias("route"),
            _transport(key).alias("transport_type"),
            F.when((v == 2) & (state == "P"), "cancelled")
            .when(state == "F", "completed")
            .when(state == "O", "paid")
            .otherwise("created")
            .alias("status"),
            F.col("o_totalprice").alias("price"),
            F.lit("USD").alias("currency"),
            F.when(key % 17 != 0, F.col("o_custkey")).alias("campaign_id"),
            F.col("o_orderdate").alias("created_at"),
            F.when(v == 1, F.when(key % 2 == 0, "r").otherwise("c")).when(v == 2, "u").otherwise("d").alias("op"),
            (key * 10 + v).alias("source_ts_ms"),
        )
    )


def _image() -> Column:
    """The order as JSON text: times as microseconds for even keys, as ISO text for odd ones."""
    plain = ("order_id", "user_id", "route", "transport_type", "status", "price", "currency", "campaign_id")

    def with_time(time: Column) -> Column:
        return F.to_json(F.struct(*plain, time.alias("created_at"), time.alias("updated_at")))

    return F.when(
        F.col("order_id") % 2 == 0, with_time(F.unix_micros(F.col("created_at").cast("timestamp")))
    ).otherwise(with_time(F.date_format("created_at", "yyyy-MM-dd'T'HH:mm:ss'Z'")))


def raw_cdc_orders(spark: SparkSession, root: str) -> DataFrame:
    """The order changes as raw change rows with JSON images."""
    gone, image = F.col("op") == "d", F.col("image")
    return settle(order_changes(spark, root), image=_image()).select(
        "order_id",
        "op",
        F.when(F.col("op").isin("u", "d"), image).otherwise("null").alias("before_record"),
        F.when(gone, "null").otherwise(image).alias("after_record"),
        F.lit("orders").alias("source_topic"),
        "source_ts_ms",
        F.lit(ORDERS_INGESTED).cast("timestamp").alias("ingested_at"),
    )


def change_messages(spark: SparkSession, root: str) -> DataFrame:
    """The order changes as envelopes in JSON text, with a cut-off message now and then."""
    rows = raw_cdc_orders(spark, root)
    envelope = F.concat(
        F.lit('{"op":"'), F.col("op"), F.lit('","before":'), F.col("before_record"), F.lit(',"after":'),
        F.col("after_record"), F.lit(',"ts_ms":'), F.col("source_ts_ms").cast("string"), F.lit("}"),
    )
    torn = F.concat(F.lit('{"op":"c","after":{"order_id":'), F.col("order_id").cast("string"))
    texts = F.when(F.col("order_id") % 97 == 0, F.array(envelope, torn)).otherwise(F.array(envelope))
    return rows.select(F.explode(texts).alias("value"))


def outcome_events(spark: SparkSession, root: str) -> DataFrame:
    """Processing outcomes over time."""
    given = F.col("event_type")
    outcome = F.when(given == "signup", "dlq").when(given == "error", "failed").otherwise("processed")
    return table(spark, root, "events").select("event_id", "ts", outcome.alias("outcome"))


def consumer_offsets(spark: SparkSession, root: str) -> DataFrame:
    """End and committed offsets per consumer group and partition."""
    return (
        table(spark, root, "events")
        .groupBy(F.col("event_type").alias("consumer_group"), (F.col("user_id") % 4).alias("partition_id"))
        .agg(
            F.count("*").alias("end_offset"),
            F.count_if(F.col("event_id") % 20 != 0).alias("committed_offset"),
        )
    )


def sampled_offsets(spark: SparkSession, root: str) -> DataFrame:
    """The same offsets sampled in four consecutive minutes, the consumers catching up a little."""
    sample = F.explode(F.sequence(F.lit(0), F.lit(3))).alias("sample")
    minute = ntz("2024-02-01 00:00:00") + F.make_dt_interval(F.lit(0), F.lit(0), F.col("sample"))
    caught_up = F.least(F.col("end_offset"), F.col("committed_offset") + 5 * F.col("sample"))
    return consumer_offsets(spark, root).select("*", sample).select(
        "consumer_group",
        "partition_id",
        minute.alias("sampled_at"),
        "end_offset",
        caught_up.alias("committed_offset"),
    )

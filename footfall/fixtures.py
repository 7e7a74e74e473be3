"""Counter tables derived from the ``events`` and order tables (see FIXTURES.md).

Each derived table is written once per session and folder to the shared scratch
folder and read back from there, so queries scan parquet as they would a real log.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from footfall import schemas
from footfall.functions.times import floor_to, ts
from footfall.operators.latest import BY_ARRIVAL, order_of
from footfall.operators.slices import slice_unit
from footfall.session import configure, workspace
from footfall.sources.tables import read_log, with_month

# Fixed values of the derivation.
ARCHIVE_BEFORE = "2024-01-10"
RETENTION_CUTOFF = "2024-01-15"
REGISTERED_BEFORE = "2024-01-02"
REBOOT_ABOVE = 60
RESET_BELOW = 14
ARCHIVED_BELOW = 10
MESSAGE_SIZE = 5

_paths: dict[tuple[str, str, str], str] = {}


def _stored(spark: SparkSession, sf_dir: str, name: str, build) -> str:
    key = (spark.sparkContext.applicationId, sf_dir, name)
    if key not in _paths:
        path = workspace(spark, f"fixture-{name}")
        build().write.parquet(path)
        _paths[key] = path
    return _paths[key]


def _stored_log(spark: SparkSession, sf_dir: str, name: str, build) -> DataFrame:
    key = (spark.sparkContext.applicationId, sf_dir, name)
    if key not in _paths:
        path = workspace(spark, f"fixture-{name}")
        with_month(build()).write.partitionBy("event_month").parquet(path)
        _paths[key] = path
    return read_log(spark, _paths[key])


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    configure(spark)
    table = spark.read.parquet(f"{sf_dir}/events.parquet")
    return table.withColumn("k", F.regexp_extract("props", "[0-9]+", 0).cast("int"))


def running_counts(rows: DataFrame, unit: str) -> DataFrame:
    """Running in and out sums of each user since its last reboot.

    With S the user's running sum, the count is S minus S at the last reboot, and
    that is the highest S at any reboot so far, as S never falls. Both are built
    per time slice and carried from slice to slice, so a very active user is
    spread over tasks.
    """
    counters = ("in", "out")
    rows = rows.withColumn("slice", floor_to(F.col("ts"), unit))
    here = Window.partitionBy("user_id", "slice").orderBy("ts", "event_id")
    here = here.rowsBetween(Window.unboundedPreceding, 0)
    local = rows.withColumns({f"sum_{c}": F.sum(f"add_{c}").over(here) for c in counters})
    local = local.withColumns(
        {f"boot_{c}": F.max(F.when(F.col("reboot"), F.col(f"sum_{c}"))).over(here) for c in counters}
    )
    slices = local.groupBy("user_id", "slice").agg(
        *[F.max(f"{part}_{c}").alias(f"last_{part}_{c}") for c in counters for part in ("sum", "boot")]
    )
    earlier = Window.partitionBy("user_id").orderBy("slice")
    earlier = earlier.rowsBetween(Window.unboundedPreceding, -1)
    slices = slices.withColumns(
        {f"base_{c}": F.coalesce(F.sum(f"last_sum_{c}").over(earlier), F.lit(0)) for c in counters}
    )
    slices = slices.withColumns(
        {
            f"floor_{c}": F.coalesce(
                F.max(F.col(f"base_{c}") + F.col(f"last_boot_{c}")).over(earlier), F.lit(0)
            )
            for c in counters
        }
    ).select("user_id", "slice", *[f"{part}_{c}" for c in counters for part in ("base", "floor")])
    joined = local.join(slices, ["user_id", "slice"])

    def since_reboot(c: str) -> Column:
        base = F.col(f"base_{c}")
        return base + F.col(f"sum_{c}") - F.greatest(f"floor_{c}", base + F.col(f"boot_{c}"))

    return joined.withColumns({f"{c}_count": since_reboot(c).cast("int") for c in counters})


def counted_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events with their counters; the base of log and resets."""

    def build() -> DataFrame:
        source = events(spark, sf_dir)
        amount = F.floor("value")
        kind = F.col("event_type")
        rows = source.select(
            "event_id", "ts", "user_id", "event_type", "k",
            F.when(kind.isin("click", "signup"), amount).otherwise(0).alias("add_in"),
            F.when(kind.isin("view", "signup"), amount).otherwise(0).alias("add_out"),
            ((kind == "error") & (F.col("value") > REBOOT_ABOVE)).alias("reboot"),
        )
        unit = slice_unit(rows, "user_id", "ts") or "month"
        return running_counts(rows, unit).select(
            "event_id", "ts", "user_id", "event_type", "k", "in_count", "out_count"
        )

    return spark.read.parquet(_stored(spark, sf_dir, "counted", build))


def _log_columns() -> list[Column]:
    user, moment = F.col("user_id"), F.col("ts")
    moved = F.when((user % 7 == 0) & (moment >= ts("2024-01-20")), 1).otherwise(0)
    place = F.concat(F.lit("B"), ((user + moved) % 10).cast("string"))
    floor = F.concat(F.lit("F"), (user % 3).cast("string"))
    return [
        F.col("event_id").alias("id"),
        F.concat(F.lit("dev-"), user.cast("string")).alias("device_id"),
        F.when(user % 41 != 0, place).alias("location"),
        F.when(user % 5 != 0, floor).alias("sublocation"),
        "in_count",
        "out_count",
        (100 + user % 50).cast("int").alias("capacity"),
        moment.alias("event_time"),
        (moment + F.make_dt_interval(F.lit(0), F.lit(0), F.col("k") * 10)).alias("created_at"),
    ]


def counter_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All readings, live and archived."""
    configure(spark)

    def build() -> DataFrame:
        return counted_events(spark, sf_dir).select(*_log_columns())

    return _stored_log(spark, sf_dir, "log", build)


def _to_months(moment: Column) -> Column:
    days = (
        F.when(moment < ts("2024-01-11"), 0).when(moment < ts("2024-01-21"), 40).otherwise(80)
    )
    return moment + F.make_dt_interval(days)


def counter_log_months(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The log spread over three months."""

    def build() -> DataFrame:
        log = counter_log(spark, sf_dir).drop("event_month")
        return log.withColumn("event_time", _to_months(F.col("event_time")))

    return _stored_log(spark, sf_dir, "log-months", build)


def split_at(log: DataFrame, moment: str) -> tuple[DataFrame, DataFrame]:
    """Live part (from ``moment``) and archived part."""
    old = F.col("event_time") < ts(moment)
    return log.filter(~old), log.filter(old)


def counter_resets(spark: SparkSession, sf_dir: str) -> DataFrame:
    configure(spark)

    def build() -> DataFrame:
        purchases = counted_events(spark, sf_dir).filter(
            (F.col("event_type") == "purchase") & (F.col("k") < RESET_BELOW)
        )
        return purchases.select(
            F.concat(F.lit("dev-"), F.col("user_id").cast("string")).alias("device_id"),
            F.col("ts").alias("reset_time"),
            F.col("in_count").alias("reset_in_count"),
            F.col("out_count").alias("reset_out_count"),
        )

    return spark.read.schema(schemas.RESETS).parquet(_stored(spark, sf_dir, "resets", build))


def counter_resets_months(spark: SparkSession, sf_dir: str) -> DataFrame:
    resets = counter_resets(spark, sf_dir)
    return resets.withColumn("reset_time", _to_months(F.col("reset_time")))


def retention_archive(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Old rows that an interrupted run already archived; the live log still has them."""
    done = counted_events(spark, sf_dir).filter(
        (F.col("k") < ARCHIVED_BELOW) & (F.col("ts") < ts(RETENTION_CUTOFF))
    )
    return with_month(done.select(*_log_columns()))


def _ip(user: Column) -> Column:
    high = F.floor(user / 256) % 256
    return F.concat(F.lit("10.0."), high.cast("string"), F.lit("."), (user % 256).cast("string"))


def sensors(spark: SparkSession, sf_dir: str) -> DataFrame:
    configure(spark)

    def build() -> DataFrame:
        user = F.substring_index("device_id", "-", -1).cast("int")
        log = counter_log(spark, sf_dir)
        first = F.min_by(F.struct("location"), order_of(log, BY_ARRIVAL)).alias("first")
        devices = (
            log.groupBy("device_id")
            .agg(first, F.max("event_time").alias("seen"))
        )
        status = F.when(user % 3 == 0, "Online").when(user % 3 == 1, "Idle").otherwise("Offline")
        address = F.when(user % 11 == 0, F.lit(None)).when(user % 19 == 0, "  ").otherwise(_ip(user))
        return devices.select(
            user.alias("id"),
            F.col("device_id").alias("device"),
            "first.location",
            address.alias("ip_address"),
            (user % 3 == 0).alias("is_online"),
            F.when(user % 13 != 0, F.col("seen")).alias("last_seen"),
            F.when(user % 17 != 0, status).alias("status"),
        )

    return spark.read.schema(schemas.SENSORS).parquet(_stored(spark, sf_dir, "sensors", build))


def early_sensors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A registry that knows only the devices that reported on the first day."""
    early = (
        counter_log(spark, sf_dir)
        .filter(F.col("event_time") < ts(REGISTERED_BEFORE))
        .select(F.col("device_id").alias("device"))
        .distinct()
    )
    return sensors(spark, sf_dir).join(early, "device", "left_semi").select(
        *schemas.SENSORS.fieldNames()
    )


def probes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sensors(spark, sf_dir).select("device", (F.col("id") % 3 == 0).alias("reachable"))


def _quoted(text: Column) -> Column:
    return F.coalesce(F.concat(F.lit('"'), text, F.lit('"')), F.lit("null"))


def _message_element() -> Column:
    """JSON of one reading's device; some values of ``k`` stand for a fault."""
    k, user = F.col("k"), F.substring_index("device_id", "-", -1).cast("int")
    number = F.col("in_count").cast("string")
    moment = F.translate(F.col("event_time").cast("string"), " ", "T")
    total_in = (
        F.when(k == 1, F.concat(F.lit('"Total_IN":"'), number, F.lit('",')))
        .when(k == 6, F.lit(""))
        .when(k == 13, F.concat(F.lit('"total_in":'), number, F.lit(",")))
        .otherwise(F.concat(F.lit('"Total_IN":'), number, F.lit(",")))
    )
    out = F.col("out_count").cast("string")
    total_out = F.when(k == 10, F.concat(out, F.lit(".5"))).when(k == 17, "null").otherwise(out)
    capacity = F.when(k == 12, "3000000000").otherwise(F.col("capacity").cast("string"))
    ip = F.when(k == 7, F.lit("")).otherwise(F.concat(F.lit('"ipaddr":'), _quoted(_ip(user)), F.lit(",")))
    when_text = (
        F.when(k == 2, '"not-a-time"')
        .when(k == 14, '""')
        .when(k == 15, "null")
        .when(k == 16, F.concat(F.lit('"'), F.substring(moment, 1, 19), F.lit('Z"')))
        .otherwise(_quoted(moment))
    )
    reading = F.concat(
        F.lit('{"Location":'), _quoted(F.col("location")),
        F.lit(',"SubLocation":'), F.when(k == 9, "null").otherwise(_quoted(F.col("sublocation"))),
        F.lit(","), total_in,
        F.lit('"Total_Out":'), total_out,
        F.lit(',"Capacity":'), capacity,
        F.lit(","), ip,
        F.lit('"TimeStamp":'), when_text, F.lit("}"),
    )
    data = (
        F.when(k == 4, F.lit("null"))
        .when(k == 5, F.concat(F.lit("[null,"), reading, F.lit("]")))
        .when(k == 8, F.concat(F.lit("["), reading, F.lit(","), reading, F.lit("]")))
        .when(k == 18, F.lit("[]"))
        .otherwise(F.concat(F.lit("["), reading, F.lit("]")))
    )
    device = F.when(k == 3, F.lit("null")).otherwise(_quoted(F.col("device_id")))
    return F.concat(
        F.when(k == 11, F.lit("null,")).otherwise(F.lit("")),
        F.lit('{"Device":'), device, F.lit(',"Data":'), data, F.lit("}"),
    )


def raw_payloads(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Messages of five readings each: ``arrival, value`` and the ``week`` (0 to 3)
    of the message's first reading, by which streams receive them."""
    configure(spark)

    def build() -> DataFrame:
        moment = F.col("event_time")
        # The events that the log is made of still have ``k``, so nothing is joined. Dealt by message
        # before they are made, the readings need no lists of their own for each task they come from.
        readings = (
            counted_events(spark, sf_dir)
            .filter("event_id is not null")
            .select(*_log_columns(), "k")
            .repartition(F.floor(F.col("id") / MESSAGE_SIZE))
            .select(
                F.floor(F.col("id") / MESSAGE_SIZE).alias("arrival"),
                "id", "k", moment.alias("at"), _message_element().alias("element"),
            )
        )
        # A message gathers at most MESSAGE_SIZE readings.
        messages = readings.groupBy("arrival").agg(
            F.sort_array(F.collect_list(F.struct("id", "element"))).alias("parts"),
            F.min_by("k", "id").alias("k"),
            F.min("at").alias("at"),
        )
        body = F.concat(F.lit("["), F.array_join("parts.element", ","), F.lit("]"))
        k = F.col("k")
        value = (
            F.when(k == 50, F.expr("substring(body, 1, length(body) - 1)"))
            .when(k == 51, "")
            .when(k == 52, "[]")
            .when(k == 53, "null")
            .when(k == 54, F.concat(F.lit('{"m":'), "body", F.lit("}")))
            .when(k == 55, F.concat("body", F.lit(" x")))
            .otherwise(F.col("body"))
        )
        week = F.floor((F.dayofmonth("at") - 1) / 8).cast("int")
        return messages.withColumn("body", body).select(
            "arrival", value.alias("value"), week.alias("week")
        )

    return spark.read.parquet(_stored(spark, sf_dir, "payloads", build))


def users(spark: SparkSession, sf_dir: str) -> DataFrame:
    customer = spark.read.parquet(f"{sf_dir}/customer.parquet")
    return customer.select(
        F.col("c_custkey").alias("user_id"),
        F.col("c_name").alias("username"),
        (F.col("c_acctbal") > 0).alias("is_active"),
    )


def roles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One role per order priority; its number is the priority's leading digit."""
    orders = spark.read.parquet(f"{sf_dir}/orders.parquet")
    return orders.select(
        F.substring("o_orderpriority", 1, 1).cast("int").alias("role_id"),
        F.col("o_orderpriority").alias("role_name"),
    ).distinct()


def user_roles(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = spark.read.parquet(f"{sf_dir}/orders.parquet")
    return orders.select(
        F.col("o_custkey").alias("user_id"),
        F.substring("o_orderpriority", 1, 1).cast("int").alias("role_id"),
    ).distinct()

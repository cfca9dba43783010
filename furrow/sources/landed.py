"""Landed raw data: payloads, nested JSON, CSV, page and request plans, checkpoints."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from furrow.data import load
from furrow.functions import scalars as X

#: Where each source's records come from: url, method, kind of source.
SOURCES: dict[str, dict[str, str]] = load("feeds")["sources"]
PAGE, WINDOW = 10_000, 10_000
#: A text inside JSON may be as long as a text can be: by default the parser gives null for longer ones than 20 million characters.
_ANY_LENGTH = {"maxStringLen": str(2**31 - 1)}


def source_table(spark: SparkSession) -> DataFrame:
    """Rows (source, source_url, method, source_name): a fixed table, small enough to broadcast."""
    return spark.createDataFrame([(k, v["url"], v["method"], v["kind"]) for k, v in SOURCES.items()], "source string, source_url string, method string, source_name string")


def with_provenance(df: DataFrame, source: str = "source") -> DataFrame:
    return df.join(F.broadcast(source_table(df.sparkSession).withColumnRenamed("source", source)), source, "left")


def code_table(spark: SparkSession, path: str, columns: str) -> DataFrame:
    """A code table (centres, categories, market codes) from a CSV file with a header."""
    return spark.read.csv(path, header=True, schema=columns)


def known_partitions(spark: SparkSession) -> DataFrame:
    """The states that the national feed is asked for, one by one."""
    return spark.createDataFrame([(x,) for x in load("words")["partitions"]], "partition string")


def read_payloads(spark: SparkSession, path: str) -> DataFrame:
    """Rows (source, success, error, details, ordinal, record) from JSON files {source: {success, data, error, details}}.

    A source without data gives one row with a null record, so its status is kept. A feed's data may itself be a text
    that holds JSON. Each file is one value; a day's files are many.
    """
    return payload_records(spark.read.text(path, wholetext=True))


def payload_records(texts: DataFrame, column: str = "value") -> DataFrame:
    """As read_payloads, from texts in a column."""
    each = texts.select(F.explode(F.from_json(column, "map<string,string>", _ANY_LENGTH)).alias("source", "payload"))
    body = each.select("source", F.from_json("payload", "success boolean, data string, error string, details string", _ANY_LENGTH).alias("p"))
    rows = F.from_json("p.data", "array<map<string,string>>", _ANY_LENGTH)
    return body.select("source", F.coalesce("p.success", F.lit(False)).alias("success"), "p.error", "p.details", F.posexplode_outer(rows).alias("ordinal", "record"))


def chained_pages(pages: DataFrame, key: str = "source") -> DataFrame:
    """Pages (key, page, has_next) that a reader who follows next links sees: up to the first without one."""
    before = Window.partitionBy(key).orderBy("page").rowsBetween(Window.unboundedPreceding, -1)
    return pages.withColumn("_open", F.coalesce(F.min(F.col("has_next").cast("int")).over(before), F.lit(1))).where("_open = 1").drop("_open")


def source_status(payloads: DataFrame) -> DataFrame:
    """One row for each source: success, error, details and number of records."""
    return payloads.groupBy("source").agg(F.bool_and("success").alias("success"), F.max("error").alias("error"), F.max("details").alias("details"), F.count("record").alias("records"))


def successful(payloads: DataFrame) -> DataFrame:
    """Records of the sources that succeeded."""
    return payloads.where("success and record is not null").select("source", "ordinal", "record")


def flatten_locations(df: DataFrame, column: str) -> DataFrame:
    """Records of location -> (lat, lon, date -> key -> [item]): one row for each item, coordinates copied down.

    Keys other than dates are the location's own values; levels of another type are left out.
    """
    return df.sparkSession.sql(
        """
        SELECT loc.key AS location,
               try_variant_get(loc.value, '$.latitude', 'double') AS latitude,
               try_variant_get(loc.value, '$.longitude', 'double') AS longitude,
               day.key AS day, crop.key AS crop_key, item.pos AS pos, item.value AS item
        FROM {nested},
             LATERAL variant_explode(doc) AS loc,
             LATERAL variant_explode(loc.value) AS day,
             LATERAL variant_explode(day.value) AS crop,
             LATERAL variant_explode(crop.value) AS item
        WHERE day.key NOT IN ('latitude', 'longitude') AND schema_of_variant(item.value) LIKE 'OBJECT%'
        """,
        nested=df.select(F.try_parse_json(column).alias("doc")),
    )


def page_plan(totals: DataFrame, page: int = PAGE, window: int = WINDOW) -> DataFrame:
    """Rows (partition, offset, size): the requests that read every partition of totals (partition, total) inside the window."""
    start = F.explode(F.when(F.col("total") > 0, F.sequence(F.lit(0).cast("bigint"), F.col("total") - 1, F.lit(page).cast("bigint"))).otherwise(F.array().cast("array<bigint>"))).alias("offset")
    asked = totals.select("partition", start)
    return asked.withColumn("size", X.page_sizes(F.col("offset"), F.lit(page), F.lit(window))).where("size > 0")


def request_plan(centres: DataFrame, categories: DataFrame) -> DataFrame:
    """Every centre with every category. Both are code tables; the smaller is broadcast by the planner."""
    return centres.crossJoin(F.broadcast(categories))


def absent_partitions(expected: DataFrame, landed: DataFrame, key: str) -> DataFrame:
    return expected.join(landed.select(key).distinct(), key, "left_anti")


def date_spine(files: DataFrame, column: str) -> DataFrame:
    """Every day from the first to the last of a column."""
    ends = files.agg(F.min(column).alias("first"), F.max(column).alias("last")).where("first is not null")
    return ends.select(F.explode(F.sequence("first", "last")).alias("day"))


def landed_days(spine: DataFrame, files: DataFrame) -> DataFrame:
    """Days with the number of landed records; days without any are kept with 0."""
    return spine.join(files.groupBy("day").count(), "day", "left").select("day", F.coalesce("count", F.lit(0)).alias("records"), F.col("count").isNotNull().alias("landed"))


def gather(frames: dict[str, DataFrame]) -> DataFrame:
    """All frames with their source's name; missing columns are null."""
    out = None
    for name, df in frames.items():
        own = df.withColumn("source", F.lit(name))
        out = own if out is None else out.unionByName(own, allowMissingColumns=True)
    if out is None:
        raise ValueError("no frames to gather")
    return out


def records_in_order() -> Column:
    """The records of a group as an array in the order of their ordinals."""
    each = F.collect_list(F.when(F.col("record").isNotNull(), F.struct("ordinal", "record")))
    return F.transform(F.array_sort(each, lambda a, b: F.sign(a["ordinal"] - b["ordinal"]).cast("int")), lambda r: r["record"])


def write_checkpoint(payloads: DataFrame, path: str) -> None:
    """Payload records as JSON texts, one a line, that payload_records() reads again."""
    own = payloads.groupBy("source").agg(F.bool_and("success").alias("success"), F.max("error").alias("error"), F.max("details").alias("details"), records_in_order().alias("data"))
    body = F.struct("success", "data", "error", "details")
    own.select(F.to_json(F.create_map("source", body)).alias("value")).write.mode("overwrite").text(path)


def read_checkpoint(spark: SparkSession, path: str) -> DataFrame:
    return payload_records(spark.read.text(path))


def write_csv(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").csv(path, header=True)


def read_names_csv(spark: SparkSession, path: str, schema: str, name: str = "commodity_name") -> DataFrame:
    """A CSV of names without blank ones and placeholders."""
    rows = spark.read.csv(path, header=True, schema=schema, enforceSchema=False)
    return rows.where((F.coalesce(F.trim(name), F.lit("")) != "") & (F.lower(F.trim(name)) != "(no commodity_name)"))


def sheet_columns(header: list[str], wanted: dict[str, tuple[str, ...]], positions: dict[str, int]) -> dict[str, int]:
    """Column numbers of a sheet's fields: the first header that holds a field's key word, else its usual position."""
    low = [h.strip().lower() for h in header]
    return {field: next((i for i, h in enumerate(low) if any(w in h for w in words)), positions[field]) for field, words in wanted.items()}


def read_sheet(spark: SparkSession, path: str, wanted: dict[str, tuple[str, ...]], positions: dict[str, int]) -> DataFrame:
    """The wanted fields of a sheet saved as CSV, found by their headers: texts without outer white space, blank ones null."""
    raw = spark.read.csv(path, header=True)
    at = sheet_columns(raw.columns, wanted, positions)
    return raw.toDF(*(f"c{i}" for i in range(len(raw.columns)))).select(*(X.blank_to_null(F.col(f"c{i}")).alias(field) for field, i in at.items()))


def copy_table(spark: SparkSession, source: str, target: str) -> int:
    """Copy a table before it is changed; the copy must have as many rows."""
    df = spark.read.parquet(source)
    df.write.mode("errorifexists").parquet(target)
    n, m = df.count(), spark.read.parquet(target).count()
    if n != m:
        raise RuntimeError(f"copy has {m} of {n} rows")
    return m


def write_report(metrics: DataFrame, path: str) -> None:
    """An audit report as JSON."""
    metrics.coalesce(1).write.mode("overwrite").json(path)


def with_geocodes(markets: DataFrame, geocodes: DataFrame) -> DataFrame:
    """Markets with district, postcode and location of a geocode table (state, name, district, postcode, lon, lat)."""
    point = F.when(F.col("lon").isNotNull() & F.col("lat").isNotNull(), F.struct(F.lit("Point").alias("type"), F.array("lon", "lat").alias("coordinates")))
    return markets.join(geocodes, ["state", "name"], "left").withColumn("location", point).drop("lon", "lat")


def override_source(df: DataFrame, label: str) -> DataFrame:
    return df.withColumn("source_system", F.lit(label))


def epoch_range(first: Column, last: Column, now: Column, days_back: int = 30) -> Column:
    """A struct (start, end) of milliseconds for a request: what is given in whatever form, else the last days."""
    return F.struct(X.epoch_millis(first, F.unix_millis(now - F.make_dt_interval(F.lit(days_back)))).alias("start"), X.epoch_millis(last, F.unix_millis(now)).alias("end"))


def day_range(first: Column, last: Column, today: Column) -> Column:
    """A struct (first, last) of days: those given, else yesterday and today."""
    return F.struct(F.coalesce(first, F.date_sub(today, 1)).alias("first"), F.coalesce(last, today).alias("last"))

"""Source, sink and catalog queries (S1–S16), unions (T4, T5) and the file stream (X1).

Files go to a fresh folder below the shared one the session names.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from entry_queries.frames import LATEST_SQL, records, table
from entry_queries.registry import query
from entry_queries.shapes import features
from stratalake.plans import analysis, layers
from stratalake.session import new_path
from stratalake.sources import catalog, files, schemas
from stratalake.streaming.ingest import ingest_stream, read_bronze, read_manifest

EVENT_SCHEMA = "event_id bigint, user_id bigint, event_type string, value double, props string"


@query(
    "s1_jsonl_scan",
    """SELECT event_id, user_id, event_type, value, CASE WHEN event_type <> 'error' THEN props END AS props,
    TRUE AS paths_agree FROM events""",
)
def s1(spark, sf):
    root = new_path(spark, "scan")
    events = table(spark, sf, "events").drop("ts")
    events.filter("event_type = 'error'").drop("props").write.json(f"{root}/2024")
    events.filter("event_type <> 'error'").write.json(f"{root}/2025")
    found = files.scan_jsonl(spark, f"{root}/*/*.json", EVENT_SCHEMA)
    same = F.col("filename") == F.col("source_file")
    return found.withColumn("paths_agree", same).drop("filename", "source_file")


@query("s2_record_type", "SELECT event_id, CAST(json_extract(props, '$.k') AS BIGINT) AS k FROM events")
def s2(spark, sf):
    kind = schemas.struct_from_json_schema(
        {"type": "array", "items": {"type": "object", "properties": {"k": {"type": ["integer", "null"]}}}}
    )
    return table(spark, sf, "events").select("event_id", F.from_json("props", kind)["k"].alias("k"))


@query(
    "s3_tolerant_scan",
    """SELECT CASE WHEN event_type <> 'error' THEN event_id END AS event_id,
    CASE WHEN event_type <> 'error' THEN CAST(json_extract(props, '$.k') AS BIGINT) END AS k,
    CASE WHEN event_type = 'error' THEN '{bad' || event_id END AS bad_line
    FROM events WHERE event_type <> 'signup'""",
)
def s3(spark, sf):
    root = new_path(spark, "tolerant")
    table(spark, sf, "events").selectExpr(
        """CASE event_type WHEN 'error' THEN concat('{bad', event_id) WHEN 'signup' THEN '  '
             ELSE concat('{"event_id":', event_id, ',"k":-1,', substr(props, 2)) END AS value"""
    ).write.text(root)
    good, bad = files.scan_jsonl_tolerant(spark, root, "event_id bigint, k bigint")
    bad = bad.select(F.col(files.CORRUPT).alias("bad_line"))
    return files.union_by_name(good.drop("source_file"), bad).select("event_id", "k", "bad_line")


@query(
    "s4_feature_load",
    f"""WITH {LATEST_SQL} SELECT attorney_type AS "attorneyType", count(*) AS n,
    CAST(sum(net_sentence_days) AS BIGINT) AS days FROM r GROUP BY 1""",
)
def s4(spark, sf):
    root = new_path(spark, "features")
    # raw records repeat their keys: as plain text they take ten times the disk of all else
    records(spark, sf).drop("source_file").write.option("compression", "gzip").json(root)
    rows = analysis.load_case_features(spark, root)
    return rows.groupBy("attorneyType").agg(F.count(F.lit(1)).alias("n"), F.sum("netSentenceDays").alias("days"))


@query("s5_parquet_scan", "SELECT p_partkey, p_brand, p_size FROM part")
def s5(spark, sf):
    return files.scan_parquet(spark, f"{sf}/part.parquet").select("p_partkey", "p_brand", "p_size")


@query("s6_layer_write", "SELECT o_orderstatus, count(*) AS n FROM orders GROUP BY 1")
def s6(spark, sf):
    path = new_path(spark, "layer")
    files.write_layer(table(spark, sf, "orders"), path)
    return files.scan_parquet(spark, path).groupBy("o_orderstatus").agg(F.count(F.lit(1)).alias("n"))


@query(
    "s7_write_by_date",
    """SELECT CAST(year(ts) AS INTEGER) AS year, CAST(month(ts) AS INTEGER) AS month,
    CAST(day(ts) AS INTEGER) AS day, count(*) AS n FROM events GROUP BY 1, 2, 3""",
)
def s7(spark, sf):
    path = new_path(spark, "dated")
    files.write_by_date(table(spark, sf, "events").select("event_id", "ts"), path, "ts")
    return files.scan_parquet(spark, path).groupBy("year", "month", "day").agg(F.count(F.lit(1)).alias("n"))


@query(
    "s7b_ingest_by_date",
    """SELECT CAST(year(ts) AS INTEGER) AS year, CAST(month(ts) AS INTEGER) AS month, CAST(day(ts) AS INTEGER) AS day,
    CAST(count(*) FILTER (event_type <> 'error') AS BIGINT) AS n,
    CAST(count(*) FILTER (event_type = 'error') AS BIGINT) AS bad_lines,
    CAST(sum(CASE WHEN event_type <> 'error' THEN CAST(json_extract(props, '$.k') AS BIGINT) END) AS BIGINT) AS k,
    CAST(count(*) FILTER (event_type = 'view') AS BIGINT) AS active
    FROM events GROUP BY 1, 2, 3""",
)
def s7b(spark, sf):
    root, out = new_path(spark, "ingest"), new_path(spark, "ingested")
    # a key twice, JSON objects as text with quotes of both kinds, and lines cut off
    row = F.expr(
        """to_json(named_struct('caseNumber', cast(event_id AS string), 'date', date_format(ts, 'MM/dd/yyyy, hh:mm a'),
             'props', if(event_type = 'view', translate(props, '"', "'"), props),
             'caseActiveIndicator', named_struct('value', if(event_type = 'view', 'Y', 'N'))))"""
    )
    line = F.concat(F.lit('{"caseNumber":"0",'), F.substr(row, F.lit(2)))
    day = F.date_format("ts", "yyyy-MM-dd")
    bad = F.concat(F.lit("{bad"), day)
    table(spark, sf, "events").select(F.when(F.col("event_type") == "error", bad).otherwise(line).alias("value")).write.text(root)
    rows = layers.ingest_by_date(spark, root, out)
    good = rows.groupBy("year", "month", "day").agg(
        F.count(F.lit(1)).alias("n"), F.sum("props_k").cast("bigint").alias("k"), F.count_if("is_active").alias("active")
    )
    date = F.to_date(F.substr(files.CORRUPT, F.lit(5)))
    bad = files.scan_parquet(spark, files.bad_lines_path(out)).groupBy(
        F.year(date).alias("year"), F.month(date).alias("month"), F.dayofmonth(date).alias("day")
    ).agg(F.count(F.lit(1)).alias("bad_lines"))
    both = good.join(bad, ["year", "month", "day"], "full")
    zero = [F.coalesce(c, F.lit(0)).alias(c) for c in ("n", "bad_lines")]
    return both.select("year", "month", "day", *zero, "k", F.coalesce("active", F.lit(0)).alias("active"))


@query("s8_append_records", "SELECT o_orderstatus, count(*) AS n, CAST(sum(o_custkey) AS BIGINT) AS parties FROM orders GROUP BY 1")
def s8(spark, sf):
    path = new_path(spark, "append")
    rows = table(spark, sf, "orders").select("o_orderkey", "o_custkey", "o_orderstatus")
    files.append_records(rows.filter("o_orderstatus = 'F'"), path)
    files.append_records(rows.filter("o_orderstatus <> 'F'"), path)
    found = files.scan_jsonl(spark, path, "o_custkey bigint, o_orderstatus string")
    return found.groupBy("o_orderstatus").agg(F.count(F.lit(1)).alias("n"), F.sum("o_custkey").alias("parties"))


@query(
    "s9_compaction",
    """SELECT CAST(ts AS DATE) AS date, count(*) AS lines, CAST(sum(event_id) AS BIGINT) AS ids FROM events GROUP BY 1""",
)
def s9(spark, sf):
    root, out = new_path(spark, "batches"), new_path(spark, "compact")
    table(spark, sf, "events").selectExpr(
        "concat('{\"event_id\":', event_id, '}') AS value",
        "concat(date_format(ts, 'yyyy-MM-dd'), '_batch_', CASE WHEN hour(ts) < 12 THEN 0 ELSE 1 END) AS b",
    ).write.partitionBy("b").text(root)
    files.compact_by_date(spark, f"{root}/*_batch_*/*", out)
    found = spark.read.text(out).select(F.col("date").cast("date"), F.from_json("value", "event_id bigint")["event_id"].alias("id"))
    return found.groupBy("date").agg(F.count(F.lit(1)).alias("lines"), F.sum("id").alias("ids"))


@query(
    "s10_dimension_scan",
    """SELECT lpad(CAST(s_suppkey AS VARCHAR), 6, '0') AS "fipsCode", s_name AS url FROM supplier""",
)
def s10(spark, sf):
    path = new_path(spark, "dim")
    table(spark, sf, "supplier").selectExpr(
        "lpad(cast(s_suppkey AS string), 6, '0') AS fipsCode", "s_name AS url"
    ).write.option("header", True).csv(path)
    return files.scan_dim_csv(spark, path)


@query("s11_register_view", "SELECT c_mktsegment, count(*) AS n FROM customer GROUP BY 1")
def s11(spark, sf):
    view = catalog.register(table(spark, sf, "customer"), "parties")
    return view.groupBy("c_mktsegment").agg(F.count(F.lit(1)).alias("n"))


@query(
    "s12_table_profile",
    " UNION ALL ".join(
        f"SELECT '{c}' AS column_name, '{t}' AS column_type, count({c}) AS known FROM orders"
        for c, t in (
            ("o_orderkey", "bigint"), ("o_custkey", "bigint"), ("o_orderstatus", "string"),
            ("o_totalprice", "double"), ("o_orderdate", "timestamp_ntz"), ("o_orderpriority", "string"),
        )
    ),
)
def s12(spark, sf):
    orders = catalog.register(table(spark, sf, "orders"), "profiled_orders")
    known = orders.agg(F.array(*[F.struct(F.lit(c).alias("column_name"), F.count(c).alias("known")) for c in orders.columns]).alias("c"))
    return catalog.describe(spark, "profiled_orders").join(known.select(F.inline("c")), "column_name")


@query("s13_ad_hoc_sql", "SELECT event_type, count(*) AS n, 5 AS result_rows FROM events GROUP BY 1")
def s13(spark, sf):
    catalog.register(table(spark, sf, "events"), "ad_hoc_events")
    result, rows = catalog.run_sql(spark, "SELECT event_type, count(*) AS n FROM ad_hoc_events GROUP BY event_type")
    return result.withColumn("result_rows", F.lit(rows).cast("int"))


@query("s14_input_guard", "SELECT count(*) AS n, TRUE AS found, FALSE AS other_found FROM orders")
def s14(spark, sf):
    found = files.has_input(spark, f"{sf}/orders*.parquet")
    other = files.has_input(spark, f"{sf}/no-such-table*.parquet")
    return table(spark, sf, "orders").agg(
        F.count(F.lit(1)).alias("n"), F.lit(found).alias("found"), F.lit(other).alias("other_found")
    )


@query(
    "s15_layer_run",
    f"""WITH {LATEST_SQL} SELECT locality_name, date_trunc('month', hearing_timestamp)::TIMESTAMP AS month,
    count(*) AS case_count, count(DISTINCT "caseNumber") AS distinct_cases FROM d GROUP BY 1, 2""",
)
def s15(spark, sf):
    root = new_path(spark, "run")
    # the file name is the only thing that orders copies, so each record names its own
    raw = records(spark, sf).withColumnRenamed("source_file", "origin")
    raw.write.option("compression", "gzip").json(f"{root}/raw/2024")
    paths = layers.LayerPaths(f"{root}/raw/*/*.json.gz", f"{root}/bronze", f"{root}/silver", f"{root}/gold")
    built = layers.run_layers(spark, paths)
    return built["monthly_locality_summary"].drop("avg_fine")


@query("s16_feature_sample")
def s16(spark, sf):
    return catalog.sample_features(features(spark, sf), 10000)


@query(
    "t4_union_by_name",
    """SELECT c_custkey AS "key", c_name AS name, c_mktsegment AS segment FROM customer
    UNION ALL SELECT s_suppkey, s_name, NULL FROM supplier""",
)
def t4(spark, sf):
    parties = table(spark, sf, "customer").selectExpr("c_custkey AS key", "c_name AS name", "c_mktsegment AS segment")
    witnesses = table(spark, sf, "supplier").selectExpr("s_suppkey AS key", "s_name AS name")
    return files.union_by_name(parties, witnesses)


@query(
    "t5_concat_pages",
    "SELECT c_name AS name, c_nationkey AS nation FROM customer UNION ALL SELECT s_name, s_nationkey FROM supplier",
)
def t5(spark, sf):
    first = table(spark, sf, "customer").selectExpr("c_name AS name", "c_nationkey AS nation")
    return files.concat_pages(first, table(spark, sf, "supplier").select("s_name", "s_nationkey"))


@query(
    "x1_file_stream",
    """SELECT strftime(ts, '%Y-%m-%d') AS hearing_day, count(*) AS n, count(DISTINCT (user_id, date_trunc('minute', ts))) AS n_silver,
    count(DISTINCT event_id % 3 = 0) AS n_batches FROM events GROUP BY 1""",
)
def x1(spark, sf):
    root = new_path(spark, "stream")
    lines = table(spark, sf, "events").selectExpr(
        "event_id", "cast(user_id AS string) AS caseNumber", "date_format(ts, 'MM/dd/yyyy, hh:mm a') AS hearingDate"
    )
    schema = files.as_struct(schemas.CASE_SCHEMA)
    for late in (False, True):  # the second run finds further files of the same days
        part = lines.filter((F.col("event_id") % 3 == 0) == late).drop("event_id")
        part.write.mode("append").json(f"{root}/in")
        ingest_stream(spark, f"{root}/in", f"{root}/bronze", schema, f"{root}/checkpoint", f"{root}/silver").awaitTermination()
    landed = read_bronze(spark, f"{root}/bronze", schema).groupBy("hearing_day").agg(F.count(F.lit(1)).alias("n"))
    silver = spark.read.parquet(f"{root}/silver").groupBy(F.col("hearing_day").cast("string").alias("hearing_day")).agg(F.count(F.lit(1)).alias("n_silver"))
    batches = read_manifest(spark, f"{root}/bronze").groupBy("hearing_day").agg(F.count(F.lit(1)).alias("n_batches"))
    return landed.join(silver, "hearing_day").join(batches, "hearing_day")

"""Sources, quality, cleaning, joins and reductions over the plain tables."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from touchline import fixed_values as fv
from touchline.functions import calendar, cleaning
from touchline.functions.keys import composite_key, name_key
from touchline.operators import bands, dedup, numbering, quality, reconcile, topk
from touchline.operators.lookup import lookup
from touchline.plans import performance
from touchline.sources import files, sinks
from touchline.session import scratch_path
from touchline.sources.tables import read_gold_inputs, read_parquet_optional, require, stored
from touchline.workload import frames
from touchline.workload.frames import exact, key
from touchline.workload.numeric import exact_sum
from touchline.workload.registry import query
from touchline.workload.tables import SCHEMAS, read_spread, read_table

#: Folders that the documents of ``load_docs`` are dealt to.
SHELVES = 64
REGION_SCHEMA = "r_regionkey INT, r_name STRING"


# --- sources ----------------------------------------------------------------

@query("""
SELECT c_custkey, c_name, c_acctbal, NULL::INT AS c_mktsegment FROM customer
""")
def scan_fixed_schema(spark, sf):
    """CSV lines parsed with a declared schema; a value of the wrong type is null."""
    line = F.to_csv(F.struct("c_custkey", "c_name", "c_acctbal", "c_mktsegment"))
    schema = "c_custkey BIGINT, c_name STRING, c_acctbal DOUBLE, c_mktsegment INT"
    parsed = F.from_csv(line, F.lit(schema), {"mode": "PERMISSIVE"})
    return read_table(spark, sf, "customer").select(parsed.alias("row")).select("row.*")


@query("SELECT r_regionkey, r_name FROM region")
def scan_optional(spark, sf):
    """A present and an absent input; the absent one adds an empty typed frame."""
    present = read_parquet_optional(spark, f"{sf}/region.parquet", REGION_SCHEMA)
    absent = read_parquet_optional(spark, f"{sf}/no_such_table.parquet", REGION_SCHEMA)
    return present.unionByName(absent)


@query("\nUNION ALL ".join(
    f"SELECT '{t}' AS table_name, '{t}.parquet' AS rel_path, '{t}.parquet' AS filename, true AS is_top_level,"
    f" true AS has_content, count(*) AS n_rows FROM {t}" for t in SCHEMAS))
def file_inventory(spark, sf):
    """Every file below the data folder that holds rows of a table, and how many it holds."""
    path = F.url_decode(F.replace(F.col("_metadata.file_path"), F.lit("+"), F.lit("%2B")))
    counted = [
        read_table(spark, sf, name).groupBy(files.relative_path(path, sf).alias("rel_path"))
        .agg(F.count(F.lit(1)).alias("n_rows")).withColumn("table_name", F.lit(name))
        for name in SCHEMAS
    ]
    listed = files.list_files(spark, sf)
    return listed.join(reduce(DataFrame.unionByName, counted), "rel_path").select(
        "table_name", "rel_path", "filename", "is_top_level", (F.col("length") > 0).alias("has_content"), "n_rows")


@query("SELECT source || '/' || doc_id AS doc_id, coalesce(length(text), 0) AS n_chars, sha256(coalesce(text, '')) AS digest FROM documents")
def load_docs(spark, sf):
    """Documents written as text files in folders and loaded again by their extension; other files are passed over."""
    folder = scratch_path(spark, "text_files")
    docs = read_spread(spark, sf, "documents", "doc_id")
    # dealt to shelves, so that no folder holds too large a part of the files for one task to list
    shelf = F.pmod(F.xxhash64("doc_id"), F.lit(SHELVES)).cast("string")
    name = F.concat_ws("/", shelf, "source", F.col("doc_id").cast("string"))
    bodies = docs.select(name.alias("name"), F.encode(F.coalesce("text", F.lit("")), "UTF-8").alias("content"))
    for extension in ("txt", "md"):
        named = bodies.select(F.concat("name", F.lit(f".{extension}")).alias("rel_path"), "content")
        files.land_files(named, folder).write.format("noop").mode("overwrite").save()
    made: list[str] = []
    loaded = files.read_documents(spark, folder, made=made).select(
        F.regexp_replace("doc_id", r"^[0-9]+/|\.txt$", "").alias("doc_id"), F.length("text").cast("bigint").alias("n_chars"), F.sha2("text", 256).alias("digest"))
    out = stored(loaded, "loaded_documents")
    files.remove_in_tasks(spark, folder)
    files.remove_folders(spark, made)
    return out


@query("""
SELECT name AS table_name, name <> 'standings' AS required, name <> 'standings' AS present, n_rows
FROM (VALUES ('matches', (SELECT count(*) FROM orders)), ('team_kpis', (SELECT count(*) FROM supplier)),
  ('attendance', (SELECT count(*) FROM lineitem)), ('standings', 0)) AS t(name, n_rows)
""")
def required_inputs(spark, sf):
    """The gate before a load: inputs written as CSV and read by name; the sink is tried first, a missing input stops the run."""
    folder = scratch_path(spark, "gate")
    sinks.smoke_test(spark, sinks.parquet_sink(f"{folder}/mart"))
    given = {"matches": ("orders", "o_orderkey", "match_id"), "team_kpis": ("supplier", "s_name", "team"), "attendance": ("lineitem", "l_orderkey", "match_id")}
    for name, (table, column, header) in given.items():
        rows = read_table(spark, sf, table).select(F.col(column).cast("string").alias(header))
        rows.write.option("header", True).csv(f"{folder}/{fv.GOLD_FILES[name].format(prefix='')}")
    inputs = read_gold_inputs(spark, folder, "")
    require(inputs)
    for name in fv.REQUIRED_GOLD_INPUTS:
        try:
            require({n: df for n, df in inputs.items() if n != name})
        except FileNotFoundError:
            continue
        raise AssertionError(f"{name} is required, but its absence did not stop the run")
    counted = [
        (inputs[name].agg(F.count(F.lit(1)).alias("n_rows")) if inputs[name] is not None else spark.range(1).select(F.lit(0).cast("bigint").alias("n_rows")))
        .select(F.lit(name).alias("table_name"), F.lit(name in fv.REQUIRED_GOLD_INPUTS).alias("required"), F.lit(inputs[name] is not None).alias("present"), "n_rows")
        for name in [*given, "standings"]
    ]
    out = stored(reduce(DataFrame.unionByName, counted), "gate_report")
    files.remove_folders(spark, [folder])
    return out


@query("""
SELECT source || '/' || doc_id || '.txt' AS key,
  json_object('rel_path', source || '/' || doc_id || '.txt', 'filename', doc_id || '.txt',
    'content_b64', base64(encode(text)), 'content_type', 'application/octet-stream',
    'ts_ms', 1737158400000 + doc_id)::VARCHAR AS value
FROM documents
""")
def file_envelope(spark, sf):
    docs = read_spread(spark, sf, "documents", "doc_id")
    name = F.concat(F.col("doc_id").cast("string"), F.lit(".txt"))
    return files.envelopes(
        docs, F.encode("text", "UTF-8"), F.lit(1737158400000) + F.col("doc_id"),
        rel_path=F.concat_ws("/", "source", name), filename=name,
    )


@query("SELECT doc_id, lang, source FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels)")
def reconcile_orphans(spark, sf):
    docs = read_table(spark, sf, "documents").select("doc_id", "lang", "source")
    return reconcile.orphans(docs, read_table(spark, sf, "labels"), ["doc_id"])


@query("\nUNION ALL ".join(f"SELECT '{t}' AS table_name, count(*) AS n_rows FROM {t}" for t in SCHEMAS))
def run_metrics(spark, sf):
    """Rows that a load of all tables reports; the sink reads everything and keeps nothing."""

    def sink(df, table):
        df.write.format("noop").mode("overwrite").save()

    written = sinks.load_tables({name: read_table(spark, sf, name) for name in SCHEMAS}, sink)
    return spark.createDataFrame(sorted(written.items()), "table_name string, n_rows long")


# --- quality ----------------------------------------------------------------

@query("""
WITH c AS (SELECT count(*) AS total FROM customer)
SELECT 'column_exists' AS rule, name AS "column", total,
  CASE WHEN name = 'c_phone' THEN total ELSE 0 END AS unexpected, name <> 'c_phone' AS success
FROM c, (VALUES ('c_custkey'), ('c_name'), ('c_phone')) AS v(name)
""")
def dq_columns(spark, sf):
    suite = [quality.column_exists(c) for c in ("c_custkey", "c_name", "c_phone")]
    return quality.report(read_table(spark, sf, "customer"), suite)


@query("""
WITH c AS (
  SELECT count(*) AS total, count(*) FILTER (WHERE c_name IS NULL) AS no_name,
    count(*) FILTER (WHERE c_acctbal < 0 OR c_acctbal > 9000) AS balance,
    count(*) FILTER (WHERE c_nationkey < 0) AS nation,
    count(*) FILTER (WHERE c_mktsegment NOT IN ('AUTOMOBILE', 'BUILDING')) AS segment
  FROM customer)
SELECT 'not_null' AS rule, 'c_name' AS "column", total, no_name AS unexpected, no_name = 0 AS success FROM c
UNION ALL SELECT 'between', 'c_acctbal', total, balance, balance = 0 FROM c
UNION ALL SELECT 'between', 'c_nationkey', total, nation, nation = 0 FROM c
UNION ALL SELECT 'in_set', 'c_mktsegment', total, segment, segment = 0 FROM c
""")
def dq_report(spark, sf):
    return quality.report(
        read_table(spark, sf, "customer"),
        [
            quality.not_null("c_name"),
            quality.between("c_acctbal", 0, 9000),
            quality.between("c_nationkey", 0),
            quality.in_set("c_mktsegment", ["AUTOMOBILE", "BUILDING"]),
        ],
    )


@query(f"""
WITH {frames.PLAYERS_SQL},
c AS (
  SELECT count(*) AS total, count(*) FILTER (WHERE "Player_Name" IS NULL) AS n0,
    count(*) FILTER (WHERE "Country" IS NULL) AS n1,
    count(*) FILTER (WHERE "Age" < 15 OR "Age" > 50) AS n2,
    count(*) FILTER (WHERE "Performance_Rating" < 0 OR "Performance_Rating" > 10) AS n3,
    count(*) FILTER (WHERE "Minutes_Played" < 0) AS n4, count(*) FILTER (WHERE "Goals" < 0) AS n5,
    count(*) FILTER (WHERE "Position" NOT IN
      ('Forward', 'Midfielder', 'Defender', 'Goalkeeper', 'FW', 'MF', 'DF', 'GK')) AS n6
  FROM players_raw)
SELECT 'column_exists' AS rule, name AS "column", total, 0 AS unexpected, true AS success
FROM c, (VALUES ('Player_Name'), ('Country'), ('Age'), ('Position'), ('Performance_Rating')) AS v(name)
UNION ALL SELECT 'not_null', 'Player_Name', total, n0, n0 = 0 FROM c
UNION ALL SELECT 'not_null', 'Country', total, n1, n1 = 0 FROM c
UNION ALL SELECT 'between', 'Age', total, n2, n2 = 0 FROM c
UNION ALL SELECT 'between', 'Performance_Rating', total, n3, n3 = 0 FROM c
UNION ALL SELECT 'between', 'Minutes_Played', total, n4, n4 = 0 FROM c
UNION ALL SELECT 'between', 'Goals', total, n5, n5 = 0 FROM c
UNION ALL SELECT 'in_set', 'Position', total, n6, n6 = 0 FROM c
""")
def dq_players(spark, sf):
    return quality.report(frames.players_raw(spark, sf), quality.player_suite())


# --- cleaning ---------------------------------------------------------------

@query("""
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_quantity, l_extendedprice, l_returnflag
FROM lineitem
QUALIFY row_number() OVER (PARTITION BY l_orderkey, l_linenumber
  ORDER BY l_partkey, l_suppkey, l_quantity, l_extendedprice, l_returnflag) = 1
""")
def dedup_subset(spark, sf):
    lines = read_table(spark, sf, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice", "l_returnflag"
    )
    return dedup.first_by(lines, ["l_orderkey", "l_linenumber"])


@query(f"""
WITH {frames.PLAYERS_SQL}
SELECT "Player_Name", "Country", "Age", "Minutes_Played" FROM players_raw
WHERE "Age" IS NOT NULL AND "Minutes_Played" IS NOT NULL
""")
def filter_not_null(spark, sf):
    rows = frames.players_raw(spark, sf).where("Age IS NOT NULL AND Minutes_Played IS NOT NULL")
    return rows.select("Player_Name", "Country", "Age", "Minutes_Played")


@query("""
SELECT o_orderkey, coalesce(c_name, 'none') AS c_name, coalesce(c_acctbal, 0) AS c_acctbal,
  coalesce(c_nationkey, 0) AS c_nationkey, c_mktsegment
FROM orders LEFT JOIN (SELECT * FROM customer WHERE c_acctbal >= 0) c ON o_custkey = c_custkey
""")
def fill_defaults(spark, sf):
    """Gaps left by an outer join are filled per column; other columns keep nulls."""
    customer = read_table(spark, sf, "customer").where("c_acctbal >= 0")
    orders = read_table(spark, sf, "orders").select("o_orderkey", "o_custkey")
    joined = orders.join(customer, orders.o_custkey == customer.c_custkey, "left").select(
        "o_orderkey", "c_name", "c_acctbal", "c_nationkey", "c_mktsegment"
    )
    return quality.clean_numbers(joined, {"c_name": "none", "c_acctbal": 0.0, "c_nationkey": 0})


@query("""
SELECT o_orderkey, CASE WHEN o_orderpriority IN ('1-URGENT', '2-HIGH') THEN 'fast'
  WHEN o_orderpriority IN ('5-LOW') THEN 'slow' ELSE o_orderpriority END AS priority
FROM orders
""")
def canonical_category(spark, sf):
    names = {"fast": ["1-URGENT", "2-HIGH"], "slow": ["5-LOW"]}
    priority = cleaning.canonical(F.col("o_orderpriority"), names)
    return read_table(spark, sf, "orders").select("o_orderkey", priority.alias("priority"))


@query("SELECT c_custkey, coalesce(nullif(c_acctbal, 0) > 0, false) AS is_active FROM customer")
def flag_active(spark, sf):
    return read_table(spark, sf, "customer").select(
        "c_custkey", cleaning.is_positive(F.col("c_acctbal")).alias("is_active")
    )


@query("""
SELECT c_custkey, CASE c_mktsegment WHEN 'AUTOMOBILE' THEN 'industry' WHEN 'MACHINERY' THEN 'industry'
  WHEN 'HOUSEHOLD' THEN 'home' ELSE 'Unknown' END AS category FROM customer
""")
def category_rollup(spark, sf):
    parents = {"AUTOMOBILE": "industry", "MACHINERY": "industry", "HOUSEHOLD": "home"}
    return read_table(spark, sf, "customer").select(
        "c_custkey", cleaning.rollup_category(F.col("c_mktsegment"), parents).alias("category")
    )


@query("""
SELECT l_orderkey, l_linenumber, l_quantity + l_linenumber AS total,
  CASE WHEN l_discount > 0 THEN l_quantity / l_discount ELSE 0 END AS per_discount,
  CASE WHEN l_linenumber > 0 THEN l_extendedprice / l_linenumber ELSE 0 END AS per_line
FROM lineitem
""")
def safe_ratio_metrics(spark, sf):
    return read_table(spark, sf, "lineitem").select(
        "l_orderkey", "l_linenumber",
        (F.col("l_quantity") + F.col("l_linenumber")).alias("total"),
        cleaning.ratio(F.col("l_quantity"), F.col("l_discount")).alias("per_discount"),
        cleaning.ratio(F.col("l_extendedprice"), F.col("l_linenumber")).alias("per_line"),
    )


@query("""
SELECT l_orderkey, l_linenumber, CASE WHEN home > l_tax THEN 'HOME_WIN' WHEN home < l_tax THEN 'AWAY_WIN'
  ELSE 'DRAW' END AS result
FROM (SELECT *, CASE WHEN l_returnflag <> 'N' THEN l_discount END AS home FROM lineitem)
""")
def ternary_outcome(spark, sf):
    home = F.when(F.col("l_returnflag") != "N", F.col("l_discount"))
    return read_table(spark, sf, "lineitem").select(
        "l_orderkey", "l_linenumber", cleaning.outcome(home, F.col("l_tax")).alias("result")
    )


@query("""
SELECT event_id, json_extract_string(props, '$.k')::INT AS k, json_extract_string(props, '$.k')::DOUBLE AS ratio,
  trunc(value)::INT AS whole, NULL::INT AS wrong, NULL::DOUBLE AS absent
FROM events
""")
def coerce_types(spark, sf):
    """Text to numbers: fractions truncate, malformed text and missing columns are null."""
    k = F.get_json_object("props", "$.k")
    texts = read_spread(spark, sf, "events", "event_id").select(
        "event_id", k.alias("k"), k.alias("ratio"),
        F.col("value").cast("string").alias("whole"), F.col("event_type").alias("wrong"),
    )
    return cleaning.coerce(texts, "event_id BIGINT, k INT, ratio DOUBLE, whole INT, wrong INT, absent DOUBLE")


@query("""
SELECT event_id, strftime(t, '%Y-%m-%d %H:%M:%S') AS parsed, strftime(t::DATE, '%Y-%m-%d') AS day,
  strftime(t, '%Y%m%d')::INT AS date_id
FROM (SELECT event_id, CASE WHEN event_type <> 'error' THEN ts END AS t FROM events)
""")
def parse_ts(spark, sf):
    text = F.when(F.col("event_type") == "error", "not a time").otherwise(F.col("ts").cast("string"))
    rows = read_table(spark, sf, "events").select("event_id", calendar.parse_timestamp(text).alias("parsed"))
    day = F.to_date("parsed")
    return rows.select("event_id", "parsed", day.alias("day"), calendar.date_id(day).alias("date_id"))


@query(f"""
SELECT s_suppkey, sha256(s_name) AS name_key, {key('s_name', 's_nationkey')} AS pair_key FROM supplier
""")
def surrogate_key(spark, sf):
    return read_table(spark, sf, "supplier").select(
        "s_suppkey", name_key("s_name").alias("name_key"), composite_key("s_name", "s_nationkey").alias("pair_key")
    )


@query(f"SELECT {key('p_partkey', 'p_name', 'p_brand', 'p_type')} AS row_id, p_partkey FROM part")
def stable_row_id(spark, sf):
    return read_table(spark, sf, "part").select(
        composite_key("p_partkey", "p_name", "p_brand", "p_type").alias("row_id"), "p_partkey"
    )


@query("SELECT row_number() OVER (ORDER BY p_brand DESC, p_name, p_partkey) AS id, p_partkey, p_brand, p_name FROM part")
def sequential_id(spark, sf):
    """Dense numbers in a global order, given without a task that sees all rows."""
    part = read_table(spark, sf, "part").select("p_partkey", "p_brand", "p_name")
    return numbering.sequential_id(part, [F.desc("p_brand"), "p_name", "p_partkey"])


_MARKUP_SQL = (
    r"regexp_replace(regexp_replace(regexp_replace(regexp_replace(regexp_replace(text, '\*+', '', 'g'),"
    r" '#+', '', 'g'), '\[([^\]]+)\]\([^\)]+\)', '\1', 'g'), '(\p{Nd}+)\.', '\1', 'g'),"
    r" '^[\s\x0b\x1c-\x1f\x{85}\p{Z}]+|[\s\x0b\x1c-\x1f\x{85}\p{Z}]+$', '', 'g')"
)


@query(f"""
SELECT 'document' AS kind, doc_id AS id, 0 AS turn, {_MARKUP_SQL} AS speech FROM documents
UNION ALL SELECT 'chat', conv_id, turn, {_MARKUP_SQL} FROM conversations
""")
def clean_markdown(spark, sf):
    docs = read_spread(spark, sf, "documents", "doc_id").select(
        F.lit("document").alias("kind"), F.col("doc_id").alias("id"), F.lit(0).cast("bigint").alias("turn"), "text"
    )
    chats = read_table(spark, sf, "conversations").select(
        F.lit("chat").alias("kind"), F.col("conv_id").alias("id"), "turn", "text"
    )
    return docs.unionByName(chats).select(
        "kind", "id", "turn", cleaning.strip_markup(F.col("text")).alias("speech")
    )


# --- joins ------------------------------------------------------------------

@query("""
SELECT l_linenumber, o_orderkey, o_orderstatus, c_name, l_extendedprice
FROM lineitem JOIN orders ON l_orderkey = o_orderkey AND l_linestatus = o_orderstatus
  JOIN customer ON o_custkey = c_custkey
""")
def join_composite(spark, sf):
    lines = read_table(spark, sf, "lineitem").select("l_orderkey", "l_linestatus", "l_linenumber", "l_extendedprice")
    orders = read_table(spark, sf, "orders").select("o_orderkey", "o_orderstatus", "o_custkey")
    customer = read_table(spark, sf, "customer").select("c_custkey", "c_name")
    same = (lines.l_orderkey == orders.o_orderkey) & (lines.l_linestatus == orders.o_orderstatus)
    return (
        lines.join(orders.join(customer, F.col("o_custkey") == F.col("c_custkey")), same)
        .select("l_linenumber", "o_orderkey", "o_orderstatus", "c_name", "l_extendedprice")
    )


@query("""
SELECT c_custkey, c_name, n_name, r_name FROM customer
  JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey
""")
def star_inner(spark, sf):
    nation, region = read_table(spark, sf, "nation"), read_table(spark, sf, "region")
    return (
        read_table(spark, sf, "customer")
        .join(nation, F.col("c_nationkey") == nation.n_nationkey)
        .join(region, nation.n_regionkey == region.r_regionkey)
        .select("c_custkey", "c_name", "n_name", "r_name")
    )


@query("""
SELECT o_orderkey, c_name, n_name FROM orders
  LEFT JOIN (SELECT * FROM customer WHERE c_acctbal >= 0) c ON o_custkey = c_custkey
  LEFT JOIN nation ON c_nationkey = n_nationkey
""")
def star_left(spark, sf):
    customer = read_table(spark, sf, "customer").where("c_acctbal >= 0").select("c_custkey", "c_name", "c_nationkey")
    nation = read_table(spark, sf, "nation").select("n_nationkey", "n_name")
    return (
        read_table(spark, sf, "orders")
        .join(customer, F.col("o_custkey") == customer.c_custkey, "left")
        .join(nation, F.col("c_nationkey") == nation.n_nationkey, "left")
        .select("o_orderkey", "c_name", "n_name")
    )


@query("""
SELECT l_orderkey, l_linenumber, l.l_partkey, l.l_suppkey, returned
FROM lineitem l LEFT JOIN (
  SELECT l_partkey, l_suppkey, count(*) AS returned FROM lineitem WHERE l_returnflag = 'R' GROUP BY ALL) r
  ON l.l_partkey = r.l_partkey AND l.l_suppkey = r.l_suppkey
""")
def join_left_composite(spark, sf):
    lines = read_table(spark, sf, "lineitem")
    pair = ["l_partkey", "l_suppkey"]
    returned = lines.where("l_returnflag = 'R'").groupBy(*pair).agg(F.count(F.lit(1)).alias("returned"))
    rows = lines.select("l_orderkey", "l_linenumber", *pair)
    return lookup(rows, returned, pair, ["l_orderkey", "l_linenumber"], salts=1)  # about as many pairs as lines


@query(f"""
SELECT b.n_name AS buyer_nation, s.n_name AS seller_nation, count(*) AS lines, {exact("l_extendedprice")} AS volume
FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey
  JOIN supplier ON l_suppkey = s_suppkey
  JOIN nation b ON c_nationkey = b.n_nationkey JOIN nation s ON s_nationkey = s.n_nationkey
GROUP BY ALL
""")
def role_playing_dim(spark, sf):
    """One dimension in two roles; the fact is reduced before the names are joined.

    Orders learn their nation first, so the line items are shuffled once.
    """
    nation = read_table(spark, sf, "nation")
    buyer = nation.select(F.col("n_nationkey").alias("c_nationkey"), F.col("n_name").alias("buyer_nation"))
    seller = nation.select(F.col("n_nationkey").alias("s_nationkey"), F.col("n_name").alias("seller_nation"))
    origin = read_table(spark, sf, "orders").join(
        read_table(spark, sf, "customer"), F.expr("o_custkey = c_custkey")
    ).select("o_orderkey", "c_nationkey")
    volume = (
        read_table(spark, sf, "lineitem")
        .join(read_table(spark, sf, "supplier"), F.expr("l_suppkey = s_suppkey"))
        .join(origin, F.expr("l_orderkey = o_orderkey"))
        .groupBy("c_nationkey", "s_nationkey")
        .agg(F.count(F.lit(1)).alias("lines"), exact_sum("l_extendedprice").alias("volume"))
    )
    return volume.join(buyer, "c_nationkey").join(seller, "s_nationkey").select(
        "buyer_nation", "seller_nation", "lines", "volume"
    )


@query("SELECT o_custkey AS custkey, o_orderkey, c_name FROM orders JOIN customer ON o_custkey = c_custkey")
def join_using(spark, sf):
    orders = read_table(spark, sf, "orders").select(F.col("o_custkey").alias("custkey"), "o_orderkey")
    customer = read_table(spark, sf, "customer").select(F.col("c_custkey").alias("custkey"), "c_name")
    return orders.join(customer, "custkey")


@query(f"""
SELECT o_orderkey, o_custkey, o_totalprice FROM orders WHERE o_custkey IN (
  SELECT o_custkey FROM orders GROUP BY o_custkey ORDER BY {exact("o_totalprice")} DESC, o_custkey LIMIT 5)
""")
def topk_semi_join(spark, sf):
    orders = read_table(spark, sf, "orders").select("o_orderkey", "o_custkey", "o_totalprice")
    spend = orders.groupBy("o_custkey").agg(exact_sum("o_totalprice").alias("spend"))
    return topk.keep_top_groups(orders, "o_custkey", spend, [F.desc("spend"), F.asc("o_custkey")], 5)


# --- reductions -------------------------------------------------------------

@query("SELECT DISTINCT p_brand, p_type FROM part")
def distinct_dim(spark, sf):
    return read_table(spark, sf, "part").select("p_brand", "p_type").distinct()


@query("""
SELECT user_id, event_id, event_type, value, strftime(ts, '%Y-%m-%d %H:%M:%S') AS ts FROM events
QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY events.ts DESC, event_id DESC) = 1
""")
def latest_wins(spark, sf):
    events = read_table(spark, sf, "events").select("user_id", "event_id", "event_type", "value", "ts")
    return dedup.latest_by(events, ["user_id"], ["ts", "event_id"])


@query("""
SELECT user_id, value FROM events WHERE event_type <> 'error'
QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) = 1
""")
def last_not_null(spark, sf):
    """Latest reading of each user; error events carry none."""
    reading = F.when(F.col("event_type") != "error", F.col("value")).alias("value")
    events = read_table(spark, sf, "events").select("user_id", "ts", "event_id", reading)
    return bands.last_not_null(events, ["user_id"], "value", ["ts", "event_id"])


@query("""
SELECT strftime(d, '%Y%m%d')::INT AS date_id, strftime(d, '%Y-%m-%d') AS full_date, year(d)::INT AS year,
  month(d)::INT AS month, day(d)::INT AS day, weekofyear(d)::INT AS week_of_year, dayname(d) AS day_of_week,
  isodow(d) >= 6 AS is_weekend
FROM (SELECT unnest(generate_series(min(o_orderdate)::DATE, max(o_orderdate)::DATE, INTERVAL 1 DAY)) AS d FROM orders)
""")
def dim_date_calendar(spark, sf):
    """Calendar without gaps over the dates of the orders."""
    day = F.to_date("o_orderdate")
    bounds = read_table(spark, sf, "orders").agg(F.min(day).alias("start"), F.max(day).alias("end"))
    return performance.calendar_between(bounds)

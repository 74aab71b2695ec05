"""The registered queries over the driver's tables, each with its DuckDB twin where SQL can express it.

Targets are perturbed copies of the tables by modulus, which both engines can write down.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions import convert as C
from tidemark.functions import geometry, tokens
from tidemark.operators import filters, guardrail, merge, metrics, ranges, reconcile
from tidemark.operators.mapping import Mapping
from tidemark.plans import jobs, tracking
from tidemark.sources import generate, plugin, reports, tables
from tidemark.session import scratch_path, stored
from tidemark.spec import Explode, Extract, JobSpec, TableSpec
from tidemark.streaming import monitor

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLE: dict[str, str] = {}


def query(sql: str | None = None) -> Callable[[Query], Query]:
    def add(f: Query) -> Query:
        QUERIES[f.__name__] = f
        if sql:
            ORACLE[f.__name__] = sql
        return f

    return add


def queries() -> dict[str, Query]:
    return dict(QUERIES)


def oracle_sql() -> dict[str, str]:
    return dict(ORACLE)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


# Perturbed targets


def orders_target(orders: DataFrame) -> DataFrame:
    return orders.where("o_orderkey % 97 <> 0").withColumn("o_totalprice", F.when(F.col("o_orderkey") % 89 == 0, F.col("o_totalprice") + 1).otherwise(F.col("o_totalprice")))


ORDERS_T = """t AS (SELECT o_orderkey, o_custkey, o_orderstatus, CASE WHEN o_orderkey % 89 = 0 THEN o_totalprice + 1 ELSE o_totalprice END AS o_totalprice,
  o_orderdate, o_orderpriority FROM orders WHERE o_orderkey % 97 <> 0)"""
CHECKED = f"""{ORDERS_T}, v AS (SELECT o.*, CASE WHEN t.o_orderkey IS NULL THEN 'MISSING' WHEN o.o_totalprice IS DISTINCT FROM t.o_totalprice THEN 'MISMATCH' ELSE 'VALID' END AS outcome
  FROM orders o LEFT JOIN t ON o.o_orderkey = t.o_orderkey)"""
TOKEN = "('0x' || substr(md5(CAST(o_orderkey AS VARCHAR)), 1, 15))::BIGINT"


def checked_orders(spark: SparkSession, sf_dir: str, keep: list[str] | None = None) -> DataFrame:
    orders = table(spark, sf_dir, "orders")
    return reconcile.validate(orders, orders_target(orders), ["o_orderkey"], keep=keep)


@query(f"""WITH {CHECKED} SELECT count(*) AS n_read, count(*) FILTER (outcome = 'MISSING') AS n_missing, count(*) FILTER (outcome = 'MISMATCH') AS n_mismatch,
  count(*) FILTER (outcome = 'VALID') AS n_valid, CAST(0 AS BIGINT) AS n_corrected_missing, CAST(0 AS BIGINT) AS n_corrected_mismatch, count(*) FILTER (outcome <> 'VALID') AS outstanding, CASE WHEN bool_and(outcome = 'VALID') THEN 'PASS' ELSE 'DIFF' END AS verdict, CASE WHEN bool_and(outcome = 'VALID') THEN 0 ELSE 1 END AS exit_code FROM v""")
def validate_orders_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    by = jobs.validation_counters(checked_orders(spark, sf_dir), [], JobSpec()).drop("n_error")
    out = by.withColumn("outstanding", metrics.outstanding())
    return out.withColumn("exit_code", metrics.exit_code(F.lit("ENDED"), F.lit(0), F.col("outstanding"), F.lit(0)))


@query(f"""WITH {CHECKED} SELECT o_orderkey, outcome, CASE WHEN outcome = 'MISMATCH' THEN 'Target column:o_totalprice-origin[<redacted>]-target[<redacted>]; ' ELSE '' END AS detail FROM v WHERE outcome <> 'VALID'""")
def validate_orders_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return checked_orders(spark, sf_dir).where("outcome <> 'VALID'").select("o_orderkey", "outcome", reconcile.detail(F.col("differences")).alias("detail"))


@query(f"WITH {ORDERS_T} SELECT CASE WHEN t.o_orderkey IS NULL THEN 'MISSING' ELSE 'VALID' END AS outcome, count(*) AS n_rows FROM orders o LEFT JOIN t ON o.o_orderkey = t.o_orderkey GROUP BY 1")
def validate_keys_only(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders")
    return reconcile.keys_only(orders, orders_target(orders), ["o_orderkey"]).groupBy("outcome").agg(F.count("*").alias("n_rows"))


RANGE_ID = f"CAST(({TOKEN} - 0) // ((1152921504606846975 - 0) // 64 + 1) AS BIGINT)"


@query(f"""WITH {CHECKED}, r AS (SELECT {RANGE_ID} AS range_id, outcome FROM v)
SELECT range_id, count(*) AS n_read, count(*) FILTER (outcome = 'MISSING') AS n_missing, count(*) FILTER (outcome = 'MISMATCH') AS n_mismatch, count(*) FILTER (outcome = 'VALID') AS n_valid,
  CASE WHEN count(*) FILTER (outcome <> 'VALID') = 0 THEN 'PASS' ELSE 'DIFF' END AS verdict FROM r GROUP BY range_id""")
def validate_by_range(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = checked_orders(spark, sf_dir).withColumn("range_id", ranges.range_of(tokens.token60("o_orderkey"), *tokens.RING60, 64))
    return jobs.validation_counters(rows, ["range_id"], JobSpec()).select("range_id", "n_read", "n_missing", "n_mismatch", "n_valid", "verdict")


@query("""WITH s AS (SELECT l_orderkey, l_linenumber FROM lineitem) SELECT l_orderkey, l_linenumber, count(*) AS n FROM s GROUP BY ALL HAVING count(*) > 1""")
def duplicate_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    return merge.duplicate_keys(table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber"), ["l_orderkey", "l_linenumber"])


@query(f"""WITH {ORDERS_T}, o AS (SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderdate, CASE WHEN o_orderkey % 83 = 0 THEN NULL ELSE o_orderpriority END AS o_orderpriority FROM orders),
k AS (SELECT * FROM t UNION ALL SELECT o_orderkey + 100000000, o_custkey, o_orderstatus, o_totalprice, o_orderdate, o_orderpriority FROM orders WHERE o_orderkey % 101 = 0)
SELECT coalesce(o.o_orderkey, k.o_orderkey) AS o_orderkey, coalesce(o.o_custkey, k.o_custkey) AS o_custkey, coalesce(o.o_orderstatus, k.o_orderstatus) AS o_orderstatus, coalesce(o.o_totalprice, k.o_totalprice) AS o_totalprice,
  coalesce(o.o_orderdate, k.o_orderdate) AS o_orderdate, coalesce(o.o_orderpriority, k.o_orderpriority) AS o_orderpriority FROM o FULL JOIN k ON o.o_orderkey = k.o_orderkey""")
def autocorrect_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Missing and differing rows are repaired; rows of the target alone stay, and cells that the origin leaves unset keep theirs."""
    orders = table(spark, sf_dir, "orders")
    spec = TableSpec.of(orders, "orders", ["o_orderkey"])
    origin = orders.withColumn("o_orderpriority", F.when(F.col("o_orderkey") % 83 != 0, F.col("o_orderpriority")))
    lone = orders.where("o_orderkey % 101 = 0").withColumn("o_orderkey", F.col("o_orderkey") + 100_000_000)
    target = orders_target(orders).unionByName(lone)
    return jobs.autocorrect(origin, target, spec, spec, JobSpec(autocorrect_missing=True, autocorrect_mismatch=True))[1]


@query(f"""WITH {ORDERS_T} SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderdate, o_orderpriority FROM t
UNION ALL SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderdate, o_orderpriority FROM orders WHERE o_orderkey % 97 = 0""")
def autocorrect_missing_only(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders")
    spec = TableSpec.of(orders, "orders", ["o_orderkey"])
    return jobs.autocorrect(orders, orders_target(orders), spec, spec, JobSpec(autocorrect_missing=True))[1]


@query("""WITH t AS (SELECT c_custkey, c_name, c_custkey * 1000 % 7 AS wt FROM customer WHERE c_custkey % 5 <> 0),
w AS (SELECT c_custkey, CASE WHEN c_custkey % 11 = 0 THEN NULL ELSE upper(c_name) || '!' END AS c_name, CAST(3 AS BIGINT) AS wt FROM customer WHERE c_custkey % 3 <> 0)
SELECT coalesce(t.c_custkey, w.c_custkey) AS c_custkey,
  CASE WHEN w.c_custkey IS NULL OR w.c_name IS NULL OR t.wt > 3 OR (t.wt = 3 AND t.c_name > w.c_name) THEN t.c_name ELSE w.c_name END AS c_name,
  CAST(CASE WHEN w.c_custkey IS NULL OR w.c_name IS NULL OR t.wt > 3 OR (t.wt = 3 AND t.c_name > w.c_name) THEN t.wt ELSE 3 END AS BIGINT) AS c_name__wt
FROM t FULL JOIN w ON t.c_custkey = w.c_custkey""")
def merge_lww_customer(spark: SparkSession, sf_dir: str) -> DataFrame:
    customer = table(spark, sf_dir, "customer")
    target = customer.where("c_custkey % 5 <> 0").select("c_custkey", "c_name", (F.col("c_custkey") * 1000 % 7).cast("long").alias("c_name__wt"))
    name = F.when(F.col("c_custkey") % 11 == 0, None).otherwise(F.concat(F.upper("c_name"), F.lit("!")))
    writes = customer.where("c_custkey % 3 <> 0").select("c_custkey", name.alias("c_name"), F.lit(3).cast("long").alias("_writetime"))
    writes = writes.withColumn("_unset", F.array_compact(F.array(F.when(F.col("c_name").isNull(), F.lit("c_name")))))
    return merge.upsert(target, writes, ["c_custkey"], ["c_name"])


@query("""WITH o AS (SELECT user_id, count(*) AS n_events FROM events GROUP BY user_id), t AS (SELECT user_id, count(*) AS n_events FROM events WHERE event_id % 2 = 0 AND user_id % 10 <> 0 GROUP BY user_id)
SELECT o.user_id, o.n_events - coalesce(t.n_events, 0) AS n_events__delta, o.n_events AS n_events FROM o LEFT JOIN t ON o.user_id = t.user_id""")
def counter_delta_user(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = table(spark, sf_dir, "events")
    count = lambda e: e.groupBy("user_id").agg(F.count("*").alias("n_events"))
    return merge.counter_updates(count(events), count(events.where("event_id % 2 = 0 and user_id % 10 <> 0")), ["user_id"], ["n_events"]).drop("_error")


@query("""WITH b AS (SELECT s_suppkey, s_name, CASE WHEN s_suppkey % 7 = 0 THEN s_nationkey + 1 ELSE s_nationkey END AS s_nationkey FROM supplier WHERE s_suppkey % 13 <> 0
  UNION ALL SELECT s_suppkey + 1000000, s_name, s_nationkey FROM supplier WHERE s_suppkey % 17 = 0)
SELECT coalesce(a.s_suppkey, b.s_suppkey) AS s_suppkey, CASE WHEN b.s_suppkey IS NULL THEN 'only_in_a' WHEN a.s_suppkey IS NULL THEN 'only_in_b' ELSE 'value' END AS kind,
  CASE WHEN a.s_suppkey IS NULL OR b.s_suppkey IS NULL THEN NULL ELSE 's_nationkey' END AS "column",
  CASE WHEN a.s_suppkey IS NULL OR b.s_suppkey IS NULL THEN NULL ELSE CAST(a.s_nationkey AS VARCHAR) END AS a, CASE WHEN a.s_suppkey IS NULL OR b.s_suppkey IS NULL THEN NULL ELSE CAST(b.s_nationkey AS VARCHAR) END AS b
FROM supplier a FULL JOIN b ON a.s_suppkey = b.s_suppkey WHERE a.s_suppkey IS NULL OR b.s_suppkey IS NULL OR a.s_nationkey <> b.s_nationkey""")
def snapshot_diff_supplier(spark: SparkSession, sf_dir: str) -> DataFrame:
    a = table(spark, sf_dir, "supplier").select("s_suppkey", "s_name", "s_nationkey")
    moved = a.where("s_suppkey % 17 = 0").withColumn("s_suppkey", (F.col("s_suppkey") + 1000000).cast(a.schema["s_suppkey"].dataType))
    b = a.where("s_suppkey % 13 <> 0").withColumn("s_nationkey", F.when(F.col("s_suppkey") % 7 == 0, F.col("s_nationkey") + 1).otherwise(F.col("s_nationkey")))
    return reconcile.snapshot_diff(a, b.unionByName(moved), ["s_suppkey"])


@query("""SELECT p_partkey, CAST(CASE WHEN p_partkey % 4 = 0 THEN NULL WHEN p_partkey % 4 = 1 THEN 100 ELSE 102 END AS INTEGER) AS a, CAST(CASE WHEN p_partkey % 4 = 0 THEN 100 WHEN p_partkey % 4 = 1 THEN NULL ELSE 100 END AS INTEGER) AS b FROM part
WHERE p_partkey % 4 IN (0, 1)""")
def snapshot_ttl_tolerance(spark: SparkSession, sf_dir: str) -> DataFrame:
    part = table(spark, sf_dir, "part")
    k = F.col("p_partkey") % 4
    a = part.select("p_partkey", F.when(k == 0, None).when(k == 1, 100).otherwise(102).cast("int").alias("v__ttl"))
    b = part.select("p_partkey", F.when(k == 0, 100).when(k == 1, None).otherwise(100).cast("int").alias("v__ttl"))
    return reconcile.snapshot_diff(a, b, ["p_partkey"], ttl_within=5).select("p_partkey", F.col("a").cast("int").alias("a"), F.col("b").cast("int").alias("b"))


@query("""WITH o AS (SELECT o_custkey AS k, CASE WHEN o_custkey % 4 = 0 THEN NULL ELSE count(*) END AS n FROM orders GROUP BY o_custkey), t AS (SELECT o_custkey AS k, CASE WHEN o_custkey % 3 = 0 THEN NULL ELSE 2 * count(*) END AS n FROM orders WHERE o_custkey % 5 <> 0 GROUP BY o_custkey)
SELECT o.k, o.n - coalesce(t.n, 0) AS n__delta, coalesce(o.n, t.n) AS n FROM o LEFT JOIN t ON o.k = t.k""")
def counter_nulls(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counters that are null on either side: a null adds nothing, and leaves a null."""
    counted = table(spark, sf_dir, "orders").groupBy(F.col("o_custkey").alias("k")).agg(F.count("*").alias("n"))
    o = counted.withColumn("n", F.when(F.col("k") % 4 != 0, F.col("n")))
    t = counted.where("k % 5 <> 0").withColumn("n", F.when(F.col("k") % 3 != 0, 2 * F.col("n")))
    return merge.counter_updates(o, t, ["k"], ["n"]).drop("_error")


@query("""SELECT o_orderkey, CASE WHEN o_orderkey % 4 = 0 THEN 'Target column:o_custkey-origin[<redacted>]-target[<redacted>]; ' WHEN o_orderkey % 4 = 1 THEN 'Target column:o_custkey origin is null, target is <redacted>; '
  WHEN o_orderkey % 4 = 2 THEN 'Target column:o_custkey-origin[<redacted>]-target[null]; ' ELSE 'Target column:o_custkey Exception BIGINT_STRING; ' END AS detail FROM orders""")
def mismatch_details(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The four forms of a mismatch: values, a null on either side, and a target that can't be converted back."""
    k = F.col("o_orderkey") % 4
    orders = table(spark, sf_dir, "orders").select("o_orderkey", F.when(k != 1, F.col("o_custkey").cast("long")).alias("o_custkey"))
    target = table(spark, sf_dir, "orders").select("o_orderkey", F.when(k == 3, "x").when(k != 2, (F.col("o_custkey") + 1).cast("string")).alias("o_custkey"))
    checked = reconcile.validate(orders, target, ["o_orderkey"], codecs=C.builtin(frozenset({"BIGINT_STRING"})))
    return checked.select("o_orderkey", reconcile.detail(F.col("differences")).alias("detail"))


# Mapping


def schema(text: str) -> T.StructType:
    return T._parse_datatype_string(text)


@query("SELECT 7 AS region_id, c_custkey AS cust, c_name, c_nationkey AS nation, 'it''s' AS note, CAST(NULL AS INTEGER) AS unknown FROM customer")
def map_rename_constants(spark: SparkSession, sf_dir: str) -> DataFrame:
    customer = table(spark, sf_dir, "customer")
    target = TableSpec("clients", schema(f"region_id int, cust {dict(customer.dtypes)['c_custkey']}, c_name string, nation int, note string, unknown int"), ("region_id", "cust"))
    job = JobSpec(renames=[("c_custkey", "cust"), ("c_nationkey", "nation")], constants={"region_id": "7", "note": "'it''s'"}, skip=["c_acctbal"])
    return jobs.migrate(customer, TableSpec.of(customer, "customer", ["c_custkey"]), target, job).rows.select("region_id", "cust", "c_name", "nation", "note", "unknown")


@query("SELECT p_partkey, p_brand FROM part")
def map_drop_origin_only(spark: SparkSession, sf_dir: str) -> DataFrame:
    part = table(spark, sf_dir, "part")
    target = TableSpec("brands", T.StructType([part.schema["p_partkey"], part.schema["p_brand"]]), ("p_partkey",))
    return jobs.migrate(part, TableSpec.of(part, "part", ["p_partkey"]), target, JobSpec()).rows.select("p_partkey", "p_brand")


@query("""WITH v AS (SELECT * FROM (VALUES ('c_custkey', 'bigint', 'c_custkey', 'same', 'bigint', 'passthrough'), ('label', 'string', 'c_name', 'renamed', 'string', 'passthrough'),
  ('nation', 'string', 'c_nationkey', 'renamed', 'int', 'INT_STRING'), ('zone', 'int', NULL, 'constant', 'int', 'passthrough'), (NULL, NULL, 'c_acctbal', 'origin only', 'double', NULL),
  (NULL, NULL, 'c_mktsegment', 'origin only', 'string', NULL)) v(target, target_type, source, kind, origin_type, conversion)),
n AS (SELECT 'c_custkey' AS c, count(c_custkey) AS n FROM customer UNION ALL SELECT 'c_name', count(c_name) FROM customer UNION ALL SELECT 'c_nationkey', count(c_nationkey) FROM customer
  UNION ALL SELECT 'c_acctbal', count(c_acctbal) FROM customer UNION ALL SELECT 'c_mktsegment', count(c_mktsegment) FROM customer)
SELECT v.*, n.n AS n_values FROM v LEFT JOIN n ON v.source = n.c""")
def mapping_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The mapping, and of each origin column how many rows have a value to map."""
    customer = table(spark, sf_dir, "customer")
    target = TableSpec("t", schema("c_custkey bigint, label string, nation string, zone int"), ("c_custkey",))
    job = JobSpec(renames=[("c_name", "label"), ("c_nationkey", "nation")], constants={"zone": "1"}, codecs=frozenset({"INT_STRING"}))
    mapping = Mapping.resolve(TableSpec.of(customer, "customer", ["c_custkey"]), target, job)
    counted = customer.agg(*(F.count(c).alias(c) for c in customer.columns))
    values = counted.select(F.explode(F.array(*(F.struct(F.lit(c).alias("_column"), F.col(c).alias("n_values")) for c in customer.columns))).alias("e")).select("e.*")
    return mapping.table(customer).join(values, F.col("source") == F.col("_column"), "left").drop("_column")


@query("""SELECT coalesce(CASE WHEN c_custkey % 3 = 0 THEN NULL ELSE c_name END, '') AS name, CASE WHEN c_custkey % 5 = 0 THEN NULL ELSE c_nationkey END AS nation, c_custkey,
  CASE WHEN c_custkey % 5 = 0 THEN 'ERROR' ELSE 'WRITE' END AS outcome FROM customer""")
def null_key_substitute(spark: SparkSession, sf_dir: str) -> DataFrame:
    customer = table(spark, sf_dir, "customer")
    origin = customer.select("c_custkey", F.when(F.col("c_custkey") % 3 != 0, F.col("c_name")).alias("name"), F.when(F.col("c_custkey") % 5 != 0, F.col("c_nationkey")).alias("nation"))
    target = TableSpec.of(origin, "t", ["name"], ["nation", "c_custkey"])
    return jobs.migrate(origin, TableSpec.of(origin, "o", ["c_custkey"]), target, JobSpec()).rows.select("name", "nation", "c_custkey", "outcome")


def with_sizes(part: DataFrame) -> DataFrame:
    entries = F.create_map(F.lit("size"), F.col("p_size").cast("int"), F.lit("name"), F.length("p_name"), F.lit("brand"), F.length("p_brand"))
    return part.select("p_partkey", F.when(F.col("p_partkey") % 10 != 0, entries).alias("sizes"))


@query("""WITH o AS (SELECT p_partkey, unnest([{'k': 'size', 'v': CAST(p_size AS INTEGER)}, {'k': 'name', 'v': CAST(length(p_name) AS INTEGER)}, {'k': 'brand', 'v': CAST(length(p_brand) AS INTEGER)}]) AS e FROM part WHERE p_partkey % 10 <> 0),
x AS (SELECT p_partkey, e.k AS measure, e.v AS amount, CASE WHEN p_partkey % 7 = 0 AND e.k = 'size' THEN 'MISSING' WHEN p_partkey % 6 = 0 AND e.k = 'name' THEN 'MISMATCH' ELSE 'VALID' END AS outcome FROM o)
SELECT measure, outcome, count(*) AS n_rows FROM x GROUP BY ALL""")
def explode_map_validate(spark: SparkSession, sf_dir: str) -> DataFrame:
    origin = with_sizes(table(spark, sf_dir, "part"))
    spec = TableSpec.of(origin, "sizes", ["p_partkey"])
    target_spec = TableSpec("measures", schema(f"p_partkey {dict(origin.dtypes)['p_partkey']}, measure string, amount int"), ("p_partkey",), ("measure",))
    job = JobSpec(explode=Explode("sizes", "measure", "amount"))
    target = jobs.migrate(origin, spec, target_spec, job).rows.select("p_partkey", "measure", "amount").where("not (p_partkey % 7 = 0 and measure = 'size')")
    target = target.withColumn("amount", F.when((F.col("p_partkey") % 6 == 0) & (F.col("measure") == "name"), F.col("amount") + 1).otherwise(F.col("amount")))
    return jobs.validate(origin, target, spec, target_spec, job).groupBy("measure", "outcome").agg(F.count("*").alias("n_rows"))


@query("""SELECT count(*) AS n_read, 3 * count(*) FILTER (p_partkey % 10 <> 0) AS n_write, count(*) FILTER (p_partkey % 10 = 0) AS n_skipped, CAST(0 AS BIGINT) AS n_error FROM part""")
def explode_map_counters(spark: SparkSession, sf_dir: str) -> DataFrame:
    origin = with_sizes(table(spark, sf_dir, "part"))
    target = TableSpec("measures", schema(f"p_partkey {dict(origin.dtypes)['p_partkey']}, measure string, amount int"), ("p_partkey",), ("measure",))
    return jobs.migrate(origin, TableSpec.of(origin, "sizes", ["p_partkey"]), target, JobSpec(explode=Explode("sizes", "measure", "amount"))).counters()


DOCS = """d AS (SELECT event_id, CASE WHEN event_id % 7 = 0 THEN '{"k": null}' WHEN event_id % 7 = 1 THEN '{}' WHEN event_id % 7 = 2 THEN '{"k": ' WHEN event_id % 7 = 3 THEN NULL ELSE props END AS props FROM events)"""


def json_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("event_id") % 7
    return table(spark, sf_dir, "events").select("event_id", F.when(k == 0, '{"k": null}').when(k == 1, "{}").when(k == 2, '{"k": ').when(k == 3, None).otherwise(F.col("props")).alias("props"))


@query(f"""WITH {DOCS} SELECT event_id, CASE WHEN event_id % 7 > 3 THEN CAST(json_extract_string(props, '$.k') AS BIGINT) END AS k, CASE WHEN event_id % 7 = 2 THEN 'ERROR' ELSE 'WRITE' END AS outcome FROM d""")
def extract_json_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    origin = json_events(spark, sf_dir)
    target = TableSpec("t", schema("event_id bigint, k bigint"), ("event_id",))
    job = JobSpec(extract=Extract.parse("props", "k:k"))
    return jobs.migrate(origin, TableSpec.of(origin, "events", ["event_id"]), target, job).rows.select("event_id", "k", "outcome")


@query(f"""WITH {DOCS} SELECT event_id, CASE WHEN event_id % 2 = 0 THEN -1 WHEN event_id % 7 > 3 THEN CAST(json_extract_string(props, '$.k') AS BIGINT) END AS k FROM d""")
def extract_json_backfill(spark: SparkSession, sf_dir: str) -> DataFrame:
    origin = json_events(spark, sf_dir)
    target = origin.select("event_id", F.when(F.col("event_id") % 2 == 0, F.lit(-1).cast("long")).alias("k"))
    spec = TableSpec.of(target, "t", ["event_id"])
    job = JobSpec(extract=Extract.parse("props", "k:k", overwrite=False, exclusive=True))
    return jobs.migrate(origin, TableSpec.of(origin, "events", ["event_id"]), spec, job).merged(target)


@query("""SELECT c_custkey, greatest(CASE WHEN c_custkey % 2 = 0 THEN c_custkey * 10 END, CASE WHEN c_custkey % 3 = 0 THEN c_custkey * 20 END) + 5 AS writetime,
  CAST(coalesce(greatest(CASE WHEN c_custkey % 2 = 0 THEN c_custkey % 100 END, CASE WHEN c_custkey % 3 = 0 THEN c_custkey % 50 END), 0) AS INTEGER) AS ttl FROM customer""")
def row_writetime_ttl(spark: SparkSession, sf_dir: str) -> DataFrame:
    key = F.col("c_custkey")
    origin = table(spark, sf_dir, "customer").select("c_custkey", F.col("c_name").alias("a"), F.col("c_mktsegment").alias("b"), F.when(key % 2 == 0, key * 10).cast("long").alias("a__wt"), F.when(key % 3 == 0, key * 20).cast("long").alias("b__wt"), F.when(key % 2 == 0, key % 100).cast("int").alias("a__ttl"), F.when(key % 3 == 0, key % 50).cast("int").alias("b__ttl"))
    target = TableSpec("t", schema("c_custkey bigint, a string, b string"), ("c_custkey",))
    rows = jobs.migrate(origin, TableSpec.of(origin, "o", ["c_custkey"]), target, JobSpec(writetime_increment=5)).rows
    return rows.select("c_custkey", F.col("_writetime").alias("writetime"), F.col("_ttl").alias("ttl"))


# Conversions


def converted(df: DataFrame, kind: T.DataType, codec: str, **options: str) -> DataFrame:
    c = C.convert(F.col("v"), df.schema["v"].dataType, kind, C.builtin(frozenset({codec}), **options))
    return df.select("id", c.value.alias("v"), F.coalesce(c.failed, F.lit(False)).alias("failed"))


INTS = "CASE WHEN o_orderkey % 5 = 0 THEN ' 12' WHEN o_orderkey % 5 = 1 THEN '99999999999' WHEN o_orderkey % 5 = 2 THEN NULL WHEN o_orderkey % 5 = 3 THEN '-' || o_orderkey ELSE CAST(o_orderkey AS VARCHAR) END"


@query(f"WITH x AS (SELECT o_orderkey AS id, {INTS} AS s FROM orders) SELECT id, CASE WHEN regexp_matches(s, '^[+-]?[0-9]+$') THEN TRY_CAST(s AS INTEGER) END AS v, s IS NOT NULL AND (CASE WHEN regexp_matches(s, '^[+-]?[0-9]+$') THEN TRY_CAST(s AS INTEGER) END) IS NULL AS failed FROM x")
def codec_int(spark: SparkSession, sf_dir: str) -> DataFrame:
    return converted(table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("id"), F.expr(INTS.replace("VARCHAR", "STRING")).alias("v")), T.IntegerType(), "INT_STRING")


@query(f"WITH x AS (SELECT o_orderkey AS id, {INTS} AS s FROM orders) SELECT id, CASE WHEN regexp_matches(s, '^[+-]?[0-9]+$') THEN TRY_CAST(s AS BIGINT) END AS v, s IS NOT NULL AND (CASE WHEN regexp_matches(s, '^[+-]?[0-9]+$') THEN TRY_CAST(s AS BIGINT) END) IS NULL AS failed FROM x")
def codec_bigint(spark: SparkSession, sf_dir: str) -> DataFrame:
    return converted(table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("id"), F.expr(INTS.replace("VARCHAR", "STRING")).alias("v")), T.LongType(), "BIGINT_STRING")


@query("SELECT o_orderkey AS id, CAST(o_orderkey % 1000 AS VARCHAR) || CASE o_orderkey % 4 WHEN 0 THEN '' WHEN 1 THEN '.25' WHEN 2 THEN '.5' ELSE '.75' END AS v, FALSE AS failed FROM orders")
def codec_double(spark: SparkSession, sf_dir: str) -> DataFrame:
    value = (F.col("o_orderkey") % 1000 + (F.col("o_orderkey") % 4) * 0.25).cast("double")
    return converted(table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("id"), value.alias("v")), T.StringType(), "DOUBLE_STRING")


@query("SELECT o_orderkey AS id, CASE WHEN o_orderkey % 6 = 0 THEN NULL ELSE CAST(o_orderkey AS DECIMAL(18,3)) / 1000 END::DECIMAL(18,3) AS v, o_orderkey % 6 = 0 AS failed FROM orders")
def codec_decimal(spark: SparkSession, sf_dir: str) -> DataFrame:
    text = F.when(F.col("o_orderkey") % 6 == 0, "1,5").otherwise((F.col("o_orderkey").cast("decimal(18,3)") / 1000).cast("decimal(18,3)").cast("string"))
    return converted(table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("id"), text.alias("v")), T.DecimalType(18, 3), "DECIMAL_STRING")


@query("SELECT event_id AS id, CAST(epoch_us(ts) // 1000 AS VARCHAR) AS v, FALSE AS failed FROM events")
def codec_ts_millis(spark: SparkSession, sf_dir: str) -> DataFrame:
    return converted(table(spark, sf_dir, "events").select(F.col("event_id").alias("id"), F.col("ts").cast("timestamp").alias("v")), T.StringType(), "TIMESTAMP_STRING_MILLIS")


@query("SELECT event_id AS id, strftime(ts, '%y%m%d%H%M%S') AS v, FALSE AS failed FROM events")
def codec_ts_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    return converted(table(spark, sf_dir, "events").select(F.col("event_id").alias("id"), F.col("ts").cast("timestamp").alias("v")), T.StringType(), "TIMESTAMP_STRING_FORMAT", timestamp_format="yyMMddHHmmss", zone="UTC")


@query("""SELECT o_orderkey AS id, CASE WHEN o_orderkey % 2 = 0 THEN o_orderkey ELSE -o_orderkey END AS v, FALSE AS failed FROM orders""")
def codec_bigint_wide(spark: SparkSession, sf_dir: str) -> DataFrame:
    span = F.lit("18446744073709551616").cast("decimal(38,0)")
    key = F.col("o_orderkey").cast("decimal(38,0)")
    value = F.when(F.col("o_orderkey") % 2 == 0, key + span).otherwise(-key)
    return converted(table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("id"), value.cast("decimal(38,0)").alias("v")), T.LongType(), "BIGINT_BIGINTEGER")


@query(f"""WITH x AS (SELECT o_orderkey, {INTS} AS a, CASE WHEN o_orderkey % 11 = 0 THEN 'x' ELSE CAST(o_custkey AS VARCHAR) END AS b FROM orders)
SELECT 'a' AS "column", count(*) AS n_errors FROM x WHERE a IS NOT NULL AND (NOT regexp_matches(a, '^[+-]?[0-9]+$') OR TRY_CAST(a AS INTEGER) IS NULL) UNION ALL
SELECT 'b', count(*) FROM x WHERE NOT regexp_matches(b, '^[+-]?[0-9]+$')""")
def convert_orders_errors(spark: SparkSession, sf_dir: str) -> DataFrame:
    key = F.col("o_orderkey")
    origin = table(spark, sf_dir, "orders").select("o_orderkey", F.expr(INTS.replace("VARCHAR", "STRING")).alias("a"), F.when(key % 11 == 0, "x").otherwise(F.col("o_custkey").cast("string")).alias("b"))
    return jobs.convert_table(origin, schema("o_orderkey bigint, a int, b bigint"), frozenset({"INT_STRING", "BIGINT_STRING"}), ["o_orderkey"])[2]


DOUBLES = "CASE o_orderkey % 6 WHEN 0 THEN -0.5 - o_orderkey WHEN 1 THEN 'NaN'::DOUBLE WHEN 2 THEN -0.0::DOUBLE WHEN 3 THEN 'Infinity'::DOUBLE WHEN 4 THEN o_orderkey * 1e15 ELSE o_orderkey END"


@query("""SELECT o_orderkey AS id, CASE o_orderkey % 6 WHEN 0 THEN '-' || o_orderkey || '.5' WHEN 1 THEN 'NaN' WHEN 2 THEN '-0' WHEN 3 THEN chr(8734) WHEN 4 THEN o_orderkey || '000000000000000' ELSE CAST(o_orderkey AS VARCHAR) END AS text,
  o_orderkey % 6 = 1 AS is_nan, CASE o_orderkey % 6 WHEN 0 THEN -2 * o_orderkey - 1 WHEN 5 THEN 2 * o_orderkey END AS doubled FROM orders""")
def codec_double_both(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Negative, large and special doubles to text, and the texts back to doubles."""
    k, key = F.col("o_orderkey") % 6, F.col("o_orderkey").cast("double")
    value = F.when(k == 0, -0.5 - key).when(k == 1, float("nan")).when(k == 2, F.lit(-0.0)).when(k == 3, float("inf")).when(k == 4, key * 1e15).otherwise(key)
    text = converted(table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("id"), value.alias("v")), T.StringType(), "DOUBLE_STRING")
    back = converted(text.select("id", "v"), T.DoubleType(), "DOUBLE_STRING").select(F.col("id").alias("_id"), F.col("v").alias("back"))
    both = text.join(back, F.col("id") == F.col("_id"))
    plain = F.when((F.col("id") % 6).isin(0, 5), (2 * F.col("back")).cast("long"))
    return both.select("id", F.col("v").alias("text"), F.isnan("back").alias("is_nan"), plain.alias("doubled"))


@query("""SELECT o_orderkey AS id, CAST(CAST(o_orderkey AS INTEGER) AS VARCHAR) AS i, CAST(CAST(-3000000000 AS BIGINT) - o_orderkey AS VARCHAR) AS l, CAST(o_orderkey // 100 AS VARCHAR) || '.' || lpad(CAST(o_orderkey % 100 AS VARCHAR), 2, '0') AS d, CAST(o_orderkey AS BIGINT) AS wide FROM orders""")
def codec_numbers_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Numbers to text and to a wider type, the other way round than the queries before."""
    key = F.col("o_orderkey")
    orders = table(spark, sf_dir, "orders").select(key.alias("id"), key.cast("int").alias("i"), (F.lit(-3_000_000_000) - key).cast("long").alias("l"), (key.cast("decimal(18,2)") / 100).cast("decimal(18,2)").alias("d"), key.cast("long").alias("w"))
    codecs = C.builtin(frozenset({"INT_STRING", "BIGINT_STRING", "DECIMAL_STRING", "BIGINT_BIGINTEGER"}))
    to = lambda c, kind: C.convert(F.col(c), orders.schema[c].dataType, kind, codecs).value
    return orders.select("id", to("i", T.StringType()).alias("i"), to("l", T.StringType()).alias("l"), to("d", T.StringType()).alias("d"), to("w", T.DecimalType(38, 0)).cast("long").alias("wide"))


@query("""SELECT event_id AS id, epoch_us(ts) // 1000 AS by_millis, epoch_us(date_trunc('second', ts)) // 1000 AS by_format, event_id % 5 = 0 AS failed FROM events""")
def codec_ts_parse(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Texts of milliseconds and of a pattern to timestamps; every fifth text is none."""
    ts = F.col("ts").cast("timestamp")
    events = table(spark, sf_dir, "events").select(F.col("event_id").alias("id"), F.unix_millis(ts).cast("string").alias("m"), F.date_format(ts, "yyyyMMddHHmmss").alias("f"), F.when(F.col("event_id") % 5 == 0, "soon").otherwise(F.unix_millis(ts).cast("string")).alias("bad"))
    of = lambda c, name, **o: C.convert(F.col(c), T.StringType(), T.TimestampType(), C.builtin(frozenset({name}), **o))
    millis, form, bad = of("m", "TIMESTAMP_STRING_MILLIS"), of("f", "TIMESTAMP_STRING_FORMAT", timestamp_format="yyyyMMddHHmmss", zone="UTC"), of("bad", "TIMESTAMP_STRING_MILLIS")
    return events.select("id", F.unix_millis(millis.value).alias("by_millis"), F.unix_millis(form.value).alias("by_format"), F.coalesce(bad.failed, F.lit(False)).alias("failed"))


@query("""SELECT c_custkey AS id, hex(encode(c_name)) AS blob, CASE WHEN c_custkey % 7 = 0 THEN NULL ELSE c_name END AS text, c_custkey % 7 = 0 AS failed FROM customer""")
def codec_blob_both(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Texts to bytes, and bytes, of which some are no text, back."""
    raw = F.when(F.col("c_custkey") % 7 == 0, F.lit(b"\xff\xfe")).otherwise(F.encode("c_name", "UTF-8"))
    rows = table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("id"), "c_name", raw.alias("raw"))
    codecs = C.builtin(frozenset({"STRING_BLOB"}))
    to, back = C.convert(F.col("c_name"), T.StringType(), T.BinaryType(), codecs), C.convert(F.col("raw"), T.BinaryType(), T.StringType(), codecs)
    return rows.select("id", F.hex(to.value).alias("blob"), back.value.alias("text"), F.coalesce(back.failed, F.lit(False)).alias("failed"))


@query("""WITH p AS (SELECT o_orderkey, o_orderdate::TIMESTAMP + INTERVAL (o_orderkey % 86400) SECOND AS a, o_orderkey % 7 AS u, o_orderkey % 6 AS k FROM orders),
t AS (SELECT *, CASE u WHEN 0 THEN strftime(a, '%Y') WHEN 1 THEN strftime(a, '%Y-%m') WHEN 2 THEN strftime(a, '%Y-%m-%d') WHEN 3 THEN strftime(a, '%Y-%m-%dT%HZ') WHEN 4 THEN strftime(a, '%Y-%m-%dT%H:%MZ') WHEN 5 THEN strftime(a, '%Y-%m-%dT%H:%M:%SZ') ELSE strftime(a, '%Y-%m-%dT%H:%M:%S') || '.007Z' END AS x FROM p)
SELECT o_orderkey, CASE k WHEN 0 THEN 'single' WHEN 1 THEN 'closed' WHEN 2 THEN 'open_high' WHEN 3 THEN 'open_low' WHEN 4 THEN 'open' ELSE 'single_open' END AS kind,
  CASE k WHEN 0 THEN x WHEN 1 THEN '[' || x || ' TO ' || x || ']' WHEN 2 THEN '[' || x || ' TO *]' WHEN 3 THEN '[* TO ' || x || ']' WHEN 4 THEN '[* TO *]' ELSE '*' END AS text,
  CASE WHEN k IN (0, 1, 2) THEN epoch_ms(CASE u WHEN 0 THEN date_trunc('year', a) WHEN 1 THEN date_trunc('month', a) WHEN 2 THEN date_trunc('day', a) WHEN 3 THEN date_trunc('hour', a) WHEN 4 THEN date_trunc('minute', a) ELSE a END) + CASE WHEN u = 6 THEN 7 ELSE 0 END END AS lower_ms,
  CASE WHEN k IN (1, 3) THEN CASE u WHEN 0 THEN epoch_ms(date_trunc('year', a) + INTERVAL 1 YEAR) - 1 WHEN 1 THEN epoch_ms(date_trunc('month', a) + INTERVAL 1 MONTH) - 1 WHEN 2 THEN epoch_ms(date_trunc('day', a) + INTERVAL 1 DAY) - 1 WHEN 3 THEN epoch_ms(date_trunc('hour', a) + INTERVAL 1 HOUR) - 1
    WHEN 4 THEN epoch_ms(date_trunc('minute', a) + INTERVAL 1 MINUTE) - 1 WHEN 5 THEN epoch_ms(a) + 999 ELSE epoch_ms(a) + 7 END END AS upper_ms FROM t""")
def date_range_kinds(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All six kinds of date ranges in all seven precisions, read from text and written as text again."""
    at = F.timestamp_seconds(F.unix_seconds(F.col("o_orderdate").cast("timestamp")) + F.col("o_orderkey") % 86400)
    unit, kind = F.col("o_orderkey") % 7, F.col("o_orderkey") % 6
    forms = ["yyyy", "yyyy-MM", "yyyy-MM-dd", "yyyy-MM-dd'T'HH'Z'", "yyyy-MM-dd'T'HH:mm'Z'", "yyyy-MM-dd'T'HH:mm:ss'Z'", "yyyy-MM-dd'T'HH:mm:ss'.007Z'"]
    x = F.coalesce(*(F.when(unit == n, F.date_format(at, form)) for n, form in enumerate(forms)))
    text = F.when(kind == 0, x).when(kind == 1, F.format_string("[%s TO %s]", x, x)).when(kind == 2, F.format_string("[%s TO *]", x)).when(kind == 3, F.format_string("[* TO %s]", x)).when(kind == 4, "[* TO *]").otherwise("*")
    rows = table(spark, sf_dir, "orders").select("o_orderkey", C.date_range(text).alias("r"))
    return rows.select("o_orderkey", "r.kind", C.date_range_text(F.col("r")).alias("text"), "r.lower_ms", "r.upper_ms")


# Filters and guardrails


@query("""WITH f AS (SELECT CASE WHEN NOT (o_totalprice > 1000) THEN 'where' WHEN lower(trim(CASE WHEN o_orderkey % 3 = 0 THEN chr(9) || o_orderpriority || ' ' ELSE o_orderpriority END, ' ' || chr(9))) = '1-urgent' THEN 'column value' END AS rejected_by FROM orders) SELECT rejected_by, count(*) AS n_rows FROM f GROUP BY rejected_by""")
def filter_chain_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders")
    orders = orders.withColumn("o_orderpriority", F.when(F.col("o_orderkey") % 3 == 0, F.concat(F.lit("\t"), "o_orderpriority", F.lit(" "))).otherwise(F.col("o_orderpriority")))
    job = JobSpec(where="AND o_totalprice > 1000", exclude_value=("o_orderpriority", " 1-URGENT "))
    marked = jobs.filter_chain(orders, TableSpec.of(orders, "orders", ["o_orderkey"]), job).mark(orders)
    return marked.groupBy(F.col("_rejected_by").alias("rejected_by")).agg(F.count("*").alias("n_rows"))


@query("""SELECT c_custkey FROM customer WHERE c_custkey % 3 = 0 OR (c_custkey * 10 BETWEEN 500 AND 5000)""")
def writetime_window(spark: SparkSession, sf_dir: str) -> DataFrame:
    customer = table(spark, sf_dir, "customer").select("c_custkey", F.when(F.col("c_custkey") % 3 != 0, F.col("c_custkey") * 10).alias("wt"))
    return customer.where(filters.written_within(F.col("wt"), 500, 5000)).select("c_custkey")


@query("SELECT c_custkey FROM customer WHERE NOT coalesce(lower(trim(c_mktsegment)) = 'building', FALSE)")
def column_value_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "customer").where(filters.value_differs("c_mktsegment", "Building")).select("c_custkey")


@query(f"""WITH o AS (SELECT o_orderkey, {TOKEN} AS token, {RANGE_ID} AS r FROM orders), b AS (SELECT *, r * CAST(18014398509481984 AS HUGEINT) AS lo, least(r * CAST(18014398509481984 AS HUGEINT) + 18014398509481983, 1152921504606846975) AS hi FROM o)
SELECT o_orderkey FROM b WHERE token <= lo + (hi - lo) // 100 * 10 + ((hi - lo) % 100) * 10 // 100""")
def coverage_sample(spark: SparkSession, sf_dir: str) -> DataFrame:
    token = tokens.token60("o_orderkey")
    orders = table(spark, sf_dir, "orders").select("o_orderkey", token.alias("token")).withColumn("r", ranges.range_of(F.col("token"), *tokens.RING60, 64))
    low = F.col("r").cast("decimal(38,0)") * F.lit("18014398509481984").cast("decimal(38,0)")
    high = F.least(low + F.lit("18014398509481983").cast("decimal(38,0)"), F.lit(str(tokens.RING60[1])).cast("decimal(38,0)"))
    return orders.where(filters.covered(F.col("token"), low, high, 10)).select("o_orderkey")


def kb_sql(n: str) -> str:
    return f"CASE WHEN {n} % 1000 = 0 THEN CAST({n} // 1000 AS VARCHAR) ELSE rtrim(CAST({n} // 1000 AS VARCHAR) || '.' || lpad(CAST({n} % 1000 AS VARCHAR), 3, '0'), '0') END"


@query(f"""SELECT doc_id, CASE WHEN strlen(text) > 5000 THEN 'LARGE' ELSE 'VALID' END AS outcome, CASE WHEN strlen(text) > 5000 THEN 'Large columns (KB): text(' || {kb_sql('strlen(text)')} || ')' END AS report,
  CASE WHEN strlen(text) > 5000 THEN 'text' END AS largest, CASE WHEN strlen(text) > 5000 THEN strlen(text) END AS bytes FROM documents""")
def guardrail_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return guardrail.findings(table(spark, sf_dir, "documents"), ["doc_id"], 5)


@query("SELECT count(*) AS n_read, count(*) FILTER (strlen(html) <= 5000) AS n_write, count(*) FILTER (strlen(html) > 5000) AS n_skipped, CAST(0 AS BIGINT) AS n_error FROM pages")
def guardrail_block(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages")
    spec = TableSpec.of(pages, "pages", ["page_id"])
    return jobs.migrate(pages, spec, spec, JobSpec(guardrail_kb=5, guardrail_mode="block")).counters()


@query("SELECT page_id, FALSE AS held_back, 'Large columns (KB): html(' || " + kb_sql("strlen(html)") + " || ')' AS report FROM pages WHERE strlen(html) > 5000")
def guardrail_warnings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """In warn mode rows with large cells are written, and reported."""
    pages = table(spark, sf_dir, "pages")
    spec = TableSpec.of(pages, "pages", ["page_id"])
    return jobs.migrate(pages, spec, spec, JobSpec(guardrail_kb=5, guardrail_mode="warn")).diagnostics()


@query("SELECT count(*) AS n_read, count(*) AS n_write, CAST(0 AS BIGINT) AS n_skipped, CAST(0 AS BIGINT) AS n_error FROM pages")
def guardrail_check_mode(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages")
    spec = TableSpec.of(pages, "pages", ["page_id"])
    return jobs.migrate(pages, spec, spec, JobSpec(guardrail_kb=5, guardrail_mode="check")).counters()


@query("""WITH o AS (SELECT c_custkey, c_nationkey * 10 AS n, CASE WHEN c_custkey % 17 = 0 THEN 'ERROR' WHEN c_custkey % 3 = 0 THEN 'SKIPPED' WHEN c_nationkey > 20 THEN 'SKIPPED' ELSE 'WRITE' END AS outcome FROM customer)
SELECT outcome, count(*) AS n_rows, CAST(coalesce(sum(CASE WHEN outcome = 'WRITE' THEN n END), 0) AS BIGINT) AS total FROM o GROUP BY 1""")
def extended_migrate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A migration with a user's transform of the rows, filter (undecided for some rows), guardrail and conversion."""
    customer = table(spark, sf_dir, "customer")
    key = F.col("c_custkey")
    own = jobs.Extensions(
        codecs=[("TENFOLD", "int", "bigint", lambda c: c.cast("long") * 10)],
        filters=[("not by three", key % 3 != 0, key % 17 == 0)],
        transforms=[lambda df: df.withColumn("c_nationkey", F.col("c_nationkey").cast("int"))],
        guardrails=[("near nations", F.col("c_nationkey") <= 20)],
    )
    origin = TableSpec("o", schema(f"c_custkey {dict(customer.dtypes)['c_custkey']}, c_nationkey int"), ("c_custkey",))
    target = TableSpec("t", schema(f"c_custkey {dict(customer.dtypes)['c_custkey']}, c_nationkey bigint"), ("c_custkey",))
    done = jobs.migrate(customer, origin, target, JobSpec(guardrail_mode="block"), extensions=own)
    total = F.coalesce(F.sum(F.when(F.col("outcome") == "WRITE", F.col("c_nationkey"))), F.lit(0)).cast("long")
    return done.every.groupBy("outcome").agg(F.count("*").alias("n_rows"), total.alias("total"))


@query("""SELECT count(*) AS n_read, CAST(sum(o_orderkey % 4) AS BIGINT) AS n_write, count(*) FILTER (o_orderkey % 4 = 0) AS n_skipped, CAST(0 AS BIGINT) AS n_error, count(*) FILTER (o_orderkey % 4 > 0) AS first_parts, CAST(sum(CASE WHEN o_orderkey % 4 > 1 THEN 1 ELSE 0 END) AS BIGINT) AS second_parts,
  CAST(sum(CASE WHEN o_orderkey % 4 > 0 AND o_orderkey % 5 = 0 THEN 1 ELSE 0 END) AS BIGINT) AS n_missing FROM orders""")
def one_to_many(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A migration in which a user makes none to three records of each order, and a validation of a target that lacks some of them:
    READ counts orders, the other counters records."""
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_totalprice")
    parts = F.transform(F.sequence(F.lit(1).cast("long"), F.lit(3).cast("long")), lambda n: F.struct(n.alias("part"), (F.col("o_totalprice") / n).alias("o_totalprice")))
    own = jobs.Extensions(records=F.slice(parts, F.lit(1), (F.col("o_orderkey") % 4).cast("int")))
    spec = TableSpec("parts", schema(f"o_orderkey {dict(orders.dtypes)['o_orderkey']}, part bigint, o_totalprice double"), ("o_orderkey",), ("part",))
    done = jobs.migrate(orders, spec, spec, JobSpec(), extensions=own)
    target = done.merged(orders.limit(0).withColumn("part", F.lit(0).cast("long")).select("o_orderkey", "part", "o_totalprice"))
    counted = target.agg(F.count_if(F.col("part") == 1).alias("first_parts"), F.count_if(F.col("part") == 2).alias("second_parts"))
    checked = jobs.validate(orders, target.where("o_orderkey % 5 <> 0 or part <> 1"), spec, spec, JobSpec(), extensions=own)
    return done.counters().crossJoin(counted).crossJoin(checked.agg(F.count_if(F.col("outcome") == "MISSING").alias("n_missing")))  # one row each


@query("SELECT CAST(count(*) AS BIGINT) AS n_rows, CAST(20 AS BIGINT) AS largest, TRUE AS only_last_ones_short FROM lineitem")
def arrival_batches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rows of a migration in batches as they arrive: all are full but the last one of each task."""
    lines = table(spark, sf_dir, "lineitem").withColumn("_nth", F.monotonically_increasing_id())
    spec = TableSpec.of(lines.select("_nth", "l_orderkey", "l_quantity"), "lines", ["_nth"])
    done = jobs.migrate(lines.select("_nth", "l_orderkey", "l_quantity"), spec, spec, JobSpec(batch_size=20, batches="arrival")).batched()
    sizes = done.groupBy(F.shiftright("batch_no", 33).alias("task"), "batch_no").agg(F.count("*").alias("n"))
    tasks = sizes.groupBy("task").agg(F.sum("n").alias("n_rows"), F.max("n").alias("largest"), F.count_if(F.col("n") < 20).alias("short"))
    return tasks.agg(F.sum("n_rows").cast("long").alias("n_rows"), F.max("largest").alias("largest"), (F.max("short") <= 1).alias("only_last_ones_short"))


@query("SELECT c_custkey AS key, nullif(c_custkey % 2 + CASE WHEN c_nationkey % 3 = 0 THEN 0 ELSE 1 END, 0) AS n_entries, CAST(c_nationkey AS BIGINT) AS nation FROM customer")
def odd_names_and_null_entries(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A table whose names are a reserved word, hold a dot, a dash and a back quote; null entries of its map are stripped, and a
    map without entries leaves its cell alone."""
    customer = table(spark, sf_dir, "customer")
    nation = F.col("c_nationkey").cast("long")
    entries = F.create_map(F.lit("a"), F.when(F.col("c_custkey") % 2 == 1, nation), F.lit("b"), F.when(nation % 3 != 0, nation))
    origin = customer.select(F.col("c_custkey").alias("order"), entries.alias("map-of.x"), nation.alias("na`tion"))
    spec = TableSpec.of(origin, "odd", ["order"])
    after = jobs.migrate(origin, spec, spec, JobSpec(strip_null_map_values=True)).merged(origin.limit(0))
    return after.select(F.col("order").alias("key"), F.size(F.col("`map-of.x`")).alias("n_entries"), F.col("`na``tion`").alias("nation"))


@query("SELECT CASE WHEN o_orderkey % 89 = 0 THEN 'MISMATCH' ELSE 'VALID' END AS outcome, count(*) AS n_rows FROM orders GROUP BY 1")
def extended_compare(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A validation with a user's test for equal prices: cents don't matter."""
    orders = table(spark, sf_dir, "orders")
    spec = TableSpec.of(orders, "orders", ["o_orderkey"])
    price = F.col("o_totalprice")
    target = orders.withColumn("o_totalprice", F.when(F.col("o_orderkey") % 89 == 0, price + 50).otherwise(F.floor(price) + 0.0))
    near = jobs.Extensions(compare={"o_totalprice": lambda a, b: F.abs(a - b) < 1})
    return jobs.validate(orders, target, spec, spec, JobSpec(), extensions=near).groupBy("outcome").agg(F.count("*").alias("n_rows"))


@query("""WITH n AS (SELECT l_orderkey, row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_suppkey, l_quantity, l_extendedprice, l_discount, l_tax, l_returnflag, l_linestatus, l_shipdate) AS n FROM lineitem)
SELECT CAST(ceil(n / 2) AS BIGINT) AS batch_no, count(*) AS n_rows FROM n GROUP BY 1""")
def batch_numbers(spark: SparkSession, sf_dir: str) -> DataFrame:
    lineitem = table(spark, sf_dir, "lineitem")
    order = ["l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice", "l_discount", "l_tax", "l_returnflag", "l_linestatus", "l_shipdate"]
    return merge.batches(lineitem, ["l_orderkey"], order, 2).groupBy("batch_no").agg(F.count("*").alias("n_rows"))


# Ranges, over the tokens of the orders


def order_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "orders").select("o_orderkey", tokens.token60("o_orderkey").alias("token"))


SPLIT = f"""k AS (SELECT {TOKEN} AS token FROM orders), b AS (SELECT CAST(min(token) AS HUGEINT) AS lo, CAST(max(token) AS HUGEINT) AS hi FROM k), z AS (SELECT lo, hi, CASE WHEN (hi - lo) // 50 = 0 THEN 100000 ELSE (hi - lo) // 50 END AS size FROM b),
r AS (SELECT i AS range_id, lo + i * (size + 1) AS "min", least(lo + i * (size + 1) + size, hi) AS "max" FROM (SELECT *, unnest(generate_series(0, CAST((hi - lo) // (size + 1) AS BIGINT))) AS i FROM z))"""


def order_ranges(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jobs.plan(order_tokens(spark, sf_dir), "token", 50)


def as_long(df: DataFrame, *names: str) -> DataFrame:
    return df.withColumns({n: F.col(n).cast("long") for n in names})


@query(f'WITH {SPLIT} SELECT range_id, CAST("min" AS BIGINT) AS "min", CAST("max" AS BIGINT) AS "max" FROM r')
def range_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    return as_long(order_ranges(spark, sf_dir), "min", "max")


@query(f"""WITH {SPLIT}, s AS (SELECT *, ("max" - "min") // 3 AS size FROM r)
SELECT range_id, i AS part, CAST("min" + i * (size + 1) AS BIGINT) AS "min", CAST(least("min" + i * (size + 1) + size, "max") AS BIGINT) AS "max" FROM (SELECT *, unnest(generate_series(0, CAST(("max" - "min") // (size + 1) AS BIGINT))) AS i FROM s)""")
def range_subdivide(spark: SparkSession, sf_dir: str) -> DataFrame:
    return as_long(ranges.subdivided(order_ranges(spark, sf_dir), 3), "min", "max").select("range_id", "part", "min", "max")


@query(f"""WITH {SPLIT} SELECT range_id, CAST("min" AS BIGINT) AS "min", CAST("min" + ("max" - "min") // 100 * 25 + (("max" - "min") % 100) * 25 // 100 AS BIGINT) AS "max" FROM r""")
def range_coverage(spark: SparkSession, sf_dir: str) -> DataFrame:
    return as_long(jobs.plan(order_tokens(spark, sf_dir), "token", 50, 25), "min", "max")


CELL = 164703072086692425


@query(f"""WITH k AS (SELECT {TOKEN} AS token FROM orders), g AS (SELECT token // {CELL} AS node, CAST(token // {CELL} AS HUGEINT) * {CELL} AS lo, CAST(token // {CELL} + 1 AS HUGEINT) * {CELL} - 1 AS hi FROM k GROUP BY ALL),
c AS (SELECT node, greatest(lo, 100000000000000000) AS lo, least(hi, 1000000000000000000) AS hi FROM g WHERE hi >= 100000000000000000 AND lo <= 1000000000000000000), t AS (SELECT *, hi - lo + 1 AS size, sum(hi - lo + 1) OVER ()::HUGEINT AS total FROM c),
p AS (SELECT *, greatest(20 * size // total, 1) AS k FROM t), q AS (SELECT *, size // k AS base, size % k AS rest, unnest(generate_series(0, CAST(k - 1 AS BIGINT))) AS i FROM p)
SELECT node, i AS part, CAST(lo + i * base + least(i, rest) AS BIGINT) AS "min", CAST(lo + i * base + least(i, rest) + base + CASE WHEN i < rest THEN 1 ELSE 0 END - 1 AS BIGINT) AS "max" FROM q""")
def ring_aware(spark: SparkSession, sf_dir: str) -> DataFrame:
    node = F.floor(F.col("token") / F.lit(CELL).cast("decimal(20,0)")).cast("long")
    wide = lambda c: c.cast("decimal(38,0)")
    cell = wide(F.lit(str(CELL)))
    segments = order_tokens(spark, sf_dir).select(node.alias("node")).distinct().select("node", (wide(F.col("node")) * cell).cast("decimal(38,0)").alias("min"), ((wide(F.col("node")) + 1) * cell - 1).cast("decimal(38,0)").alias("max"))
    return as_long(ranges.ring_aware((100000000000000000, 1000000000000000000), segments, 20), "min", "max").select("node", "part", "min", "max")


def order_estimates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows and bytes of the orders by ring segment, as a cluster would estimate them."""
    orders = table(spark, sf_dir, "orders").select(tokens.token60("o_orderkey").alias("token"), F.length("o_orderpriority").alias("b"))
    return ranges.measured(orders, "token", F.col("b"), CELL)


ESTIMATES = f"e AS (SELECT CAST(n AS HUGEINT) * {CELL} AS lo, CAST(n AS HUGEINT) * {CELL} + {CELL} - 1 AS hi, partitions, mean_bytes FROM (SELECT {TOKEN} // {CELL} AS n, count(*) AS partitions, CAST(floor(avg(length(o_orderpriority))) AS BIGINT) AS mean_bytes FROM orders GROUP BY 1))"
ESTIMATED = f"""{SPLIT}, {ESTIMATES}, m AS (SELECT r.range_id, r."min", r."max", coalesce(CAST(sum((partitions * (least(r."max", e.hi) - greatest(r."min", e.lo) + 1)) // (e.hi - e.lo + 1)) AS BIGINT), 0) AS estimate FROM r LEFT JOIN e ON r."min" <= e.hi AND e.lo <= r."max" GROUP BY ALL)"""


@query(f"""WITH {ESTIMATED}, p AS (SELECT *, CAST(greatest(ceil(estimate / 100), 1) AS HUGEINT) AS k, "max" - "min" + 1 AS size FROM m), q AS (SELECT *, size // k AS base, size % k AS rest, unnest(generate_series(0, CAST(k - 1 AS BIGINT))) AS i FROM p)
SELECT range_id, estimate, i AS part, CAST("min" + i * base + least(i, rest) AS BIGINT) AS "min", CAST("min" + i * base + least(i, rest) + base + CASE WHEN i < rest THEN 1 ELSE 0 END - 1 AS BIGINT) AS "max" FROM q""")
def adaptive_plan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return as_long(ranges.adaptive(order_ranges(spark, sf_dir), order_estimates(spark, sf_dir), 100), "min", "max").select("range_id", "estimate", "part", "min", "max")


@query(f"""WITH {ESTIMATED} SELECT count(*) AS n_ranges, CAST(sum("max" - "min" + 1)::HUGEINT AS VARCHAR) AS planned_tokens, CAST(sum(estimate) AS BIGINT) AS estimated_rows, CAST(ceil(sum(estimate) / 1000) AS BIGINT) AS seconds FROM m""")
def plan_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    sized = ranges.estimated(order_ranges(spark, sf_dir), order_estimates(spark, sf_dir))
    return ranges.plan_report(sized, F.col("estimate"), 1000)


@query(f"WITH {ESTIMATES} SELECT CAST(floor(sum(partitions * mean_bytes) / sum(partitions)) AS BIGINT) AS mean_row_bytes FROM e")
def mean_row_bytes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ranges.mean_row_bytes(order_estimates(spark, sf_dir))


@query(f"""WITH {SPLIT} SELECT CAST(length(bin("max" - "min" + 1)) - 1 AS INTEGER) AS power, count(*) AS n_ranges FROM (SELECT "min", "max" FROM r UNION ALL SELECT 0, CAST(1152921504606846976 AS HUGEINT) - CASE WHEN o_orderkey % 2 = 0 THEN 1 ELSE 2 END FROM orders) GROUP BY 1""")
def span_histogram(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The plan's ranges, and for each order one of 2 to the 60 tokens or of one less."""
    wide = lambda x: F.lit(str(x)).cast("decimal(38,0)")
    edges = table(spark, sf_dir, "orders").select(wide(0).alias("min"), (wide(1 << 60) - F.when(F.col("o_orderkey") % 2 == 0, 1).otherwise(2)).cast("decimal(38,0)").alias("max"))
    return ranges.span_histogram(order_ranges(spark, sf_dir).select("min", "max").unionByName(edges))


@query(f"""WITH {SPLIT} SELECT range_id, row_number() OVER (ORDER BY md5(CAST("min" AS VARCHAR) || ':' || '42'), "min") - 1 AS work_order FROM r""")
def work_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ranges.work_order(order_ranges(spark, sf_dir), 42).select("range_id", "work_order")


@query(f"""WITH k AS (SELECT {TOKEN} AS token FROM orders) SELECT token AS "min", row_number() OVER (ORDER BY token) - 1 AS work_order FROM k""")
def ring_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every order's token as a range of its own, in the order of the ring."""
    points = order_tokens(spark, sf_dir).select(F.col("token").cast("decimal(38,0)").alias("min"), F.col("token").cast("decimal(38,0)").alias("max"))
    return as_long(ranges.ring_order(points), "min").select("min", "work_order")


@query(f"""WITH {SPLIT} SELECT "min"::BIGINT AS "min", "max"::BIGINT AS "max", n::BIGINT AS next_min FROM (SELECT "min", CASE WHEN range_id % 9 = 0 THEN "max" + 5 ELSE "max" END AS "max", lead("min") OVER (ORDER BY "min") AS n FROM r) WHERE n <= "max" """)
def work_list_conflicts(spark: SparkSession, sf_dir: str) -> DataFrame:
    bad = order_ranges(spark, sf_dir).withColumn("max", F.when(F.col("range_id") % 9 == 0, F.col("max") + 5).otherwise(F.col("max")).cast("decimal(38,0)"))
    return as_long(ranges.conflicts(bad), "min", "max", "next_min")


@query(f"""WITH {SPLIT}, irregular AS (SELECT range_id, "min", CASE WHEN range_id % 4 = 0 THEN "min" + ("max" - "min") // 2 ELSE "max" END AS "max" FROM r WHERE range_id <> 7
UNION ALL SELECT 1000 + i, "min" + i * (s + 1), least("min" + i * (s + 1) + s, "max") FROM (SELECT "min", "max", s, unnest(generate_series(0, CAST(("max" - "min") // (s + 1) AS BIGINT))) AS i FROM (SELECT *, ("max" - "min") // 100000 AS s FROM r WHERE range_id = 7))),
o AS (SELECT o_orderkey, {TOKEN} AS token FROM orders)
SELECT i.range_id, count(*) AS n_rows FROM o JOIN irregular i ON o.token BETWEEN i."min" AND i."max" GROUP BY 1""")
def range_assignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows by the ranges of a plan with gaps, one of whose ranges is cut in 100,000."""
    half = (F.col("min") + ranges.whole(F.col("max") - F.col("min"), ranges.wide(2))).cast("decimal(38,0)")
    plan = order_ranges(spark, sf_dir)
    irregular = plan.where("range_id <> 7").withColumn("max", F.when(F.col("range_id") % 4 == 0, half).otherwise(F.col("max")))
    dense = ranges.subdivided(plan.where("range_id = 7"), 100_000).select((1000 + F.col("part")).alias("range_id"), "min", "max")
    return ranges.assigned(order_tokens(spark, sf_dir), "token", irregular.unionByName(dense)).groupBy("range_id").agg(F.count("*").alias("n_rows"))


# Run tracking, over a log that the orders give


TABLE = "CASE WHEN o_orderkey % 7 = 0 THEN 'more' ELSE 'orders' END"


def range_table() -> Column:
    return F.when(F.col("o_orderkey") % 7 == 0, "more").otherwise("orders")


def run_details(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A status log of two tables with the same run ids: every order is a range of the run of its customer's last digit, with one to
    three status rows."""
    key = F.col("o_orderkey")
    log = table(spark, sf_dir, "orders").select(range_table().alias("table_name"), (F.col("o_custkey") % 10).cast("long").alias("run_id"), key.alias("token_min"), key.alias("token_max"), F.explode(F.sequence(F.lit(0), (key % 3).cast("int"))).alias("n"))
    last = F.element_at(F.array(*map(F.lit, ("PASS", "FAIL", "DIFF", "DIFF_CORRECTED"))), (F.col("token_min") % 4).cast("int") + 1)
    text = F.when(F.col("n") == 2, F.concat(F.lit("Read: "), (F.col("token_min") % 50).cast("string"), F.lit("; Valid: "), (F.col("token_min") % 40).cast("string"), F.lit("; Odd: 5; Error: x")))
    return log.select("table_name", "run_id", F.timestamp_seconds(F.lit(1_700_000_000) + F.col("n")).alias("start_time"), "token_min", "token_max", F.when(F.col("n") == 0, "NOT_STARTED").when(F.col("n") == 1, "STARTED").otherwise(last).alias("status"), text.alias("run_info"))


STATUS = "CASE WHEN o_orderkey % 3 = 0 THEN 'NOT_STARTED' WHEN o_orderkey % 3 = 1 THEN 'STARTED' WHEN o_orderkey % 4 = 0 THEN 'PASS' WHEN o_orderkey % 4 = 1 THEN 'FAIL' WHEN o_orderkey % 4 = 2 THEN 'DIFF' ELSE 'DIFF_CORRECTED' END"


def run_info(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Runs: every customer is one, of one of three kinds, resumed from the customer 7 before it."""
    key = F.col("c_custkey")
    text = F.when(key % 4 == 0, "Read: 1; Partitions Failed: 2").when(key % 4 == 1, "Read: 1; Partitions Failed: 0").when(key % 4 == 2, "Partitions Failed: many")
    kind = F.element_at(F.array(F.lit("MIGRATE"), F.lit("VALIDATE"), F.lit("GUARDRAIL")), (key % 3).cast("int") + 1)
    at = F.timestamp_seconds(F.lit(1_700_000_000) + key)
    return table(spark, sf_dir, "customer").select(F.concat(F.lit("t"), (key % 5).cast("string")).alias("table_name"), key.cast("long").alias("run_id"), kind.alias("run_type"), F.when(key >= 8, key - 7).otherwise(0).cast("long").alias("prev_run_id"), at.alias("start_time"), at.alias("end_time"), text.alias("run_info"), F.when(key % 6 == 0, "INTERRUPTED").otherwise("ENDED").alias("status"))


@query(f"SELECT {TABLE} AS table_name, CAST(o_custkey % 10 AS BIGINT) AS run_id, {STATUS} AS status, count(*) AS n_ranges FROM orders GROUP BY 1, 2, 3")
def runs_by_status(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tracking.by_status(run_details(spark, sf_dir))


@query(f"SELECT o_orderkey AS token_min, o_orderkey AS token_max, {STATUS} AS status, CASE WHEN {STATUS} = 'NOT_STARTED' THEN 'pending' ELSE 'quarantined' END AS state FROM orders WHERE {TABLE} = 'orders' AND o_custkey % 10 = 3 AND {STATUS} IN ('NOT_STARTED', 'STARTED', 'FAIL', 'DIFF')")
def resume_pending(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tracking.pending(run_details(spark, sf_dir), "orders", 3, writes_counters=True)


@query(f"""WITH p AS (SELECT {TOKEN} AS token, o_orderkey, o_custkey FROM orders), s AS (SELECT *, token // 18014398509481984 AS r FROM p)
SELECT o_orderkey FROM s WHERE r % 3 = 0""")
def resume_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = order_tokens(spark, sf_dir)
    plan = ranges.split(rows.agg(F.min(F.lit(0)).alias("min"), F.max(F.lit(tokens.RING60[1])).alias("max")), 64)
    work = plan.where("range_id % 3 = 0").select(F.col("min").alias("token_min"), F.col("max").alias("token_max"), F.lit("pending").alias("state"))
    return jobs.resumed(rows, "token", work).select("o_orderkey")


@query(f"SELECT o_orderkey AS token_min FROM orders WHERE o_custkey % 10 = 3 AND ({TABLE} = 'more' OR {STATUS} NOT IN ('PASS', 'DIFF_CORRECTED'))")
def outstanding_ranges(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What run 3 of one table has left to do of all planned ranges; the same run of the other table has finished none of them."""
    planned = table(spark, sf_dir, "orders").where("o_custkey % 10 = 3").select(F.col("o_orderkey").alias("token_min"))
    return tracking.outstanding(planned, run_details(spark, sf_dir), "orders", 3)


@query("""SELECT token_min, token_max, status, state, n_pending FROM (SELECT o_orderkey AS token_min, o_orderkey AS token_max, %(s)s AS status, 'pending' AS state, count(*) OVER () AS n_pending FROM orders WHERE o_orderkey %% 7 <> 0 AND o_custkey %% 10 = 4 AND %(s)s IN ('NOT_STARTED', 'STARTED', 'FAIL', 'DIFF')) ORDER BY token_min LIMIT 20""" % {"s": STATUS})
def pending_sample(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tracking.pending_sample(run_details(spark, sf_dir), "orders", 4)


@query(f"""SELECT {TABLE} AS table_name, CAST(o_custkey % 10 AS BIGINT) AS run_id, c AS counter, CAST(sum(n) AS BIGINT) AS n FROM (SELECT o_orderkey, o_custkey, 'Read' AS c, o_orderkey % 50 AS n FROM orders WHERE o_orderkey % 3 = 2 UNION ALL SELECT o_orderkey, o_custkey, 'Valid', o_orderkey % 40 FROM orders WHERE o_orderkey % 3 = 2) GROUP BY ALL""")
def parse_run_info(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tracking.totals(run_details(spark, sf_dir))


@query(f"""SELECT {TABLE} AS table_name, CAST(o_custkey % 10 AS BIGINT) AS run_id, count(*) AS n_ranges, count(*) FILTER ({STATUS} NOT IN ('NOT_STARTED', 'STARTED')) AS n_done, count(*) FILTER ({STATUS} = 'NOT_STARTED') AS n_pending, count(*) FILTER ({STATUS} = 'STARTED') AS n_in_flight, CAST(sum(o_orderkey % 9 + 1) AS BIGINT) AS weight,
  CAST(coalesce(sum(o_orderkey % 9 + 1) FILTER ({STATUS} NOT IN ('NOT_STARTED', 'STARTED')), 0) AS BIGINT) AS weight_done FROM orders GROUP BY 1, 2""")
def progress(spark: SparkSession, sf_dir: str) -> DataFrame:
    weights = table(spark, sf_dir, "orders").select(range_table().alias("table_name"), F.col("o_orderkey").alias("token_min"), (F.col("o_orderkey") % 9 + 1).alias("weight"))
    return tracking.progress(run_details(spark, sf_dir), weights)


@query("SELECT CASE WHEN o_orderkey % 5 = 0 THEN 'NOT_STARTED' WHEN o_orderkey % 5 = 1 THEN 'STARTED' WHEN o_orderkey % 5 = 2 THEN 'PASS' WHEN o_orderkey % 5 = 3 THEN 'FAIL' ELSE 'DIFF' END AS status, count(*) AS n_ranges FROM orders GROUP BY 1")
def ended_ranges(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ranges whose rows all have the time at which they started: the end counts, not the start."""
    key = F.col("o_orderkey")
    life = F.array(*(F.lit(s) for s in ("NOT_STARTED", "STARTED")), F.element_at(F.array(*map(F.lit, ("PASS", "FAIL", "DIFF"))), F.greatest(key % 5 - 1, F.lit(1)).cast("int")))
    rows = table(spark, sf_dir, "orders").select(F.lit("t").alias("table_name"), F.lit(1).cast("long").alias("run_id"), F.timestamp_seconds(F.lit(1_700_000_000)).alias("start_time"), key.alias("token_min"), key.alias("token_max"), F.explode(F.slice(life, F.lit(1), F.least(key % 5 + 1, F.lit(3)).cast("int"))).alias("status"), F.lit("").alias("run_info"))
    return tracking.by_status(rows).select("status", "n_ranges")


@query(f"""WITH p AS (SELECT {TABLE} AS table_name, CAST(o_custkey % 10 AS BIGINT) AS run_id, count(*) FILTER ({STATUS} NOT IN ('NOT_STARTED', 'STARTED')) AS n_done, CAST(sum(o_orderkey % 9 + 1) AS BIGINT) AS weight,
  CAST(coalesce(sum(o_orderkey % 9 + 1) FILTER ({STATUS} NOT IN ('NOT_STARTED', 'STARTED')), 0) AS BIGINT) AS weight_done FROM orders GROUP BY 1, 2), f AS (SELECT *, weight_done / weight AS f FROM p)
SELECT table_name, run_id, n_done, CAST(CASE WHEN f >= 0.02 AND n_done >= 16 THEN floor((600 + run_id) * (1 - f) / f) END AS BIGINT) AS seconds_left FROM f""")
def progress_left(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The time that the tracked runs will still take, by the weight that they have done."""
    weights = table(spark, sf_dir, "orders").select(range_table().alias("table_name"), F.col("o_orderkey").alias("token_min"), (F.col("o_orderkey") % 9 + 1).alias("weight"))
    elapsed = table(spark, sf_dir, "orders").select(range_table().alias("table_name"), (F.col("o_custkey") % 10).cast("long").alias("run_id")).distinct().withColumn("elapsed_s", 600 + F.col("run_id"))
    return tracking.progress(run_details(spark, sf_dir), weights, elapsed).select("table_name", "run_id", "n_done", "seconds_left")


BY_RANGE = f"""{CHECKED}, {SPLIT}, w AS (SELECT outcome, {TOKEN} AS token FROM v),
a1 AS (SELECT CAST(1 AS BIGINT) AS run_id, "min" AS lo, "max" AS hi, count(outcome) AS n, count(*) FILTER (outcome = 'MISMATCH') AS mi, count(*) FILTER (outcome = 'MISSING') AS ms, count(*) FILTER (outcome = 'VALID') AS va FROM r LEFT JOIN w ON token BETWEEN "min" AND "max" GROUP BY ALL),
p1 AS (SELECT lo + i * (size + 1) AS lo, least(lo + i * (size + 1) + size, hi) AS hi FROM (SELECT *, unnest(generate_series(0, CAST((hi - lo) // (size + 1) AS BIGINT))) AS i FROM (SELECT *, (hi - lo) // 3 AS size FROM a1 WHERE mi + ms > 0))),
b1 AS (SELECT CAST(2 AS BIGINT) AS run_id, lo, hi, count(outcome) AS n, count(*) FILTER (outcome = 'MISMATCH') AS mi, count(*) FILTER (outcome = 'MISSING') AS ms, count(*) FILTER (outcome = 'VALID') AS va FROM p1 LEFT JOIN w ON token BETWEEN lo AND hi GROUP BY ALL),
e1 AS (SELECT * FROM a1 UNION ALL SELECT * FROM b1)"""
INFO = "'Read: ' || {n} || '; Mismatch: ' || {mi} || '; Corrected Mismatch: 0; Missing: ' || {ms} || '; Corrected Missing: 0; Valid: ' || {va} || '; Skipped: 0; Error: 0; Partitions Passed: ' || {ok} || '; Partitions Failed: 0'"


def recorded_runs(spark: SparkSession, sf_dir: str) -> tracking.RunLog:
    """A validation of the orders on record, range by range, and its resumption over the ranges with differences."""
    log = tracking.RunLog(spark, scratch_path(spark, "runs"))
    orders = table(spark, sf_dir, "orders")
    spec = TableSpec.of(orders, "orders", ["o_orderkey"])
    origin = orders.withColumn("_token", tokens.token60("o_orderkey"))
    plan = as_long(order_ranges(spark, sf_dir), "min", "max").select(F.col("min").alias("token_min"), F.col("max").alias("token_max"))
    run = lambda run_id, prev: lambda part: jobs.recorded_validate(log, run_id, part, origin, "_token", orders_target(orders), spec, spec, JobSpec(), prev)
    run(1, 0)(plan)
    jobs.resume(log, "orders", 1, 2, 3, False, run(2, 1))
    return log


@query(f"WITH {BY_RANGE} SELECT run_id, CAST(lo AS BIGINT) AS token_min, CAST(hi AS BIGINT) AS token_max, CASE WHEN mi + ms = 0 THEN 'PASS' ELSE 'DIFF' END AS status, {INFO.format(n='n', mi='mi', ms='ms', va='va', ok='1')} AS run_info FROM e1")
def recorded_ranges(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How the ranges of a recorded run and of its resumption ended."""
    return tracking.latest_ranges(recorded_runs(spark, sf_dir).details()).select("run_id", "token_min", "token_max", "status", "run_info")


@query(f"WITH {BY_RANGE} SELECT run_id, 'VALIDATE' AS run_type, run_id - 1 AS prev_run_id, 'ENDED' AS status, {INFO.format(n='sum(n)', mi='sum(mi)', ms='sum(ms)', va='sum(va)', ok='count(*)')} AS run_info FROM e1 GROUP BY run_id")
def recorded_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The runs themselves, with the totals of their ranges."""
    return tracking.listed(recorded_runs(spark, sf_dir).info()).select("run_id", "run_type", "prev_run_id", "status", "run_info")


@query(f"WITH {SPLIT}, o AS (SELECT {TOKEN} AS token, o_orderkey FROM orders) SELECT range_id, count(*) AS n_read, count(*) FILTER (o_orderkey % 4 <> 0) AS n_write, count(*) FILTER (o_orderkey % 4 = 0) AS n_skipped FROM o JOIN r ON token BETWEEN \"min\" AND \"max\" GROUP BY 1")
def migrate_by_range(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The counters of a migration by range, in one pass."""
    orders = table(spark, sf_dir, "orders")
    spec = TableSpec.of(orders, "orders", ["o_orderkey"])
    rows = ranges.assigned(orders.withColumn("_token", tokens.token60("o_orderkey")), "_token", order_ranges(spark, sf_dir))
    return jobs.migrate(rows, spec, spec, JobSpec(where="o_orderkey % 4 <> 0"), keep=["range_id"]).counters(["range_id"]).drop("n_error")


@query(f"""WITH {SPLIT}, o AS (SELECT {TOKEN} AS token, o_totalprice, o_orderkey FROM orders), j AS (SELECT range_id, count(token) AS n, count(*) FILTER (o_totalprice > 200000) AS large FROM r LEFT JOIN o ON token BETWEEN "min" AND "max" GROUP BY 1)
SELECT range_id, CASE WHEN bad THEN 'FAIL' ELSE 'PASS' END AS status, 'Read: ' || n || '; Large: ' || CASE WHEN bad THEN 0 ELSE large END || '; Small: ' || CASE WHEN bad THEN 0 ELSE n - large END || '; Error: ' || CASE WHEN bad THEN n ELSE 0 END || '; Partitions Passed: ' || CASE WHEN bad THEN 0 ELSE 1 END || '; Partitions Failed: ' || CASE WHEN bad THEN 1 ELSE 0 END AS run_info
FROM (SELECT *, range_id % 10 = 3 AND n > 0 AS bad FROM j)""")
def user_range_job(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A user's job by range, which raises in every tenth of them: those fail with their rows as errors, and the others end."""
    log = tracking.RunLog(spark, scratch_path(spark, "runs"))
    plan = as_long(order_ranges(spark, sf_dir), "range_id", "min", "max").select("range_id", F.col("min").alias("token_min"), F.col("max").alias("token_max"))
    bad = {r.token_min for r in plan.where("range_id % 10 = 3").select("token_min").collect()}
    registry = jobs.JobRegistry()

    @registry.range_job("price classes", ["LARGE", "SMALL"])
    def classes(low, high, batches, counts):
        if low in bad:
            raise RuntimeError("this range is to fail")
        for batch in batches:
            prices = batch.column("o_totalprice").to_numpy(zero_copy_only=False)
            counts.add("LARGE", int((prices > 200_000).sum()))
            counts.add("SMALL", int((prices <= 200_000).sum()))

    rows = table(spark, sf_dir, "orders").select("o_totalprice", tokens.token60("o_orderkey").alias("_token"))
    done = registry.run_ranges("price classes", log, "orders", 1, plan, rows, "_token")
    return tracking.latest_ranges(done).join(plan, ["token_min"]).select("range_id", "status", "run_info")


@query(f"""WITH {CHECKED}, b AS (SELECT {TOKEN} % 256 AS bucket, outcome FROM v), w AS (SELECT DISTINCT bucket FROM b WHERE outcome <> 'VALID')
SELECT count(*) AS n_rows, count(*) FILTER (outcome <> 'VALID') AS n_written, (SELECT count(*) FROM w) AS n_buckets, count(*) FILTER (bucket IN (SELECT bucket FROM w)) AS n_rewritten FROM b""")
def repaired_buckets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A repair of a bucketed target in place: the rows written, the buckets that hold them, and the rows in those, which alone were
    rewritten."""
    orders = table(spark, sf_dir, "orders")
    spec = TableSpec.of(orders, "orders", ["o_orderkey"])
    store = tables.BucketedTable(spark, scratch_path(spark, "orders"), ["o_orderkey"], 256)
    store.create(orders_target(orders))
    before = stored(store.files(), "files")
    writes, touched = jobs.repair(orders, store, spec, spec, JobSpec(autocorrect_missing=True, autocorrect_mismatch=True))
    new = store.files().join(before.select("file"), "file", "left_anti")
    after = new.agg(F.count("*").alias("n_files"), F.sum("n_rows").cast("long").alias("n_rewritten"))
    both = store.read().agg(F.count("*").alias("n_rows")).crossJoin(after).crossJoin(writes.agg(F.count("*").alias("n_written")))  # one row each
    return both.select("n_rows", "n_written", F.col("n_files").alias("n_buckets"), "n_rewritten")


@query(f"WITH o AS (SELECT {TOKEN} AS token, o_totalprice FROM orders) SELECT count(*) AS n_rows, sum(CAST(round(o_totalprice * 100) AS BIGINT))::BIGINT AS cents, count(*) FILTER (token BETWEEN 200000000000000000 AND 500000000000000000) AS n_inside FROM o")
def user_source_and_sink(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The orders through a user's sink, which lists its files by token range, and back through a user's source, whole and in part."""
    root = scratch_path(spark, "kept")
    plugin.register_sink(spark, "tidemark_kept", plugin.ManifestSink(root, "token"))
    plugin.register_source(spark, "tidemark_kept_rows", plugin.ManifestSource(root, "token", "token long, cents long", 1 << 57))
    rows = table(spark, sf_dir, "orders").select(tokens.token60("o_orderkey").alias("token"), F.round(F.col("o_totalprice") * 100).cast("long").alias("cents"))
    rows.repartitionByRange(8, "token").write.format("tidemark_kept").mode("append").save()
    inside = plugin.range_rows(spark, "tidemark_kept_rows", 200000000000000000, 500000000000000000).agg(F.count("*").alias("n_inside"))
    return plugin.range_rows(spark, "tidemark_kept_rows").agg(F.count("*").alias("n_rows"), F.sum("cents").alias("cents")).crossJoin(inside)  # one row each


KIND = "CASE c_custkey % 3 WHEN 0 THEN 'MIGRATE' WHEN 1 THEN 'VALIDATE' ELSE 'GUARDRAIL' END"


@query(f"SELECT 't' || c_custkey % 5 AS table_name, {KIND} AS run_type, max(c_custkey) AS run_id FROM customer GROUP BY 1, 2")
def latest_run(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tracking.latest_runs(run_info(spark, sf_dir)).select("table_name", "run_type", "run_id")


@query(f"""WITH l AS (SELECT max(c_custkey) AS run_id FROM customer GROUP BY c_custkey % 5, c_custkey % 3) SELECT run_id FROM l WHERE run_id % 6 = 0 OR run_id % 4 IN (0, 2)""")
def runs_to_adopt(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tracking.to_adopt(run_info(spark, sf_dir)).select("run_id")


CHAINS = "SELECT 't' || c_custkey % 5 AS table_name, c_custkey // 5 + 1 AS run_id, c_custkey // 5 % 7 + 1 AS first_run_id, CAST(c_custkey // 35 AS INTEGER) AS depth FROM customer"


def runs_of_tables(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Runs of five tables with the same ids, resumed from the run 7 before each."""
    run = F.floor(F.col("run_id") / 5) + 1
    return run_info(spark, sf_dir).withColumn("run_id", run).withColumn("prev_run_id", F.greatest(F.col("run_id") - 7, F.lit(0)))


@query(CHAINS)
def resume_chain(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tracking.chain(runs_of_tables(spark, sf_dir))


@query(f"SELECT table_name, first_run_id, count(*) AS n_runs, max(depth) AS depth FROM ({CHAINS}) GROUP BY 1, 2")
def resume_chain_all(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The chains of all runs: how many runs each has, and how deep it is."""
    return tracking.chain(runs_of_tables(spark, sf_dir)).groupBy("table_name", "first_run_id").agg(F.count("*").alias("n_runs"), F.max("depth").alias("depth"))


# Counters, reports, events


@query(f"""WITH {CHECKED} SELECT {RANGE_ID} AS range_id, 'Read: ' || count(*) || '; Mismatch: ' || count(*) FILTER (outcome = 'MISMATCH') || '; Corrected Mismatch: 0; Missing: ' || count(*) FILTER (outcome = 'MISSING') || '; Corrected Missing: ' || count(*) FILTER (outcome = 'MISSING')
 || '; Valid: ' || count(*) FILTER (outcome = 'VALID') || '; Skipped: 0; Error: 0; Partitions Passed: 1; Partitions Failed: 0' AS run_info FROM v GROUP BY 1""")
def metrics_strings(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = checked_orders(spark, sf_dir).withColumn("range_id", ranges.range_of(tokens.token60("o_orderkey"), *tokens.RING60, 64))
    by = jobs.validation_counters(rows, ["range_id"], JobSpec(autocorrect_missing=True)).withColumns({"n_skipped": F.lit(0), "n_passed": F.lit(1), "n_failed": F.lit(0)})
    return by.select("range_id", metrics.metrics_string("validate").alias("run_info"))


@query(f"""WITH {CHECKED}, a AS (SELECT outcome, count(*) AS n FROM v GROUP BY 1), b AS (SELECT outcome, count(*) AS n FROM v WHERE o_orderkey % 2 = 0 GROUP BY 1)
SELECT a.outcome AS counter, 'different' AS kind, a.n AS a, b.n AS b FROM a JOIN b ON a.outcome = b.outcome WHERE a.n <> b.n UNION ALL
SELECT 'READ', 'different', (SELECT count(*) FROM orders), (SELECT count(*) FROM orders WHERE o_orderkey % 2 = 0)""")
def counter_blocks(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = checked_orders(spark, sf_dir)
    block = lambda r: metrics.unpivoted(metrics.counters(r, [], ["MISSING", "MISMATCH", "VALID"]))
    return metrics.compare_blocks(block(rows), block(rows.where("o_orderkey % 2 = 0"))).select("counter", "kind", "a", "b")


@query(f"""WITH {CHECKED} SELECT o_orderkey, CAST(n AS INTEGER) AS n, CASE WHEN n = 0 AND outcome = 'MISSING' THEN 'Missing target row found for key: ' || o_orderkey
  WHEN n = 0 THEN 'Mismatch row found for key: ' || o_orderkey || ' Mismatch: Target column:o_totalprice-origin[<redacted>]-target[<redacted>]; '
  WHEN outcome = 'MISSING' THEN 'Inserted missing row in target: ' || o_orderkey ELSE 'Corrected mismatch row in target: ' || o_orderkey END AS line FROM v, (SELECT unnest([0, 1]) AS n) WHERE outcome <> 'VALID'""")
def diff_log_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reports.log_lines(checked_orders(spark, sf_dir), ["o_orderkey"], True, True)


@query(f"""WITH {CHECKED}, w AS (SELECT v.*, t.o_totalprice AS after FROM v LEFT JOIN t ON v.o_orderkey = t.o_orderkey)
SELECT CAST(9 AS BIGINT) AS run_id, CAST(o_orderkey AS VARCHAR) AS "key", lower(outcome) AS kind, CASE WHEN outcome = 'MISMATCH' THEN 'o_totalprice' END AS "column",
  CASE WHEN outcome = 'MISMATCH' THEN CAST(CAST(o_totalprice * 100 AS BIGINT) AS VARCHAR) END AS origin, CASE WHEN outcome = 'MISMATCH' THEN CAST(CAST(after * 100 AS BIGINT) AS VARCHAR) END AS target FROM w WHERE outcome <> 'VALID'""")
def discrepancy_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    records = reports.discrepancies(checked_orders(spark, sf_dir), ["o_orderkey"], 9, redact=False)
    cents = lambda c: F.round(F.col(c).cast("double") * 100).cast("long").cast("string")
    return reports.csv_rows(records).select("run_id", "key", "kind", "column", cents("origin").alias("origin"), cents("target").alias("target"))


@query(f"""WITH {CHECKED}, n AS (SELECT count(*) AS n_read, count(*) FILTER (outcome = 'MISSING') AS n_missing, count(*) FILTER (outcome = 'MISMATCH') AS n_mismatch, count(*) FILTER (outcome = 'VALID') AS n_valid FROM v)
SELECT CAST(unnest(generate_series(0, 11)) AS INTEGER) AS n, unnest([repeat('#', 81), 'RunId: 42', 'Final Read Record Count: ' || n_read, 'Final Mismatch Record Count: ' || n_mismatch, 'Final Corrected Mismatch Record Count: 0', 'Final Missing Record Count: ' || n_missing, 'Final Corrected Missing Record Count: 0',
 'Final Valid Record Count: ' || n_valid, 'Final Skipped Record Count: 0', 'Final Error Record Count: 0', 'Final Partitions Passed: 1', 'Final Partitions Failed: 0']) AS line FROM n UNION ALL SELECT 12, repeat('#', 81) FROM n""")
def final_block(spark: SparkSession, sf_dir: str) -> DataFrame:
    by = jobs.validation_counters(checked_orders(spark, sf_dir), [], JobSpec()).withColumns({"n_skipped": F.lit(0), "n_passed": F.lit(1), "n_failed": F.lit(0)})
    return by.select(F.posexplode(metrics.final_lines("validate", F.lit(42))).alias("n", "line"))


BOUND = "CASE WHEN v < 16 THEN v ELSE (v // s + 1) * s - 1 END"


@query(f"""WITH x AS (SELECT event_type, greatest(CAST(floor(value * 100 - 1000) AS BIGINT), 0) AS v FROM events WHERE value IS NOT NULL), y AS (SELECT *, CAST(pow(2, floor(log2(CASE WHEN v < 16 THEN 16 ELSE v END)) - 4) AS BIGINT) AS s FROM x),
b AS (SELECT event_type, CAST({BOUND} AS BIGINT) AS bound, count(*) AS n FROM y GROUP BY ALL), c AS (SELECT *, sum(n) OVER (PARTITION BY event_type ORDER BY bound) AS upto, sum(n) OVER (PARTITION BY event_type) AS total FROM b)
SELECT event_type, CAST(sum(n) AS BIGINT) AS n, min(bound) FILTER (upto >= ceil(total * 0.5)) AS p50, min(bound) FILTER (upto >= ceil(total * 0.9)) AS p90, min(bound) FILTER (upto >= ceil(total * 0.99)) AS p99, min(bound) FILTER (upto >= ceil(total * 0.999)) AS p999 FROM c GROUP BY event_type""")
def value_percentiles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Values of which some are negative, and count as 0."""
    events = table(spark, sf_dir, "events").select("event_type", F.floor(F.col("value") * 100 - 1000).cast("long").alias("v"))
    return metrics.percentiles(events, F.col("v"), ["event_type"], {"p50": 0.5, "p90": 0.9, "p99": 0.99, "p999": 0.999})


@query("""WITH t AS (SELECT CAST(epoch(date_trunc('second', ts)) AS BIGINT) AS second, count(*) AS marks FROM events GROUP BY 1)
SELECT a.second, a.marks, sum(b.marks) FILTER (b.second > a.second - 1) / 1 AS mean_1s, sum(b.marks) FILTER (b.second > a.second - 10) / 10 AS mean_10s, sum(b.marks) / 60 AS mean_60s
FROM t a JOIN t b ON b.second BETWEEN a.second - 59 AND a.second GROUP BY ALL""")
def event_rates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return metrics.rates(timed_events(spark, sf_dir), "ts", F.lit(1))


def timed_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events").withColumn("ts", F.col("ts").cast("timestamp"))


@query("""WITH t AS (SELECT CAST(epoch(date_trunc('second', ts)) AS BIGINT) AS second, count(*) AS marks FROM events GROUP BY 1)
SELECT second // 86400 AS day, max(m10) AS best_10s, max(m60) AS best_60s FROM (SELECT second, sum(marks) OVER (ORDER BY second RANGE BETWEEN 9 PRECEDING AND CURRENT ROW) / 10 AS m10, sum(marks) OVER (ORDER BY second RANGE BETWEEN 59 PRECEDING AND CURRENT ROW) / 60 AS m60 FROM t) GROUP BY 1""")
def event_rates_unbroken(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The highest trailing means of each day; those at a day's begin count what came before midnight."""
    rates = metrics.rates(timed_events(spark, sf_dir), "ts", F.lit(1), (10, 60))
    return rates.groupBy(F.floor(F.col("second") / 86_400).alias("day")).agg(F.max("mean_10s").alias("best_10s"), F.max("mean_60s").alias("best_60s"))


@query("""WITH t AS (SELECT CAST(epoch(date_trunc('second', ts)) AS BIGINT) AS second, count(*) AS marks FROM events GROUP BY 1), z AS (SELECT min(second) AS begin FROM t),
x AS (SELECT a.second, a.marks, b.second AS s, b.marks AS m, b.second = z.begin AS seed FROM t a, z JOIN t b ON b.second BETWEEN a.second - 2400 AND a.second)
SELECT second, marks, CAST(round(1000 * sum(m * CASE WHEN seed THEN 1 ELSE 1 - exp(-1.0) END * exp(-(second - s) / 1.0))) AS BIGINT) AS ewma_1s,
  CAST(round(1000 * sum(m * CASE WHEN seed THEN 1 ELSE 1 - exp(-0.1) END * exp(-(second - s) / 10.0))) AS BIGINT) AS ewma_10s,
  CAST(round(1000 * sum(m * CASE WHEN seed THEN 1 ELSE 1 - exp(-1 / 60.0) END * exp(-(second - s) / 60.0))) AS BIGINT) AS ewma_60s FROM x GROUP BY ALL""")
def event_ewma(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Exponentially weighted averages by second, in thousandths."""
    averages = metrics.smoothed(timed_events(spark, sf_dir), "ts", F.lit(1))
    return averages.select("second", "marks", *(F.round(1000 * F.col(c)).cast("long").alias(c) for c in ("ewma_1s", "ewma_10s", "ewma_60s")))


@query("SELECT count(*) AS total, CAST(greatest(max(CAST(epoch(date_trunc('second', ts)) AS BIGINT)) - min(CAST(epoch(date_trunc('second', ts)) AS BIGINT)), 1) AS BIGINT) AS seconds FROM events")
def event_throughput(spark: SparkSession, sf_dir: str) -> DataFrame:
    return metrics.throughput(timed_events(spark, sf_dir), "ts", F.lit(1)).select("total", "seconds")


@query("""WITH s AS (SELECT count(*) AS n_rows, CAST(sum(8 + strlen(text) + strlen(lang) + strlen(source) + 8) AS BIGINT) AS n_bytes, CAST(max(greatest(strlen(text), strlen(lang), strlen(source))) AS BIGINT) AS largest_text FROM documents)
SELECT n_rows, n_bytes, largest_text, CAST(greatest(ceil(n_bytes / 1073741824 * 1024 / 10), 1000) AS BIGINT) AS num_parts, CAST(1 AS BIGINT) AS batch_size, CAST(CASE WHEN largest_text > 8000 THEN 100 ELSE 1000 END AS BIGINT) AS fetch_size, CAST(CASE WHEN largest_text > 8000 THEN 5000 ELSE 20000 END AS BIGINT) AS rate_limit FROM s""")
def table_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents")
    return jobs.profile(documents, TableSpec.of(documents, "documents", ["doc_id"]))


@query("""SELECT vec_id, 4 * len(embedding) AS bytes FROM embeddings WHERE 4 * len(embedding) > 100""")
def guardrail_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    embeddings = table(spark, sf_dir, "embeddings")
    size = guardrail.stored_bytes(F.col("embedding"), embeddings.schema["embedding"].dataType) - 4 - 4 * F.size("embedding")
    return embeddings.select("vec_id", size.cast("long").alias("bytes")).where("bytes > 100")


WKT = "CASE WHEN c_acctbal = floor(c_acctbal) THEN CAST(CAST(c_acctbal AS BIGINT) AS VARCHAR) ELSE CAST(c_acctbal AS VARCHAR) END"


@query(f"""WITH w AS (SELECT c_custkey, c_nationkey AS n, {WKT} AS x, c_custkey % 3 AS k FROM customer)
SELECT c_custkey, CASE k WHEN 0 THEN 'POINT (' || x || ' ' || n || '.5)' WHEN 1 THEN 'LINESTRING (' || x || ' ' || n || ', 0 -1.25)' ELSE 'POLYGON ((0 0, ' || x || ' 0.125, 3 ' || n || ', 0 0), (1 1, 2 1, 2 2, 1 1))' END AS text,
  CASE k WHEN 0 THEN 21 WHEN 1 THEN 41 ELSE 9 + 2 * (4 + 4 * 16) END AS bytes FROM w""")
def geometry_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Points, lines and polygons with fractions, read to WKB from texts of other spacing, and written as WKT again."""
    k = F.col("c_custkey") % 3
    x, n = F.expr("CASE WHEN c_acctbal = floor(c_acctbal) THEN CAST(CAST(c_acctbal AS BIGINT) AS STRING) ELSE CAST(CAST(c_acctbal AS DECIMAL(18,2)) AS DOUBLE) END").cast("string"), F.col("c_nationkey").cast("string")
    text = F.when(k == 0, F.format_string("point(%s  %s.50)", x, n)).when(k == 1, F.format_string(" LineString ( %s %s,0 -1.25)", x, n)).otherwise(F.format_string("POLYGON((0 0,%s 0.125,3 %s,0 0),(1 1,2 1,2 2,1 1))", x, n))
    stored = table(spark, sf_dir, "customer").select("c_custkey", geometry.wkb(text).alias("wkb"))
    return stored.select("c_custkey", geometry.wkt("wkb").alias("text"), F.octet_length("wkb").alias("bytes"))


@query("""WITH d AS (SELECT o_orderkey, date_trunc('month', o_orderdate) AS m FROM orders) SELECT o_orderkey, 'closed' AS kind, CAST(epoch_ms(m) AS BIGINT) AS lower_ms, 'month' AS lower_prec, CAST(epoch_ms(m + INTERVAL 3 MONTH) - 1 AS BIGINT) AS upper_ms, 'month' AS upper_prec FROM d""")
def date_ranges(spark: SparkSession, sf_dir: str) -> DataFrame:
    month = F.date_trunc("month", F.col("o_orderdate").cast("timestamp"))
    text = F.concat(F.lit("["), F.date_format(month, "yyyy-MM"), F.lit(" TO "), F.date_format(F.add_months(month, 2), "yyyy-MM"), F.lit("]"))
    return table(spark, sf_dir, "orders").select("o_orderkey", C.date_range(text).alias("r")).select("o_orderkey", "r.*")


def drawn(name: str) -> str:
    return f"('0x' || substr(md5(base || ':{name}'), 1, 15))::BIGINT"


@query(f"""WITH s AS (SELECT c_custkey AS id, ('0x' || substr(md5(c_custkey || ':11'), 1, 15))::BIGINT AS base FROM customer)
SELECT {drawn('id')} % 4611686018427387904 - 2305843009213693952 AS id, CAST({drawn('a')} % 4294967296 - 2147483648 AS INTEGER) AS a, substr(md5(CAST({drawn('b')} AS VARCHAR)), 1, {drawn('b')} % 24 + 1) AS b, {drawn('g')} % 2 = 1 AS g, {drawn('d')} % 1000000000000 AS cents,
  CAST(DATE '1970-01-01' + CAST({drawn('i')} % 40000 AS INTEGER) AS DATE) AS i, CASE WHEN {drawn('z?')} % 100 >= 10 THEN {drawn('z')} % 4611686018427387904 - 2305843009213693952 END AS z FROM s""")
def generated_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows generated for the customers' keys, with nulls in one column."""
    ids = table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("id"))
    kinds = f"id {dict(ids.dtypes)['id']}, a int, b string, g boolean, d decimal(12,2), i date, z bigint"
    rows = generate.rows(ids, "id", schema(kinds), ["id", "a", "b", "g", "d", "i"], 11)
    return rows.select("id", "a", "b", "g", (F.col("d") * 100).cast("long").alias("cents"), "i", "z")


@query("""SELECT c_custkey AS id, list_extract([-2147483648, -1, 0, 1, 2147483647], c_custkey % 5 + 1) AS a, list_extract(['', ' ', chr(233), chr(128512), 'a''b"c', 'x' || chr(9) || 'y' || chr(10) || 'z', 'NULL', '0'], c_custkey % 8 + 1) AS b,
  list_extract([DATE '1970-01-01', DATE '0001-01-01', DATE '9999-12-31', DATE '2024-02-29'], c_custkey % 4 + 1) AS d, CAST(list_extract([0, 1, 2], c_custkey % 3 + 1) AS INTEGER) AS n_list, CAST(list_extract([9999999.99, -9999999.99, 0, 1], c_custkey % 4 + 1) * 100 AS BIGINT) AS cents FROM customer""")
def generated_edges(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The types' edge values, dealt to the customers' keys."""
    ids = table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("id"))
    rows = generate.edge_rows(ids, "id", schema(f"id {dict(ids.dtypes)['id']}, a int, b string, d date, l array<double>, c decimal(9,2)"), ["id"])
    return rows.select("id", "a", "b", "d", F.size("l").alias("n_list"), (F.col("c") * 100).cast("long").alias("cents"))


@query(f"""SELECT type, status, sum(n)::BIGINT AS n_events FROM (
  SELECT 'RangeStarted' AS type, 'STARTED' AS status, count(*) AS n FROM orders WHERE o_orderkey % 3 >= 1
  UNION ALL SELECT 'RangeCompleted', {STATUS}, count(*) FROM orders WHERE o_orderkey % 3 = 2 GROUP BY 2) GROUP BY ALL""")
def run_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events of the tracked ranges by type and status, as the event log would hold them."""
    return reports.range_events(run_details(spark, sf_dir)).groupBy("type", "status").agg(F.count("*").alias("n_events"))



def streamed(spark: SparkSession, sf_dir: str, events: DataFrame, count: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """The events as a log, each twice, the second time an hour later, and counted as a stream; a last event closes all windows."""
    path = scratch_path(spark, "events")
    again = events.withColumn("at", F.col("at") + F.expr("interval 1 hour"))
    end = spark.range(1).select(F.timestamp_seconds(F.lit(1_700_000_000 + 86_400)).alias("at"), F.lit(-1).cast("long").alias("run_id"), F.lit("RunCompleted").alias("type"))
    events.write.json(f"{path}/log")
    again.unionByName(end, allowMissingColumns=True).write.mode("append").json(f"{path}/log")
    return monitor.run_to_files(count(monitor.read_events(spark, f"{path}/log")), f"{path}/out").where("run_id >= 0")


def monitored(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The events of the tracked ranges, and the discrepancies of a validation, as run 9 of another table."""
    found = reports.discrepancy_events(checked_orders(spark, sf_dir), ["o_orderkey"], 9, F.timestamp_seconds(F.lit(1_700_000_005)), table="checked")
    return reports.range_events(run_details(spark, sf_dir)).unionByName(found)


@query(f"""SELECT {TABLE} AS table_name, CAST(1700000001 AS BIGINT) AS second, CAST(o_custkey % 10 AS BIGINT) AS run_id, 'RangeStarted' AS type, count(*) AS n_events, CAST(0 AS BIGINT) AS n_rows FROM orders WHERE o_orderkey % 3 >= 1 GROUP BY 1, 3
UNION ALL SELECT {TABLE}, 1700000002, CAST(o_custkey % 10 AS BIGINT), 'RangeCompleted', count(*), CAST(sum(o_orderkey % 50) AS BIGINT) FROM orders WHERE o_orderkey % 3 = 2 GROUP BY 1, 3""")
def stream_run_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events and rows by second from the event log of the tracked ranges: ranges that complete again an hour later count once."""
    counted = streamed(spark, sf_dir, reports.range_events(run_details(spark, sf_dir)), monitor.per_second)
    return counted.groupBy("table_name", F.unix_seconds("second").alias("second"), "run_id", "type").agg(F.sum("n_events").cast("long").alias("n_events"), F.sum("n_rows").cast("long").alias("n_rows"))


@query(f"""WITH {CHECKED} SELECT 'Discrepancy' AS type, lower(outcome) AS kind, count(*) AS n_events FROM v WHERE outcome <> 'VALID' GROUP BY 2
UNION ALL SELECT 'Warning', NULL, count(*) FROM documents WHERE strlen(text) > 5000 UNION ALL SELECT 'RunCompleted', NULL, count(*) FROM customer""")
def event_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Discrepancies, warnings and ends of runs as the event log holds them."""
    at = F.timestamp_seconds(F.lit(1_700_000_000))
    documents = table(spark, sf_dir, "documents")
    spec = TableSpec.of(documents, "documents", ["doc_id"])
    warned = jobs.migrate(documents, spec, spec, JobSpec(guardrail_kb=5, guardrail_mode="warn")).diagnostics()
    log = reports.discrepancy_events(checked_orders(spark, sf_dir), ["o_orderkey"], 9, at).unionByName(reports.warning_events(warned, ["doc_id"], 9, at)).unionByName(reports.run_events(run_info(spark, sf_dir)))
    return log.groupBy("type", "kind").agg(F.count("*").alias("n_events"))


ENDS = f"""SELECT {TABLE} AS table_name, CAST(o_custkey % 10 AS BIGINT) AS run_id, 'RangeCompleted' AS type, CASE WHEN o_orderkey % 4 = 0 THEN 'PASS' WHEN o_orderkey % 4 = 1 THEN 'FAIL' WHEN o_orderkey % 4 = 2 THEN 'DIFF' ELSE 'DIFF_CORRECTED' END AS what, count(*) AS n_events, CAST(sum(o_orderkey % 50) AS BIGINT) AS n_rows FROM orders WHERE o_orderkey % 3 = 2 GROUP BY 1, 2, 4
UNION ALL SELECT {TABLE}, CAST(o_custkey % 10 AS BIGINT), 'RangeStarted', 'STARTED', count(*), 0 FROM orders WHERE o_orderkey % 3 >= 1 GROUP BY 1, 2
UNION ALL SELECT 'checked', 9, 'Discrepancy', lower(outcome), count(*), count(*) FROM v WHERE outcome <> 'VALID' GROUP BY 4"""


@query(f"WITH {CHECKED} {ENDS}")
def stream_statuses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How ranges ended, and discrepancies by kind, counted from the event log as a stream in which all comes again an hour later."""
    counted = streamed(spark, sf_dir, monitored(spark, sf_dir), monitor.statuses)
    return counted.groupBy("table_name", "run_id", "type", F.coalesce("status", "kind").alias("what")).agg(F.sum("n_events").cast("long").alias("n_events"), F.sum("n_rows").cast("long").alias("n_rows"))


@query(f"""WITH {CHECKED}, e AS ({ENDS}), n AS (SELECT table_name, run_id, CAST(coalesce(sum(n_rows) FILTER (type = 'RangeCompleted'), 0) AS BIGINT) AS n_rows FROM e GROUP BY ALL)
SELECT e.table_name, e.run_id, type || ':' || what AS what, n_events, n.n_rows, n.n_rows / 10 AS rows_per_second FROM e JOIN n USING (table_name, run_id)""")
def stream_progress(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The running numbers of the tracked runs as their events' stream leaves them: events by kind, rows, and rows a second."""
    last = monitor.latest_progress(streamed(spark, sf_dir, monitored(spark, sf_dir), monitor.progress))
    return last.select("table_name", "run_id", F.explode("tallies").alias("what", "n_events"), "n_rows", "rows_per_second")


@query(f"""WITH {CHECKED}, n AS (SELECT count(*) FILTER (outcome <> 'VALID') AS n FROM v) SELECT CASE i WHEN 0 THEN '[' WHEN 1 THEN 'first' WHEN 2 THEN 'more' ELSE ']' END AS part, CASE WHEN i IN (0, 1, 3) THEN 1 ELSE n - 1 END AS n_lines FROM n, (SELECT unnest([0, 1, 2, 3]) AS i)""")
def discrepancy_array(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The lines of the discrepancies' JSON array, hashed values in them: all but the first record begin with a comma."""
    lines = reports.json_array(reports.discrepancies(checked_orders(spark, sf_dir), ["o_orderkey"], 9))
    record = F.from_json(F.regexp_replace("value", "^,", ""), "values_redacted boolean, kind string")
    part = F.when(F.col("value").isin("[", "]"), F.col("value")).when(~record["values_redacted"] | ~record["kind"].isin("missing", "mismatch"), "bad").when(F.col("value").startswith(","), "more").otherwise("first")
    return lines.groupBy(part.alias("part")).agg(F.count("*").alias("n_lines"))


@query("""SELECT lang, count(*) AS n_read, count(*) FILTER (strlen(text) > 5000) AS n_large, CASE WHEN bool_or(strlen(text) > 5000) THEN 'DIFF' ELSE 'PASS' END AS status, CASE WHEN bool_or(strlen(text) > 5000) THEN 1 ELSE 0 END AS exit_code FROM documents GROUP BY lang""")
def guardrail_status(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How guardrail runs over the documents of each language would end."""
    documents = table(spark, sf_dir, "documents")
    large = F.size(guardrail.oversized(documents, 5)) > 0
    by = documents.groupBy("lang").agg(F.count("*").alias("n_read"), F.count_if(large).alias("n_large"))
    no = F.lit(0)
    return by.select("lang", "n_read", "n_large", metrics.run_status(F.lit(False), no, F.col("n_large")).alias("status"), metrics.exit_code(F.lit("ENDED"), no, no, F.col("n_large")).alias("exit_code"))


@query(f"WITH {ORDERS_T} SELECT CASE WHEN o_orderkey % 97 = 0 THEN 'lacking' WHEN o_orderkey % 89 = 0 THEN 'other price' ELSE 'same' END AS kind, count(t.o_orderkey) AS n_stored FROM orders LEFT JOIN t USING (o_orderkey) GROUP BY 1")
def dry_run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A dry run of a repair: the target stays as it was."""
    orders = table(spark, sf_dir, "orders")
    spec = TableSpec.of(orders, "orders", ["o_orderkey"])
    _, after = jobs.autocorrect(orders, orders_target(orders), spec, spec, JobSpec(autocorrect_missing=True, autocorrect_mismatch=True, dry_run=True))
    both = orders.join(after.select(F.col("o_orderkey").alias("_key"), F.col("o_totalprice").alias("_price")), F.col("o_orderkey") == F.col("_key"), "left")
    kind = F.when(F.col("_key").isNull(), "lacking").when(F.col("_price") != F.col("o_totalprice"), "other price").otherwise("same")
    return both.groupBy(kind.alias("kind")).agg(F.count("_key").alias("n_stored"))


@query("SELECT CAST(1700000001 AS BIGINT) AS started, CAST(1700000002 AS BIGINT) AS ended, CAST(1 AS BIGINT) AS seconds, count(*) FILTER (o_orderkey % 3 = 2) AS n_ranges, CAST(sum(o_orderkey % 50) FILTER (o_orderkey % 3 = 2) AS BIGINT) AS n_rows FROM orders")
def run_timing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """When a run began and ended, and the ranges that its node completed, from its events."""
    counted = jobs.validation_counters(checked_orders(spark, sf_dir), [], JobSpec())
    plan = order_ranges(spark, sf_dir).agg(F.count("*").alias("n_ranges"))
    one = reports.summary(counted, plan, JobSpec(), reports.range_events(run_details(spark, sf_dir)))
    return one.select(F.unix_seconds("timing.started").alias("started"), F.unix_seconds("timing.ended").alias("ended"), "timing.seconds", F.col("nodes")[0]["n_ranges"].alias("n_ranges"), F.col("nodes")[0]["n_rows"].alias("n_rows"))


SUMMARY_JOB = JobSpec(autocorrect_missing=True, codecs=frozenset({"INT_STRING", "BIGINT_STRING"}), parts=50)


@query(f"""WITH {CHECKED}, n AS (SELECT count(*) AS n_read, count(*) FILTER (outcome = 'MISSING') AS n_missing, count(*) FILTER (outcome = 'MISMATCH') AS n_mismatch FROM v), {SPLIT}
SELECT sha256('{SUMMARY_JOB.canonical()}') AS config_hash, n_read, n_missing AS missing, n_missing AS corrected_missing, n_mismatch AS mismatch, n_mismatch AS outstanding, (SELECT count(*) FROM r) AS n_ranges FROM n""")
def run_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    counted = jobs.validation_counters(checked_orders(spark, sf_dir), [], SUMMARY_JOB)
    plan = order_ranges(spark, sf_dir).agg(F.count("*").alias("n_ranges"))
    return reports.summary(counted, plan, SUMMARY_JOB).select("config_hash", "counters.n_read", "discrepancies.missing", "discrepancies.corrected_missing", "discrepancies.mismatch", "discrepancies.outstanding", "plan.n_ranges")


# Further operators


@query("""WITH b AS (SELECT s_suppkey FROM supplier WHERE s_suppkey % 3 <> 0 UNION ALL SELECT s_suppkey + 1000000 FROM supplier WHERE s_suppkey % 5 = 0)
SELECT coalesce(a.s_suppkey, b.s_suppkey) AS s_suppkey, a.s_suppkey IS NOT NULL AS in_a, b.s_suppkey IS NOT NULL AS in_b FROM supplier a FULL JOIN b ON a.s_suppkey = b.s_suppkey""")
def all_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    a = table(spark, sf_dir, "supplier").select("s_suppkey")
    more = a.where("s_suppkey % 5 = 0").select((F.col("s_suppkey") + 1000000).cast(a.schema["s_suppkey"].dataType).alias("s_suppkey"))
    return reconcile.all_keys(a, a.where("s_suppkey % 3 <> 0").unionByName(more), ["s_suppkey"])


@query("""WITH d AS (SELECT c_custkey, c_nationkey AS a, c_nationkey + 1 AS b FROM customer WHERE c_custkey % 2 = 0)
SELECT c_custkey, 'value' AS kind, 'c_nationkey' AS "column", CAST(a AS VARCHAR) AS a, CAST(b AS VARCHAR) AS b, (SELECT count(*) FROM d) AS n_differences FROM d ORDER BY c_custkey LIMIT 100""")
def difference_cap(spark: SparkSession, sf_dir: str) -> DataFrame:
    a = table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey")
    b = a.withColumn("c_nationkey", F.when(F.col("c_custkey") % 2 == 0, F.col("c_nationkey") + 1).otherwise(F.col("c_nationkey")))
    return reconcile.capped(reconcile.snapshot_diff(a, b, ["c_custkey"]), ["c_custkey"])


@query("SELECT o_orderkey, o_custkey FROM orders WHERE o_orderkey % 97 = 0 OR o_orderkey % 89 = 0")
def rows_to_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The origin rows behind the discrepancies, read by key."""
    orders = table(spark, sf_dir, "orders")
    found = checked_orders(spark, sf_dir)
    return reconcile.corrections(orders, found, ["o_orderkey"], True, True).select("o_orderkey", "o_custkey")


@query(f"SELECT 't' || c_custkey % 5 AS table_name, c_custkey AS run_id, CASE WHEN c_custkey % 6 = 0 THEN 'INTERRUPTED' ELSE 'ENDED' END AS status FROM customer WHERE {KIND} = 'VALIDATE'")
def runs_list(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tracking.listed(run_info(spark, sf_dir), "VALIDATE").select("table_name", "run_id", "status")


@query("SELECT c_custkey AS run_id, 'ABORTED' AS status, CASE c_custkey % 4 WHEN 0 THEN 'Read: 1; Partitions Failed: 2' WHEN 1 THEN 'Read: 1; Partitions Failed: 0' WHEN 2 THEN 'Partitions Failed: many' END AS run_info FROM customer WHERE c_custkey = 12")
def cancelled_run(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tracking.cancelled(run_info(spark, sf_dir), "t2", 12, F.timestamp_seconds(F.lit(1_800_000_000))).select("run_id", "status", "run_info")


@query("""SELECT o_orderkey, o_orderkey % 10 + o_orderkey % 7 AS list_sum, CAST(2 AS INTEGER) AS list_size, CAST(CASE WHEN o_orderkey % 2 = 0 THEN 1 ELSE 2 END AS INTEGER) AS set_size, CASE WHEN o_orderkey % 13 = 0 THEN NULL ELSE CAST(o_custkey AS BIGINT) END AS map_value, o_orderstatus AS by_name, o_orderkey % 13 = 0 AS failed FROM orders""")
def convert_nested(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lists, sets, maps and structs whose elements are converted; a bad element is an error of its row."""
    key = F.col("o_orderkey")
    text = lambda c: c.cast("string")
    orders = table(spark, sf_dir, "orders").select(
        "o_orderkey",
        "o_custkey",
        "o_orderstatus",
        F.array(text(key % 10), text(key % 7)).alias("l"),
        F.array(F.lit("1"), F.when(key % 2 == 0, "1").otherwise("2")).alias("s"),
        F.create_map(F.when(key % 13 == 0, "x").otherwise("1"), text(F.col("o_custkey"))).alias("m"),
        F.struct(F.col("o_orderstatus").alias("a"), text(key).alias("b")).alias("u"),
    )
    codecs = C.builtin(frozenset({"INT_STRING", "BIGINT_STRING"}))
    to = lambda c, kind, **meta: C.convert(F.col(c), orders.schema[c].dataType, T._parse_datatype_string(kind), codecs, meta)
    lists, sets, maps, structs = to("l", "array<int>"), to("s", "array<int>", set=True), to("m", "map<int,bigint>"), to("u", "struct<b:bigint,a:string>")
    total = F.aggregate(lists.value, F.lit(0), lambda x, y: x + y)
    return orders.select("o_orderkey", total.cast("long").alias("list_sum"), F.size(lists.value).alias("list_size"), F.size(sets.value).alias("set_size"), F.try_element_at(maps.value, F.lit(1)).alias("map_value"), structs.value["a"].alias("by_name"), F.coalesce(maps.failed, F.lit(False)).alias("failed"))


@query("""SELECT o_orderkey, CASE WHEN o_orderkey % 13 = 0 THEN NULL ELSE CAST(o_orderkey % 1000 AS INTEGER) END AS first, CASE WHEN o_orderkey % 13 = 0 THEN NULL ELSE CAST(o_custkey AS BIGINT) END AS second, o_orderkey % 13 = 0 AS failed FROM orders""")
def convert_tuples(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tuples, whose elements are converted by position; a tuple with a bad element is an error of its row."""
    key = F.col("o_orderkey")
    orders = table(spark, sf_dir, "orders").select("o_orderkey", F.struct(F.when(key % 13 == 0, "x").otherwise((key % 1000).cast("string")).alias("_1"), F.col("o_custkey").cast("string").alias("_2")).alias("t"))
    done = C.convert(F.col("t"), orders.schema["t"].dataType, T._parse_datatype_string("struct<_1:int,_2:bigint>"), C.builtin(frozenset({"INT_STRING", "BIGINT_STRING"})))
    good = lambda c: F.when(~done.failed, done.value[c])
    return orders.select("o_orderkey", good("_1").alias("first"), good("_2").alias("second"), done.failed.alias("failed"))


@query("SELECT count(*) AS n_write, count(*) AS n_stored, TRUE AS complete FROM part")
def completion_check(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A migration into an empty target: its own count against the target's rows."""
    part = table(spark, sf_dir, "part")
    spec = TableSpec.of(part, "part", ["p_partkey"])
    job = jobs.migrate(part, spec, spec, JobSpec())
    stored = job.merged(part.where(F.lit(False))).agg(F.lit(1).alias("_one"), F.count("*").alias("n_stored"))
    both = job.counters().withColumn("_one", F.lit(1)).join(stored, "_one")
    return both.select("n_write", "n_stored", reconcile.complete(F.col("n_write"), F.col("n_read"), F.col("n_stored")).alias("complete"))


@query("SELECT c_custkey, 16 AS width, substr(md5(c_custkey || '|' || c_name), 1, 16) AS digest FROM customer")
def key_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "customer").select("c_custkey", F.length(tokens.fingerprint("c_custkey")).alias("width"), tokens.key_digest("c_custkey", "c_name").alias("digest"))


@query(f"SELECT o_orderkey, o_totalprice, {TOKEN} AS token FROM orders WHERE o_totalprice > 1000 AND {TOKEN} BETWEEN 100000000000000000 AND 400000000000000000")
def range_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tables.range_scan(table(spark, sf_dir, "orders"), tokens.token60("o_orderkey"), 100000000000000000, 400000000000000000, ["o_orderkey", "o_totalprice"], "and o_totalprice > 1000")


@query(f"""WITH {CHECKED}, r AS (SELECT {RANGE_ID} AS range_id, outcome FROM v), c AS (SELECT range_id, count(*) AS n_read, count(*) FILTER (outcome = 'VALID' AND range_id % 2 = 0) AS n_valid, count(*) FILTER (outcome = 'MISSING') AS n_missing, count(*) FILTER (outcome = 'MISMATCH') AS n_mismatch FROM r GROUP BY 1)
SELECT range_id, greatest(n_read - n_valid - n_missing - n_mismatch, 0) AS n_lost, CASE WHEN range_id % 2 = 1 THEN 'FAIL' WHEN n_missing + n_mismatch = 0 THEN 'PASS' ELSE 'DIFF' END AS verdict FROM c""")
def failed_ranges(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ranges of odd numbers fail after their discrepancies were counted: what they hadn't counted is lost."""
    rows = checked_orders(spark, sf_dir).withColumn("range_id", ranges.range_of(tokens.token60("o_orderkey"), *tokens.RING60, 64))
    odd = F.col("range_id") % 2 == 1
    by = jobs.validation_counters(rows, ["range_id"], JobSpec()).withColumn("n_valid", F.when(odd, 0).otherwise(F.col("n_valid"))).withColumn("n_skipped", F.lit(0))
    zero = F.lit(0)
    return by.select("range_id", metrics.lost("validate").alias("n_lost"), metrics.verdict(F.col("n_missing"), F.col("n_mismatch"), zero, zero, odd).alias("verdict"))


@query(f"""WITH {SPLIT} SELECT CAST(greatest("min", 200000000000000000) AS BIGINT) AS "min", CAST(least("max", 700000000000000000) AS BIGINT) AS "max" FROM r WHERE "max" >= 200000000000000000 AND "min" <= 700000000000000000""")
def range_clamp(spark: SparkSession, sf_dir: str) -> DataFrame:
    low, high = ranges.resolve_bounds("md5_60", 200000000000000000, 700000000000000000)
    return as_long(ranges.clamped(order_ranges(spark, sf_dir), low, high), "min", "max").select("min", "max")


@query(f"""WITH {SPLIT} SELECT CAST("min" AS BIGINT) AS "min", CAST("max" AS BIGINT) AS "max", 100 AS coverage FROM r WHERE range_id % 3 = 0""")
def work_list_plan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return as_long(ranges.from_work_list(order_ranges(spark, sf_dir).where("range_id % 3 = 0")), "min", "max")

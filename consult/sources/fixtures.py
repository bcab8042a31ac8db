"""Stand-in inputs derived from the driver's parquet tables.

Each builder only shapes rows into the schema a job expects (FIXTURES.md §3);
it does none of the job's work. The same derivations are kept as DuckDB SQL
text (``FIXTURE_SQL``) so oracle queries can inline them as CTEs.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


#: Tables that the consultations are derived from.
CONSULTATION_TABLES = ("lineitem", "orders")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _pid(custkey: Column) -> Column:
    return F.concat(F.lit("P"), F.lpad(custkey.cast("string"), 8, "0"))


def _fl_score(qty: Column) -> Column:
    return F.floor((qty - 1) / 10).cast("int")


def _p_score(priority: Column) -> Column:
    return F.substring(priority, 1, 1).cast("int") - 1


def _status(col: Column, mapping: dict, other) -> Column:
    out = None
    for k, v in mapping.items():
        out = (F.when(col == k, v) if out is None else out.when(col == k, v))
    return out.otherwise(other)


def _joined(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = table(spark, sf_dir, "lineitem")
    od = table(spark, sf_dir, "orders")
    return li.join(od, li.l_orderkey == od.o_orderkey, "inner")


def consultations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Clean 8-column consultation table (one row per line item).

    Line items go to the join as the few short values that are read of them."""
    li = table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_quantity", F.col("l_shipdate").cast("date").alias("contact_date"),
        _status(F.col("l_returnflag"), {"A": 0, "N": 1}, 2).alias("fl_status"),
        (F.col("l_partkey") % 5 == 0).alias("unknown"), (F.col("l_suppkey") % 3).alias("third"))
    od = table(spark, sf_dir, "orders")
    b = li.join(od, li.l_orderkey == od.o_orderkey, "inner").select(
        _pid(F.col("o_custkey")).alias("accident_number"),
        F.col("o_orderdate").cast("date").alias("accident_date"),
        "contact_date",
        _fl_score(F.col("l_quantity")).alias("fl_score"),
        "fl_status",
        _p_score(F.col("o_orderpriority")).alias("p_score"),
        _status(F.col("o_orderstatus"), {"F": 0, "O": 1}, 2).alias("p_status"),
        "unknown", "third",
    )
    nbe = (F.when(F.col("unknown"), F.lit(2))
           .when(F.col("p_score") + F.col("fl_score") - F.col("p_status") - F.col("fl_status")
                 + F.col("third") <= 3, F.lit(1))
           .otherwise(F.lit(0)))
    return b.select("accident_number", "accident_date", "contact_date", "fl_score",
                    "fl_status", "p_score", "p_status", nbe.cast("int").alias("nbe"))


def consultations_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Dirty all-string variant: bad dates, times of day, fractions, nulls,
    out-of-range values, duplicates."""
    j = _joined(spark, sf_dir)
    pk = F.col("l_partkey")
    date_txt = lambda c: F.substring(c.cast("date").cast("string"), 1, 10)
    b = j.select(
        _pid(F.col("o_custkey")).alias("accident_number"),
        F.when(pk % 13 == 0, F.concat(date_txt(F.col("o_orderdate")), F.lit(" 23:00:00")))
         .otherwise(date_txt(F.col("o_orderdate"))).alias("accident_date"),
        F.when(pk % 89 == 0, F.lit("unknown"))
         .when(pk % 13 < 4, F.concat(date_txt(F.col("l_shipdate")), F.lit(" 01:00:00")))
         .otherwise(date_txt(F.col("l_shipdate"))).alias("contact_date"),
        F.when(pk % 97 == 0, F.lit(None).cast("string")).when(pk % 109 == 0, F.lit("2.5"))
         .otherwise(_fl_score(F.col("l_quantity")).cast("string")).alias("fl_score"),
        _status(F.col("l_returnflag"), {"A": "0", "N": "1"}, "2").alias("fl_status"),
        F.when(pk % 101 == 0, F.lit("n/a")).when(pk % 103 == 0, F.lit("9"))
         .otherwise(_p_score(F.col("o_orderpriority")).cast("string")).alias("p_score"),
        _status(F.col("o_orderstatus"), {"F": "0", "O": "1"}, "2").alias("p_status"),
        F.when(pk % 107 == 0, F.lit(None).cast("string")).when(pk % 5 == 0, F.lit("2"))
         .when(F.col("l_suppkey") % 3 == 0, F.lit("0")).otherwise(F.lit("1")).alias("nbe"),
        "l_orderkey",
    )
    cols = ["accident_number", "accident_date", "contact_date", "fl_score",
            "fl_status", "p_score", "p_status", "nbe"]
    return b.select(*cols).unionAll(b.where(F.col("l_orderkey") % 50 == 0).select(*cols))


def scored(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Labels with exact dyadic scores (multiples of 1/32) for the metrics."""
    c = consultations(spark, sf_dir).where(F.col("nbe").isin(0, 1))
    s = (F.lit(16) + F.col("p_status") + F.col("fl_status") + F.col("p_status") * F.col("fl_status")
         - 2 * F.col("p_score") - F.col("fl_score")).cast("double") / 32
    return c.select("accident_number", F.col("nbe").alias("label"), s.alias("score"))


def scoring_requests(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Batch scoring requests with defaults and rule violations."""
    j = _joined(spark, sf_dir)
    pk = F.col("l_partkey")
    return j.select(
        F.concat_ws("-", *[F.col(c).cast("string") for c in
                           ("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey")]).alias("request_id"),
        F.when(pk % 103 == 0, F.lit(5)).otherwise(_p_score(F.col("o_orderpriority"))).cast("int").alias("p_score"),
        _status(F.col("o_orderstatus"), {"F": 0, "O": 1}, 2).cast("int").alias("p_status"),
        _fl_score(F.col("l_quantity")).alias("fl_score"),
        F.when(pk % 107 == 0, F.lit(None).cast("int"))
         .when(F.col("l_returnflag") == "A", F.lit(0))
         .when(F.col("l_returnflag") == "N", F.lit(1)).otherwise(F.lit(2)).cast("int").alias("fl_status"),
        F.when(F.col("l_tax") == 0, F.lit(None).cast("int"))
         .otherwise((pk % 1100).cast("int")).alias("days_since_accident"),
        F.when(F.col("l_discount") == 0, F.lit(None).cast("int"))
         .otherwise(F.col("l_linenumber").cast("int")).alias("consultation_number"),
        F.when(F.col("l_linestatus") == "F", F.lit("minimal")).otherwise(F.lit("detailed")).alias("response_type"),
    )


def request_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Access-log rows from the events table."""
    ev = table(spark, sf_dir, "events")
    et = F.col("event_type")
    path = (F.when(et == "click", "/api/v1/nbe/predict/baseline")
            .when((et == "view") & (F.col("user_id") % 11 == 0), "/docs")
            .when((et == "view") & (F.col("user_id") % 11 == 1), "/api/v1/validation/rules")
            .when(et == "purchase", "/api/v1/nbe/predict/enhanced")
            .when(et == "view", "/api/v1/models/info")
            .when(et == "signup", "/api/v1/health")
            .otherwise("/api/v1/nbe/predict/enhanced"))
    status = (F.when(et == "error", 500).when(F.col("value") > 100, 422).otherwise(200))
    return ev.select(
        F.col("event_id").alias("request_id"), "ts",
        F.concat(F.lit("c"), F.col("user_id").cast("string")).alias("client_id"),
        path.alias("path"), status.alias("status"),
        F.col("value").alias("latency_ms"),
        F.when(F.col("user_id") % 5 == 0, F.lit(None).cast("string"))
         .otherwise(F.concat(F.lit("key-"), (F.col("user_id") % 4).cast("string"))).alias("api_key"),
    )


# Companion key table (key, permission).
API_KEY_ROWS = [("key-0", "all"), ("key-1", "predict"), ("key-1", "info"), ("key-2", "info")]


def api_keys(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(API_KEY_ROWS, "api_key string, permission string")


# Companion limits of a small service (path, requests a minute).
LIMIT_ROWS = [("/api/v1/nbe/predict/baseline", 1), ("/api/v1/nbe/predict/enhanced", 0), ("/api/v1/health", 1)]


def consultations_gaps(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The dirty variant with rows that carry no patient id."""
    gap = (F.col("p_score") == "0") & (F.col("fl_score") == "4")
    raw = consultations_raw(spark, sf_dir)
    return raw.withColumn("accident_number", F.when(F.coalesce(gap, F.lit(False)), F.lit(None))
                          .otherwise(F.col("accident_number")))


def csv_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The dirty variant as CSV lines without a header; rows whose pain score is 9 have one field too many."""
    raw = consultations_raw(spark, sf_dir)
    line = F.concat_ws(",", *[F.coalesce(F.col(c), F.lit("")) for c in raw.columns])
    return raw.select(F.when(F.col("p_score") == "9", F.concat(line, F.lit(",more"))).otherwise(line).alias("value"))


BUILDERS = {
    "consultations": consultations,
    "consultations_raw": consultations_raw,
    "scored": scored,
    "scoring_requests": scoring_requests,
    "request_log": request_log,
}


# ---------------------------------------------------------------------------
# DuckDB text of the same derivations, for the oracle queries.
# ---------------------------------------------------------------------------

FIXTURE_SQL = {
    "consultations": """
consultations AS (
  SELECT accident_number, accident_date, contact_date, fl_score, fl_status, p_score, p_status,
         CAST(CASE WHEN l_partkey % 5 = 0 THEN 2
              WHEN p_score + fl_score - p_status - fl_status + l_suppkey % 3 <= 3 THEN 1
              ELSE 0 END AS INTEGER) AS nbe
  FROM (
    SELECT concat('P', lpad(cast(o.o_custkey AS varchar), 8, '0')) AS accident_number,
           cast(o.o_orderdate AS date) AS accident_date,
           cast(l.l_shipdate AS date) AS contact_date,
           cast(floor((l.l_quantity - 1) / 10) AS int) AS fl_score,
           CASE l.l_returnflag WHEN 'A' THEN 0 WHEN 'N' THEN 1 ELSE 2 END AS fl_status,
           cast(substr(o.o_orderpriority, 1, 1) AS int) - 1 AS p_score,
           CASE o.o_orderstatus WHEN 'F' THEN 0 WHEN 'O' THEN 1 ELSE 2 END AS p_status,
           l.l_partkey, l.l_suppkey
    FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey) b)""",
    "consultations_raw": """
raw_b AS (
  SELECT concat('P', lpad(cast(o.o_custkey AS varchar), 8, '0')) AS accident_number,
         substr(cast(cast(o.o_orderdate AS date) AS varchar), 1, 10)
           || CASE WHEN l.l_partkey % 13 = 0 THEN ' 23:00:00' ELSE '' END AS accident_date,
         CASE WHEN l.l_partkey % 89 = 0 THEN 'unknown'
              WHEN l.l_partkey % 13 < 4 THEN substr(cast(cast(l.l_shipdate AS date) AS varchar), 1, 10) || ' 01:00:00'
              ELSE substr(cast(cast(l.l_shipdate AS date) AS varchar), 1, 10) END AS contact_date,
         CASE WHEN l.l_partkey % 97 = 0 THEN NULL
              WHEN l.l_partkey % 109 = 0 THEN '2.5'
              ELSE cast(cast(floor((l.l_quantity - 1) / 10) AS int) AS varchar) END AS fl_score,
         CASE l.l_returnflag WHEN 'A' THEN '0' WHEN 'N' THEN '1' ELSE '2' END AS fl_status,
         CASE WHEN l.l_partkey % 101 = 0 THEN 'n/a'
              WHEN l.l_partkey % 103 = 0 THEN '9'
              ELSE cast(cast(substr(o.o_orderpriority, 1, 1) AS int) - 1 AS varchar) END AS p_score,
         CASE o.o_orderstatus WHEN 'F' THEN '0' WHEN 'O' THEN '1' ELSE '2' END AS p_status,
         CASE WHEN l.l_partkey % 107 = 0 THEN NULL
              WHEN l.l_partkey % 5 = 0 THEN '2'
              WHEN l.l_suppkey % 3 = 0 THEN '0' ELSE '1' END AS nbe,
         l.l_orderkey
  FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey),
consultations_raw AS (
  SELECT accident_number, accident_date, contact_date, fl_score, fl_status, p_score, p_status, nbe FROM raw_b
  UNION ALL
  SELECT accident_number, accident_date, contact_date, fl_score, fl_status, p_score, p_status, nbe FROM raw_b
  WHERE l_orderkey % 50 = 0)""",
    "consultations_gaps": """
consultations_gaps AS (
  SELECT * REPLACE (CASE WHEN p_score = '0' AND fl_score = '4' THEN NULL ELSE accident_number END AS accident_number)
  FROM consultations_raw)""",
    "scored": """
scored AS (
  SELECT accident_number, nbe AS label,
         cast(16 + p_status + fl_status + p_status * fl_status - 2 * p_score - fl_score AS double) / 32 AS score
  FROM consultations WHERE nbe IN (0, 1))""",
    "scoring_requests": """
scoring_requests AS (
  SELECT concat_ws('-', cast(l.l_orderkey AS varchar), cast(l.l_linenumber AS varchar),
                   cast(l.l_partkey AS varchar), cast(l.l_suppkey AS varchar)) AS request_id,
         CAST(CASE WHEN l.l_partkey % 103 = 0 THEN 5 ELSE cast(substr(o.o_orderpriority, 1, 1) AS int) - 1 END AS INTEGER) AS p_score,
         CAST(CASE o.o_orderstatus WHEN 'F' THEN 0 WHEN 'O' THEN 1 ELSE 2 END AS INTEGER) AS p_status,
         cast(floor((l.l_quantity - 1) / 10) AS int) AS fl_score,
         CAST(CASE WHEN l.l_partkey % 107 = 0 THEN NULL
              WHEN l.l_returnflag = 'A' THEN 0 WHEN l.l_returnflag = 'N' THEN 1 ELSE 2 END AS INTEGER) AS fl_status,
         CASE WHEN l.l_tax = 0 THEN NULL ELSE cast(l.l_partkey % 1100 AS int) END AS days_since_accident,
         CASE WHEN l.l_discount = 0 THEN NULL ELSE cast(l.l_linenumber AS int) END AS consultation_number,
         CASE WHEN l.l_linestatus = 'F' THEN 'minimal' ELSE 'detailed' END AS response_type
  FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey)""",
    "request_log": """
request_log AS (
  SELECT event_id AS request_id, ts, concat('c', cast(user_id AS varchar)) AS client_id,
         CASE WHEN event_type = 'click' THEN '/api/v1/nbe/predict/baseline'
              WHEN event_type = 'purchase' THEN '/api/v1/nbe/predict/enhanced'
              WHEN event_type = 'view' AND user_id % 11 = 0 THEN '/docs'
              WHEN event_type = 'view' AND user_id % 11 = 1 THEN '/api/v1/validation/rules'
              WHEN event_type = 'view' THEN '/api/v1/models/info'
              WHEN event_type = 'signup' THEN '/api/v1/health'
              ELSE '/api/v1/nbe/predict/enhanced' END AS path,
         CASE WHEN event_type = 'error' THEN 500 WHEN value > 100 THEN 422 ELSE 200 END AS status,
         value AS latency_ms,
         CASE WHEN user_id % 5 = 0 THEN NULL ELSE concat('key-', cast(user_id % 4 AS varchar)) END AS api_key
  FROM events)""",
    "api_keys": """
api_keys AS (
  SELECT * FROM (VALUES ('key-0', 'all'), ('key-1', 'predict'), ('key-1', 'info'), ('key-2', 'info'))
  AS t(api_key, permission))""",
}

_DEPS = {"scored": ["consultations"], "consultations_gaps": ["consultations_raw"]}


def with_fixtures(names: list[str], body: str, extra_ctes: str = "") -> str:
    """DuckDB query: WITH <fixture CTEs> [, extra] <body>."""
    order: list[str] = []

    def add(n):
        for d in _DEPS.get(n, []):
            add(d)
        if n not in order:
            order.append(n)
    for n in names:
        add(n)
    ctes = ",".join(FIXTURE_SQL[n] for n in order)
    if extra_ctes:
        ctes = ctes + ",\n" + extra_ctes
    return f"WITH {ctes}\n{body}"


def prediction_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Stand-in prediction events (ts, model_type, probability) from the
    request log: predict calls only, dyadic probability from the id."""
    log = request_log(spark, sf_dir)
    return log.where(F.col("path").startswith("/api/v1/nbe/predict")).select(
        "request_id", "ts",
        F.when(F.col("path").endswith("baseline"), F.lit("baseline")).otherwise(F.lit("enhanced")).alias("model_type"),
        ((F.col("request_id") % 33).cast("double") / 32).alias("nbe_yes_probability"))


FIXTURE_SQL["prediction_log"] = """
prediction_log AS (
  SELECT request_id, ts,
         CASE WHEN path LIKE '%baseline' THEN 'baseline' ELSE 'enhanced' END AS model_type,
         CAST(request_id % 33 AS DOUBLE) / 32 AS nbe_yes_probability
  FROM request_log WHERE path LIKE '/api/v1/nbe/predict%')"""
_DEPS["prediction_log"] = ["request_log"]

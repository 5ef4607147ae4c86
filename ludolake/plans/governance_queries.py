"""Catalog, governance and file quality (ids G, Q, J3-J5)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ludolake.operators import governance as gv
from ludolake.operators import quality as qu
from ludolake.operators import stats
from ludolake.plans.lake_queries import warehouse
from ludolake.plans.registry import query, written_once
from ludolake.plans.sql_views import AS_OF as SQL_AS_OF
from ludolake.plans.views import AS_OF, Lake
from ludolake.session import scratch_path
from ludolake.sources import files

TABLES = ["benchmark", "conversations", "customer", "documents", "embeddings", "events", "labels", "lineitem",
          "nation", "orders", "pages", "part", "region", "supplier"]
ROW_COUNTS = " UNION ALL ".join(f"SELECT '{t}' AS name, count(*) AS row_count FROM {t}" for t in TABLES)
NAMES = ", ".join(f"'{t}'" for t in TABLES)
PII = "regexp_matches(lower(column_name), 'email|phone|ssn|address|name|id')"


def cataloged(lake: Lake) -> str:
    """Catalog of every table in the data folder."""
    return written_once(lake, "catalog", lambda root: gv.catalog_warehouse(lake.spark, lake.sf_dir, root, AS_OF))


def catalog_table(lake: Lake, name: str) -> DataFrame:
    return gv.read_catalog(lake.spark, cataloged(lake), name)


@query("g1_profile_dataset", """
    SELECT 'games' AS name, 'parquet' AS format, count(*) AS row_count, CAST(13 AS INTEGER) AS column_count,
           'public' AS classification, 'store,games' AS tags, true AS has_checksum, true AS has_size FROM games""")
def _(lake):
    row = gv.profile_dataset(lake.spark, "games", files.table_path(warehouse(lake), "games"), "parquet", AS_OF,
                             tags=["store", "games"], classification="public")
    return row.select("name", "format", "row_count", "column_count", "classification",
                      F.array_join("tags", ",").alias("tags"), (F.length("checksum") == 32).alias("has_checksum"),
                      (F.col("size_bytes") > 0).alias("has_size"))


def _profile_sql(table: str, columns: dict[str, str]) -> str:
    lines = []
    for c, kind in columns.items():
        numeric = kind != "string" and kind != "timestamp_ntz"
        low, high = (f"CAST(min({c}) AS VARCHAR)", f"CAST(max({c}) AS VARCHAR)") if numeric else ("NULL", "NULL")
        lines.append(f"SELECT '{c}' AS column_name, '{kind}' AS data_type, count(*) FILTER ({c} IS NULL) > 0 AS nullable, "
                     f"count(DISTINCT {c}) AS unique_values, count(*) FILTER ({c} IS NULL) AS null_count, "
                     f"{low} AS min_value, {high} AS max_value, "
                     f"regexp_matches('{c}', 'email|phone|ssn|address|name|id') AS pii_flag FROM {table}")
    return " UNION ALL ".join(lines)


@query("g2_profile_columns", _profile_sql("orders", {
    "o_orderkey": "bigint", "o_custkey": "bigint", "o_orderstatus": "string", "o_totalprice": "double",
    "o_orderdate": "timestamp_ntz", "o_orderpriority": "string"}))
def profile_orders(lake):
    return stats.profile_columns(lake.table("orders").select(
        "o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate", "o_orderpriority"))


@query("g3_flag_pii_columns", f"""
    SELECT table_name AS name, column_name FROM information_schema.columns
    WHERE table_name IN ({NAMES}) AND {PII}""")
def _(lake):
    flagged = catalog_table(lake, "columns").filter("pii_flag")
    return flagged.join(catalog_table(lake, "datasets").select("dataset_id", "name"), "dataset_id").select(
        "name", "column_name")


@query("g4_onboard_dataset", """
    SELECT 'games' AS name, (SELECT count(*) FROM games) AS row_count, CAST(13 AS BIGINT) AS columns,
           'lineitem,part' AS sources, CAST(1 AS BIGINT) AS accesses""")
def _(lake):
    root = scratch_path(lake.spark, "onboarded")
    gv.onboard_dataset(lake.spark, root, "games", files.table_path(warehouse(lake), "games"), "parquet", AS_OF,
                       sources=["part", "lineitem"], description="Games")
    read = lambda table: gv.read_catalog(lake.spark, root, table)
    return read("datasets").select(
        "name", "row_count", read("columns").agg(F.count(F.lit(1)).alias("n")).scalar().alias("columns"),
        read("lineage").agg(F.array_join(F.sort_array(F.collect_set("source_dataset")), ",").alias("s"))
        .scalar().alias("sources"),
        read("access_logs").agg(F.count(F.lit(1)).alias("n")).scalar().alias("accesses"))


@query("g5_discover", f"""
    SELECT c.name, 'parquet' AS format, 'Auto-discovered parquet dataset' AS description, c.row_count,
           CAST(i.n AS INTEGER) AS column_count
    FROM ({ROW_COUNTS}) c JOIN (SELECT table_name, count(*) AS n FROM information_schema.columns GROUP BY table_name) i
         ON c.name = i.table_name""")
def _(lake):
    return gv.current_datasets(catalog_table(lake, "datasets")).select(
        "name", "format", "description", "row_count", "column_count")


def edges(lake: Lake) -> DataFrame:
    """Lineage drawn from the order lines: part into order."""
    return gv.lineage_edges(lake.table("lineitem").select(
        F.concat(F.lit("part_"), F.col("l_partkey").cast("string")).alias("source_dataset"),
        F.concat(F.lit("order_"), F.col("l_orderkey").cast("string")).alias("target_dataset"),
        F.lit("ETL").alias("transformation_type"), F.col("l_returnflag").alias("transformation_details")), AS_OF)


EDGES = """e AS (SELECT 'part_' || l_partkey AS s, 'order_' || l_orderkey AS t, 'ETL' AS type,
                        l_returnflag AS details FROM lineitem)"""


@query("g6_lineage", f"""WITH {EDGES}
    SELECT 'upstream' AS direction, s AS dataset, type, details FROM e WHERE t = 'order_7'
    UNION ALL SELECT 'downstream', t, type, details FROM e WHERE s = 'order_7'""")
def _(lake):
    root = written_once(lake, "lineage", lambda p: gv.append_catalog(edges(lake), p, "lineage"))
    return gv.lineage_of(gv.read_catalog(lake.spark, root, "lineage"), "order_7")


@query("j5_lineage_neighbours", f"""WITH {EDGES}
    SELECT 'upstream' AS direction, s AS dataset, type, details FROM e WHERE t = 'part_11'
    UNION ALL SELECT 'downstream', t, type, details FROM e WHERE s = 'part_11'""")
def _(lake):
    return gv.lineage_of(edges(lake), "part_11")


@query("g7_log_access", """
    SELECT 'dataset_' || (event_id % 20) AS dataset_name, event_type AS access_type, count(*) AS accesses,
           count(*) FILTER (event_type <> 'error') AS succeeded FROM events GROUP BY ALL""")
def _(lake):
    def write(root: str):
        accesses = lake.table("events").select(
            F.concat(F.lit("dataset_"), (F.col("event_id") % 20).cast("string")).alias("dataset_name"),
            F.col("user_id").cast("string").alias("user_id"), F.col("event_type").alias("access_type"),
            (F.col("event_type") != "error").alias("success"))
        gv.append_catalog(gv.access_rows(accesses, AS_OF), root, "access_logs")

    logs = gv.read_catalog(lake.spark, written_once(lake, "access", write), "access_logs")
    return logs.groupBy("dataset_name", "access_type").agg(
        F.count(F.lit(1)).alias("accesses"), F.count_if("success").alias("succeeded"))


def game_datasets(lake: Lake) -> DataFrame:
    """Each game as a registered dataset."""
    key = F.col("app_id")
    tags = F.filter(F.array(F.lit("win"), F.when(F.col("mac"), F.lit("mac")), F.when(F.col("linux"), F.lit("linux"))),
                    lambda t: t.isNotNull())
    return lake.games.select(
        key.cast("string").alias("dataset_id"), F.col("title").alias("name"),
        F.when(key % 70 == 0, F.lit("")).otherwise(F.col("rating")).alias("description"), tags.alias("tags"),
        F.when(key % 50 == 0, F.lit(0)).otherwise(F.col("user_reviews") + 1).alias("row_count"),
        (F.col("user_reviews") * 1024).cast("bigint").alias("size_bytes"))


def game_columns(lake: Lake) -> DataFrame:
    """Columns of those datasets: one per order line, some personal by name."""
    names = F.when(F.col("l_linenumber") == 1, F.lit("buyer_email")).otherwise(
        F.concat(F.lit("flag_"), F.col("l_returnflag")))
    return lake.table("lineitem").select(
        F.col("l_partkey").cast("string").alias("dataset_id"), names.alias("column_name"),
        stats.flag_pii(names).alias("pii_flag"))


GAME_SETS = """d AS (SELECT app_id, title AS name, CASE WHEN app_id % 70 = 0 THEN '' ELSE rating END AS description,
        mac, linux, CASE WHEN app_id % 50 = 0 THEN 0 ELSE user_reviews + 1 END AS row_count,
        CAST(user_reviews AS BIGINT) * 1024 AS size_bytes FROM games),
    k AS (SELECT l_partkey, l_linenumber = 1 AS pii FROM lineitem)"""


@query("g8_search_catalog", f"""WITH {GAME_SETS}
    SELECT name, description FROM d WHERE (name ILIKE '%red%' OR description ILIKE '%red%') AND linux""")
def _(lake):
    return gv.search_catalog(game_datasets(lake), "RED", ["linux"]).select("name", "description")


@query("g9_catalog_report", f"""WITH {GAME_SETS}
    SELECT (SELECT count(*) FROM d) AS total_datasets, (SELECT round(avg(size_bytes) / 1024 / 1024, 6) FROM d)
           AS avg_dataset_size_mb, (SELECT count(*) FROM d WHERE row_count = 0) AS empty_datasets,
           (SELECT count(*) FROM d WHERE description = '') AS missing_descriptions,
           (SELECT count(*) FROM k) AS total_columns,
           (SELECT count(DISTINCT l_partkey) FROM k WHERE pii) AS datasets_with_pii""")
def catalog_report(lake):
    return gv.catalog_report(game_datasets(lake), game_columns(lake)).withColumn(
        "avg_dataset_size_mb", F.round("avg_dataset_size_mb", 6))


@query("g9_quality_issues", f"""WITH {GAME_SETS}
    SELECT 'empty_datasets' AS type, name AS dataset FROM d WHERE row_count = 0
    UNION ALL SELECT 'missing_descriptions', name FROM d WHERE description = ''""")
def _(lake):
    return gv.quality_issues(game_datasets(lake))


@query("j3_pii_per_dataset", f"""WITH {GAME_SETS}
    SELECT name, count(l_partkey) AS columns, count(*) FILTER (pii) AS pii_columns
    FROM d LEFT JOIN k ON app_id = l_partkey GROUP BY app_id, name""")
def _(lake):
    return gv.pii_per_dataset(game_datasets(lake), game_columns(lake))


@query("j3_datasets_with_pii", f"""WITH {GAME_SETS}
    SELECT name FROM d WHERE app_id IN (SELECT l_partkey FROM k WHERE pii)""")
def _(lake):
    return gv.datasets_with_pii(game_datasets(lake), game_columns(lake)).select("name")


@query("g10_mask_pii", r"""
    WITH p AS (SELECT c_custkey, CASE WHEN c_custkey % 9 = 0 THEN NULL ELSE c_name END AS full_name,
                      lower(replace(c_name, '#', '.')) || '@mail.example.com' AS email FROM customer)
    SELECT c_custkey, regexp_replace(full_name, '(.{2}).*(.{2})', '\1***\2', 'g') AS full_name,
           regexp_replace(email, '(.{2}).*@(.*)\.(.{2,})', '\1***@\2.\3', 'g') AS email FROM p""")
def mask_customers(lake):
    people = lake.table("customer").select(
        "c_custkey", F.when(F.col("c_custkey") % 9 != 0, F.col("c_name")).alias("full_name"),
        F.concat(F.lower(F.replace("c_name", F.lit("#"), F.lit("."))), F.lit("@mail.example.com")).alias("email"))
    return gv.mask_pii(people, ["full_name", "email", "absent"])


@query("g11_check_access", """
    WITH r AS (SELECT event_id, CASE user_id % 4 WHEN 0 THEN 'admin_' WHEN 1 THEN 'analyst_' ELSE 'viewer_' END
                      || user_id AS user_id,
                      CASE WHEN event_id % 3 = 0 THEN 'Sensitive_' ELSE 'open_' END || event_type AS dataset_name,
                      CASE event_type WHEN 'view' THEN 'read' WHEN 'click' THEN 'read' WHEN 'error' THEN 'delete'
                           ELSE 'write' END AS operation FROM events)
    SELECT event_id, CASE WHEN starts_with(user_id, 'admin') THEN true
                          WHEN contains(lower(dataset_name), 'sensitive') AND operation IN ('write', 'delete') THEN false
                          WHEN starts_with(user_id, 'analyst') THEN operation = 'read' ELSE false END AS allowed
    FROM r""")
def _(lake):
    roles = F.element_at(F.array(*[F.lit(x) for x in ("admin_", "analyst_", "viewer_", "viewer_")]),
                         (F.col("user_id") % 4 + 1).cast("int"))
    op = (F.when(F.col("event_type").isin("view", "click"), F.lit("read"))
          .when(F.col("event_type") == "error", F.lit("delete")).otherwise(F.lit("write")))
    requests = lake.table("events").select(
        "event_id", F.concat(roles, F.col("user_id").cast("string")).alias("user_id"),
        F.concat(F.when(F.col("event_id") % 3 == 0, F.lit("Sensitive_")).otherwise(F.lit("open_")),
                 F.col("event_type")).alias("dataset_name"), op.alias("operation"))
    return gv.check_access(requests).select("event_id", "allowed")


def configs(lake: Lake) -> DataFrame:
    """One security configuration per supplier, read back from JSON files."""
    key = F.col("s_suppkey")
    path = written_once(lake, "security", lambda p: lake.table("supplier").select(
        F.struct((key % 3 != 0).alias("enabled"), key.cast("string").alias("algorithm")).alias("encryption"),
        F.struct(F.lit("deny").alias("default_policy")).alias("access_control"),
        F.struct(F.lit(True).alias("gdpr_enabled"), (F.lit(2500) + key).cast("int").alias("data_retention_days"))
        .alias("compliance")).write.json(p))
    return gv.read_security_config(lake.spark, path, multi_line=False)


COMPLIANCE = """v AS (SELECT s_suppkey, s_suppkey % 3 = 0 AS plain, 2500 + s_suppkey > 2555 AS long FROM supplier)"""


@query("g12_compliance_report", f"""WITH {COMPLIANCE}
    SELECT s_suppkey, 'GDPR' AS compliance_framework, CASE WHEN plain THEN 'NON_COMPLIANT' ELSE 'COMPLIANT' END AS status,
           concat_ws('|', CASE WHEN long THEN 'Data retention period exceeds recommended 7 years' END,
                          CASE WHEN plain THEN 'Encryption not enabled' END) AS findings,
           CASE WHEN plain THEN 'Enable data encryption' ELSE '' END AS recommendations FROM v""")
def _(lake):
    return gv.compliance_report(configs(lake)).select(
        F.col("encryption.algorithm").cast("bigint").alias("s_suppkey"), "compliance_framework", "status",
        F.array_join("findings", "|").alias("findings"), F.array_join("recommendations", "|").alias("recommendations"))


@query("g13_governance_audit", f"""WITH {GAME_SETS}, {COMPLIANCE}
    SELECT (SELECT count(*) FROM d) AS total_datasets, (SELECT count(*) FROM k) AS total_columns,
           (SELECT round(avg(size_bytes) / 1024 / 1024, 6) FROM d) AS avg_dataset_size_mb,
           (SELECT count(*) FROM d WHERE row_count = 0) AS empty_datasets,
           (SELECT count(*) FROM d WHERE description = '') AS missing_descriptions,
           (SELECT count(DISTINCT l_partkey) FROM k WHERE pii) AS datasets_with_pii,
           CASE WHEN (SELECT count(*) FROM v WHERE plain) > 0 THEN 'NON_COMPLIANT' ELSE 'COMPLIANT' END AS compliance_status,
           (SELECT string_agg(f || ': ' || n, '|' ORDER BY f) FROM (
                SELECT 'Data retention period exceeds recommended 7 years' AS f, count(*) AS n FROM v WHERE long HAVING count(*) > 0
                UNION ALL SELECT 'Encryption not enabled', count(*) FROM v WHERE plain HAVING count(*) > 0))
               AS compliance_findings,
           concat_ws('|', CASE WHEN (SELECT count(*) FROM d WHERE row_count = 0 OR description = '') > 0
                               THEN 'Address data quality issues identified in the report' END,
                     CASE WHEN (SELECT count(*) FROM v WHERE plain) > 0
                          THEN 'Resolve compliance issues to maintain regulatory compliance' END) AS audit_recommendations""")
def _(lake):
    audit = gv.governance_audit(game_datasets(lake), game_columns(lake), configs(lake))
    found = F.transform("compliance_findings", lambda f: F.concat(f["finding"], F.lit(": "), f["configurations"].cast("string")))
    return audit.withColumns({
        "avg_dataset_size_mb": F.round("avg_dataset_size_mb", 6), "compliance_findings": F.array_join(found, "|"),
        "audit_recommendations": F.array_join("audit_recommendations", "|")})


# ---- file quality -------------------------------------------------------------------------

def listed(lake: Lake) -> DataFrame:
    return files.batch_files(lake.spark, warehouse(lake))


PRESENT = """(SELECT 'reviews' AS t, count(*) AS n FROM reviews UNION ALL SELECT 'games', count(*) FROM games
              UNION ALL SELECT 'logs', count(*) FROM server_logs)"""
EXPECTED = "(VALUES ('reviews'), ('games'), ('logs'), ('configs'), ('catalog')) x(t)"


@query("j4_missing_tables", f"""
    SELECT x.t AS table_name FROM {EXPECTED} WHERE x.t NOT IN (SELECT t FROM {PRESENT} WHERE n > 0)""")
def _(lake):
    return qu.missing_tables(listed(lake))


@query("q1_file_completeness", f"""
    SELECT count(p.t) / 5.0e0 * 100 AS score, string_agg(x.t, ',' ORDER BY x.t) FILTER (p.t IS NULL) AS missing_files
    FROM {EXPECTED} LEFT JOIN (SELECT t FROM {PRESENT} WHERE n > 0) p ON x.t = p.t""")
def _(lake):
    return qu.file_completeness(listed(lake)).withColumn("missing_files", F.array_join("missing_files", ","))


#: A file listing drawn from the events: one file an event, of the tables that a warehouse may have.
LISTED_TABLES = ["reviews", "games", "logs", "configs", "events"]
LISTING = f"""f AS (SELECT ['reviews', 'games', 'logs', 'configs', 'events'][event_id % 5 + 1] AS t,
        CAST(floor(value * 100) AS BIGINT) AS length, ts FROM events)"""
FRESH = f"ts > {SQL_AS_OF} - INTERVAL 24 HOUR AND ts <= {SQL_AS_OF}"


def listing(lake: Lake) -> DataFrame:
    table = F.element_at(F.array(*[F.lit(t) for t in LISTED_TABLES]), (F.col("event_id") % 5 + 1).cast("int"))
    return lake.table("events").select(
        F.concat(F.lit("/warehouse/"), table, F.lit(".parquet/part-"), F.col("event_id").cast("string")).alias("path"),
        F.floor(F.col("value") * 100).cast("bigint").alias("length"), F.col("ts").cast("timestamp").alias("modificationTime"))


@query("q2_file_freshness", f"""WITH {LISTING}
    SELECT round(count(*) FILTER ({FRESH}) * 100.0e0 / count(*), 9) AS score, count(*) FILTER ({FRESH}) AS fresh_files,
           count(*) AS total_files FROM f""")
def _(lake):
    return qu.file_freshness(listing(lake), AS_OF).withColumn("score", F.round("score", 9))


@query("q3_file_size_check", f"""WITH {LISTING}
    SELECT round(count(*) FILTER (length >= 1024) * 100.0e0 / count(*), 9) AS score,
           count(*) FILTER (length < 1024) AS small_files FROM f""")
def _(lake):
    return qu.file_size_check(listing(lake)).withColumn("score", F.round("score", 9))


@query("q4_quality_score", f"""WITH {LISTING},
    s AS (SELECT (5 - count(*) FILTER (n IS NULL)) * 20.0e0 AS completeness, string_agg(x.t, ', ' ORDER BY x.t) FILTER (n IS NULL)
                 AS missing FROM {EXPECTED} LEFT JOIN (SELECT t, count(*) AS n FROM f GROUP BY t) p ON x.t = p.t),
    r AS (SELECT count(*) FILTER ({FRESH}) * 100.0e0 / count(*) AS freshness,
                 count(*) FILTER (length >= 1024) * 100.0e0 / count(*) AS size_consistency,
                 count(*) FILTER (length < 1024) AS small FROM f),
    o AS (SELECT *, (completeness + freshness + size_consistency) / 3.0e0 AS overall FROM s, r)
    SELECT completeness, round(freshness, 9) AS freshness, round(size_consistency, 9) AS size_consistency,
           round(overall, 9) AS overall_score,
           CASE WHEN overall >= 90 THEN 'excellent' WHEN overall >= 70 THEN 'needs attention' ELSE 'critical' END AS grade,
           concat_ws('|', CASE WHEN missing IS NOT NULL THEN 'Missing files: ' || missing END,
                     CASE WHEN freshness < 50 THEN 'Data freshness below 50%' END,
                     CASE WHEN small > 0 THEN 'Suspiciously small files' END) AS issues FROM o""")
def _(lake):
    return qu.quality_score(listing(lake), AS_OF).select(
        "completeness", F.round("freshness", 9).alias("freshness"), F.round("size_consistency", 9).alias("size_consistency"),
        F.round("overall_score", 9).alias("overall_score"), "grade", F.array_join("issues", "|").alias("issues"))


@query("q5_expired_files", f"WITH {LISTING} " + " UNION ALL ".join(
    f"SELECT '{kind}' AS kind, count(*) AS expired FROM f WHERE ts < {SQL_AS_OF} + INTERVAL 40 DAY - INTERVAL {days} DAY"
    for kind, days in qu.RETENTION_DAYS.items()))
def _(lake):
    """Files past each retention, forty days after the data's end."""
    ahead = F.lit(AS_OF).cast("timestamp") + F.make_dt_interval(days=F.lit(40))
    kinds = [qu.expired_files(listing(lake), days, ahead).agg(F.count(F.lit(1)).alias("expired")).select(
        F.lit(kind).alias("kind"), "expired") for kind, days in qu.RETENTION_DAYS.items()]
    return kinds[0].unionByName(kinds[1]).unionByName(kinds[2])


@query("q6_storage_stats", f"SELECT CAST(sum(n) AS BIGINT) AS total_records FROM {PRESENT}")
def _(lake):
    root = warehouse(lake)
    tables = {n: files.read_table(lake.spark, root, n) for n in ("reviews", "games", "logs")}
    return qu.storage_stats(listed(lake), tables).select("total_records")

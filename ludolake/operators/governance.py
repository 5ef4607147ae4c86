"""Catalog, lineage, masking, access and compliance. Catalog tables are append-only Parquet."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ludolake import schemas
from ludolake.functions.predicates import moment
from ludolake.operators.frames import beside, union_all
from ludolake.operators.stats import profile_columns

# Table name, description.
KNOWN_DESCRIPTIONS = {
    "reviews": "Game reviews dari Steam platform dengan sentiment analysis",
    "games": "Game catalog dengan metadata lengkap",
    "logs": "Server logs untuk monitoring dan debugging",
    "configs": "Game server configuration data",
    "catalog": "Game catalog dalam format XML yang sudah di-transform",
}
MAX_RETENTION_DAYS = 2555

CATALOG_SCHEMAS = {"datasets": schemas.DATASETS, "columns": schemas.DATASET_COLUMNS,
                   "lineage": schemas.LINEAGE, "access_logs": schemas.ACCESS_LOGS}


def dataset_id(name: Column) -> Column:
    """A stable id: registering a name again keeps its id and its column rows."""
    return F.md5(name)


def file_fingerprint(spark: SparkSession, path: str, fmt: str = "text") -> DataFrame:
    """size_bytes and checksum of a file or of a folder of files, in one row.

    One rule for every size and number of files: each row of a Parquet file, or each line of any other, is hashed
    with its file's path below ``path``, by two independent 64-bit hashes. Their sums and the number of
    rows make the checksum. It does not depend on the order of rows or files, on change times, or on how
    the reader splits the files.
    """
    listed = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(path).select("length")
    base = path.rstrip("/").rsplit("/", 1)[-1]
    reader = spark.read.option("recursiveFileLookup", True)
    rows = reader.option("mergeSchema", True).parquet(path) if fmt.lower() == "parquet" else reader.text(path)
    # below the folder, or the name alone where the path is a file
    name = F.substring_index(F.col("_metadata.file_path"), f"/{base}/", -1)
    name = F.when(F.endswith(name, F.lit(f"/{base}")), F.lit(base)).otherwise(name)
    keyed = rows.select(name.alias("__file"), F.to_json(F.struct(*[F.col(f"`{c}`") for c in rows.columns])).alias("__row"))
    digest = [F.coalesce(F.sum(F.xxhash64(F.lit(salt), "__file", "__row").cast("decimal(38,0)")), F.lit(0)).cast("string")
              for salt in ("first", "second")]
    return beside(
        listed.agg(F.coalesce(F.sum("length"), F.lit(0)).cast("bigint").alias("size_bytes")),
        keyed.agg(F.md5(F.concat_ws("|", F.count(F.lit(1)).cast("string"), *digest)).alias("checksum")))


def profile_dataset(spark: SparkSession, name: str, path: str, fmt: str, as_of, description: str = "",
                    tags: list[str] | None = None, owner: str = "system",
                    classification: str = "internal") -> DataFrame:
    """One catalog row of a dataset. Rows and columns are counted for Parquet."""
    measures = [file_fingerprint(spark, path, fmt)]
    columns = 0
    if fmt.lower() == "parquet":
        table = spark.read.parquet(path)
        columns = len(table.columns)
        measures.append(table.agg(F.count(F.lit(1)).alias("row_count")))
    row = beside(*measures)
    if "row_count" not in row.columns:
        row = row.withColumn("row_count", F.lit(0).cast("bigint"))
    return row.select(
        dataset_id(F.lit(name)).alias("dataset_id"), F.lit(name).alias("name"), F.lit(path).alias("path"),
        F.lit(fmt).alias("format"), "size_bytes", "row_count", F.lit(columns).alias("column_count"),
        moment(as_of).alias("created_date"), moment(as_of).alias("last_updated"), "checksum",
        F.lit(description).alias("description"),
        F.array(*[F.lit(t) for t in (tags or [])]).cast("array<string>").alias("tags"),
        F.lit(owner).alias("owner"), F.lit(classification).alias("classification"))


def profile_dataset_columns(spark: SparkSession, name: str, path: str, approximate: bool = False) -> DataFrame:
    return profile_columns(spark.read.parquet(path), approximate).select(
        dataset_id(F.lit(name)).alias("dataset_id"), "*")


def lineage_edges(edges: DataFrame, as_of, created_by: str = "system") -> DataFrame:
    """Edges (source_dataset, target_dataset, transformation_type, transformation_details) stamped."""
    return edges.select("source_dataset", "target_dataset", "transformation_type", "transformation_details",
                        moment(as_of).alias("created_date"), F.lit(created_by).alias("created_by"))


def access_rows(accesses: DataFrame, as_of, ip_address: str = "") -> DataFrame:
    """Audit rows of (dataset_name, user_id, access_type, success)."""
    return accesses.select("dataset_name", "user_id", "access_type", moment(as_of).alias("timestamp"),
                           F.lit(ip_address).alias("ip_address"), "success")


def append_catalog(df: DataFrame, root: str, table: str) -> None:
    """Appends rows to a catalog table; every writer only adds files."""
    names = schemas.names(CATALOG_SCHEMAS[table])
    df.select(*names).write.mode("append").parquet(f"{root}/{table}")


def read_catalog(spark: SparkSession, root: str, table: str) -> DataFrame:
    return spark.read.schema(CATALOG_SCHEMAS[table]).parquet(f"{root}/{table}")


def current_datasets(datasets: DataFrame) -> DataFrame:
    """The latest registration of each dataset, with the date of its first one; ties by the whole row."""
    row = F.struct(*datasets.columns)
    return (datasets.groupBy("dataset_id")
            .agg(F.max_by(row, F.struct("last_updated", row)).alias("r"), F.min("created_date").alias("first"))
            .select("r.*", "first").withColumn("created_date", F.col("first")).drop("first"))


def onboarding_rows(spark: SparkSession, name: str, path: str, fmt: str, as_of,
                    sources: list[str] | None = None, approximate: bool = False, **described) -> dict[str, DataFrame]:
    """Catalog rows of a new dataset, by catalog table; ``approximate`` is for the columns' distinct counts."""
    rows = {"datasets": profile_dataset(spark, name, path, fmt, as_of, **described)}
    if fmt.lower() == "parquet":
        rows["columns"] = profile_dataset_columns(spark, name, path, approximate)
    if sources:
        edges = spark.range(1).select(F.explode(F.array(*[F.lit(s) for s in sources])).alias("source_dataset"))
        rows["lineage"] = lineage_edges(edges.withColumns({
            "target_dataset": F.lit(name), "transformation_type": F.lit("ETL"),
            "transformation_details": F.concat(F.lit("Transformed from "), F.col("source_dataset"),
                                               F.lit(" via ETL pipeline"))}), as_of)
    created = spark.range(1).select(F.lit(name).alias("dataset_name"), F.lit("system").alias("user_id"),
                                    F.lit("create").alias("access_type"), F.lit(True).alias("success"))
    rows["access_logs"] = access_rows(created, as_of)
    return rows


def onboard_dataset(spark: SparkSession, root: str, name: str, path: str, fmt: str, as_of,
                    sources: list[str] | None = None, **described) -> None:
    """Registers a dataset: profile, columns, one lineage edge per source, one access row."""
    for table, rows in onboarding_rows(spark, name, path, fmt, as_of, sources, **described).items():
        append_catalog(rows, root, table)


def discover(spark: SparkSession, root: str) -> DataFrame:
    """Datasets below a folder: name, format, description, files and bytes.

    A file, or a folder of part files named like one (``games.parquet/``), is a dataset.
    """
    files = (spark.read.format("binaryFile").option("recursiveFileLookup", True).load(root)
             .select("path", "length"))
    where = r"([^/]+)\.(parquet|csv|json)(/|$)"
    found = files.withColumns({
        "name": F.regexp_extract("path", where, 1), "format": F.regexp_extract("path", where, 2),
        "location": F.regexp_extract("path", r"^(.*?\.(?:parquet|csv|json))(/|$)", 1)})
    described = F.coalesce(
        F.try_element_at(F.create_map(*[F.lit(x) for kv in KNOWN_DESCRIPTIONS.items() for x in kv]), F.col("name")),
        F.concat(F.lit("Auto-discovered "), F.col("format"), F.lit(" dataset")))
    return (found.filter(F.col("name") != "").groupBy("location", "name", "format")
            .agg(F.count(F.lit(1)).alias("files"), F.sum("length").alias("size_bytes"))
            .withColumn("description", described))


def catalog_warehouse(spark: SparkSession, warehouse: str, catalog_root: str, as_of,
                      together: int = 16) -> int:
    """Onboards every dataset found below a folder; loops over datasets, not over data.

    The rows of ``together`` datasets go into one append per catalog table.
    """
    found = discover(spark, warehouse).orderBy("name").collect()
    for start in range(0, len(found), together):
        batch = [onboarding_rows(spark, d["name"], d["location"], d["format"], as_of,
                                 description=d["description"], owner="auto-discovery",
                                 classification="internal", tags=["auto-discovered", "warehouse"])
                 for d in found[start:start + together]]
        for table in CATALOG_SCHEMAS:
            rows = [b[table].select(*schemas.names(CATALOG_SCHEMAS[table])) for b in batch if table in b]
            if rows:
                append_catalog(union_all(*rows), catalog_root, table)
    return len(found)


def lineage_of(lineage: DataFrame, name: str) -> DataFrame:
    """Direct neighbours of a dataset: (direction, dataset, type, details); one pass."""
    sides = F.filter(F.array(
        F.when(F.col("target_dataset") == name, F.struct(F.lit("upstream").alias("direction"),
                                                         F.col("source_dataset").alias("dataset"))),
        F.when(F.col("source_dataset") == name, F.struct(F.lit("downstream").alias("direction"),
                                                         F.col("target_dataset").alias("dataset")))),
        lambda s: s.isNotNull())
    near = lineage.filter((F.col("target_dataset") == name) | (F.col("source_dataset") == name))
    return (near.select(F.explode(sides).alias("s"), F.col("transformation_type").alias("type"),
                        F.col("transformation_details").alias("details"))
            .select("s.direction", "s.dataset", "type", "details"))


def search_catalog(datasets: DataFrame, query: str = "", tags: list[str] | None = None) -> DataFrame:
    """Datasets whose name or description holds the query and that carry every tag."""
    if query:
        like = F.lit(f"%{query}%")
        datasets = datasets.filter(F.ilike("name", like) | F.ilike("description", like))
    for tag in tags or []:
        datasets = datasets.filter(F.array_contains("tags", tag))
    return datasets


def pii_per_dataset(datasets: DataFrame, columns: DataFrame) -> DataFrame:
    """Datasets with their number of columns and of personal columns."""
    per = columns.groupBy("dataset_id").agg(F.count(F.lit(1)).alias("columns"),
                                            F.count_if("pii_flag").alias("pii_columns"))
    return datasets.select("dataset_id", "name").join(per, "dataset_id", "left").select(
        "name", F.coalesce("columns", F.lit(0)).alias("columns"),
        F.coalesce("pii_columns", F.lit(0)).alias("pii_columns"))


def datasets_with_pii(datasets: DataFrame, columns: DataFrame) -> DataFrame:
    return datasets.join(columns.filter("pii_flag"), "dataset_id", "left_semi")


def quality_issues(datasets: DataFrame) -> DataFrame:
    """One row per issue and dataset: (type, dataset)."""
    found = F.filter(F.array(
        F.when(F.col("row_count") == 0, F.lit("empty_datasets")),
        F.when(F.col("description") == "", F.lit("missing_descriptions"))), lambda x: x.isNotNull())
    return datasets.select(F.explode(found).alias("type"), F.col("name").alias("dataset"))


def catalog_report(datasets: DataFrame, columns: DataFrame) -> DataFrame:
    """One row of totals and issue counts; ``quality_issues`` names the datasets."""
    totals = datasets.agg(
        F.count(F.lit(1)).alias("total_datasets"),
        F.coalesce(F.avg("size_bytes") / F.lit(1024.0) / F.lit(1024.0), F.lit(0.0)).alias("avg_dataset_size_mb"),
        F.count_if(F.col("row_count") == 0).alias("empty_datasets"),
        F.count_if(F.col("description") == "").alias("missing_descriptions"))
    cols = columns.agg(F.count(F.lit(1)).alias("total_columns"),
                       F.count_distinct(F.when(F.col("pii_flag"), F.col("dataset_id")))
                       .alias("datasets_with_pii"))
    return beside(totals, cols)


# Masking patterns (pattern, replacement).
EMAIL_MASK = (r"(.{2}).*@(.*)\.(.{2,})", "$1***@$2.$3")
GENERAL_MASK = ("(.{2}).*(.{2})", "$1***$2")


def mask_pii(df: DataFrame, columns: list[str]) -> DataFrame:
    """Masked text of the named columns; null stays null, absent columns are passed over."""
    return df.withColumns({
        c: F.regexp_replace(F.col(c).cast("string"), *(EMAIL_MASK if "email" in c.lower() else GENERAL_MASK))
        for c in columns if c in df.columns})


def check_access(requests: DataFrame, default_policy: str = "deny") -> DataFrame:
    """Requests (user_id, dataset_name, operation) with ``allowed``; the first rule that fits decides."""
    op = F.col("operation")
    allowed = (F.when(F.startswith("user_id", F.lit("admin")), F.lit(True))
               .when(F.contains(F.lower("dataset_name"), F.lit("sensitive")) & op.isin("write", "delete"),
                     F.lit(False))
               .when(F.startswith("user_id", F.lit("analyst")), op == "read")
               .otherwise(F.lit(default_policy == "allow")))
    return requests.withColumn("allowed", allowed)


def read_security_config(spark: SparkSession, path: str, multi_line: bool = True) -> DataFrame:
    return spark.read.schema(
        "encryption STRUCT<enabled: BOOLEAN, algorithm: STRING, key_rotation_days: INT>, "
        "access_control STRUCT<default_policy: STRING>, "
        "compliance STRUCT<gdpr_enabled: BOOLEAN, data_retention_days: INT>").json(path, multiLine=multi_line)


def compliance_report(config: DataFrame) -> DataFrame:
    """Status, findings and recommendations for each configuration row."""
    long = F.col("compliance.data_retention_days") > MAX_RETENTION_DAYS
    plain = ~F.col("encryption.enabled")

    def notes(*pairs):
        return F.filter(F.array(*[F.when(c, F.lit(t)) for c, t in pairs]), lambda x: x.isNotNull())

    return config.withColumns({
        "compliance_framework": F.lit("GDPR"),
        "status": F.when(plain, F.lit("NON_COMPLIANT")).otherwise(F.lit("COMPLIANT")),
        "findings": notes((long, "Data retention period exceeds recommended 7 years"),
                          (plain, "Encryption not enabled")),
        "recommendations": notes((plain, "Enable data encryption")),
    })


def governance_audit(datasets: DataFrame, columns: DataFrame, config: DataFrame) -> DataFrame:
    """Catalog report and compliance of all configurations, with what to do about them.

    Not compliant if any configuration is not; each finding comes with the number of its configurations.
    """
    judged = compliance_report(config)
    found = (judged.select(F.explode("findings").alias("finding")).groupBy("finding")
             .agg(F.count(F.lit(1)).alias("configurations"))
             .agg(F.sort_array(F.collect_list(F.struct("finding", "configurations"))).alias("compliance_findings")))
    bad = F.count_if(F.col("status") != "COMPLIANT")
    status = judged.agg(F.when(bad > 0, F.lit("NON_COMPLIANT")).otherwise(F.lit("COMPLIANT")).alias("compliance_status"))
    both = beside(catalog_report(datasets, columns), status, found)
    issues = (F.col("empty_datasets") + F.col("missing_descriptions")) > 0
    advice = F.filter(F.array(
        F.when(issues, F.lit("Address data quality issues identified in the report")),
        F.when(F.col("compliance_status") != "COMPLIANT",
               F.lit("Resolve compliance issues to maintain regulatory compliance"))),
        lambda x: x.isNotNull())
    return both.withColumn("audit_recommendations", advice)

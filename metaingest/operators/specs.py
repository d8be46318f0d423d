"""Configuration tables as DataFrames, and as specs on the driver."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import minilang as ml
from ..functions._cols import named
from ..functions.paths import PathError, check_xpath
from ..session import local_rows
from ..specs import ApiSpec, BucketSpec, ColumnSpec, ProcessSpec, SpecError

CHANGE, DATA = "C", "D"
_MAPS = ("anchor_args", "request_args", "header_args")


def active_processes(cfg_process: DataFrame) -> DataFrame:
    """Active processes in id order."""
    return cfg_process.where("active_ind = 'Y'").orderBy("process_id")


def api_settings(cfg_api: DataFrame) -> DataFrame:
    """API rows with their lists and maps parsed, ordered by process and type."""
    return _parsed_apis(cfg_api).orderBy("process_id", "api_type")


def _parsed_apis(cfg_api: DataFrame) -> DataFrame:
    def text(name: str) -> Column:
        return F.coalesce(F.col(name), F.lit("")).alias(name)

    return cfg_api.select(
        "process_id",
        "api_type",
        text("base_url"),
        ml.comma_items(F.coalesce("bucket_list", F.lit(""))).alias("buckets"),
        text("since_url_arg_nm"),
        text("anchor_ind_tag_nm"),
        text("anchor_val_tag_nm"),
        ml.kv_map("anchor_filter_args").alias("anchor_args"),
        ml.kv_map("request_filter_args").alias("request_args"),
        ml.kv_map("request_hdr_args").alias("header_args"),
        text("xpath_resp_filter"),
        text("target_chld_tag"),
        text("target_chld_key_tag"),
        "target_key_list",
        ml.content_type("content_type").alias("content_type"),
    )


def bucket_rows(cfg_bucket: DataFrame) -> DataFrame:
    """Bucket columns with flags parsed: by bucket, keys first, then attribute."""
    return _parsed_buckets(cfg_bucket).orderBy("process_id", "api_type", "bucket_nm", F.desc("is_key"), "attr_nm")


def _parsed_buckets(cfg_bucket: DataFrame) -> DataFrame:
    return cfg_bucket.select(
        "process_id",
        "api_type",
        "bucket_nm",
        "target_table_nm",
        "attr_nm",
        "attr_ora_type",
        F.coalesce(F.col("attr_ora_type_len").cast("int"), F.lit(-1)).alias("attr_len"),
        ml.is_yes("attr_is_key").alias("is_key"),
        "attr_xpath",
        ml.is_yes("attr_is_xml_body").alias("is_body"),
    )


def bucket_columns(cfg_bucket: DataFrame) -> DataFrame:
    """One row per bucket: its columns as an array (keys first) and its key names."""
    column = F.struct(
        (~F.col("is_key")).alias("not_key"),
        F.col("attr_nm").alias("name"),
        F.col("attr_ora_type").alias("config_type"),
        F.col("attr_len").alias("length"),
        F.col("attr_xpath").alias("path"),
        "is_body",
    )
    grouped = (
        _parsed_buckets(cfg_bucket)
        .groupBy("process_id", "api_type", "bucket_nm")
        .agg(
            F.min("target_table_nm").alias("table_nm"),
            F.sort_array(F.collect_list(F.when(F.col("attr_nm").isNotNull(), column))).alias("columns"),
        )
    )
    keys = F.transform(F.filter("columns", lambda c: ~c["not_key"]), lambda c: c["name"])
    return grouped.withColumn("keys", keys)


def process_settings(cfg_process: DataFrame, cfg_api: DataFrame, cfg_bucket: DataFrame) -> DataFrame:
    """One row per active process: its C and D settings, each with its buckets.

    Both joins and the pivot are keyed by process, and Spark broadcasts the
    smaller side only if its measured size allows it.
    """
    bucket = F.struct(F.col("bucket_nm").alias("name"), "table_nm", "columns")
    buckets = (
        bucket_columns(cfg_bucket)
        .groupBy("process_id", "api_type")
        .agg(F.sort_array(F.collect_list(bucket)).alias("bucket_specs"))
    )
    apis = _parsed_apis(cfg_api)
    setting = F.struct(*[c for c in apis.columns if c not in ("process_id", "api_type")], "bucket_specs")

    def of_type(api_type: str) -> Column:
        return F.first(F.when(F.col("api_type") == api_type, setting), ignorenulls=True)

    pivoted = (
        apis.join(buckets, ["process_id", "api_type"], "left")
        .groupBy("process_id")
        .agg(of_type(CHANGE).alias("change_api"), of_type(DATA).alias("data_api"))
    )
    active = cfg_process.where("active_ind = 'Y'").select("process_id", "process_name")
    return active.join(pivoted, "process_id").orderBy("process_id")


def inline_keys(df: DataFrame, column: str, key_name: str = "key") -> DataFrame:
    """Distinct non-blank keys of comma lists."""
    return df.select(F.explode(ml.comma_keys(column)).alias(key_name)).distinct()


def table_keys(df: DataFrame, column: str, key_name: str = "key") -> DataFrame:
    """Distinct non-null keys of a table column, as text.

    Whole numbers are made distinct as such; only those that remain become text.
    """
    key = named(column)
    keys = df.where(key.isNotNull()).select(key.alias(key_name))
    text = F.col(key_name).cast("string").alias(key_name)
    if isinstance(keys.schema[0].dataType, T.IntegralType):
        return keys.distinct().select(text)
    return keys.select(text).distinct()


def key_frame(spark: SparkSession, api: ApiSpec, resolve=None) -> DataFrame:
    """Keys of a configured list: a table's key column, or the list itself.

    ``resolve`` maps a table name to a DataFrame; by default ``spark.table``.
    """
    text = api.key_list or ""
    if "_" in text:
        return table_keys((resolve or spark.table)(text.strip()), api.key_tag)
    keys = list(dict.fromkeys(k for k in (part.strip() for part in text.split(",")) if k))
    return local_rows(spark, "key string", [(k,) for k in keys])


def has_keys(spark: SparkSession, api: ApiSpec, resolve=None) -> bool:
    """Whether ``key_frame`` has rows; of a table, no more is read than tells it."""
    text = api.key_list or ""
    if "_" not in text:
        return any(part.strip() for part in text.split(","))
    rows = (resolve or spark.table)(text.strip())
    return rows.where(named(api.key_tag).isNotNull()).select(named(api.key_tag)).first() is not None


def load_specs(
    spark: SparkSession, cfg_process: DataFrame, cfg_api: DataFrame, cfg_bucket: DataFrame
) -> tuple[list[ProcessSpec], dict[int, str]]:
    """Specs of the runnable active processes, and why the others are not.

    Only configuration reaches the driver: one row per active process.
    """
    specs, skipped = [], {}
    active = active_processes(cfg_process).select("process_id").collect()
    settings = process_settings(cfg_process, cfg_api, cfg_bucket)
    # Maps lose their order on the way to the driver, lists of pairs do not.
    sides = [
        F.when(
            F.col(side).isNotNull(),
            F.struct(f"{side}.*", *[F.map_entries(f"{side}.{m}").alias(f"{m}_list") for m in _MAPS]),
        ).alias(side)
        for side in ("change_api", "data_api")
    ]
    rows = {row["process_id"]: row for row in settings.select("process_id", "process_name", *sides).collect()}
    for process_id in (row["process_id"] for row in active):
        row = rows.get(process_id)
        if row is None:
            skipped[process_id] = "no API configuration"
            continue
        try:
            spec = ProcessSpec(
                process_id, row["process_name"] or "", _api(row["change_api"]), _api(row["data_api"])
            )
            for path in spec.validate():
                check_xpath(spark, path)
            specs.append(spec)
        except (SpecError, PathError) as error:
            skipped[process_id] = str(error)
    return specs, skipped


def _api(row) -> ApiSpec | None:
    if row is None:
        return None
    configured = {b["name"]: b for b in row["bucket_specs"] or []}
    names = list(dict.fromkeys([n for n in row["buckets"] if n] + list(configured)))
    return ApiSpec(
        base_url=row["base_url"],
        since_arg=row["since_url_arg_nm"],
        anchor_indicator=row["anchor_ind_tag_nm"],
        anchor_element=row["anchor_val_tag_nm"],
        **{m: {pair["key"]: pair["value"] for pair in row[f"{m}_list"]} for m in _MAPS},
        response_filter=row["xpath_resp_filter"],
        record_tag=row["target_chld_tag"],
        key_tag=row["target_chld_key_tag"],
        key_list=row["target_key_list"],
        content_type=row["content_type"],
        buckets=tuple(_bucket(name, configured.get(name)) for name in names),
    )


def _bucket(name: str, row) -> BucketSpec:
    if row is None:
        return BucketSpec(name)
    columns = tuple(
        ColumnSpec(c["name"], c["path"] or "", c["config_type"] or "", c["length"], not c["not_key"], c["is_body"])
        for c in row["columns"]
    )
    return BucketSpec(name, row["table_nm"], columns)

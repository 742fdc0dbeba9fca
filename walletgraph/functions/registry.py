"""The library's functions under names for SQL."""

from pyspark.sql import SparkSession

from walletgraph.functions import keys
from walletgraph.functions.script import EXTENDED_PREFIXES, KEY_PATTERN


def register(spark: SparkSession) -> None:
    spark.udf.register("derive_addresses", keys.derive_addresses())
    spark.udf.register("derive_many", keys.derive_many())
    spark.udf.register("decompress_pubkey", keys.decompress_pubkey())
    pattern = KEY_PATTERN.replace("\\", "\\\\").replace("'", "\\'")
    prefixes = ", ".join(f"'{x}'" for x in EXTENDED_PREFIXES)
    for signature, kind, body in (
        ("parse_push_data(asm STRING)", "ARRAY<STRING>", "filter(split(trim(asm), '\\\\s+'), x -> x <> '' AND NOT startswith(x, 'OP'))"),
        ("parse_desc(d STRING)", "ARRAY<STRING>", f"regexp_extract_all(substring_index(translate(d, ' ', ''), '#', 1), '{pattern}', 2)"),
        ("revealed_key(w STRING, a STRING)", "STRING", "CASE WHEN w IS NOT NULL THEN trim(substring_index(w, ',', -1)) ELSE trim(substring_index(a, ' ', -1)) END"),
        ("is_extended_key(k STRING)", "BOOLEAN", f"substring(k, 1, 4) IN ({prefixes})"),
    ):
        spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION {signature} RETURNS {kind} RETURN {body}")

"""A business registry derived from customer, supplier, part and documents.

The statements use only what Spark SQL and DuckDB read alike, so that both engines make
the same rows.  Braces hold table names.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

_BASE = """
SELECT c.c_custkey AS k, p.p_name AS word, lower(c.c_mktsegment) AS segment,
  CASE c.c_custkey % 7 WHEN 0 THEN ' Inc.' WHEN 1 THEN ' LLC' WHEN 2 THEN ' Pvt Ltd' WHEN 3 THEN ' Company'
    WHEN 4 THEN ' & Sons' WHEN 5 THEN '.com Holdings' ELSE '' END AS suffix,
  CAST(100 + c.c_custkey % 900 AS STRING) AS house,
  CASE c.c_custkey % 13 WHEN 0 THEN 'Newton Street' WHEN 1 THEN 'Lake Road' WHEN 2 THEN 'Station Road' WHEN 3 THEN 'Maple Avenue'
    WHEN 4 THEN 'Gandhi Nagar' WHEN 5 THEN 'Hill Lane' WHEN 6 THEN 'Rue Lafayette' WHEN 7 THEN 'Park Street' WHEN 8 THEN 'Wayne Avenue'
    WHEN 9 THEN 'First Cross Malabar' WHEN 10 THEN 'Church Road' WHEN 11 THEN 'Plot 7 Orchard' ELSE 'Mill Drive' END AS street,
  CASE c.c_custkey % 5 WHEN 0 THEN 'Springfield' WHEN 1 THEN 'Chennai' WHEN 2 THEN 'Lyon' WHEN 3 THEN 'Pune' ELSE 'Dayton' END AS city,
  CASE c.c_nationkey % 3 WHEN 1 THEN CAST(100000 + c.c_custkey * 371 % 899999 AS STRING)
    ELSE CAST(10000 + c.c_custkey * 37 % 89999 AS STRING) END AS postal,
  CASE c.c_nationkey % 3 WHEN 0 THEN 'US' WHEN 1 THEN 'India' ELSE 'France' END AS country
FROM {customer} c JOIN {part} p ON p.p_partkey = c.c_custkey % (SELECT count(*) FROM {part})
"""

#: Letters and digits, and their full-width forms, which NFKC makes plain.
PLAIN = "abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789"
WIDE = "".join(chr(ord(c) + 0xFEE0) for c in PLAIN)
_ADDRESS = "house || ' ' || street || ', ' || city || ' ' || postal"


def _noisy(prefix: str, suffix: str, phase: str) -> str:
    return f"""SELECT '{prefix}-' || CAST(k AS STRING) || '{suffix}' AS entity_id, k,
  CASE {phase} WHEN 1 THEN word || ' ' || segment
    WHEN 2 THEN replace(replace(word, 'o', '0'), 'e', '3') || ' ' || segment || suffix
    WHEN 3 THEN segment || ' ' || word || suffix
    WHEN 4 THEN substr(word, 1, 2) || substr(word, 4) || ' ' || segment || suffix
    ELSE word || ' ' || segment || suffix END AS business_name,
  CASE WHEN {phase} = 5 THEN '' ELSE {_ADDRESS} END AS business_address, country"""


def statements(**tables: str) -> dict[str, str]:
    """Statements for s1, s2, s3 and truth, over the given table names or subqueries."""
    base = f"({_BASE}) base".format(**tables)
    accented = "CASE WHEN k % 11 = 3 THEN translate(word || ' ' || segment, 'aeu', 'áéü') ELSE word || ' ' || segment END || suffix"
    s1 = f"SELECT 'S1-' || CAST(k AS STRING) AS entity_id, {accented} AS business_name, {_ADDRESS} AS business_address, country FROM {base}"
    decoys = f"""
SELECT 'S2-D' || CAST(s.s_suppkey AS STRING) AS entity_id,
  CASE WHEN s.s_suppkey % 2 = 0 THEN 'quiet harbour ' || lower(s.s_name) ELSE b.word || ' ' || b.segment || b.suffix END AS business_name,
  CASE WHEN s.s_suppkey % 2 = 0 THEN b.house || ' ' || b.street || ', ' || b.city || ' ' || b.postal
    ELSE b.house || ' ' || b.street || ', ' || b.city || ' ' || CAST(99999 - s.s_suppkey AS STRING) END AS business_address, b.country
FROM {{supplier}} s JOIN ({_BASE}) b ON b.k = s.s_suppkey""".format(**tables)
    columns = "entity_id, business_name, business_address, country"
    s2 = f"SELECT {columns} FROM ({_noisy('S2', '', 'k % 6')} FROM {base} WHERE k % 4 <> 0) x UNION ALL SELECT {columns} FROM ({decoys}) d"
    once, again = _noisy("S3", "", "(k + 2) % 6"), _noisy("S3", "b", "(k + 3) % 6")
    wide = ", ".join(f"CASE WHEN k % 10 = 7 THEN translate({c}, '{PLAIN}', '{WIDE}') ELSE {c} END AS {c}" for c in ("business_name", "business_address"))
    s3 = f"SELECT entity_id, {wide}, country FROM ({once} FROM {base} WHERE k % 3 <> 0) x UNION ALL SELECT {columns} FROM ({again} FROM {base} WHERE k % 3 <> 0 AND k % 5 = 0) y"
    custom = tables["customer"]
    truth = f"""
SELECT 'S1-' || CAST(c_custkey AS STRING) AS source1_entity_id, 'S2-' || CAST(c_custkey AS STRING) AS id FROM {custom} WHERE c_custkey % 4 <> 0
UNION ALL SELECT 'S1-' || CAST(c_custkey AS STRING), 'S3-' || CAST(c_custkey AS STRING) FROM {custom} WHERE c_custkey % 3 <> 0
UNION ALL SELECT 'S1-' || CAST(c_custkey AS STRING), 'S3-' || CAST(c_custkey AS STRING) || 'b' FROM {custom} WHERE c_custkey % 3 <> 0 AND c_custkey % 5 = 0"""
    return {"s1": s1, "s2": s2, "s3": s3, "truth_pairs": truth}


class Registry:
    """s1, s2, s3 (raw records) and truth (source1_entity_id, ids)."""

    def __init__(self, spark: SparkSession, sf_dir: str) -> None:
        names = ("customer", "supplier", "part")
        tables = {t: spark.read.parquet(f"{sf_dir}/{t}.parquet") for t in names}
        made = {k: spark.sql(s, **tables) for k, s in statements(**{t: f"{{{t}}}" for t in names}).items()}
        self.s1, self.s2, self.s3, self.truth_pairs = made["s1"], made["s2"], made["s3"], made["truth_pairs"]

    @property
    def truth(self) -> DataFrame:
        from pyspark.sql import functions as F

        ids = self.truth_pairs.groupBy("source1_entity_id").agg(F.array_sort(F.collect_list("id")).alias("ids"))
        rows = self.s1.select(F.col("entity_id").alias("source1_entity_id"), "country").join(ids, "source1_entity_id", "left")
        return rows.withColumn("ids", F.coalesce("ids", F.array().cast("array<string>")))

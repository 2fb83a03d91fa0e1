"""Noisy page headers made from the order tables: eight orders are a document, a line item is a page.

Twelve of twenty pages are clean; the others have letters for digits, an extra digit, a lost letter, a confusable code, a lost
separator, nothing at all, stray spaces, or a country that is too long.
"""

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc, page_idx, order_no, header, clean, k (kind of noise), confidence, quantity, price."""
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderstatus")
    items = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_extendedprice", "l_discount")
    both = items.join(orders, F.col("l_orderkey") == F.col("o_orderkey"))
    letter = lambda x: F.char(F.lit(65) + x % 26)
    key = F.col("o_orderkey")
    lead = F.concat_ws("-", "o_orderstatus", F.concat(letter(F.col("o_custkey")), letter(F.floor(F.col("o_custkey") / 26))))
    code = F.get(F.array(*map(F.lit, ("020H", "UEL", "WFE", "5U5"))), (key % 4).cast("int"))
    mark, digits = F.when(key % 2 == 0, "S").otherwise("R"), F.lpad((key * 37 + 17000000).cast("string"), 8, "0")
    b = both.select(
        F.floor(key / 8).alias("doc"), key.alias("order_no"), lead.alias("lead"), code.alias("code"), mark.alias("mark"), digits.alias("digits"),
        ((F.col("l_partkey") * 31 + F.col("l_linenumber") * 7 + F.col("l_suppkey")) % 20).cast("int").alias("k"), (F.col("l_discount") * 1000).alias("confidence"),
        F.col("l_quantity").alias("quantity"), F.col("l_extendedprice").alias("price"), "l_linenumber", "l_partkey", "l_suppkey",
    )
    columns = ("lead", "code", "mark", "digits")
    join = lambda *p: F.concat(*[x if isinstance(x, Column) else F.col(x) if x in columns else F.lit(x) for x in p])
    clean = join("lead", "-", "code", "-", "mark", "digits")
    other = F.when(F.col("code") == "020H", "02OH").when(F.col("code") == "UEL", "UEI").otherwise(F.col("code"))
    status, country = F.substring_index("lead", "-", 1), F.substring_index("lead", "-", -1)
    noisy = (
        F.when(F.col("k") == 0, join("lead", "-", "code", "-", "mark", F.replace("digits", F.lit("0"), F.lit("O"))))
        .when(F.col("k") == 1, F.concat(clean, F.lit("7"))).when(F.col("k") == 2, join("lead", "-", "code", "-", "digits"))
        .when(F.col("k") == 3, join("lead", "-", other, "-", "mark", "digits")).when(F.col("k") == 4, join(status, country, "-", "code", "-", "mark", "digits"))
        .when(F.col("k") == 5, "").when(F.col("k") == 6, F.concat(F.lit(" "), F.lower(status), F.lit("- "), F.lower(join(country, "-", "code", "-", "mark", "digits"))))
        .when(F.col("k") == 7, join(status, "--C", country, "-", "code", "-", "mark", "digits", "-")).otherwise(clean)
    )
    order = Window.partitionBy("doc").orderBy("order_no", "l_linenumber", "l_partkey", "l_suppkey", "quantity", "price")
    v = b.withColumns({"clean": clean, "header": noisy, "page_idx": F.row_number().over(order) - 1})
    return v.select("doc", "page_idx", "order_no", "header", "clean", "k", "confidence", "quantity", "price")


PAGES_SQL = """
pv0 AS (SELECT o_orderkey // 8 AS doc, o_orderkey AS order_no, o_orderstatus AS st, chr(CAST(65 + o_custkey % 26 AS INT)) || chr(CAST(65 + (o_custkey // 26) % 26 AS INT)) AS ct,
  CASE o_orderkey % 4 WHEN 0 THEN '020H' WHEN 1 THEN 'UEL' WHEN 2 THEN 'WFE' ELSE '5U5' END AS cd, CASE WHEN o_orderkey % 2 = 0 THEN 'S' ELSE 'R' END AS mk,
  lpad(CAST(o_orderkey * 37 + 17000000 AS VARCHAR), 8, '0') AS dg, CAST((l_partkey * 31 + l_linenumber * 7 + l_suppkey) % 20 AS INT) AS k, l_discount * 1000 AS confidence,
  l_quantity AS quantity, l_extendedprice AS price,
  CAST(row_number() OVER (PARTITION BY o_orderkey // 8 ORDER BY o_orderkey, l_linenumber, l_partkey, l_suppkey, l_quantity, l_extendedprice) - 1 AS INT) AS page_idx
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey),
v AS (SELECT doc, page_idx, order_no, k, confidence, quantity, price, st || '-' || ct || '-' || cd || '-' || mk || dg AS clean,
  CASE k WHEN 0 THEN st || '-' || ct || '-' || cd || '-' || mk || replace(dg, '0', 'O') WHEN 1 THEN st || '-' || ct || '-' || cd || '-' || mk || dg || '7'
    WHEN 2 THEN st || '-' || ct || '-' || cd || '-' || dg
    WHEN 3 THEN st || '-' || ct || '-' || CASE cd WHEN '020H' THEN '02OH' WHEN 'UEL' THEN 'UEI' ELSE cd END || '-' || mk || dg
    WHEN 4 THEN st || ct || '-' || cd || '-' || mk || dg WHEN 5 THEN ''
    WHEN 6 THEN ' ' || lower(st) || '- ' || lower(ct || '-' || cd || '-' || mk || dg) WHEN 7 THEN st || '--C' || ct || '-' || cd || '-' || mk || dg || '-'
    ELSE st || '-' || ct || '-' || cd || '-' || mk || dg END AS header FROM pv0)
"""


def fields_sql(source: str, column: str, out: str) -> str:
    """CTEs that add to source what with_header_fields adds, as out."""
    four = (
        "20 + CASE WHEN regexp_matches(p[1], '^[A-Z]$') THEN 15 WHEN regexp_matches(p[1], '^[A-Z0-9]{1,2}$') THEN 8 ELSE 0 END"
        " + CASE WHEN regexp_matches(p[2], '^[A-Z]{1,2}$') THEN 12 WHEN regexp_matches(p[2], '^[A-Z0-9]{1,6}$') THEN 4 ELSE 0 END"
        " + CASE WHEN regexp_matches(p[3], '^[A-Z0-9]{2,4}$') THEN 15 WHEN regexp_matches(p[3], '^[A-Z0-9]{1,8}$') THEN 6 ELSE 0 END"
        " + CASE WHEN vs THEN 35 WHEN nd >= 6 THEN 4 ELSE 0 END"
    )
    three = (
        "10 + CASE WHEN regexp_matches(p[1], '^[A-Z]$') THEN 10 WHEN regexp_matches(p[1], '^[A-Z0-9]{1,2}$') THEN 6 ELSE 0 END"
        " + CASE WHEN regexp_matches(p[2], '^[A-Z0-9]{1,8}$') THEN 15 ELSE 0 END + CASE WHEN vs THEN 25 WHEN nd >= 6 THEN 4 ELSE 0 END"
    )
    total = f"25 + CASE WHEN len(p) >= 3 THEN 20 ELSE 0 END + CASE WHEN regexp_matches(norm, '^[A-Z](-[A-Z0-9]{{1,8}}){{1,2}}-[SR][0-9]{{7,8}}$') THEN 60 ELSE 0 END + CASE len(p) WHEN 4 THEN {four} WHEN 3 THEN {three} ELSE 0 END"
    prefix = "CASE WHEN regexp_matches(p[1], '^[A-Z]$') THEN 20 WHEN p[1] <> '' THEN 6 ELSE 0 END"
    fit4 = (
        f"{prefix} + CASE WHEN regexp_matches(p[2], '^[A-Z]{{1,2}}$') THEN 30 WHEN regexp_matches(p[2], '^[A-Z]{{3}}$') THEN 6 WHEN p[2] <> '' THEN 4 ELSE 0 END"
        " + CASE WHEN regexp_matches(p[3], '^[A-Z0-9]{2,4}$') THEN 25 WHEN p[3] <> '' THEN 6 ELSE 0 END + CASE WHEN vs THEN 25 ELSE 0 END"
    )
    fit3 = f"{prefix} + CASE WHEN regexp_matches(p[2], '^[A-Z0-9]{{1,4}}$') THEN 25 WHEN p[2] <> '' THEN 6 ELSE 0 END + CASE WHEN vs THEN 25 ELSE 0 END"
    return f"""
{out}a AS (SELECT *, trim(regexp_replace(regexp_replace(upper(coalesce({column}, '')), '[^A-Z0-9-]', '', 'g'), '-+', '-', 'g'), '-') AS z FROM {source}),
{out}b AS (SELECT * EXCLUDE (z), CASE WHEN len(string_split(z, '-')) = 3 AND regexp_matches(z, '^[A-Z][A-Z0-9]{{3,}}-') THEN substr(z, 1, 1) || '-' || substr(z, 2) ELSE z END AS y FROM {out}a),
{out}c AS (SELECT * EXCLUDE (y), array_to_string(string_split(y, '-')[:-2], '-') || CASE WHEN contains(y, '-') THEN '-' ELSE '' END
  || substr(string_split(y, '-')[-1], 1, 1) || translate(substr(string_split(y, '-')[-1], 2), 'SBPOIZ', '58F012') AS norm FROM {out}b),
{out}d AS (SELECT *, string_split(norm, '-') AS p, string_split(norm, '-')[-1] AS serial FROM {out}c),
{out}e AS (SELECT *, regexp_matches(serial, '^[SR][0-9]{{6,8}}$') AS vs, length(regexp_replace(serial, '[^0-9]', '', 'g')) AS nd, left(norm, length(norm) - length(serial)) AS lead FROM {out}d),
{out} AS (SELECT *, len(p) AS n_parts, len(p) >= 3 AND vs AS strict,
  CAST(CASE WHEN norm = '' THEN 0 WHEN vs THEN {total} ELSE least({total}, 89) END AS INT) AS score,
  CAST(CASE WHEN norm = '' THEN 0 WHEN len(p) = 4 THEN {fit4} WHEN len(p) = 3 THEN {fit3} ELSE 0 END AS INT) AS fitness FROM {out}e)"""

"""Each query with the SQL that says what it must return, where SQL can. SHIPPED settings but where another is named."""

from dataclasses import replace

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..config import SHIPPED, both_ways
from ..functions import legacy as L
from ..functions import score as S
from ..functions import similarity as M
from ..functions import text as T
from ..operators import legacy as LO
from ..operators import manifest, metrics, propagate, recognise, report, segment, state, vote
from ..sources.files import title
from .view import PAGES_SQL, fields_sql, pages, table

QUERIES: dict = {}
ORACLES: dict[str, str] = {}

V = f"WITH RECURSIVE {PAGES_SQL}"
H = f"{V}, {fields_sql('v', 'header', 'h')}"
PAGE = ["doc", "page_idx"]
LISTED = replace(SHIPPED, pages=(1, 2, 5, 2))
BREAKER = replace(SHIPPED, breaker_failures=2, breaker_seconds=21600)


def query(sql: str | None = None):
    def keep(f):
        QUERIES[f.__name__] = f
        if sql:
            ORACLES[f.__name__] = sql
        return f

    return keep


def headed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return S.with_header_fields(pages(spark, sf_dir))


# --- one header at a time


@query(f"{H} SELECT doc, page_idx, norm FROM h")
def normalize_headers(spark, sf_dir):
    return headed(spark, sf_dir).select(*PAGE, "norm")


@query(f"{H} SELECT doc, page_idx, score FROM h")
def score_headers(spark, sf_dir):
    return headed(spark, sf_dir).select(*PAGE, "score")


@query(f"{H} SELECT doc, page_idx, strict FROM h")
def strict_headers(spark, sf_dir):
    return headed(spark, sf_dir).select(*PAGE, "strict")


@query(f"{H} SELECT doc, page_idx, fitness FROM h")
def shape_fitness(spark, sf_dir):
    return headed(spark, sf_dir).select(*PAGE, "fitness")


@query(
    f"""{H}, o AS (SELECT doc, page_idx, p, unnest(range(1, len(p) + 1)) AS i FROM h)
SELECT doc, page_idx, CAST(i - 1 AS INT) AS part, CAST(length(array_to_string(p[:i-1], '-')) + CASE WHEN i > 1 THEN 1 ELSE 0 END AS INT) AS start_at,
  CAST(length(array_to_string(p[:i], '-')) AS INT) AS end_at FROM o"""
)
def segment_offsets(spark, sf_dir):
    each = headed(spark, sf_dir).select(*PAGE, F.posexplode(T.segment_offsets(F.col("norm"))).alias("part", "x"))
    return each.select(*PAGE, "part", F.col("x.start").alias("start_at"), F.col("x.end").alias("end_at"))


@query(f"{H} SELECT doc, page_idx, CASE len(p) WHEN 4 THEN 2 WHEN 3 THEN 1 END AS code_at, CASE len(p) WHEN 4 THEN p[3] WHEN 3 THEN p[2] END AS code FROM h")
def code_index(spark, sf_dir):
    return headed(spark, sf_dir).select(*PAGE, T.code_index(F.col("norm")).alias("code_at"), T.code_of(F.col("norm")).alias("code"))


CODE = """c AS (SELECT *, CASE len(p) WHEN 4 THEN p[3] WHEN 3 THEN p[2] END AS code, CASE len(p) WHEN 4 THEN 3 WHEN 3 THEN 2 END AS ca FROM h),
w AS (SELECT *, list_distinct(list_filter(list_transform(range(1, length(coalesce(code, '')) + 1), lambda i: CASE
  WHEN i = 1 AND code[i] = '0' THEN NULL WHEN code[i] IN ('O', '0', 'I', 'L') THEN substr(code, 1, i - 1) || translate(code[i], 'O0IL', '0OLI') || substr(code, i + 1) END), lambda x: x IS NOT NULL)) AS alts FROM c),
a AS (SELECT *, CASE WHEN norm = '' THEN 'empty_normalized' WHEN code IS NULL THEN 'unsupported_format' WHEN code = '' THEN 'empty_code' WHEN len(alts) = 0 THEN 'no_variant'
  WHEN NOT (regexp_matches(code, '[A-Z]') AND regexp_matches(code, '[0-9]')) AND NOT regexp_matches(code, '[IL]') THEN 'not_mixed_alnum' ELSE 'code_confusable_ambiguous' END AS note FROM w)"""


@query(f"{H}, {CODE} SELECT doc, page_idx, code, array_to_string(list_sort(alts), '|') AS variants FROM w WHERE code IS NOT NULL")
def code_variants(spark, sf_dir):
    code = T.code_of(F.col("norm"))
    variants = F.array_join(F.array_sort(T.single_variants(code, both_ways(SHIPPED.code_pairs))), "|")
    return headed(spark, sf_dir).select(*PAGE, code.alias("code"), variants.alias("variants")).where("code is not null")


@query(f"{H}, {CODE} SELECT doc, page_idx, note = 'code_confusable_ambiguous' AS is_ambiguous, coalesce(code, '') AS code, CAST(CASE WHEN note = 'code_confusable_ambiguous' THEN len(alts) ELSE 0 END AS INT) AS n, note FROM a")
def code_ambiguity(spark, sf_dir):
    info = headed(spark, sf_dir).withColumn("i", T.ambiguity(F.col("norm")))
    return info.select(*PAGE, "i.is_ambiguous", "i.code", F.size("i.headers").alias("n"), "i.note")


@query(
    f"""{H}, {CODE} SELECT doc, page_idx, CASE WHEN note = 'code_confusable_ambiguous' THEN 'code_ambiguity:' || code || '->' ||
  array_to_string(list_transform(list_filter(range(1, length(code) + 1), lambda i: code[i] IN ('O', '0', 'I', 'L') AND NOT (i = 1 AND code[i] = '0')),
  lambda i: substr(code, 1, i - 1) || translate(code[i], 'O0IL', '0OLI') || substr(code, i + 1))[:3], '|') ELSE '' END AS flag FROM a"""
)
def ambiguity_flag(spark, sf_dir):
    return headed(spark, sf_dir).select(*PAGE, T.ambiguity_flag(T.ambiguity(F.col("norm"))).alias("flag"))


LONGEST = "list_reduce(list_prepend('', regexp_extract_all({c}, '[0-9]+')), lambda x, y: CASE WHEN length(y) > length(x) THEN y ELSE x END)"


@query(f"{V} SELECT doc, page_idx, {LONGEST.format(c='header')} AS digits FROM v")
def longest_digit_run(spark, sf_dir):
    return pages(spark, sf_dir).select(*PAGE, T.longest_digits(F.col("header")).alias("digits"))


def next_page(df: DataFrame, *columns: str) -> DataFrame:
    """Each page with the next one of its document: next_<column>."""
    order = Window.partitionBy("doc").orderBy("page_idx")
    return df.withColumns({f"next_{c}": F.lead(c).over(order) for c in columns}).where(f"next_{columns[0]} is not null")


NEXT = "nx AS (SELECT *, lead(header) OVER q AS header2, lead(norm) OVER q AS norm2, lead(p) OVER q AS p2, lead(lead) OVER q AS lead2, lead(serial) OVER q AS serial2, lead(strict) OVER q AS strict2, lead(n_parts) OVER q AS n_parts2, lead(confidence) OVER q AS confidence2 FROM h WINDOW q AS (PARTITION BY doc ORDER BY page_idx))"
TAIL = """({a}lead = {b}lead AND {a}n_parts >= 3 AND {b}n_parts >= 3 AND substr({a}serial, 1, 1) = substr({b}serial, 1, 1)
  AND regexp_replace(substr({a}serial, 2), '[^0-9]', '', 'g') <> '' AND regexp_replace(substr({b}serial, 2), '[^0-9]', '', 'g') <> ''
  AND abs(length(regexp_replace(substr({a}serial, 2), '[^0-9]', '', 'g')) - length(regexp_replace(substr({b}serial, 2), '[^0-9]', '', 'g'))) = 1
  AND (starts_with(regexp_replace(substr({a}serial, 2), '[^0-9]', '', 'g'), regexp_replace(substr({b}serial, 2), '[^0-9]', '', 'g'))
    OR starts_with(regexp_replace(substr({b}serial, 2), '[^0-9]', '', 'g'), regexp_replace(substr({a}serial, 2), '[^0-9]', '', 'g'))))"""


@query(f"{H}, {NEXT}, y AS (SELECT doc, page_idx, {TAIL.format(a='l.', b='r.')} AS variant FROM (SELECT doc, page_idx, {{'lead': lead, 'serial': serial, 'n_parts': n_parts}} AS l, {{'lead': lead2, 'serial': serial2, 'n_parts': n_parts2}} AS r FROM nx WHERE norm2 IS NOT NULL)) SELECT * FROM y")
def tail_digit_variant(spark, sf_dir):
    return next_page(headed(spark, sf_dir), "norm").select(*PAGE, M.tail_digit_variant(F.col("norm"), F.col("next_norm")).alias("variant"))


SIM = "(CASE WHEN {a} = '' OR {b} = '' THEN 0 ELSE 1 - levenshtein({a}, {b}) / CAST(greatest(length({a}), length({b})) AS DOUBLE) END)"


@query(f"{H}, {NEXT} SELECT doc, page_idx, levenshtein(norm, norm2) AS distance, round_even({SIM.format(a='norm', b='norm2')}, 6) AS similarity FROM nx WHERE norm2 IS NOT NULL")
def edit_similarity(spark, sf_dir):
    pairs = next_page(headed(spark, sf_dir), "norm")
    return pairs.select(*PAGE, F.levenshtein("norm", "next_norm").cast("long").alias("distance"), F.bround(M.edit_similarity(F.col("norm"), F.col("next_norm")), 6).alias("similarity"))


def safe_sql(c: str) -> str:
    cut = f"regexp_replace(substr(regexp_replace(replace(regexp_replace({c}, '[^\\p{{L}}\\p{{N}}_\\s-]', '', 'g'), ' ', '_'), '[_-]+', '_', 'g'), 1, 100), '^[_-]+|[_-]+$', '', 'g')"
    return f"coalesce(nullif({cut}, ''), 'unnamed')"


@query(f"{V} SELECT 'page' AS kind, doc * 100000 + page_idx AS id, {safe_sql('header')} AS name FROM v UNION ALL SELECT 'document', doc_id, {safe_sql('coalesce(text, $$$$)')} FROM documents")
def sanitize_filename(spark, sf_dir):
    one = pages(spark, sf_dir).select(F.lit("page").alias("kind"), (F.col("doc") * 100000 + F.col("page_idx")).alias("id"), T.safe_name(F.col("header")).alias("name"))
    return one.unionByName(table(spark, sf_dir, "documents").select(F.lit("document").alias("kind"), F.col("doc_id").alias("id"), T.safe_name(F.col("text")).alias("name")))


@query(
    f"""{V}, x AS (SELECT *, string_split(header, '-')[-1] AS s FROM v) SELECT doc, page_idx, CASE WHEN len(string_split(header, '-')) >= 4 AND length(s) > 1 THEN
  left(header, length(header) - length(s)) || CASE WHEN regexp_matches(s, '^\\p{{L}}') THEN s[1] || translate(s[2:], 'OolIZ', '00112') ELSE translate(s, 'OolIZ', '00112') END ELSE header END AS corrected FROM x"""
)
def pattern_correction(spark, sf_dir):
    return pages(spark, sf_dir).select(*PAGE, T.pattern_correction(F.col("header")).alias("corrected"))


@query(f"{V} SELECT doc, page_idx, array_to_string(list_sort(list_distinct(regexp_extract_all(header, '[^A-Z0-9-]'))), '') AS invalid FROM v")
def invalid_chars(spark, sf_dir):
    return pages(spark, sf_dir).select(*PAGE, F.array_join(T.invalid_characters(F.col("header")), "").alias("invalid"))


@query(
    f"""{V}, f AS (SELECT doc, page_idx, CASE WHEN k % 2 = 0 THEN 'a; b' ELSE 'noise' || k || ' ;; x' END AS flags, CASE WHEN k % 4 = 0 THEN 'b' WHEN k % 4 = 1 THEN ' x ' WHEN k % 4 = 2 THEN 'c' ELSE '' END AS extra FROM v),
g AS (SELECT *, list_filter(list_transform(string_split(flags, ';'), lambda x: trim(x)), lambda x: x <> '') AS l FROM f)
SELECT doc, page_idx, CASE WHEN trim(extra) = '' THEN flags WHEN list_contains(l, trim(extra)) THEN array_to_string(l, ';') ELSE array_to_string(list_append(l, trim(extra)), ';') END AS flags FROM g"""
)
def flag_append(spark, sf_dir):
    k = F.col("k")
    flags = F.when(k % 2 == 0, "a; b").otherwise(F.concat(F.lit("noise"), k.cast("string"), F.lit(" ;; x")))
    extra = F.when(k % 4 == 0, "b").when(k % 4 == 1, " x ").when(k % 4 == 2, "c").otherwise("")
    return pages(spark, sf_dir).select(*PAGE, T.add_flag(flags, extra).alias("flags"))


@query(f"{V}, e AS (SELECT doc, page_idx, header, confidence, unnest(range(1, length(header) + 1)) AS i FROM v) SELECT doc, page_idx, CAST(i - 1 AS INT) AS pos, header[i] AS ch, round_even(confidence / 100 * 100, 6) AS confidence FROM e")
def char_explode(spark, sf_dir):
    chars = recognise.characters_with_confidence(F.col("header"), F.col("confidence") / 100)
    return pages(spark, sf_dir).select(*PAGE, F.inline(chars)).withColumn("confidence", F.bround("confidence", 6))


@query("SELECT o_orderkey, round_even(o_totalprice * 0.12, 6) AS x0, round_even(CAST(o_custkey AS DOUBLE) * CAST(0.02 AS DOUBLE), 6) AS y0, round_even(o_totalprice * 0.12 + o_totalprice * 0.45, 6) AS x1, round_even(CAST(o_custkey AS DOUBLE) * CAST(0.02 AS DOUBLE) + CAST(o_custkey AS DOUBLE) * CAST(0.06 AS DOUBLE), 6) AS y1 FROM orders")
def roi_rect(spark, sf_dir):
    box = recognise.region(F.col("o_totalprice"), F.col("o_custkey").cast("double"))
    boxes = table(spark, sf_dir, "orders").withColumn("b", box)
    return boxes.select("o_orderkey", *(F.bround(f"b.{c}", 6).alias(c) for c in ("x0", "y0", "x1", "y1")))


@query(f"{V} SELECT doc, page_idx, translate(upper(header), 'OSFI', '05EL') AS canonical FROM v")
def canonicalize(spark, sf_dir):
    return pages(spark, sf_dir).select(*PAGE, T.for_alignment(F.col("header")).alias("canonical"))


@query("SELECT page_id, trim(regexp_extract(coalesce(html, ''), '(?is)<title[^>]*>(.*?)</title>', 1)) AS title FROM pages")
def direct_text_title(spark, sf_dir):
    return table(spark, sf_dir, "pages").select("page_id", title(F.col("html")).alias("title"))


@query(f"{H} SELECT doc, page_idx, CASE WHEN strict AND score > 0 THEN norm END AS direct, NOT (strict AND score > 0) AS needs_recognition FROM h")
def direct_text_gate(spark, sf_dir):
    got = pages(spark, sf_dir).select(*PAGE, recognise.direct_text(F.col("header")).alias("direct"))
    return got.withColumn("needs_recognition", F.col("direct").isNull())


@query(f"{V} SELECT doc, page_idx, header FROM v JOIN (SELECT unnest([0, 1, 4, 1]) AS i) ON i = page_idx")
def page_selection(spark, sf_dir):
    return recognise.select_pages(pages(spark, sf_dir), LISTED).select(*PAGE, "header")


@query(f"{H} SELECT doc, page_idx, length(p[2]) > 2 AND len(p) = 4 AS suspicious, CASE WHEN norm = '' THEN false WHEN len(p) = 4 THEN length(p[3]) = 2 OR regexp_matches(p[3], '^[0-9].{{0,2}}$') WHEN len(p) = 3 THEN length(p[2]) <= 2 ELSE false END AS short_code FROM (SELECT * REPLACE (CASE WHEN len(p) < 2 THEN [p[1], ''] ELSE p END AS p) FROM h)")
def suspicious_headers(spark, sf_dir):
    return headed(spark, sf_dir).select(*PAGE, S.suspicious(F.col("norm")).alias("suspicious"), S.short_code(F.col("norm")).alias("short_code"))


# --- reports


def records(spark: SparkSession, sf_dir: str) -> DataFrame:
    h = headed(spark, sf_dir)
    return h.select(
        "doc", "page_idx", (F.col("page_idx") + 1).alias("page_number"), F.col("norm").alias("header_extracted"), F.col("score").alias("confidence_score"),
        F.col("price").alias("processing_time_ms"), S.status(F.col("norm"), F.col("score")).alias("status"),
        T.ambiguity_flag(T.ambiguity(F.col("norm"))).alias("quality_flags"), F.col("order_no").cast("string").alias("split_group"),
    )


RECORDS = f"""{H}, {CODE}, rec AS (SELECT doc, page_idx, norm AS header_extracted, score AS confidence_score, price AS processing_time_ms,
  CASE WHEN norm = '' THEN 'error' WHEN score >= 130 THEN 'success' ELSE 'low_confidence' END AS status, note = 'code_confusable_ambiguous' AS amb, CAST(order_no AS VARCHAR) AS split_group FROM a)"""
SUMMARY = """count(*) AS total_pages, count(*) FILTER (status = 'success') AS success_count, count(*) FILTER (status = 'error') AS error_count, count(*) FILTER (status = 'low_confidence') AS low_confidence_count,
  round_even(avg(confidence_score), 1) AS avg_confidence_score, round_even(avg(processing_time_ms), 2) AS avg_processing_time_ms, count(DISTINCT nullif(header_extracted, '')) AS unique_headers,
  count(DISTINCT split_group) AS unique_split_groups, round_even(count(*) FILTER (status = 'success') * 100.0 / count(*), 1) AS success_rate"""


@query(f"{RECORDS} SELECT {SUMMARY} FROM rec")
def report_summary(spark, sf_dir):
    return report.summary(records(spark, sf_dir))


@query(f"{RECORDS} SELECT doc, {SUMMARY} FROM rec GROUP BY doc")
def document_summary(spark, sf_dir):
    return report.summary(records(spark, sf_dir), ["doc"])


@query(f"{RECORDS} SELECT status, count(*) AS n, round_even(avg(confidence_score), 6) AS avg_score FROM rec GROUP BY status")
def status_report(spark, sf_dir):
    return records(spark, sf_dir).groupBy("status").agg(F.count("*").alias("n"), F.bround(F.avg("confidence_score"), 6).alias("avg_score"))


@query(f"{RECORDS} SELECT doc, page_idx, header_extracted, confidence_score, status FROM rec WHERE status <> 'success'")
def error_report(spark, sf_dir):
    return report.errors(records(spark, sf_dir)).select(*PAGE, "header_extracted", "confidence_score", "status")


@query(f"{RECORDS} SELECT doc, count(*) AS pages, round_even(avg(confidence_score), 6) AS avg_confidence, count(*) FILTER (amb) AS code_ambiguity_pages FROM rec GROUP BY doc")
def job_summary(spark, sf_dir):
    return report.job_summary(records(spark, sf_dir), ["doc"]).withColumn("avg_confidence", F.bround("avg_confidence", 6))


# --- which readings are made and trusted; the pages of an order stand for the readings of a page


def readings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pages(spark, sf_dir).select("order_no", F.col("page_idx").alias("attempt_no"), F.col("header").alias("text"), "confidence", "quantity", "price")


BAD = "array_to_string(list_sort(list_distinct(regexp_extract_all(header, '[^A-Z0-9-]'))), '')"


@query(
    f"""{V}, r AS (SELECT doc, page_idx, header, concat_ws(', ', CASE WHEN NOT regexp_matches(header, '^[A-Z](-[A-Z0-9]{{1,8}}){{1,2}}-[SR][0-9]{{7,8}}$') THEN 'regex_failed' END,
  CASE WHEN confidence < 82 THEN 'low_confidence(' || printf('%.1f', confidence) || '%)' END, CASE WHEN {BAD} <> '' THEN 'invalid_chars(' || {BAD} || ')' END) AS x FROM v)
SELECT doc, page_idx, CASE WHEN header = '' THEN 'empty_text' WHEN x = '' THEN 'passed' ELSE x END AS reason FROM r"""
)
def fallback_triggers(spark, sf_dir):
    return pages(spark, sf_dir).select(*PAGE, recognise.fallback_reason(F.col("header"), F.col("confidence")).alias("reason"))


@query(f"{V} SELECT doc, page_idx, CASE WHEN confidence > 0 AND confidence < 70 THEN CAST(length(header) AS INT) ELSE 0 END AS n_low FROM v")
def low_conf_chars(spark, sf_dir):
    chars = recognise.characters_with_confidence(F.col("header"), F.col("confidence") / 100)
    return pages(spark, sf_dir).select(*PAGE, F.size(recognise.low_confidence_characters(chars)).alias("n_low"))


@query(
    f"""{H}, g AS (SELECT *, strict AND score >= 90 AND confidence >= 82 AND header <> '' AS great, row_number() OVER (PARTITION BY order_no ORDER BY page_idx) AS nth FROM h),
s AS (SELECT *, great AND nth >= 2 AND sum(CAST(great AS INT)) OVER (PARTITION BY order_no, header ORDER BY page_idx) >= 2 AS exits FROM g),
f AS (SELECT order_no, min(page_idx) AS stop FROM s WHERE exits GROUP BY order_no)
SELECT order_no, page_idx AS attempt_no, header AS text, score, exits FROM s LEFT JOIN f USING (order_no) WHERE stop IS NULL OR page_idx <= stop"""
)
def early_exit(spark, sf_dir):
    return recognise.early_exit(readings(spark, sf_dir), ["order_no"])


@query(f"{V} SELECT order_no, attempt_no, text FROM (SELECT order_no, page_idx AS attempt_no, header AS text, row_number() OVER (PARTITION BY order_no ORDER BY page_idx) AS n FROM v) WHERE n <= 3")
def attempt_budget(spark, sf_dir):
    return recognise.within_budget(readings(spark, sf_dir), ["order_no"], replace(SHIPPED, attempts=3)).select("order_no", "attempt_no", "text")


@query(
    f"""{H}, s AS (SELECT order_no, page_idx, header, score, strict AND score >= 70 AND NOT (len(p) = 4 AND length(p[2]) > 2) AS stops FROM h),
f AS (SELECT order_no, min(page_idx) AS stop FROM s WHERE stops GROUP BY order_no)
SELECT order_no, CAST(page_idx AS DOUBLE) AS scale, header AS text, score, stops FROM s LEFT JOIN f USING (order_no) WHERE stop IS NULL OR page_idx <= stop"""
)
def scale_escalation(spark, sf_dir):
    r = readings(spark, sf_dir).withColumn("scale", F.col("attempt_no").cast("double"))
    return recognise.escalate(r, ["order_no"])


@query(
    f"""{H}, g AS (SELECT order_no, header, any_value(norm) AS norm, any_value(score) AS score, any_value(strict) AS strict, count(*) AS freq, avg(confidence) AS conf FROM h WHERE header <> '' GROUP BY order_no, header),
w AS (SELECT *, score * 0.7 + conf * 0.3 + CASE WHEN strict THEN 20 ELSE 0 END AS weighted, sum(freq) OVER (PARTITION BY order_no) AS total FROM g),
b AS (SELECT *, row_number() OVER (PARTITION BY order_no ORDER BY strict DESC, round(weighted, 9) DESC, score DESC, freq DESC, round(conf, 9) DESC, header) AS n FROM w)
SELECT order_no, CASE WHEN score > 0 THEN norm ELSE header END AS header, score, strict, freq, round_even(freq / CAST(total AS DOUBLE), 6) AS freq_ratio, round_even(weighted, 6) AS weighted FROM b WHERE n = 1"""
)
def method_vote(spark, sf_dir):
    out = vote.method_vote(readings(spark, sf_dir), ["order_no"])
    return out.withColumns({"freq_ratio": F.bround("freq_ratio", 6), "weighted": F.bround("weighted", 6)})


def scale_candidates(spark: SparkSession, sf_dir: str) -> DataFrame:
    h = headed(spark, sf_dir)
    return h.select("order_no", F.col("page_idx").alias("idx"), F.col("norm").alias("text"), "score", "strict", (F.col("quantity") / 50).alias("freq_ratio"), F.col("page_idx").cast("double").alias("scale"), "fitness")


@query(
    f"""{H}, s AS (SELECT x.order_no, x.page_idx, count(*) FILTER (x.norm = y.norm) AS n_exact, count(*) FILTER ({SIM.format(a='x.norm', b='y.norm')}  >= 0.92) AS n_similar, sum({SIM.format(a='x.norm', b='y.norm')}) AS total
  FROM h x JOIN h y ON x.order_no = y.order_no WHERE x.norm <> '' AND y.norm <> '' GROUP BY x.order_no, x.page_idx),
j AS (SELECT h.*, coalesce(n_exact, 0) AS n_exact, coalesce(n_similar, 0) AS n_similar, round(coalesce(total, 0), 9) AS total FROM h LEFT JOIN s USING (order_no, page_idx)),
r AS (SELECT *, row_number() OVER (PARTITION BY order_no ORDER BY strict DESC, n_exact DESC, n_similar DESC, fitness DESC, score DESC, quantity DESC, total DESC, page_idx DESC, length(norm), page_idx) AS n FROM j)
SELECT order_no, page_idx AS idx, norm AS text, n_exact, n_similar, round_even(total, 6) AS sim_sum FROM r WHERE n = 1"""
)
def scale_vote_lev(spark, sf_dir):
    out = vote.scale_vote(scale_candidates(spark, sf_dir), ["order_no"])
    return out.select("order_no", "idx", "text", "n_exact", "n_similar", F.bround("sim_sum", 6).alias("sim_sum"))


@query(f"{H} SELECT order_no, round_even(coalesce(avg(CASE WHEN k <> 7 THEN confidence END), least(100.0, greatest(0.0, avg(score) / 1.5))), 6) AS confidence FROM h GROUP BY order_no")
def mean_confidence(spark, sf_dir):
    r = headed(spark, sf_dir).select("order_no", F.when(F.col("k") == 7, -1.0).otherwise(F.col("confidence")).alias("confidence"), "score")
    return vote.mean_confidence(r, ["order_no"]).withColumn("confidence", F.bround("confidence", 6))


NEXT_SCORES = "nt AS (SELECT doc, page_idx, header, norm, score, confidence, lead(header) OVER q AS header2, lead(norm) OVER q AS norm2, lead(score) OVER q AS score2, lead(confidence) OVER q AS confidence2 FROM h WINDOW q AS (PARTITION BY doc ORDER BY page_idx))"


@query(f"{H}, {NEXT_SCORES} SELECT doc, page_idx, CASE WHEN header = header2 THEN header WHEN score2 * 0.6 + confidence2 * 0.4 > score * 0.6 + confidence * 0.4 THEN norm2 ELSE norm END AS chosen FROM nt WHERE header2 IS NOT NULL")
def ensemble_vote(spark, sf_dir):
    p = next_page(pages(spark, sf_dir), "header", "confidence")
    return p.select(*PAGE, vote.ensemble(F.col("header"), F.col("next_header"), F.col("confidence"), F.col("next_confidence")).alias("chosen"))


@query(
    f"""{H}, {NEXT_SCORES}, r AS (SELECT doc, page_idx, header, concat_ws(', ', CASE WHEN NOT regexp_matches(header, '^[A-Z](-[A-Z0-9]{{1,8}}){{1,2}}-[SR][0-9]{{7,8}}$') THEN 'x' END, CASE WHEN confidence < 82 THEN 'x' END, CASE WHEN {BAD} <> '' THEN 'x' END) <> '' AS reason FROM v),
k AS (SELECT nt.*, h.strict, r.reason FROM nt JOIN h USING (doc, page_idx) JOIN r USING (doc, page_idx)),
q AS (SELECT *, NOT ((strict AND score >= 70) OR (header <> '' AND NOT reason)) AS asked FROM k)
SELECT doc, page_idx, asked, CASE WHEN NOT asked OR coalesce(header2, '') = '' OR header = header2 THEN header WHEN score2 * 0.6 + confidence2 * 0.4 > score * 0.6 + confidence * 0.4 THEN norm2 ELSE norm END AS text FROM q"""
)
def engine_fallback(spark, sf_dir):
    p = pages(spark, sf_dir).select(*PAGE, F.col("header").alias("text"), "confidence")
    second = next_page(p, "text", "confidence").select(*PAGE, F.col("next_text").alias("second_text"), F.col("next_confidence").alias("second_confidence"))
    return recognise.fallback(p, second, PAGE)


# --- votes inside groups


@query(
    f"""{H}, g AS (SELECT order_no, CASE WHEN norm <> '' THEN norm ELSE header END AS best, count(*) AS n, max(score) AS score, max(fitness) AS fitness, max(strict) AS strict FROM h GROUP BY ALL),
r AS (SELECT *, row_number() OVER (PARTITION BY order_no ORDER BY n DESC, strict DESC, fitness DESC, score DESC, length(best), best) AS i FROM g) SELECT order_no, best, n FROM r WHERE i = 1"""
)
def best_header(spark, sf_dir):
    return vote.best_header(pages(spark, sf_dir), ["order_no"]).select("order_no", "best", "n")


@query(f"{V} SELECT order_no, count(*) FILTER (trim(header) = clean) AS support, count(*) FILTER (length(trim(header)) > 0) AS non_empty FROM v GROUP BY order_no")
def header_support(spark, sf_dir):
    return vote.header_support(pages(spark, sf_dir), ["order_no"], "clean", "header")


@query(
    f"""WITH {PAGES_SQL}, bases AS (SELECT DISTINCT order_no, clean FROM v), {fields_sql('bases', 'clean', 'h')}, {CODE},
o AS (SELECT order_no, i AS place, array_to_string(list_concat(list_append(p[:ca-1], substr(code, 1, i - 1) || translate(code[i], 'O0IL', '0OLI') || substr(code, i + 1)), p[ca+1:]), '-') AS option
  FROM (SELECT *, unnest(range(1, length(code) + 1)) AS i FROM a WHERE note = 'code_confusable_ambiguous') WHERE code[i] IN ('O', '0', 'I', 'L') AND NOT (i = 1 AND code[i] = '0')),
{fields_sql('v', 'header', 'z')}, said AS (SELECT order_no, CASE WHEN norm <> '' THEN norm ELSE header END AS option, count(*) AS votes FROM z WHERE header <> '' GROUP BY ALL),
b AS (SELECT o.order_no, o.option, coalesce(votes, 0) AS votes, row_number() OVER (PARTITION BY o.order_no ORDER BY coalesce(votes, 0) DESC, place) AS n FROM o LEFT JOIN said USING (order_no, option))
SELECT a.order_no, clean AS header, CASE WHEN coalesce(votes, 0) >= 1 THEN option ELSE clean END AS resolved, coalesce(votes, 0) >= 1 AS applied, coalesce(votes, 0) AS votes FROM a LEFT JOIN b ON a.order_no = b.order_no AND b.n = 1"""
)
def resolve_by_support(spark, sf_dir):
    v = pages(spark, sf_dir)
    bases = v.select("order_no", F.col("clean").alias("header")).distinct()
    return vote.resolve_by_support(bases, v.select("order_no", F.col("header").alias("text")), ["order_no"])


# --- documents from pages

MATCH = f"""CASE WHEN {{a}}.norm = '' OR {{b}}.norm = '' THEN false WHEN {{a}}.norm = {{b}}.norm THEN true
  WHEN {{a}}.n_parts >= 3 AND {{b}}.n_parts >= 3 AND {{a}}.strict AND {{b}}.strict THEN {{a}}.serial = {{b}}.serial AND {SIM.format(a='{a}.norm', b='{b}.norm')} >= 0.93
  WHEN {{a}}.n_parts >= 3 AND {{b}}.n_parts >= 3 AND {{a}}.lead = {{b}}.lead AND {{a}}.strict <> {{b}}.strict THEN {{a}}.sd <> '' AND {{b}}.sd <> '' AND {SIM.format(a='{a}.sd', b='{b}.sd')} >= 0.85
  WHEN {{a}}.n_parts >= 3 AND {{b}}.n_parts >= 3 AND {{a}}.lead = {{b}}.lead THEN {{a}}.serial = {{b}}.serial ELSE {SIM.format(a='{a}.norm', b='{b}.norm')} >= 0.85 END"""
SEGMENTS = f"""{H}, hp AS MATERIALIZED (SELECT *, regexp_replace(serial, '[^0-9]', '', 'g') AS sd, row_number() OVER (PARTITION BY doc ORDER BY page_idx) AS rn FROM h WHERE header <> ''),
walk(doc, rn, anchor, segment) AS (SELECT doc, rn, rn, 0 FROM hp WHERE rn = 1 UNION ALL
  SELECT w.doc, x.rn, CASE WHEN {MATCH.format(a='x', b='y')} THEN w.anchor ELSE x.rn END, CASE WHEN {MATCH.format(a='x', b='y')} THEN w.segment ELSE w.segment + 1 END
  FROM walk w JOIN hp x ON x.doc = w.doc AND x.rn = w.rn + 1 JOIN hp y ON y.doc = w.doc AND y.rn = w.anchor),
sp AS (SELECT walk.segment, hp.* FROM walk JOIN hp USING (doc, rn)),
sv AS (SELECT doc, segment, CASE WHEN norm <> '' THEN norm ELSE header END AS best, count(*) AS n, max(score) AS score, max(fitness) AS fitness, max(strict) AS strict FROM sp GROUP BY ALL),
sb AS (SELECT *, row_number() OVER (PARTITION BY doc, segment ORDER BY n DESC, strict DESC, fitness DESC, score DESC, length(best), best) AS i FROM sv),
sg AS (SELECT doc, segment, start_page, end_page, best AS header FROM (SELECT doc, segment, min(page_idx) AS start_page, max(page_idx) AS end_page FROM sp GROUP BY ALL) JOIN sb USING (doc, segment) WHERE i = 1)"""


@query(f"{SEGMENTS} SELECT * FROM sg")
def segment_pages(spark, sf_dir):
    return segment.segments(pages(spark, sf_dir), ["doc"])


MISREAD = f"""CASE WHEN {{a}}.strict AND {{b}}.strict AND {{a}}.norm <> {{b}}.norm THEN {TAIL.format(a='{a}.', b='{b}.')}
  WHEN abs(length({{a}}.header) - length({{b}}.header)) > 5 THEN false
  WHEN length({{a}}.ld) >= 7 AND length({{b}}.ld) >= 7 AND ({{a}}.ld = {{b}}.ld OR ((contains({{a}}.ld, {{b}}.ld) OR contains({{b}}.ld, {{a}}.ld)) AND abs(length({{a}}.ld) - length({{b}}.ld)) <= 2)
    OR (levenshtein({{a}}.ld, {{b}}.ld) <= 2 AND levenshtein({{a}}.ld, {{b}}.ld) < greatest(length({{a}}.ld), length({{b}}.ld)) * 0.25)) THEN true
  ELSE abs(len({{a}}.rp) - len({{b}}.rp)) <= 1 AND len({{a}}.rp) >= 3 AND len({{b}}.rp) >= 3 AND {{a}}.rp[1] = {{b}}.rp[1] AND ({{a}}.rp[2] = {{b}}.rp[2] OR {SIM.format(a='{a}.rp[2]', b='{b}.rp[2]')} >= 0.7)
    AND {SIM.format(a='{a}.rp[3]', b='{b}.rp[3]')} >= 0.5 AND {{a}}.s4 <> '' AND {{b}}.s4 <> '' AND levenshtein({{a}}.s4, {{b}}.s4) <= 3 AND levenshtein({{a}}.s4, {{b}}.s4) < greatest(length({{a}}.s4), length({{b}}.s4)) * 0.3 END"""


def readable(source: str, out: str) -> str:
    """CTE that adds to source what MISREAD reads."""
    return f"{out} AS MATERIALIZED (SELECT *, {LONGEST.format(c='header')} AS ld, string_split(header, '-') AS rp, CASE WHEN len(string_split(header, '-')) > 3 THEN regexp_replace(string_split(header, '-')[-1], '[^0-9]', '', 'g') ELSE '' END AS s4 FROM {source})"


@query(f"{H}, {readable('h', 'hr')} SELECT x.doc, x.page_idx, {MISREAD.format(a='x', b='y')} AS misread FROM hr x JOIN hr y ON x.doc = y.doc AND y.page_idx = x.page_idx + 1 WHERE x.header <> '' AND y.header <> ''")
def ocr_error_pairs(spark, sf_dir):
    p = next_page(headed(spark, sf_dir), "header", "norm", "strict").where("header != '' and next_header != ''")
    struct = lambda pre: F.struct(*(F.col(pre + c).alias(c) for c in ("header", "norm", "strict")))
    return p.select(*PAGE, M.likely_misread(struct(""), struct("next_")).alias("misread"))


_ROW = "STRUCT(start_page INT, end_page INT, header VARCHAR, norm VARCHAR, strict BOOLEAN, lead VARCHAR, serial VARCHAR, n_parts BIGINT, ld VARCHAR, rp VARCHAR[], s4 VARCHAR, worth INT)"
CONTEXT = f"""{SEGMENTS}, {fields_sql('sg', 'header', 'gf')}, {readable('gf', 'gr')},
gi AS MATERIALIZED (SELECT doc, row_number() OVER (PARTITION BY doc ORDER BY start_page) AS i, CAST({{'start_page': start_page, 'end_page': end_page, 'header': header, 'norm': norm, 'strict': strict, 'lead': lead, 'serial': serial, 'n_parts': n_parts, 'ld': ld, 'rp': rp, 's4': s4, 'worth': score + CASE WHEN strict THEN 20 ELSE 0 END}} AS {_ROW}) AS g FROM gr),
fix(doc, i, carried, done) AS (SELECT DISTINCT doc, CAST(0 AS BIGINT), CAST(NULL AS INT), CAST([] AS {_ROW}[]) FROM gi UNION ALL
  SELECT doc, i, CASE WHEN to_next THEN st END, CASE WHEN to_next THEN done WHEN to_prev THEN list_append(done[:-2], struct_update(pv, end_page := cur.end_page)) ELSE list_append(done, struct_update(cur, start_page := st)) END
  FROM (SELECT *, m2 AND (NOT m1 OR nxt.worth + least(10, nxt.end_page - nxt.start_page + 1) > pv.worth + least(10, pv.end_page - pv.start_page + 1)) AS to_next, m1 AS to_prev
    FROM (SELECT *, coalesce(single AND pv IS NOT NULL AND {MISREAD.format(a='cur', b='pv')}, false) AS m1, coalesce(single AND nxt IS NOT NULL AND {MISREAD.format(a='cur', b='nxt')}, false) AS m2
      FROM (SELECT f.doc, c.i, f.done, c.g AS cur, n.g AS nxt, f.done[-1] AS pv, coalesce(f.carried, c.g.start_page) AS st, coalesce(f.carried, c.g.start_page) = c.g.end_page AS single
        FROM fix f JOIN gi c ON c.doc = f.doc AND c.i = f.i + 1 LEFT JOIN gi n ON n.doc = f.doc AND n.i = f.i + 2)))),
last AS (SELECT doc, unnest(arg_max(done, i)) AS g FROM fix GROUP BY doc),
fl AS (SELECT doc, g.start_page AS start_page, g.end_page AS end_page, g.header AS header FROM last),
mk AS (SELECT *, CASE WHEN start_page = lag(end_page) OVER q + 1 AND header = lag(header) OVER q THEN 0 ELSE 1 END AS new FROM fl WINDOW q AS (PARTITION BY doc ORDER BY start_page)),
mg AS (SELECT *, sum(new) OVER (PARTITION BY doc ORDER BY start_page) AS grp FROM mk),
groups AS (SELECT doc, min(start_page) AS start_page, max(end_page) AS end_page, min(header) AS header FROM mg GROUP BY doc, grp)"""


@query(f"{CONTEXT} SELECT * FROM groups")
def context_correction(spark, sf_dir):
    return segment.document_groups(pages(spark, sf_dir), ["doc"])


ORDER_RUNS = """runs AS (SELECT doc, page_idx AS start_page, page_idx AS end_page, substr(clean, 1, 9) AS header FROM v WHERE k <> 5)"""


ORDER_GROUPS = f"""{V}, {ORDER_RUNS}, mk AS (SELECT *, CASE WHEN start_page = lag(end_page) OVER q + 1 AND header = lag(header) OVER q THEN 0 ELSE 1 END AS new FROM runs WINDOW q AS (PARTITION BY doc ORDER BY start_page)),
mg AS (SELECT *, sum(new) OVER (PARTITION BY doc ORDER BY start_page) AS grp FROM mk), og AS (SELECT doc, min(start_page) AS start_page, max(end_page) AS end_page, min(header) AS header FROM mg GROUP BY doc, grp)"""


@query(f"{ORDER_GROUPS} SELECT * FROM og")
def merge_adjacent(spark, sf_dir):
    v = pages(spark, sf_dir).where("k != 5")
    return segment.merge_adjacent(v.select("doc", F.col("page_idx").alias("start_page"), F.col("page_idx").alias("end_page"), F.substring("clean", 1, 9).alias("header")), ["doc"])


@query(f"{SEGMENTS}, {fields_sql('sg', 'header', 'gf')} SELECT doc, start_page, score + CASE WHEN strict THEN 20 ELSE 0 END + least(10, end_page - start_page + 1) AS rank FROM gf")
def neighbour_rank(spark, sf_dir):
    g = S.with_header_fields(segment.segments(pages(spark, sf_dir), ["doc"]))
    return g.select("doc", "start_page", (F.col("score") + F.when(F.col("strict"), 20).otherwise(0) + F.least(F.lit(10), F.col("end_page") - F.col("start_page") + 1)).alias("rank"))


# --- what is written where


def order_groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A group a run of equal order codes: names repeat inside a document."""
    return merge_adjacent(spark, sf_dir)


SAFE = "coalesce(nullif(regexp_replace(regexp_replace(replace(regexp_replace(header, '[^A-Za-z0-9_\\s-]', '', 'g'), ' ', '_'), '[_-]+', '_', 'g'), '^[_-]+|[_-]+$', '', 'g'), ''), 'unnamed')"
MANIFEST = f"""{ORDER_GROUPS}, tot AS (SELECT doc, count(*) AS total FROM v GROUP BY doc),
n1 AS (SELECT *, count(*) OVER (PARTITION BY doc) AS n, row_number() OVER (PARTITION BY doc ORDER BY start_page) AS idx FROM og),
al AS (SELECT tot.doc, 1 AS idx, 0 AS start_page, total - 1 AS end_page, coalesce(n1.header, 'UNKNOWN') AS header FROM tot LEFT JOIN n1 ON n1.doc = tot.doc AND n = 1 WHERE tot.doc NOT IN (SELECT doc FROM n1 WHERE n > 1)
  UNION ALL SELECT doc, idx, start_page, end_page, header FROM n1 WHERE n > 1),
us AS (SELECT *, {SAFE} AS safe, row_number() OVER (PARTITION BY doc, {SAFE} ORDER BY idx) AS use FROM al),
mf AS (SELECT doc, CAST(idx AS INT) AS idx, CAST(start_page AS BIGINT) AS start_page, CAST(end_page AS BIGINT) AS end_page, header, CAST(use AS INT) AS use, safe || CASE WHEN use > 1 THEN '_' || lpad(CAST(use AS VARCHAR), 2, '0') ELSE '' END || '.pdf' AS file_name FROM us)"""


def manifest_of(spark: SparkSession, sf_dir: str) -> DataFrame:
    totals = pages(spark, sf_dir).groupBy("doc").agg(F.count("*").alias("total_pages")).withColumn("original", F.concat(F.lit("scan"), F.col("doc").cast("string")))
    return manifest.split_manifest(order_groups(spark, sf_dir), totals, ["doc"], "original")


@query(f"{MANIFEST} SELECT doc, 'scan' || doc AS original, idx, start_page, end_page, header, file_name FROM mf")
def split_manifest(spark, sf_dir):
    return manifest_of(spark, sf_dir)


@query(f"{MANIFEST} SELECT doc, count(*) AS files, count(*) FILTER (use > 1) AS renamed, count(DISTINCT file_name) AS names FROM mf GROUP BY doc")
def duplicate_names(spark, sf_dir):
    return manifest_of(spark, sf_dir).groupBy("doc").agg(F.count("*").alias("files"), F.count_if(F.col("file_name").rlike("_[0-9]{2}\\.pdf$") & ~F.col("file_name").rlike("^[A-Z]_[A-Z]{2}_[A-Z0-9]{4}\\.pdf$")).alias("renamed"), F.count_distinct("file_name").alias("names"))


@query("SELECT o_orderkey, 'output/' || strftime(o_orderdate, '%Y/%Y-%m-%d/') || 'order-' || o_orderkey || '.pdf' AS path FROM orders")
def output_paths(spark, sf_dir):
    name = F.concat(F.lit("order-"), F.col("o_orderkey").cast("string"), F.lit(".pdf"))
    return table(spark, sf_dir, "orders").select("o_orderkey", manifest.dated_path("output", F.col("o_orderdate"), name).alias("path"))


@query(
    """WITH w AS (SELECT o_orderkey AS id, 'out/' || strftime(o_orderdate, '%Y-%m-%d') AS stem, o_orderkey % 5 = 0 AS old FROM orders),
t AS (SELECT DISTINCT stem, CASE WHEN id % 10 = 0 THEN 0 ELSE id % 7 END AS no FROM w WHERE old),
n AS (SELECT id, stem, row_number() OVER (PARTITION BY stem ORDER BY id) AS n FROM w WHERE NOT old),
f AS (SELECT s.stem, i, row_number() OVER (PARTITION BY s.stem ORDER BY i) AS n FROM (SELECT DISTINCT stem FROM n) s, range(0, 400) r(i) WHERE NOT EXISTS (SELECT 1 FROM t WHERE t.stem = s.stem AND t.no = i))
SELECT n.id, n.stem || '.pdf' AS path, n.stem || CASE WHEN f.i = 0 THEN '' ELSE '_' || f.i END || '.pdf' AS unique_path FROM n JOIN f ON f.stem = n.stem AND f.n = n.n"""
)
def unique_paths(spark, sf_dir):
    o = table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("id"), F.concat(F.lit("out/"), F.date_format("o_orderdate", "yyyy-MM-dd")).alias("stem"))
    no = F.when(F.col("id") % 10 == 0, 0).otherwise(F.col("id") % 7)
    old = o.where("id % 5 = 0").select(F.concat("stem", F.when(no == 0, "").otherwise(F.concat(F.lit("_"), no.cast("string"))), F.lit(".pdf")).alias("path"))
    return manifest.unique_paths(o.where("id % 5 != 0").select("id", F.concat("stem", F.lit(".pdf")).alias("path")), old.distinct())


@query(f"{MANIFEST} SELECT v.doc, v.page_idx + 1 AS page_number, mf.header AS split_group, mf.file_name FROM v LEFT JOIN mf ON mf.doc = v.doc AND v.page_idx BETWEEN mf.start_page AND mf.end_page")
def range_join_groups(spark, sf_dir):
    rows = pages(spark, sf_dir).select("doc", (F.col("page_idx") + 1).alias("page_number"))
    return manifest.label_records(rows, manifest_of(spark, sf_dir), ["doc"])


@query(f"{V} SELECT doc, page_idx FROM v WHERE NOT EXISTS (SELECT 1 FROM events e WHERE e.user_id = v.doc)")
def unprocessed_pages(spark, sf_dir):
    seen = table(spark, sf_dir, "events").select(F.col("user_id").alias("doc"))
    return manifest.unseen(pages(spark, sf_dir).select(*PAGE), seen, ["doc"])


@query("SELECT DISTINCT CAST(o_orderdate AS DATE) AS day FROM orders WHERE CAST(o_orderdate AS DATE) < DATE '2001-08-01' - 90")
def retention_victims(spark, sf_dir):
    folders = table(spark, sf_dir, "orders").select(F.to_date("o_orderdate").alias("day")).distinct()
    return manifest.retention_victims(folders, F.lit("2001-08-01").cast("date"), 90)


@query(
    """WITH f AS (SELECT CAST(o_orderdate AS DATE) AS day, CAST(floor(o_totalprice) AS BIGINT) AS bytes FROM orders), s AS (SELECT CAST(year(day) AS INT) AS year, * FROM f)
SELECT year, count(DISTINCT day) AS folders, count(*) AS files, CAST(sum(bytes) AS BIGINT) AS bytes, min(day) AS oldest, max(day) AS newest, round_even(sum(bytes) / 1048576, 2) AS megabytes FROM s GROUP BY year
UNION ALL SELECT NULL, count(DISTINCT day), count(*), CAST(sum(bytes) AS BIGINT), min(day), max(day), round_even(sum(bytes) / 1048576, 2) FROM s"""
)
def folder_stats(spark, sf_dir):
    return manifest.folder_stats(table(spark, sf_dir, "orders").select(F.to_date("o_orderdate").alias("day"), F.floor("o_totalprice").alias("bytes")))


@query("SELECT o_orderkey, o_totalprice FROM orders WHERE CAST(o_orderdate AS DATE) = DATE '1998-10-03'")
def date_listing(spark, sf_dir):
    day = F.lit("1998-10-03").cast("date")
    return table(spark, sf_dir, "orders").where(F.to_date("o_orderdate") == day).select("o_orderkey", "o_totalprice")


# --- evidence about codes


def flagged(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pages under one serial a document half, with flags: every fifth kind was decided by glyphs, every third had no boxes."""
    v = pages(spark, sf_dir)
    header = F.when(F.col("header") != "", F.regexp_replace(F.regexp_replace("header", "[A-Z]?[0-9O]{8,}7?$", "S17000001"), "^[A-Z]-[A-Z]{2}", "B-HK"))
    flags = F.when(F.col("k") % 5 == 3, "glyph_disambiguated:x").when(F.col("k") % 3 == 0, "glyph_disambiguation_skipped:no_char_boxes").otherwise("")
    return v.where("header != ''").select("doc", "page_idx", header.alias("header"), flags.alias("flags"), (F.col("k") % 5 == 3).alias("g"))


FLAGGED = f"""{V}, fv AS (SELECT doc, page_idx, regexp_replace(regexp_replace(header, '[A-Z]?[0-9O]{{8,}}7?$', 'S17000001'), '^[A-Z]-[A-Z]{{2}}', 'B-HK') AS header,
  CASE WHEN k % 5 = 3 THEN 'glyph_disambiguated:x' WHEN k % 3 = 0 THEN 'glyph_disambiguation_skipped:no_char_boxes' ELSE '' END AS flags FROM v WHERE header <> ''), {fields_sql('fv', 'header', 'h')},
{CODE}, an AS (SELECT *, CASE WHEN ca IS NOT NULL THEN len(p) || '-' || array_to_string(list_concat(p[:ca-1], p[ca+1:]), '-') END AS anchor, contains(flags, 'glyph_disambiguated') AS glyph, contains(flags, 'no_char_boxes') AS nob FROM a),
ev AS (SELECT doc, anchor, code, count(*) AS n, count(*) FILTER (glyph) AS n_glyph FROM an WHERE anchor IS NOT NULL AND regexp_matches(code, '[0O]') GROUP BY ALL)"""


@query(f"{FLAGGED} SELECT * FROM ev")
def anchor_evidence(spark, sf_dir):
    return propagate.anchor_evidence(flagged(spark, sf_dir), ["doc"])


RECODED = "CASE WHEN {c} IS NOT NULL AND {c} <> code THEN array_to_string(list_concat(list_append(p[:ca-1], {c}), p[ca+1:]), '-') ELSE norm END"


@query(
    f"""{FLAGGED}, rk AS (SELECT *, row_number() OVER q AS r, lead(n) OVER q AS n2, lead(n_glyph) OVER q AS g2 FROM ev WINDOW q AS (PARTITION BY doc, anchor ORDER BY n_glyph DESC, n DESC, code)),
ch AS (SELECT doc, anchor, code AS canon FROM rk WHERE r = 1 AND n2 IS NOT NULL AND n_glyph >= 1 AND NOT (n2 = n AND g2 = n_glyph))
SELECT doc, page_idx, {RECODED.format(c='canon')} AS header, {RECODED.format(c='canon')} <> norm AS updated FROM an LEFT JOIN ch USING (doc, anchor)"""
)
def harmonize(spark, sf_dir):
    return propagate.harmonize(flagged(spark, sf_dir), ["doc"])


@query(
    f"""{FLAGGED}, am AS (SELECT * FROM an WHERE note = 'code_confusable_ambiguous'), ok AS (SELECT doc, anchor FROM am GROUP BY ALL HAVING bool_or(nob) AND NOT bool_or(glyph AND NOT nob OR glyph)),
rq AS (SELECT am.*, row_number() OVER (PARTITION BY am.doc, am.anchor ORDER BY nob DESC, page_idx) AS r FROM am JOIN ok USING (doc, anchor)),
rd AS (SELECT doc, anchor, translate(code, 'O0', '0O') AS rescued FROM rq WHERE r = 1 AND translate(code, 'O0', '0O') <> code)
SELECT doc, page_idx, {RECODED.format(c='c')} AS header, {RECODED.format(c='c')} <> norm AS updated FROM (SELECT an.*, CASE WHEN note = 'code_confusable_ambiguous' THEN rescued END AS c FROM an LEFT JOIN rd USING (doc, anchor))"""
)
def rescue_propagate(spark, sf_dir):
    """A stubbed reading exchanges all 0 and O of the code. Flags of skipped pages name the glyph step too, so they count as decided nowhere."""
    f = flagged(spark, sf_dir).withColumn("flags", F.col("flags"))
    asked = propagate.rescue_requests(f, ["doc"])
    new = asked.select("doc", "page_idx", T.with_code(F.col("norm"), F.translate("code", "O0", "0O")).alias("reading"))
    return propagate.rescue(f, new, ["doc"])


@query(f"{V} SELECT doc, page_idx, CASE WHEN k = 3 THEN clean ELSE header END AS header, k = 3 AND header <> clean AS changed FROM v")
def update_join(spark, sf_dir):
    v = pages(spark, sf_dir)
    return propagate.apply_updates(v.select(*PAGE, "header"), v.where("k = 3").select(*PAGE, F.col("clean").alias("new_header")), ["doc"]).select(*PAGE, "header", "changed")


@query(
    f"""{H}, {CODE}, wz AS (SELECT *, length(array_to_string(p[:ca-1], '-')) + 1 AS st, list_filter(range(1, length(coalesce(code, '')) + 1), lambda i: code[i] = '0') AS zs FROM c),
wl AS (SELECT *, list_min(list_transform(zs, lambda i: 10 + (st + i - 1 + k) % 4)) AS least FROM wz)
SELECT doc, page_idx, CASE WHEN len(zs) >= 2 THEN array_to_string(p[:ca-1], '-') || '-' || array_to_string(list_transform(range(1, length(code) + 1), lambda i: CASE WHEN i > 1 AND code[i] = '0' AND (10 + (st + i - 1 + k) % 4) / CAST(least AS DOUBLE) >= 1.12 THEN 'O' ELSE code[i] END), '') || '-' || array_to_string(p[ca+1:], '-') ELSE norm END AS refined FROM wl"""
)
def width_rule(spark, sf_dir):
    h = headed(spark, sf_dir)
    places = F.sequence(F.lit(0), F.lit(40))
    widths = F.map_from_arrays(places, F.transform(places, lambda i: (F.lit(10) + (i + F.col("k")) % 4).cast("double")))
    return h.select(*PAGE, propagate.width_rule(F.col("norm"), widths).alias("refined"))


@query(
    f"""{H}, gv AS (SELECT doc, page_idx, norm AS header, i AS pos, ch, n, norm[i+1] AS now, length(array_to_string(p[:CASE len(p) WHEN 4 THEN 2 WHEN 3 THEN 1 END], '-')) + 1 AS st
  FROM (SELECT *, unnest([0, 2, 5, 5, 6, 7, 7]) AS i, unnest(['O', '0', 'X', 'O', 'L', '0', 'Q']) AS ch, unnest([k, 3, 2, k % 4, 1 + k % 3, 4, 4]) AS n FROM h WHERE norm <> '')),
ow AS (SELECT doc, page_idx, header, pos, sum(CASE WHEN ch = now THEN n ELSE 0 END) AS own FROM gv GROUP BY ALL),
rv AS (SELECT *, row_number() OVER (PARTITION BY doc, page_idx, header, pos ORDER BY n DESC, ch) AS r FROM gv WHERE ch <> now),
bt AS (SELECT doc, page_idx, rv.pos, rv.ch, row_number() OVER (PARTITION BY doc, page_idx ORDER BY rv.pos) AS q FROM rv JOIN ow USING (doc, page_idx, header, pos) WHERE r = 1 AND n > own AND n >= 2 AND NOT coalesce(rv.pos = st AND regexp_matches(now, '[0-9]') AND regexp_matches(ch, '[A-Z]'), false)),
cg AS (SELECT doc, page_idx, map(list(pos), list(ch)) AS m FROM bt WHERE q <= 2 GROUP BY ALL)
SELECT h.doc, h.page_idx, CASE WHEN m IS NULL THEN norm ELSE array_to_string(list_transform(range(0, length(norm)), lambda i: coalesce(m[CAST(i AS INT)], norm[i+1])), '') END AS refined FROM h LEFT JOIN cg USING (doc, page_idx) WHERE norm <> ''"""
)
def glyph_votes(spark, sf_dir):
    h = headed(spark, sf_dir).where("norm != ''")
    k = F.col("k")
    each = F.array(*(F.struct(F.lit(p).alias("pos"), F.lit(c).alias("ch"), F.lit(n).alias("votes") if isinstance(n, int) else n.alias("votes")) for p, c, n in ((0, "O", k), (2, "0", 3), (5, "X", 2), (5, "O", k % 4), (6, "L", 1 + k % 3), (7, "0", 4), (7, "Q", 4))))
    votes = h.select(*PAGE, F.col("norm").alias("header"), F.inline(each))
    return propagate.glyph_vote(votes, PAGE, 2, 2).select(*PAGE, "refined")


# --- metrics


def job_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    kind = F.col("event_type")
    named = F.when(kind == "view", "page").when(kind == "click", "attempt").when(kind == "purchase", "success").when(kind == "error", "error").when(F.col("value") < 10, "api_failure").otherwise("api")
    seconds = F.unix_micros(F.col("ts").cast("timestamp")) / F.lit(1e6)
    return table(spark, sf_dir, "events").select(F.col("user_id").alias("job_id"), "event_id", seconds.alias("ts"), named.alias("kind"), "value", F.col("props").alias("message"))


EVENTS = """WITH RECURSIVE ev AS (SELECT user_id AS job_id, event_id, epoch_us(ts) / 1e6 AS ts, value, props AS message,
  CASE event_type WHEN 'view' THEN 'page' WHEN 'click' THEN 'attempt' WHEN 'purchase' THEN 'success' WHEN 'error' THEN 'error' ELSE CASE WHEN value < 10 THEN 'api_failure' ELSE 'api' END END AS kind FROM events),
jb AS (SELECT job_id, min(ts) AS started, max(ts) AS ended, count(*) FILTER (kind = 'page') AS processed_pages, count(*) FILTER (kind IN ('attempt', 'success')) AS ocr_attempts, count(*) FILTER (kind = 'success') AS ocr_successful,
  coalesce(max(value) FILTER (kind = 'success'), 0.0) AS best_score, count(*) FILTER (kind IN ('api', 'api_failure')) AS api_calls, count(*) FILTER (kind = 'api') AS api_success, count(*) FILTER (kind = 'error') AS errors_count FROM ev GROUP BY job_id),
jm AS (SELECT *, ended - started AS processing_time_seconds FROM jb)"""


@query(
    f"""{EVENTS} SELECT job_id, processed_pages, ocr_attempts, ocr_successful, best_score, api_calls, api_success, errors_count, round_even(processing_time_seconds, 6) AS processing_time_seconds,
  round_even(CASE WHEN processed_pages = 0 THEN 0 ELSE processing_time_seconds / processed_pages END, 3) AS avg_time_per_page_seconds, round_even(CASE WHEN ocr_attempts = 0 THEN 0 ELSE ocr_successful * 100.0 / ocr_attempts END, 2) AS success_rate,
  api_calls - api_success AS api_failures, round_even(CASE WHEN api_calls = 0 THEN 0 ELSE api_success * 100.0 / api_calls END, 2) AS api_success_rate FROM jm"""
)
def job_metrics(spark, sf_dir):
    out = metrics.job_metrics(job_events(spark, sf_dir), "job_id").drop("started", "ended")
    return out.withColumns({c: F.bround(c, n) for c, n in (("processing_time_seconds", 6), ("avg_time_per_page_seconds", 3), ("success_rate", 2), ("api_success_rate", 2))})


FLEET = """count(*) AS total_jobs, CAST(sum(processed_pages) AS BIGINT) AS total_pages_processed, round_even(sum(processing_time_seconds) / count(*), 2) AS avg_processing_time_seconds,
  round_even(CASE WHEN sum(processed_pages) = 0 THEN 0 ELSE sum(processing_time_seconds) / sum(processed_pages) END, 3) AS avg_processing_per_page_seconds, round_even(sum(processing_time_seconds), 2) AS total_processing_time_seconds,
  CAST(sum(ocr_attempts) AS BIGINT) AS total_ocr_attempts, CAST(sum(ocr_successful) AS BIGINT) AS total_ocr_successful, round_even(CASE WHEN sum(ocr_attempts) = 0 THEN 0 ELSE sum(ocr_successful) * 100.0 / sum(ocr_attempts) END, 2) AS ocr_success_rate,
  CAST(sum(api_calls) AS BIGINT) AS total_api_calls, CAST(sum(api_success) AS BIGINT) AS total_api_success, round_even(CASE WHEN sum(api_calls) = 0 THEN 0 ELSE sum(api_success) * 100.0 / sum(api_calls) END, 2) AS api_success_rate,
  min(processing_time_seconds) AS fastest_job, max(processing_time_seconds) AS slowest_job"""


@query(f"{EVENTS} SELECT {FLEET} FROM jm")
def fleet_summary(spark, sf_dir):
    return metrics.fleet_summary(metrics.job_metrics(job_events(spark, sf_dir), "job_id"))


@query(f"{EVENTS} SELECT strftime(make_timestamp(CAST(round(ended * 1e6) AS BIGINT)), '%Y-%m-%d') AS day, {FLEET} FROM jm GROUP BY day")
def daily_metrics(spark, sf_dir):
    return metrics.daily(metrics.job_metrics(job_events(spark, sf_dir), "job_id"))


@query(f"{EVENTS} SELECT job_id, ended FROM jm ORDER BY ended DESC, job_id DESC LIMIT 100")
def last_n_jobs(spark, sf_dir):
    return metrics.last_jobs(metrics.job_metrics(job_events(spark, sf_dir), "job_id"), "job_id").select("job_id", "ended")


@query(f"{EVENTS} SELECT job_id, array_to_string(list(message ORDER BY ts, event_id)[:5], ';') AS errors FROM ev WHERE kind = 'error' GROUP BY job_id")
def first_errors(spark, sf_dir):
    return metrics.first_errors(job_events(spark, sf_dir), "job_id").withColumn("errors", F.array_join("errors", ";"))


def outcomes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return job_events(spark, sf_dir).select("job_id", "event_id", "ts", (F.col("kind").isin("error", "api_failure")).alias("failed"))


OUTCOMES = f"{EVENTS}, oc AS MATERIALIZED (SELECT job_id, event_id, ts, kind IN ('error', 'api_failure') AS failed, row_number() OVER (PARTITION BY job_id ORDER BY ts, event_id) AS rn FROM ev)"


@query(
    f"""{OUTCOMES}, st(job_id, rn, event_id, state, failures, last, allowed) AS (SELECT DISTINCT job_id, CAST(0 AS BIGINT), CAST(NULL AS BIGINT), 'CLOSED', 0, CAST(NULL AS DOUBLE), true FROM oc UNION ALL
  SELECT job_id, rn, event_id, CASE WHEN NOT al THEN s0 WHEN failed THEN CASE WHEN bs = 'HALF_OPEN' OR failures + 1 >= 2 THEN 'OPEN' ELSE bs END WHEN bs = 'HALF_OPEN' THEN 'CLOSED' ELSE bs END,
    CASE WHEN NOT al THEN failures WHEN failed THEN failures + 1 ELSE 0 END, CASE WHEN al AND failed THEN ts ELSE last END, al
  FROM (SELECT x.job_id, x.rn, x.event_id, x.ts, x.failed, s.state AS s0, s.failures, s.last, s.state <> 'OPEN' OR x.ts - s.last > 21600 AS al, CASE WHEN s.state = 'OPEN' AND x.ts - s.last > 21600 THEN 'HALF_OPEN' ELSE s.state END AS bs
    FROM st s JOIN oc x ON x.job_id = s.job_id AND x.rn = s.rn + 1))
SELECT job_id, event_id, state, allowed FROM st WHERE rn > 0"""
)
def circuit_breaker(spark, sf_dir):
    return state.circuit_breaker(outcomes(spark, sf_dir), "job_id", BREAKER)


@query(
    f"""{OUTCOMES}, st(job_id, rn, event_id, state, failures, until, allowed) AS (SELECT DISTINCT job_id, CAST(0 AS BIGINT), CAST(NULL AS BIGINT), 'READY', 0, CAST(0 AS DOUBLE), true FROM oc UNION ALL
  SELECT job_id, rn, event_id, CASE WHEN NOT al OR (failed AND failures + 1 >= 2) THEN 'RESTING' ELSE 'READY' END, CASE WHEN NOT al THEN failures WHEN NOT failed OR failures + 1 >= 2 THEN 0 ELSE failures + 1 END,
    CASE WHEN al AND failed AND failures + 1 >= 2 THEN ts + 36000 ELSE until END, al
  FROM (SELECT x.job_id, x.rn, x.event_id, x.ts, x.failed, s.failures, s.until, x.ts >= s.until AS al FROM st s JOIN oc x ON x.job_id = s.job_id AND x.rn = s.rn + 1))
SELECT job_id, event_id, state, allowed FROM st WHERE rn > 0"""
)
def engine_cooldown(spark, sf_dir):
    return state.cooldown(outcomes(spark, sf_dir), "job_id", 2, 36000)


@query(
    """WITH m AS (SELECT conv_id, turn, role, CASE WHEN role = lag(role) OVER q THEN 0 ELSE 1 END AS new FROM conversations WINDOW q AS (PARTITION BY conv_id ORDER BY turn)),
g AS (SELECT *, sum(new) OVER (PARTITION BY conv_id ORDER BY turn) AS run FROM m) SELECT conv_id, CAST(run AS BIGINT) AS run, min(role) AS role, min(turn) AS first, max(turn) AS last, count(*) AS n FROM g GROUP BY conv_id, run"""
)
def role_runs(spark, sf_dir):
    return segment.runs(table(spark, sf_dir, "conversations"), ["conv_id"], "turn", "role")


@query("SELECT doc_id, CASE WHEN quality IS NULL THEN 'unlabelled' WHEN quality = 1 THEN 'success' ELSE 'error' END AS status FROM documents LEFT JOIN labels USING (doc_id)")
def label_status(spark, sf_dir):
    both = table(spark, sf_dir, "documents").select("doc_id").join(table(spark, sf_dir, "labels").select("doc_id", "quality"), "doc_id", "left")
    return both.select("doc_id", F.when(F.col("quality").isNull(), "unlabelled").when(F.col("quality") == 1, "success").otherwise("error").alias("status"))


@query("SELECT doc_id, source FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels WHERE doc_id IS NOT NULL)")
def unlabelled_documents(spark, sf_dir):
    return manifest.unseen(table(spark, sf_dir, "documents").select("doc_id", "source"), table(spark, sf_dir, "labels").select("doc_id"), ["doc_id"])


# --- the older extractor

FIXED = """lf AS (SELECT *, rtrim(regexp_replace(header, '-+$', '')) AS t0 FROM v),
lg AS (SELECT *, CASE WHEN starts_with(t0, '-') AND len(string_split(ltrim(t0, '-'), '-')) >= 3 AND regexp_matches(ltrim(t0, '-'), '^[A-Za-z]{1,2}-') THEN ltrim(t0, '-') ELSE t0 END AS t1 FROM lf),
lh AS (SELECT *, CASE WHEN len(string_split(t1, '-')) >= 3 AND upper(string_split(t1, '-')[1]) IN ('BL', 'RB', 'PL') THEN CASE upper(string_split(t1, '-')[1]) WHEN 'PL' THEN 'P' ELSE 'B' END || substr(t1, 3) ELSE t1 END AS t2 FROM lg),
lx AS (SELECT * EXCLUDE (t0, t1), CASE WHEN len(string_split(t2, '-')) >= 3 AND regexp_matches(string_split(t2, '-')[-1], '^8[0-9]{7,}$') THEN left(t2, length(t2) - length(string_split(t2, '-')[-1])) || 'S' || substr(string_split(t2, '-')[-1], 2) ELSE t2 END AS fixed FROM lh)"""
CLEAN = "regexp_replace(trim(string_split({c}, '-')[-1]), '[^A-Za-z0-9]', '', 'g')"
SCORED = f"""lp AS (SELECT *, string_split(fixed, '-') AS fp, trim(string_split(fixed, '-')[-1]) AS raw, {CLEAN.format(c='fixed')} AS c0 FROM lx),
lq AS (SELECT *, CASE WHEN length(c0) > 9 AND length(regexp_extract(c0, '(?i)^[SR][0-9]+')) BETWEEN 7 AND 9 THEN regexp_extract(c0, '(?i)^[SR][0-9]+') ELSE c0 END AS c1 FROM lp),
ls AS (SELECT *, CASE len(fp) WHEN 4 THEN 60 + CASE WHEN regexp_matches(fp[1], '^[A-Za-z]$') THEN 30 ELSE -20 END + CASE WHEN regexp_matches(fp[2], '^[A-Za-z]{{1,2}}$') THEN 30 ELSE -20 END + CASE WHEN regexp_matches(fp[3], '^[A-Za-z0-9]{{2,4}}$') THEN 30 ELSE -20 END
    WHEN 3 THEN 40 + CASE WHEN regexp_matches(fp[1], '^[A-Za-z]{{1,2}}$') THEN 20 ELSE -20 END + CASE WHEN regexp_matches(fp[2], '^[A-Za-z0-9]{{2,5}}$') THEN 20 ELSE -20 END END AS s0,
  CASE WHEN length(c1) BETWEEN 7 AND 9 THEN 40 + CASE WHEN regexp_matches(c1, '(?i)^[SR]') THEN 30 + CASE WHEN regexp_matches(c1, '^.[0-9]+$') THEN 50 + CASE WHEN length(c1) IN (8, 9) THEN 20 ELSE 0 END ELSE -40 END ELSE -40 END
    - CASE WHEN raw <> c1 THEN (length(raw) - length(c1)) * 15 ELSE 0 END ELSE -30 END AS s1 FROM lq),
lz AS (SELECT *, CAST(CASE WHEN length(header) < 10 OR len(fp) NOT BETWEEN 3 AND 4 THEN -1 ELSE greatest(s0 + s1, -1) END AS INT) AS lscore FROM ls)"""


@query(f"{V}, {FIXED} SELECT doc, page_idx, fixed FROM lx")
def legacy_corrections(spark, sf_dir):
    return pages(spark, sf_dir).select(*PAGE, L.corrections(F.col("header")).alias("fixed"))


@query(f"{V}, {FIXED}, {SCORED} SELECT doc, page_idx, lscore AS score FROM lz")
def legacy_pattern_score(spark, sf_dir):
    return pages(spark, sf_dir).select(*PAGE, L.score(F.col("header")).alias("score"))


@query(
    f"""{V}, x AS (SELECT *, string_split(header, '-')[-1] AS s, string_split(header, '-') AS q FROM v), y AS (SELECT *, length(regexp_replace(s, '[^0-9]', '', 'g')) AS nd, length(regexp_replace(s, '[^A-Za-z]', '', 'g')) AS nl FROM x)
SELECT doc, page_idx, CAST(CASE WHEN length(header) < 10 THEN -1 ELSE CASE WHEN len(q) = 4 THEN 50 + CASE WHEN length(s) >= 8 THEN 10 + CASE WHEN nd = 8 THEN 100 WHEN nd = 7 THEN 50 WHEN nd >= 6 THEN 20 ELSE 0 END
  + CASE WHEN regexp_matches(s, '^[A-Za-z][0-9]{{8}}$') THEN 50 ELSE 0 END - CASE WHEN nl > 1 THEN 30 * (nl - 1) ELSE 0 END ELSE 0 END ELSE 0 END + CASE WHEN length(regexp_replace(header, '[^0-9]', '', 'g')) >= 8 THEN 20 ELSE 0 END END AS INT) AS score FROM y"""
)
def legacy_count_score(spark, sf_dir):
    return pages(spark, sf_dir).select(*PAGE, L.count_score(F.col("header")).alias("score"))


SERIAL = f"CASE WHEN len(string_split({{c}}, '-')) >= 3 THEN nullif({CLEAN}, '') END"


@query(
    f"""{V}, x AS (SELECT doc, page_idx, header, {CLEAN.format(c='header')} AS c, {SERIAL.format(c='header')} AS serial FROM v)
SELECT doc, page_idx, CASE WHEN len(string_split(header, '-')) = 4 AND length(c) > 9 AND regexp_matches(c, '(?i)^[SR][0-9]{{6,8}}') THEN left(header, length(header) - length(string_split(header, '-')[-1])) || regexp_extract(c, '(?i)^[SR][0-9]{{6,8}}') ELSE header END AS cleaned, serial FROM x"""
)
def legacy_serial_extract(spark, sf_dir):
    return pages(spark, sf_dir).select(*PAGE, L.clean_serial(F.col("header")).alias("cleaned"), L.serial_number(F.col("header")).alias("serial"))


QUALITY = f"""qx AS (SELECT *, string_split(header, '-') AS q, trim(string_split(header, '-')[-1]) AS raw, {CLEAN.format(c='header')} AS c FROM v),
qy AS (SELECT *, CAST(CASE WHEN header = '' THEN 0 WHEN len(q) < 2 THEN -50 ELSE CASE WHEN len(q) BETWEEN 3 AND 4 THEN 20 ELSE -50 END + CASE WHEN regexp_matches(q[1], '^[A-Za-z]$') THEN 10 ELSE 0 END + CASE WHEN regexp_matches(q[2], '^[A-Za-z]{{1,2}}$') THEN 10 ELSE 0 END
  + CASE WHEN len(q) = 4 THEN CASE WHEN q[3] IN ('WFE', 'WFH', 'GTX', '5U5', 'W1A') THEN 30 WHEN regexp_matches(q[3], '^[A-Za-z0-9]{{3}}$') THEN 15 WHEN contains(q[3], 'EE') OR contains(q[3], 'EFE') THEN -10 WHEN length(q[3]) > 4 THEN -20 ELSE 0 END ELSE 0 END
  + CASE WHEN c <> '' THEN CASE WHEN regexp_matches(c, '(?i)^[SR]') THEN 15 ELSE 0 END + CASE WHEN regexp_matches(c, '^.[0-9]+$') THEN 20 ELSE 0 END + CASE WHEN length(c) BETWEEN 8 AND 9 THEN 10 ELSE 0 END - CASE WHEN contains(raw, ' ') THEN 15 ELSE 0 END ELSE 0 END
  - CASE WHEN starts_with(header, '-') OR starts_with(header, 'BL-') THEN 30 ELSE 0 END END AS INT) AS quality FROM qx)"""


@query(f"{V}, {QUALITY} SELECT doc, page_idx, quality FROM qy")
def legacy_quality(spark, sf_dir):
    return pages(spark, sf_dir).select(*PAGE, L.quality(F.col("header")).alias("quality"))


def legacy_results(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pages(spark, sf_dir).select("order_no", F.col("header").alias("text"), L.score(F.col("header")).alias("score"), (F.col("quantity") / 50).alias("freq_ratio"))


@query(
    f"""{V}, {FIXED}, {SCORED}, g AS (SELECT order_no, header, round(avg(lscore) * 0.4 + max(lscore) * 0.2 + avg(quantity / 50) * 30 + count(*) - CASE WHEN length(header) > 2 AND regexp_matches(header, ' [\\p{{L}}\\p{{N}}]$') THEN 30 ELSE 0 END, 9) AS combined FROM lz GROUP BY order_no, header),
b AS (SELECT *, row_number() OVER (PARTITION BY order_no ORDER BY combined DESC, header) AS n, {CLEAN.format(c='header')} AS c FROM g)
SELECT order_no, CASE WHEN len(string_split(header, '-')) = 4 AND length(c) > 9 AND regexp_matches(c, '(?i)^[SR][0-9]{{6,8}}') THEN left(header, length(header) - length(string_split(header, '-')[-1])) || regexp_extract(c, '(?i)^[SR][0-9]{{6,8}}') ELSE header END AS header, round_even(combined, 6) AS combined FROM b WHERE n = 1"""
)
def legacy_page_combine(spark, sf_dir):
    return LO.page_combine(legacy_results(spark, sf_dir), ["order_no"]).withColumn("combined", F.bround("combined", 6))


@query(
    f"""{V}, {FIXED}, {SCORED}, s AS (SELECT order_no, header, lscore, {SERIAL.format(c='header')} AS serial FROM lz), c AS (SELECT order_no, serial, count(*) AS votes FROM s WHERE serial IS NOT NULL GROUP BY ALL),
t AS (SELECT *, row_number() OVER (PARTITION BY order_no ORDER BY votes DESC, serial) AS n FROM c),
b AS (SELECT s.order_no, s.header, s.lscore, coalesce(t.votes, 0) AS votes, row_number() OVER (PARTITION BY s.order_no ORDER BY lscore DESC, header) AS r FROM s LEFT JOIN t ON t.order_no = s.order_no AND t.n = 1 WHERE t.serial IS NULL OR t.serial = s.serial)
SELECT order_no, header AS text, lscore AS score, votes FROM b WHERE r = 1"""
)
def legacy_serial_vote(spark, sf_dir):
    return LO.serial_vote(legacy_results(spark, sf_dir), ["order_no"])


@query(
    f"""{V}, {FIXED}, {SCORED}, g AS (SELECT order_no, header, fixed, lscore, count(*) AS freq FROM lz WHERE header <> '' GROUP BY ALL),
b AS (SELECT *, row_number() OVER (PARTITION BY order_no ORDER BY lscore DESC, freq DESC, length(fixed), fixed) AS n FROM g WHERE lscore >= 0) SELECT order_no, fixed AS header, lscore AS score, freq FROM b WHERE n = 1"""
)
def legacy_vote(spark, sf_dir):
    return LO.vote(legacy_results(spark, sf_dir), ["order_no"])


@query(f"{V}, b AS (SELECT order_no, header, row_number() OVER (PARTITION BY order_no ORDER BY length(header) DESC, header) AS n FROM v) SELECT order_no, header AS text FROM b WHERE n = 1")
def longest_text(spark, sf_dir):
    return LO.longest_text(legacy_results(spark, sf_dir), ["order_no"])


LMATCH = f"""CASE WHEN {{a}}.header = '' OR {{b}}.header = '' THEN {{a}}.header = {{b}}.header WHEN {{a}}.hk = {{b}}.hk THEN true WHEN {{a}}.serial IS NOT NULL AND {{b}}.serial IS NOT NULL THEN {{a}}.serial = {{b}}.serial ELSE {SIM.format(a='{a}.hk', b='{b}.hk')} >= 0.85 END"""


@query(
    f"""{V}, {QUALITY}, lpg AS MATERIALIZED (SELECT doc, header, quality, upper(replace(header, ' ', '')) AS hk, {SERIAL.format(c='header')} AS serial, row_number() OVER (PARTITION BY doc ORDER BY page_idx) AS rn FROM qy),
walk(doc, rn, anchor, segment) AS (SELECT doc, rn, rn, 0 FROM lpg WHERE rn = 1 UNION ALL
  SELECT w.doc, x.rn, CASE WHEN {LMATCH.format(a='y', b='x')} AND x.quality <= y.quality THEN w.anchor ELSE x.rn END, CASE WHEN {LMATCH.format(a='y', b='x')} THEN w.segment ELSE w.segment + 1 END
  FROM walk w JOIN lpg x ON x.doc = w.doc AND x.rn = w.rn + 1 JOIN lpg y ON y.doc = w.doc AND y.rn = w.anchor),
j AS (SELECT w.doc, w.segment, w.rn, x.header, x.quality, a.header AS anchor FROM walk w JOIN lpg x ON x.doc = w.doc AND x.rn = w.rn JOIN lpg a ON a.doc = w.doc AND a.rn = w.anchor)
SELECT doc, segment, CAST(min(rn) - 1 AS INT) AS start_page, CAST(max(rn) - 1 AS INT) AS end_page, list(header ORDER BY quality DESC, rn)[1] AS header FROM j GROUP BY doc, segment HAVING arg_max(anchor, rn) <> ''"""
)
def segment_pages_legacy(spark, sf_dir):
    return LO.segments(pages(spark, sf_dir), ["doc"])


@query(f"{V} SELECT doc, page_idx, CASE WHEN header = '' THEN 'scan' || doc ELSE {safe_sql('header')} END AS name FROM v")
def legacy_filename(spark, sf_dir):
    return pages(spark, sf_dir).select(*PAGE, L.file_name(F.col("header"), F.concat(F.lit("scan"), F.col("doc").cast("string"))).alias("name"))


# --- likeness by matching blocks, which SQL has not


def distinct_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Neighbouring headers that differ, each pair once, before a Python function sees them."""
    p = next_page(headed(spark, sf_dir), "norm", "serial").where("norm != '' and next_norm != '' and norm != next_norm")
    return p.select("norm", "next_norm", "serial", "next_serial").distinct()


@query()
def headers_match_ratio(spark, sf_dir):
    pairs = distinct_pairs(spark, sf_dir).withColumn("ratio", M.matching_ratio(F.col("norm"), F.col("next_norm")))
    named = S.with_header_fields(pairs.select("norm", "next_norm", "ratio").withColumnRenamed("norm", "header")).withColumn("a", F.struct("norm", "n_parts", "lead", "serial", "strict"))
    other = S.with_header_fields(named.select("header", "next_norm", "ratio", "a"), "next_norm").withColumn("b", F.struct("norm", "n_parts", "lead", "serial", "strict"))
    digits = M.matching_ratio(T.digits_of(F.col("a.serial")), T.digits_of(F.col("b.serial")))
    ready = other.select("header", "next_norm", "ratio", "a", "b", digits.alias("digit_ratio"))
    calls = iter((F.col("ratio"), F.col("digit_ratio")))
    return ready.select("header", "next_norm", F.bround("ratio", 6).alias("ratio"), M.headers_match(F.col("a"), F.col("b"), SHIPPED, lambda x, y: next(calls)).alias("matches"))


@query()
def serials_close(spark, sf_dir):
    pairs = distinct_pairs(spark, sf_dir).select("serial", "next_serial").distinct()
    digits = M.matching_ratio(T.digits_of(F.col("serial")), T.digits_of(F.col("next_serial")))
    return pairs.withColumn("ratio", digits).select("serial", "next_serial", M.close_serials(F.col("serial"), F.col("next_serial"), F.col("ratio")).alias("close"))


@query()
def box_alignment(spark, sf_dir):
    pairs = distinct_pairs(spark, sf_dir).select("norm", "next_norm")
    found = pairs.withColumn("places", M.aligned(T.for_alignment(F.col("norm")), T.for_alignment(F.col("next_norm"))))
    return found.select("norm", "next_norm", F.size("places").alias("n_aligned"))


@query()
def scale_vote_ratio(spark, sf_dir):
    out = vote.scale_vote(scale_candidates(spark, sf_dir), ["order_no"], M.matching_ratio)
    return out.select("order_no", "idx", "text", "n_exact", "n_similar", F.bround("sim_sum", 6).alias("sim_sum"))

"""Benchmark decontamination by template canonicalisation; DataFrame functions only.

A window is SIZE consecutive words (a whole item if it has fewer). Its template replaces numbers by <num>, units after a number
by <unit> and capitalised words inside a sentence by <name>; the other words are lower-cased without punctuation. Templates of
the benchmark's windows are hash-joined with those of the documents. A match counts if its slots are consistent: the
benchmark's values map one to one to the document's, so that the same question with other numbers and names is caught, and a
mere likeness of shape is not.

Only windows around an anchor need a template: each benchmark window names its longest literal word as its anchor, which every
matching window has at the same place. Beyond ANCHORS distinct anchors they are joined instead of tested in place.

A window with under LITERAL of its words literal has a template that says little, so it matches with its own values only: the same
words, but for case and marks. Such matches tell documents that have no other match with the item; they count in n_windows only
there, as the SQL has none of them.

Null and empty texts match nothing. Repeated rows count once, rows that share a doc_id are one document. An empty benchmark gives an
empty result, and so do empty documents. Other columns are unread; clean() passes them through.
"""

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import Scratch, table

SIZE, LITERAL = 8, 0.6
#: Anchors tested in place at most; benchmark windows broadcast at most.
ANCHORS, BROADCAST = 20_000, 100_000
#: Characters dropped from words.
MARKS = ".,;:!?()[]{}\"'*&%$#_|<>"
#: Fixed list of units.
UNITS = ["%", "km", "m", "cm", "mm", "kg", "g", "mg", "l", "ml", "s", "ms", "min", "h", "hours", "minutes", "seconds", "days", "weeks", "months", "years", "miles", "feet", "inches", "pounds", "dollars", "euros", "percent", "degrees"]
SPACE = "[\\x20\\x09-\\x0D]+"


def words_of(text: Column) -> Column:
    return F.filter(F.split(text, SPACE), lambda w: w != "")


def literal(word: Column) -> Column:
    return F.lower(F.translate(word, MARKS, ""))


def _is_number(word: Column) -> Column:
    return word.rlike("\\p{N}") & ~word.rlike("\\p{L}")


def _kind(words: Column, w: Column, i: Column) -> Column:
    """The placeholder of a word, or null."""
    before = F.get(words, i - 1)
    name = (i > 0) & w.rlike("^[^\\p{L}\\p{N}]*\\p{Lu}\\p{Ll}") & ~before.rlike("[.!?:]$")
    unit = (i > 0) & F.lower(w).isin(UNITS) & _is_number(before)
    return F.when(_is_number(w), "<num>").when(F.coalesce(unit, F.lit(False)), "<unit>").when(F.coalesce(name, F.lit(False)), "<name>")


def template(words: Column) -> Column:
    """The words with placeholders, as an array."""
    return F.transform(words, lambda w, i: F.coalesce(_kind(words, w, i), literal(w)))


def slots(words: Column) -> Column:
    """What stands in the places of placeholders."""
    return F.transform(F.filter(words, lambda w, i: _kind(words, w, i).isNotNull()), literal)


def _none() -> Column:
    return F.array().cast("array<string>")


def benchmark_windows(items: DataFrame) -> DataFrame:
    """item_id, size, verbatim (matches with its own values only), template, slots, anchor, offset of each window."""
    words = items.select("item_id", words_of("text").alias("w")).where(F.size("w") > 0)
    size = F.least(F.lit(SIZE), F.size("w"))
    each = words.select("item_id", size.alias("size"), "w", F.explode(F.sequence(F.lit(1), F.size("w") - size + 1)).alias("at"))
    each = each.select("item_id", "size", F.slice("w", F.col("at"), F.col("size")).alias("w")).select("item_id", "size", F.transform("w", literal).alias("own"), template(F.col("w")).alias("t"), slots(F.col("w")).alias("slots"))
    plain = each.withColumn("plain", F.filter("t", lambda x: ~x.startswith("<") & (x != "")))
    plain = plain.withColumn("verbatim", F.size("plain") < F.ceil(F.col("size") * LITERAL))
    own = plain.select("item_id", "size", "verbatim", *(F.when(F.col("verbatim"), x).otherwise(F.col(y)).alias(y) for x, y in ((F.col("own"), "t"), (_none(), "slots"), (F.col("own"), "plain"))))
    longest = F.aggregate("plain", F.lit(""), lambda best, x: F.when(F.length(x) > F.length(best), x).otherwise(best))
    out = own.withColumn("anchor", longest).withColumn("offset", (F.array_position("t", F.col("anchor")) - 1).cast("int"))
    return out.select("item_id", "size", "verbatim", F.array_join("t", " ").alias("template"), "slots", "anchor", "offset").distinct()


def _split(docs: DataFrame) -> DataFrame:
    """doc_id, w (words), l (their literal forms, place by place) of texts with words. Marks go from the whole text at once, which costs less than word by word."""
    spaced = docs.select("doc_id", F.trim(F.regexp_replace("text", SPACE, " ")).alias("text")).where("text != ''")
    return spaced.select("doc_id", F.split("text", " ").alias("w"), F.split(literal(F.col("text")), " ").alias("l"))


def _around(words: Column, literals: Column, keep=None) -> Column:
    """For each word, or each that keep says: its place, literal form and neighbours."""
    near = F.transform(
        literals,
        lambda x, i: F.when(keep(x) if keep else F.lit(True), F.struct(i.alias("place"), x.alias("anchor"), F.least(i, F.lit(SIZE - 1)).alias("before"), F.slice(words, F.greatest(i - (SIZE - 2), F.lit(1)), F.lit(2 * SIZE - 1)).alias("near"))),
    )
    return F.array_compact(near)


def matches(docs: DataFrame, items: DataFrame, scratch: Scratch) -> DataFrame:
    """doc_id, item_id, start, verbatim, same (slots equal too) of each window of docs (doc_id, text) that an item has."""
    bench = scratch.keep(benchmark_windows(items), "benchmark")
    n = bench.count()
    small = F.broadcast if n <= BROADCAST else lambda df: df
    anchors = bench.select("anchor").distinct().limit(ANCHORS + 1).collect()
    keep = None if len(anchors) > ANCHORS else (lambda w: w.isin([r[0] for r in anchors])) if anchors else (lambda w: F.lit(False))
    found = _split(docs).select("doc_id", F.explode(_around(F.col("w"), F.col("l"), keep)).alias("x")).select("doc_id", "x.*")
    at = found.join(small(bench.select("anchor", "offset", "size", "verbatim").distinct()), "anchor").where(F.col("place") >= F.col("offset"))
    part = F.slice("near", F.greatest(F.col("before") - F.col("offset") + 1, F.lit(1)), F.col("size"))
    at = at.select("doc_id", (F.col("place") - F.col("offset")).alias("start"), "size", "verbatim", part.alias("w")).where(F.size("w") == F.col("size"))
    words = F.when(F.col("verbatim"), F.transform("w", literal)).otherwise(template(F.col("w")))
    at = at.select("doc_id", "start", "size", "verbatim", F.array_join(words, " ").alias("template"), F.when(F.col("verbatim"), _none()).otherwise(slots(F.col("w"))).alias("here"))
    both = at.join(small(bench.select("item_id", "size", "verbatim", "template", "slots")), ["size", "verbatim", "template"])
    pairs = F.size(F.array_distinct(F.arrays_zip("slots", "here")))
    both = both.where((pairs == F.size(F.array_distinct("slots"))) & (pairs == F.size(F.array_distinct("here"))))
    return both.groupBy("doc_id", "item_id", "start", "verbatim").agg(F.max(F.col("slots") == F.col("here")).alias("same"))


def contamination(docs: DataFrame, items: DataFrame, scratch: Scratch) -> DataFrame:
    """doc_id, item_id, n_windows, n_exact (with the benchmark's own values), first_word of each contaminated pair."""
    each = matches(docs, items, scratch).groupBy("doc_id", "item_id", "verbatim").agg(F.count("*").alias("n"), F.count_if("same").alias("same"), F.min("start").cast("long").alias("first"))
    first = F.min(F.struct("verbatim", "n", "same", "first")).alias("x")  # templates before verbatim windows
    return each.groupBy("doc_id", "item_id").agg(first).select("doc_id", "item_id", F.col("x.n").alias("n_windows"), F.col("x.same").alias("n_exact"), F.col("x.first").alias("first_word"))


def clean(docs: DataFrame, items: DataFrame, scratch: Scratch) -> DataFrame:
    """The rows of docs without any match. A row is named by its id, or none, and its text, as ids may repeat or be null."""
    name = F.concat_ws(" ", F.coalesce(F.col("doc_id").cast("string"), F.lit("none")), F.xxhash64("text").cast("string"))
    found = matches(docs.select(name.alias("doc_id"), "text"), items, scratch)
    bad = scratch.keep(found.select(F.col("doc_id").alias("__hf_row")).distinct(), "contaminated")
    return docs.withColumn("__hf_row", name).join(bad, "__hf_row", "left_anti").select(*docs.columns)


def op6_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), Scratch(spark, "op6"))


def _lit_sql(w: str) -> str:
    return f"lower(translate({w}, '{MARKS.replace(chr(39), chr(39) * 2)}', ''))"


def _number_sql(w: str) -> str:
    return f"(regexp_matches({w}, '\\p{{N}}') AND NOT regexp_matches({w}, '\\p{{L}}'))"


_KIND = (
    "CASE WHEN " + _number_sql("ws[j]") + " THEN '<num>' WHEN j > 1 AND lower(ws[j]) IN (" + ", ".join(f"'{u}'" for u in UNITS) + ") AND " + _number_sql("ws[j-1]") + " THEN '<unit>' "
    "WHEN j > 1 AND regexp_matches(ws[j], '^[^\\p{L}\\p{N}]*\\p{Lu}\\p{Ll}') AND NOT regexp_matches(ws[j-1], '[.!?:]$') THEN '<name>' END"
)


def _windows_sql(source: str, key: str, size: str) -> str:
    lit = _lit_sql("ws[j]")
    return f"""{source}_w AS (SELECT {key}, coalesce(list_filter(string_split_regex(text, '[\\x20\\x09-\\x0D]+'), lambda x: x <> ''), []) AS a FROM {source}),
{source}_e AS (SELECT {key}, a, s.size, unnest(range(1, len(a) - s.size + 2)) AS st FROM {source}_w, LATERAL ({size}) s WHERE len(a) >= s.size),
{source}_s AS (SELECT DISTINCT {key}, st, size, a[st:st+size-1] AS ws FROM {source}_e),
{source}_t AS (SELECT {key}, st, size, list_transform(range(1, size + 1), lambda j: coalesce({_KIND}, {lit})) AS t,
  list_transform(list_filter(range(1, size + 1), lambda j: ({_KIND}) IS NOT NULL), lambda j: {lit}) AS slots FROM {source}_s)"""


ORACLE = f"""
WITH {_windows_sql("benchmark", "item_id", f"SELECT CAST(least({SIZE}, len(a)) AS BIGINT) AS size WHERE len(a) > 0")},
sizes AS (SELECT DISTINCT size FROM benchmark_t),
{_windows_sql("documents", "doc_id", "SELECT size FROM sizes")},
b AS (SELECT item_id, size, array_to_string(t, ' ') AS template, slots FROM benchmark_t
  WHERE len(list_filter(t, lambda x: x[1] <> '<' AND x <> '')) >= ceil(size * {LITERAL})),
m AS (SELECT d.doc_id, b.item_id, d.st - 1 AS start, max(d.slots = b.slots) AS same
  FROM documents_t d JOIN b ON b.size = d.size AND b.template = array_to_string(d.t, ' ')
  WHERE len(list_distinct(list_zip(b.slots, d.slots))) = len(list_distinct(b.slots)) AND len(list_distinct(list_zip(b.slots, d.slots))) = len(list_distinct(d.slots))
  GROUP BY ALL)
SELECT doc_id, item_id, count(*) AS n_windows, count(*) FILTER (same) AS n_exact, CAST(min(start) AS BIGINT) AS first_word FROM m GROUP BY doc_id, item_id
"""

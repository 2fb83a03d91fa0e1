"""What is written where: names and paths of split files, retention, folder statistics, groups of pages."""

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..config import SHIPPED, HeaderConfig
from ..functions.text import safe_name


def file_name(header: Column, start: Column, end: Column, original: Column, index: Column, cfg: HeaderConfig = SHIPPED) -> Column:
    """The name pattern filled in, with its ending; start and end are counted from 1."""
    values = {"{header}": safe_name(header, cfg), "{start}": start.cast("string"), "{end}": end.cast("string"), "{original}": original, "{index}": index.cast("string")}
    name = F.lit(cfg.name_pattern)
    for mark, value in values.items():
        name = F.replace(name, F.lit(mark), value)
    return F.when(name.endswith(".pdf"), name).otherwise(F.concat(name, F.lit(".pdf")))


def split_manifest(groups: DataFrame, documents: DataFrame, keys: list[str], original: str, cfg: HeaderConfig = SHIPPED) -> DataFrame:
    """groups: keys, start_page, end_page, header; documents: keys, total_pages and original. A row for each file to write.

    At most one group: the whole document in one file, UNKNOWN without any. A name's second and later uses get _02, _03 and so on.
    """
    doc = Window.partitionBy(*keys)
    g = groups.withColumns({"n": F.count("*").over(doc), "idx": F.row_number().over(doc.orderBy("start_page"))})
    whole = documents.join(g.where("n = 1").select(*keys, "header"), keys, "left").join(g.where("n > 1").select(*keys).distinct(), keys, "left_anti")
    total = F.col("total_pages").cast("long")
    whole = whole.select(*keys, F.col(original).alias("original"), F.lit(1).alias("idx"), F.lit(0).cast("long").alias("start_page"), (total - 1).alias("end_page"), F.coalesce("header", F.lit("UNKNOWN")).alias("header"))
    many = g.where("n > 1").join(documents, keys).select(*keys, F.col(original).alias("original"), "idx", F.col("start_page").cast("long"), F.col("end_page").cast("long"), "header")
    rows = whole.unionByName(many).withColumn("safe", safe_name(F.col("header"), cfg))
    name = file_name(F.col("header"), F.col("start_page") + 1, F.col("end_page") + 1, F.col("original"), F.col("idx"), cfg)
    rows = rows.withColumns({"name": name, "use": F.row_number().over(Window.partitionBy(*keys, "safe").orderBy("idx"))})
    suffixed = F.concat(F.regexp_replace("name", "\\.pdf$", ""), F.lit("_"), F.lpad(F.col("use").cast("string"), 2, "0"), F.lit(".pdf"))
    return rows.withColumn("file_name", F.when(F.col("use") > 1, suffixed).otherwise(F.col("name"))).drop("safe", "name", "use")


def dated_path(base: str, day: Column, name: Column) -> Column:
    return F.concat(F.lit(base), F.date_format(day, "/yyyy/yyyy-MM-dd/"), name)


def unique_paths(wanted: DataFrame, existing: DataFrame, path: str = "path", order: str = "id") -> DataFrame:
    """A free path for each wanted one: as it is, or with the first free _1, _2 ... before its ending.

    existing: path. Wanted paths that are equal follow each other in order.
    """
    stem, end = F.regexp_extract(path, "^(.*?)(_[0-9]+)?(\\.[^./]*)?$", 1), F.regexp_extract(path, "(\\.[^./]*)?$", 0)
    whole = F.regexp_extract(path, "^(.*?)(\\.[^./]*)?$", 1)
    want = wanted.withColumns({"_stem": whole, "_end": end}).withColumn("_n", F.row_number().over(Window.partitionBy(path).orderBy(order)))
    taken = existing.select(
        F.explode(F.array(F.struct(whole.alias("_stem"), F.lit(0).alias("_no")), F.struct(stem.alias("_stem"), F.try_to_number(F.regexp_extract(path, "_([0-9]{1,9})(\\.[^./]*)?$", 1), F.lit("999999999")).cast("int").alias("_no")))).alias("x"), end.alias("_end")
    ).select("x._stem", "x._no", "_end").where("_no is not null").groupBy("_stem", "_end").agg(F.array_sort(F.collect_set("_no")).alias("_taken"))
    both = want.join(taken, ["_stem", "_end"], "left")
    # below the j-th (from 0) taken number t there are t - j free ones, so it is passed where these do not reach the one looked for
    passed = F.filter(F.coalesce("_taken", F.array().cast("array<int>")), lambda t, j: t - j < F.col("_n"))
    number = F.col("_n") - 1 + F.size(passed)
    return both.withColumn("unique_path", F.concat("_stem", F.when(number == 0, "").otherwise(F.concat(F.lit("_"), number.cast("string"))), "_end")).drop("_stem", "_end", "_n", "_taken")


def retention_victims(folders: DataFrame, today: Column, days: int) -> DataFrame:
    """folders: day, and others. Those older than the retention; none if it is 0 or less."""
    return folders.where(F.col("day") < F.date_sub(today, days)) if days > 0 else folders.limit(0)


def folder_stats(files: DataFrame) -> DataFrame:
    """files: day (date), bytes. One row a year and a total (year null): folders, files, bytes, megabytes, oldest and newest day."""
    sums = [F.count_distinct("day").alias("folders"), F.count("*").alias("files"), F.sum("bytes").alias("bytes"), F.min("day").alias("oldest"), F.max("day").alias("newest")]
    by_year = files.groupBy(F.year("day").alias("year")).agg(*sums)
    both = by_year.unionByName(files.agg(*sums).withColumn("year", F.lit(None).cast("int")))
    return both.withColumn("megabytes", F.bround(F.col("bytes") / 1048576, 2))


def label_records(records: DataFrame, groups: DataFrame, keys: list[str]) -> DataFrame:
    """records: keys, page_number (from 1). Adds the header and file of the group whose pages hold the record; ranges do not overlap."""
    g = groups.select(*[F.col(k).alias(f"_{k}") for k in keys], "start_page", "end_page", F.col("header").alias("split_group"), "file_name")
    on = (F.col("page_number") - 1).between(F.col("start_page"), F.col("end_page"))
    for k in keys:
        on = on & (F.col(k) == F.col(f"_{k}"))
    return records.join(g, on, "left").drop("start_page", "end_page", *[f"_{k}" for k in keys])


def unseen(files: DataFrame, seen: DataFrame, keys: list[str]) -> DataFrame:
    return files.join(seen, keys, "left_anti")

"""How well a normalised header fits the expected shape."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..config import SHIPPED, HeaderConfig
from .text import digits_of, lead_of, let, normalize, parts, serial_of


def valid_serial(serial: Column, cfg: HeaderConfig = SHIPPED) -> Column:
    return serial.rlike(cfg.serial_regex())


def strict(header: Column, cfg: HeaderConfig = SHIPPED) -> Column:
    """Three parts or more, the last a valid serial."""
    return (F.size(parts(header)) >= cfg.short_parts) & valid_serial(serial_of(header), cfg)


def _part(header: Column, i: int) -> Column:
    return F.coalesce(F.get(parts(header), F.lit(i)), F.lit(""))


def _between(c: Column, low_high: tuple[int, int], kind: str) -> Column:
    return c.rlike(f"^[{kind}]{{{low_high[0]},{low_high[1]}}}$")


ALPHA, ALNUM = "A-Z", "A-Z0-9"


def structure(header: Column, cfg: HeaderConfig = SHIPPED) -> Column:
    """Points for the parts of a header of four or of three parts."""
    p0, p1, p2, last = _part(header, 0), _part(header, 1), _part(header, 2), serial_of(header)
    digits = F.length(digits_of(last)) >= cfg.least_digits
    prefix, brief = _between(p0, (cfg.prefix_length,) * 2, ALPHA), _between(p0, (1, 2), ALNUM)
    serial = valid_serial(last, cfg)
    four = (
        F.lit(20) + F.when(prefix, 15).when(brief, 8).otherwise(0)
        + F.when(_between(p1, cfg.country, ALPHA), 12).when(_between(p1, (1, 6), ALNUM), 4).otherwise(0)
        + F.when(_between(p2, cfg.code, ALNUM), 15).when(_between(p2, (1, 8), ALNUM), 6).otherwise(0)
        + F.when(serial, 35).when(digits, 4).otherwise(0)
    )
    three = F.lit(10) + F.when(prefix, 10).when(brief, 6).otherwise(0) + F.when(_between(p1, (1, 8), ALNUM), 15).otherwise(0) + F.when(serial, 25).when(digits, 4).otherwise(0)
    n = F.size(parts(header))
    return F.when(n == cfg.full_parts, four).when(n == cfg.short_parts, three).otherwise(0)


def score(header: Column, cfg: HeaderConfig = SHIPPED) -> Column:
    """0 for an empty header; without a valid serial never above the cap."""
    return let(header, lambda h: _score(h, cfg))


def _score(header: Column, cfg: HeaderConfig) -> Column:
    n = F.size(parts(header))
    points = F.lit(25) + F.when(n >= cfg.short_parts, 20).otherwise(0) + F.when(header.rlike(cfg.pattern), 60).otherwise(0) + structure(header, cfg)
    capped = F.when(valid_serial(serial_of(header), cfg), points).otherwise(F.least(points, F.lit(cfg.weak_cap)))
    return F.when(header == "", 0).otherwise(capped).cast("int")


def fitness(header: Column, cfg: HeaderConfig = SHIPPED) -> Column:
    """0 to 100: how well the parts have the expected shapes, whatever the pattern says."""
    return let(header, lambda h: _fitness(h, cfg))


def _fitness(header: Column, cfg: HeaderConfig) -> Column:
    p0, p1, p2, last = _part(header, 0), _part(header, 1), _part(header, 2), serial_of(header)
    prefix = F.when(_between(p0, (cfg.prefix_length,) * 2, ALPHA), 20).when(p0 != "", 6).otherwise(0)
    serial = F.when(valid_serial(last, cfg), 25).otherwise(0)
    over = cfg.country[1] + 1
    country = F.when(_between(p1, cfg.country, ALPHA), 30).when(_between(p1, (over, over), ALPHA), 6).when(p1 != "", 4).otherwise(0)
    code = F.when(_between(p2, cfg.code, ALNUM), 25).when(p2 != "", 6).otherwise(0)
    middle = F.when(_between(p1, (1, max(cfg.code[1], cfg.country[1] + 2)), ALNUM), 25).when(p1 != "", 6).otherwise(0)
    n = F.size(parts(header))
    return F.when(header == "", 0).when(n == cfg.full_parts, prefix + country + code + serial).when(n == cfg.short_parts, prefix + middle + serial).otherwise(0).cast("int")


def suspicious(header: Column, cfg: HeaderConfig = SHIPPED) -> Column:
    """Four parts with a country longer than any."""
    return (F.size(parts(header)) == cfg.full_parts) & (F.length(_part(header, 1)) > cfg.country[1])


def short_code(header: Column, cfg: HeaderConfig = SHIPPED) -> Column:
    """A code that may have lost a character."""
    n, p1, p2 = F.size(parts(header)), _part(header, 1), _part(header, 2)
    four = (F.length(p2) == cfg.code[0]) | p2.rlike("^[0-9].{0,2}$")
    return F.when(header == "", False).when(n == 4, four).when(n == 3, F.length(p1) <= 2).otherwise(False)


def status(header: Column, points: Column) -> Column:
    """Empty: error; from 130 points: success; else low_confidence."""
    return F.when(header == "", "error").when(points >= 130, "success").otherwise("low_confidence")


def with_header_fields(df: DataFrame, column: str = "header", cfg: HeaderConfig = SHIPPED) -> DataFrame:
    """Adds norm, then n_parts, lead, serial, strict, score and fitness of it."""
    norm = F.col("norm")
    df = df.withColumn("norm", normalize(F.col(column), cfg))
    return df.withColumns({
        "n_parts": F.size(parts(norm)), "lead": lead_of(norm), "serial": serial_of(norm),
        "strict": strict(norm, cfg), "score": score(norm, cfg), "fitness": fitness(norm, cfg),
    })

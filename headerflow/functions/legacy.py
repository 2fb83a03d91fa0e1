"""Rules of the older extractor: structural fixes, two scores, serials, header quality."""

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..config import SHIPPED, HeaderConfig
from .text import digits_of, lead_of, let, parts, safe_name, serial_of

ALNUM = "[^A-Za-z0-9]"
#: Prefixes read double, and codes known to be good.
DOUBLE = {"BL": "B", "RB": "B", "PL": "P"}
KNOWN = ["WFE", "WFH", "GTX", "5U5", "W1A"]


def corrections(text: Column) -> Column:
    """Outer dashes, doubled prefix letters and an 8 for the S of a serial."""

    def no_dash(t):
        bare = F.regexp_replace(t, "^-+", "")
        return F.when(t.startswith("-") & (F.size(parts(bare)) >= 3) & bare.rlike("^[A-Za-z]{1,2}-"), bare).otherwise(t)

    def one_letter(t):
        first = F.upper(F.get(parts(t), F.lit(0)))
        fixed = F.lit(None).cast("string")
        for double, letter in DOUBLE.items():
            fixed = F.when(first == double, letter).otherwise(fixed)
        return F.when((F.size(parts(t)) >= 3) & fixed.isNotNull(), F.concat(fixed, F.substr(t, F.length(first) + 1))).otherwise(t)

    def serial_letter(t):
        serial = serial_of(t)
        return F.when((F.size(parts(t)) >= 3) & serial.rlike("^8[0-9]{7,}$"), F.concat(lead_of(t), F.lit("S"), F.substr(serial, F.lit(2)))).otherwise(t)

    t = F.rtrim(F.regexp_replace(text, "-+$", ""))
    for step in (no_dash, one_letter, serial_letter):
        t = let(t, step)
    return t


def pattern_score(text: Column, cfg: HeaderConfig = SHIPPED) -> Column:
    """-1 to 290 for a corrected text, by the shape of each part."""
    return let(text, lambda t: _pattern_score(t, cfg))


def _pattern_score(text: Column, cfg: HeaderConfig) -> Column:
    p = parts(text)
    part = lambda i: F.coalesce(F.get(p, F.lit(i)), F.lit(""))
    good = lambda cond, yes: F.when(cond, yes).otherwise(-20)
    n = F.size(p)
    letters = lambda low, high: f"^[A-Za-z]{{{low},{high}}}$"
    four = F.lit(60) + good(part(0).rlike(letters(cfg.prefix_length, cfg.prefix_length)), 30) + good(part(1).rlike(letters(*cfg.country)), 30) + good(part(2).rlike(f"^[A-Za-z0-9]{{{cfg.code[0]},{cfg.code[1]}}}$"), 30)
    three = F.lit(40) + good(part(0).rlike(letters(1, 2)), 20) + good(part(1).rlike("^[A-Za-z0-9]{2,5}$"), 20)
    low, high = cfg.serial
    letters_ = "".join(cfg.serial_prefixes)

    def shortened(clean):
        taken = F.regexp_extract(clean, f"(?i)^[{letters_}][0-9]+", 0)
        return F.when((F.length(clean) > high) & F.length(taken).between(low, high), taken).otherwise(clean)

    def points(s):
        raw, clean = s["raw"], s["clean"]
        ideal = F.when(F.length(clean).isin(8, 9), 20).otherwise(0)
        inside = F.lit(40) + F.when(clean.rlike(f"(?i)^[{letters_}]"), F.lit(30) + F.when(clean.rlike("^.[0-9]+$"), F.lit(50) + ideal).otherwise(-40)).otherwise(-40)
        return F.when(F.length(clean).between(low, high), inside - F.when(raw != clean, (F.length(raw) - F.length(clean)) * 15).otherwise(0)).otherwise(-30)

    serial = let(F.trim(serial_of(text)), lambda r: let(F.struct(r.alias("raw"), let(F.regexp_replace(r, ALNUM, ""), shortened).alias("clean")), points))
    total = F.greatest(F.when(n == 4, four).otherwise(three) + serial, F.lit(-1))
    return F.when(n.between(cfg.short_parts, cfg.full_parts), total).otherwise(-1).cast("int")


def count_score(text: Column, cfg: HeaderConfig = SHIPPED) -> Column:
    """The oldest score: counts of digits and letters in the last of four parts; -1 for less than 10 characters."""
    last = serial_of(text)
    digits, letters = F.length(digits_of(last)), F.length(F.regexp_replace(last, "[^A-Za-z]", ""))
    by_digits = F.when(digits == cfg.usual_digits, 100).when(digits == cfg.usual_digits - 1, 50).when(digits >= cfg.least_digits, 20).otherwise(0)
    perfect = F.when(last.rlike(f"^[A-Za-z][0-9]{{{cfg.usual_digits}}}$"), 50).otherwise(0)
    long_ = F.lit(10) + by_digits + perfect - F.when(letters > 1, (letters - 1) * 30).otherwise(0)
    shape = F.when(F.size(parts(text)) == cfg.full_parts, F.lit(50) + F.when(F.length(last) >= 8, long_).otherwise(0)).otherwise(0)
    total = shape + F.when(F.length(digits_of(text)) >= cfg.usual_digits, 20).otherwise(0)
    return F.when(F.length(F.coalesce(text, F.lit(""))) < 10, -1).otherwise(total).cast("int")


def score(text: Column, cfg: HeaderConfig = SHIPPED) -> Column:
    """-1 for less than 10 characters, else the pattern score of the corrected text."""
    return F.when(F.length(F.coalesce(text, F.lit(""))) < 10, -1).otherwise(pattern_score(corrections(text), cfg))


def clean_serial(text: Column, cfg: HeaderConfig = SHIPPED) -> Column:
    """Four parts whose serial is too long: its letter and first 6 to 8 digits."""
    clean = F.regexp_replace(F.trim(serial_of(text)), ALNUM, "")
    taken = F.regexp_extract(clean, f"(?i)^[{''.join(cfg.serial_prefixes)}][0-9]{{6,8}}", 0)
    return F.when((F.size(parts(text)) == cfg.full_parts) & (F.length(clean) > cfg.serial[1]) & (taken != ""), F.concat(lead_of(text), taken)).otherwise(text)


def serial_number(text: Column, cfg: HeaderConfig = SHIPPED) -> Column:
    """Letters and digits of the last part of three or more; null without any."""
    clean = F.regexp_replace(F.trim(serial_of(text)), ALNUM, "")
    return F.when((F.size(parts(text)) >= cfg.short_parts) & (clean != ""), clean)


def quality(text: Column, cfg: HeaderConfig = SHIPPED) -> Column:
    """How much a header looks right; 0 for an empty one."""
    p, n = parts(text), F.size(parts(text))
    part = lambda i: F.coalesce(F.get(p, F.lit(i)), F.lit(""))
    give = lambda cond, x: F.when(cond, x).otherwise(0)
    code = part(2)
    by_code = F.when(code.isin(KNOWN), 30).when(code.rlike("^[A-Za-z0-9]{3}$"), 15).when(code.contains("EE") | code.contains("EFE"), -10).when(F.length(code) > 4, -20).otherwise(0)
    raw = F.trim(serial_of(text))
    clean = F.regexp_replace(raw, ALNUM, "")
    serial = give(clean.rlike("(?i)^[SR]"), 15) + give(clean.rlike("^.[0-9]+$"), 20) + give(F.length(clean).between(8, 9), 10) - give(raw.contains(" "), 15)
    points = (
        give(part(0).rlike("^[A-Za-z]$"), 10) + give(part(1).rlike("^[A-Za-z]{1,2}$"), 10) + F.when(n == 4, by_code).otherwise(0)
        + F.when(clean != "", serial).otherwise(0) - give(text.startswith("-") | text.startswith("BL-"), 30)
    )
    base = F.when(n.between(cfg.short_parts, cfg.full_parts), 20).otherwise(-50)
    return F.when(F.coalesce(text, F.lit("")) == "", 0).when(n < 2, base).otherwise(base + points).cast("int")


def file_name(text: Column, original: Column) -> Column:
    """As safe_name, but the original name where there is no text."""
    return F.when(F.coalesce(text, F.lit("")) == "", F.coalesce(original, F.lit("unnamed"))).otherwise(safe_name(text))


def header_key(text: Column) -> Column:
    return F.replace(F.upper(text), F.lit(" "), F.lit(""))

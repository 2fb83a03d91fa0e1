"""Header text as columns: normal form, parts, confusable characters, file names."""

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..config import SHIPPED, HeaderConfig, both_ways, canonical, one_way


def let(value: Column, body) -> Column:
    """body(value), with value evaluated once however often body names it: plans of nested rules stay small."""
    return F.get(F.transform(F.array(value), lambda v: body(v)), F.lit(0))


def _translate(c: Column, mapping: dict[str, str]) -> Column:
    return F.translate(c, "".join(mapping), "".join(mapping.values())) if mapping else c


def normalize_serial(serial: Column, cfg: HeaderConfig = SHIPPED) -> Column:
    """Confusable letters become digits, but for the first character."""
    return F.concat(F.substring(serial, 1, 1), _translate(F.substr(serial, F.lit(2)), one_way(cfg.confusable)))


def repair_first_separator(text: Column) -> Column:
    """ABCD-X-Y: the first letter was a part of its own."""
    lost = (F.size(F.split(text, "-")) == 3) & text.rlike("^[A-Z][A-Z0-9]{3,}-")
    return F.when(lost, F.concat(F.substring(text, 1, 1), F.lit("-"), F.substr(text, F.lit(2)))).otherwise(text)


def normalize(text: Column, cfg: HeaderConfig = SHIPPED) -> Column:
    """Upper case, allowed characters only, single inner separators, repaired first block, digits in the serial. Null as empty."""
    bare = F.regexp_replace(F.upper(F.coalesce(text, F.lit(""))), "[^A-Z0-9-]", "")
    bare = F.regexp_replace(F.regexp_replace(bare, "-+", "-"), "^-|-$", "")
    whole = lambda b: F.concat(F.regexp_extract(b, "^(.*-)?[^-]*$", 1), normalize_serial(F.substring_index(b, "-", -1), cfg))
    return let(let(bare, repair_first_separator), whole)


def parts(header: Column) -> Column:
    return F.split(header, "-")


def serial_of(header: Column) -> Column:
    return F.substring_index(header, "-", -1)


def lead_of(header: Column) -> Column:
    """All parts but the serial, with the separator."""
    return F.regexp_extract(header, "^(.*-)?[^-]*$", 1)


def code_index(header: Column, cfg: HeaderConfig = SHIPPED) -> Column:
    """Place of the code among the parts: 2 of four, 1 of three, else null."""
    n = F.size(parts(header))
    return F.when(n == cfg.full_parts, 2).when(n == cfg.short_parts, 1)


def code_of(header: Column, cfg: HeaderConfig = SHIPPED) -> Column:
    return F.get(parts(header), code_index(header, cfg))


def with_code(header: Column, code: Column, cfg: HeaderConfig = SHIPPED) -> Column:
    """The header with another code; unchanged where it has no code."""

    def changed(both):
        at, p = code_index(both["h"], cfg), parts(both["h"])
        new = F.array_join(F.transform(p, lambda x, i: F.when(i == at, both["c"]).otherwise(x)), "-")
        return F.when(at.isNull() | both["c"].isNull(), both["h"]).otherwise(new)

    return let(F.struct(header.alias("h"), code.alias("c")), changed)


def code_anchor(header: Column, cfg: HeaderConfig = SHIPPED) -> Column:
    """What headers that differ in the code alone share; null without a code."""

    def rest(h):
        at = code_index(h, cfg)
        others = F.filter(parts(h), lambda p, i: i != at)
        return F.when(at.isNotNull(), F.concat_ws("-", F.size(parts(h)).cast("string"), F.array_join(others, "-")))

    return let(header, rest)


def segment_offsets(header: Column) -> Column:
    """Start (from 0) and end (exclusive) of each part."""
    sizes = F.transform(parts(header), F.length)
    starts = F.transform(sizes, lambda n, i: F.aggregate(F.slice(sizes, F.lit(1), i), F.lit(0), lambda a, x: a + x + 1))
    return F.transform(starts, lambda s, i: F.struct(s.alias("start"), (s + F.get(sizes, i)).alias("end")))


def single_variants(text: Column, pairs: dict[str, str]) -> Column:
    """The text with one confusable character exchanged, by place; a leading digit never becomes a letter."""
    table = F.create_map(*[F.lit(x) for kv in pairs.items() for x in kv])
    chars = F.filter(F.split(text, ""), lambda c: c != "")

    def exchanged(c, i):
        other = F.try_element_at(table, c)
        barred = (i == 0) & c.rlike("[0-9]") & other.rlike("[A-Z]")
        return F.when(other.isNotNull() & ~F.coalesce(barred, F.lit(False)), F.concat(F.substr(text, F.lit(1), i), other, F.substr(text, i + 2)))

    return F.array_distinct(F.array_compact(F.transform(chars, exchanged)))


def ambiguity(header: Column, cfg: HeaderConfig = SHIPPED) -> Column:
    """For a normalised header: code, alternative codes and headers, and a note that says why there are none."""
    pairs = both_ways(cfg.code_pairs)
    told = lambda h, code: let(F.struct(h.alias("h"), code.alias("c"), single_variants(code, pairs).alias("v")), lambda x: _ambiguity(x["h"], x["c"], x["v"], pairs, cfg))
    return let(header, lambda h: told(h, code_of(h, cfg)))


def _ambiguity(header: Column, code: Column, codes: Column, pairs: dict, cfg: HeaderConfig) -> Column:
    mixed = code.rlike("[A-Z]") & code.rlike("[0-9]")
    alike = "".join(a for a, b in pairs.items() if a.isalpha() == b.isalpha())
    same_kind = code.rlike(f"[{alike}]") if alike else F.lit(False)
    note = (
        F.when(header == "", "empty_normalized").when(code.isNull(), "unsupported_format").when(code == "", "empty_code")
        .when(F.size(codes) == 0, "no_variant").when(~mixed & ~same_kind, "not_mixed_alnum").otherwise("code_confusable_ambiguous")
    )
    yes = note == "code_confusable_ambiguous"
    none = F.array().cast("array<string>")
    return F.struct(
        yes.alias("is_ambiguous"), F.coalesce(code, F.lit("")).alias("code"), F.when(yes, codes).otherwise(none).alias("codes"),
        F.when(yes, F.transform(codes, lambda c: with_code(header, c, cfg))).otherwise(none).alias("headers"), note.alias("note"),
    )


def ambiguity_flag(info: Column) -> Column:
    """code_ambiguity:CODE->first|three|alternatives, or empty."""
    flag = lambda i: F.when(i["is_ambiguous"], F.concat(F.lit("code_ambiguity:"), i["code"], F.lit("->"), F.array_join(F.slice(i["codes"], 1, 3), "|"))).otherwise("")
    return let(info, flag)


def add_flag(flags: Column, new: Column) -> Column:
    """Semicolon-separated flags with one more, each trimmed; not twice."""
    clean = F.filter(F.transform(F.split(F.coalesce(flags, F.lit("")), ";"), lambda x: F.trim(x)), lambda x: x != "")
    new = F.trim(F.coalesce(new, F.lit("")))
    added = F.when(F.array_contains(clean, new), clean).otherwise(F.concat(clean, F.array(new)))
    return F.when(new == "", F.coalesce(flags, F.lit(""))).otherwise(F.array_join(added, ";"))


def for_alignment(text: Column, cfg: HeaderConfig = SHIPPED) -> Column:
    """Upper case with one character for each confusable pair."""
    return _translate(F.upper(text), canonical(cfg.box_pairs))


def longest_digits(text: Column) -> Column:
    """The first of the longest digit runs, or empty."""
    runs = F.regexp_extract_all(text, F.lit("[0-9]+"), F.lit(0))
    return F.aggregate(runs, F.lit(""), lambda best, x: F.when(F.length(x) > F.length(best), x).otherwise(best))


def digits_of(text: Column) -> Column:
    return F.regexp_replace(text, "[^0-9]", "")


def safe_name(text: Column, cfg: HeaderConfig = SHIPPED) -> Column:
    """A file name: letters, digits, underscore, ASCII white space; runs of separators become one; cut and trimmed; never empty."""
    kept = F.regexp_replace(F.coalesce(text, F.lit("")), "[^\\p{L}\\p{N}_ \\t\\n\\f\\r-]", "")
    kept = F.substr(F.regexp_replace(F.replace(kept, F.lit(" "), F.lit("_")), "[_-]+", "_"), F.lit(1), F.lit(cfg.name_length))
    kept = F.regexp_replace(kept, "^[_-]+|[_-]+\\z", "")  # $ would also match before a last line feed
    return F.when(kept == "", "unnamed").otherwise(kept)


def pattern_correction(text: Column, cfg: HeaderConfig = SHIPPED) -> Column:
    """Letters that look like digits, in the serial of a header of four parts or more."""
    serial = serial_of(text)
    letter = serial.rlike("^\\p{L}")
    head = F.when(letter, F.substring(serial, 1, 1)).otherwise("")
    rest = F.when(letter, F.substr(serial, F.lit(2))).otherwise(serial)
    fixed = F.concat(lead_of(text), head, F.translate(rest, "OolIZ", "00112"))
    return F.when((F.size(parts(text)) >= cfg.full_parts) & (F.length(serial) > 1), fixed).otherwise(text)


def invalid_characters(text: Column) -> Column:
    """Characters outside the whitelist, each once, in order."""
    return F.array_sort(F.array_distinct(F.filter(F.split(text, ""), lambda c: c.rlike("[^A-Z0-9-]"))))

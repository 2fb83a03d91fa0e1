"""Settings of the engine: what a header looks like, when texts match, how recognition and reports behave."""

import configparser
from dataclasses import dataclass, fields, replace


def pair_list(spec: str) -> list[tuple[str, str]]:
    """'A:B,C:D' as pairs of single upper-case characters; malformed entries are skipped."""
    out = []
    for entry in (spec or "").split(","):
        left, colon, right = (x.strip().upper() for x in entry.partition(":"))
        if colon and len(left) == len(right) == 1:
            out.append((left, right))
    return out


def one_way(spec: str) -> dict[str, str]:
    return dict(pair_list(spec))


def both_ways(spec: str) -> dict[str, str]:
    return {k: v for a, b in pair_list(spec) for k, v in ((a, b), (b, a))}


def canonical(spec: str) -> dict[str, str]:
    """Both characters of a pair stand for its second one."""
    return {k: b for a, b in pair_list(spec) for k in (a, b)}


def merged(first: str, second: str) -> str:
    """Pairs of both lists, each once, in order."""
    return ",".join(dict.fromkeys(f"{a}:{b}" for spec in (first, second) for a, b in pair_list(spec)))


@dataclass(frozen=True)
class HeaderConfig:
    """The defaults of a fresh installation; SHIPPED has the values of the configuration file that goes with it."""

    # region of the header, in percent of the page
    top: float = 0.0
    left: float = 0.0
    width: float = 100.0
    height: float = 15.0
    pages: tuple[int, ...] = (1,)
    # shape of a header
    separator: str = "-"
    full_parts: int = 4
    short_parts: int = 3
    prefix_length: int = 1
    country: tuple[int, int] = (1, 2)
    code: tuple[int, int] = (2, 4)
    serial: tuple[int, int] = (7, 10)
    serial_prefixes: tuple[str, ...] = ("S", "R")
    usual_digits: int = 8
    least_digits: int = 6
    exact_digits: int = 8
    pattern: str = "^[A-Z](?:-[A-Z0-9]{1,8}){1,2}-[SR][0-9]{7,8}$"
    weak_cap: int = 89
    confusable: str = "S:5,B:8,P:F,O:0,I:1,Z:2"
    code_pairs: str = "O:0,I:L"
    box_pairs: str = "O:0,S:5,F:E,I:L"
    # matching and splitting
    similarity: float = 1.0
    serial_similarity: float = 0.85
    strict_similarity: float = 0.93
    least_pages: int = 1
    name_pattern: str = "{header}_pages_{start}-{end}"
    name_length: int = 100
    # recognition
    first_scale: float = 2.0
    last_scale: float = 6.0
    good_score: int = 70
    great_score: int = 90
    attempts: int = 8
    confirmations: int = 2
    confidence: float = 85.0
    glyph_support: int = 1
    zero_width_ratio: float = 1.12
    # sinks
    retention_days: int = 90
    breaker_failures: int = 5
    breaker_seconds: int = 60

    def __post_init__(self):
        for name in ("top", "width"):
            if not 0 <= getattr(self, name) <= 100:
                raise ValueError(f"{name} must be a percentage, got {getattr(self, name)}")
        if self.first_scale > self.last_scale:
            raise ValueError("the first scale is larger than the last")
        if any(p < 1 for p in self.pages):
            raise ValueError("pages are counted from 1")

    def serial_regex(self) -> str:
        """A strict serial: an allowed letter and digits, within the limits on digits and on length."""
        low = max(self.least_digits, self.serial[0] - 1)
        high = min(self.exact_digits or self.usual_digits + 2, self.serial[1] - 1)
        low = max(low, self.exact_digits)
        return f"^[{''.join(self.serial_prefixes)}][0-9]{{{low},{high}}}$" if low <= high else "^(?!)$"


SHIPPED = HeaderConfig(
    top=2, left=12, width=45, height=6, pages=(), serial=(7, 9), exact_digits=0, attempts=12, similarity=0.85, least_pages=0,
    name_pattern="{header}", retention_days=0, confidence=82.0,
)

#: Keys of a configuration file and the settings they give.
KEYS = {
    "header_area_top": "top", "header_area_left": "left", "header_area_width": "width", "header_area_height": "height",
    "expected_separator": "separator", "expected_parts": "full_parts", "min_expected_parts": "short_parts",
    "pattern_prefix_length": "prefix_length", "expected_digit_count": "usual_digits", "min_digit_count": "least_digits",
    "serial_digits_exact": "exact_digits", "header_pattern": "pattern", "invalid_serial_score_cap": "weak_cap",
    "ambiguous_characters": "confusable", "code_ambiguity_pairs": "code_pairs", "code_box_alignment_ambiguity_pairs": "box_pairs",
    "header_similarity_threshold": "similarity", "serial_close_match_threshold": "serial_similarity",
    "min_pages_per_split": "least_pages", "split_naming_pattern": "name_pattern", "max_filename_length": "name_length",
    "initial_render_scale": "first_scale", "max_render_scale": "last_scale", "score_threshold_for_escalation": "good_score",
    "early_exit_score": "great_score", "max_ocr_attempts": "attempts", "ocr_method_early_exit_min_confirmations": "confirmations",
    "tesseract_confidence_threshold": "confidence", "code_anchor_harmonize_min_glyph_support": "glyph_support",
    "code_zero_to_o_width_ratio": "zero_width_ratio", "output_retention_days": "retention_days", "circuit_breaker_threshold": "breaker_failures",
}
RANGES = {"country": "pattern_country", "code": "pattern_code", "serial": "pattern_serial"}


def load(path: str, base: HeaderConfig | None = None) -> HeaderConfig:
    """Reads an INI file's [Settings]; a key that is missing keeps its default."""
    parser = configparser.ConfigParser(interpolation=None)
    with open(path, encoding="utf-8") as f:
        parser.read_file(f)
    got, base = parser["Settings"], base or HeaderConfig()
    kinds = {f.name: type(getattr(base, f.name)) for f in fields(base)}
    new: dict = {ours: kinds[ours](got[key]) for key, ours in KEYS.items() if key in got}
    for ours, key in RANGES.items():
        low, high = getattr(base, ours)
        new[ours] = (got.getint(f"{key}_min", fallback=low), got.getint(f"{key}_max", fallback=high))
    if "pattern_serial_allowed_prefixes" in got:
        new["serial_prefixes"] = tuple(x.strip().upper() for x in got["pattern_serial_allowed_prefixes"].split(",") if x.strip())
    if "pages_to_read" in got:
        new["pages"] = () if got["pages_to_read"].strip().lower() == "all" else tuple(int(x) for x in got["pages_to_read"].split(","))
    return replace(base, **new)

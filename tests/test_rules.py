"""Known values of the header rules."""

from dataclasses import replace

import pytest
from pyspark.sql import functions as F

from headerflow.config import SHIPPED, HeaderConfig, both_ways, canonical, load, merged, one_way
from headerflow.functions import legacy as L
from headerflow.functions import score as S
from headerflow.functions import similarity as M
from headerflow.functions import text as T
from headerflow.operators import manifest, propagate, recognise, segment, state, vote

SCORES = [
    ("B-HK-WFE-S17975643", "B-HK-WFE-S17975643", 202, True),
    ("b-hk-fi4-s18oo8633", "B-HK-FI4-S18008633", 202, True),
    ("B-WFE-S17975643", "B-WFE-S17975643", 165, True),
    ("A-US-GTX-R123456", "A-US-GTX-R123456", 142, True),
    ("B-CHK-WEE-S17991790", "B-CHK-WEE-S17991790", 194, True),
    ("7 B-HK-DSH-S17979897", "7B-HK-DSH-S17979897", 135, True),
    ("BHK-GO1-S18009353", "BHK-GO1-S18009353", 95, True),
    ("RLWK-RWC-S1R015003", "R-LWK-RWC-S1R015003", 89, False),
    ("B-HK-ZN1-S179780077", "B-HK-ZN1-S179780077", 89, False),
    ("B-HK-ZN1-817976332", "B-HK-ZN1-817976332", 89, False),
    ("B-C-5U5-T4091534", "B-C-5U5-T4091534", 89, False),
    ("B-HK-FL4518008633", "B-HK-FL4518008633", 84, False),
    ("A-B-C-D-S1234567", "A-B-C-D-S1234567", 45, True),
    ("", "", 0, False),
    ("---", "", 0, False),
    (None, "", 0, False),
]


def frame(spark, rows, schema):
    return spark.createDataFrame(rows, schema)


def test_scores(spark):
    got = S.with_header_fields(frame(spark, [(r[0],) for r in SCORES], "header string")).select("header", "norm", "score", "strict").collect()
    assert {tuple(r) for r in got} == set(SCORES)


def test_serials(spark):
    cases = [("S17975643", True), ("R4092533", True), ("R409253380", False), ("S12345", False), ("T4091534", False), ("", False)]
    df = frame(spark, cases, "s string, want boolean")
    assert df.where(S.valid_serial(F.col("s")) != F.col("want")).count() == 0
    exact = HeaderConfig()
    assert [r[0] for r in frame(spark, [("S1234567",), ("S12345678",)], "s string").select(S.valid_serial(F.col("s"), exact)).collect()] == [False, True]


def test_fitness_and_best_header(spark):
    df = S.with_header_fields(frame(spark, [("B-HK-WFE-S17991790",), ("B-CHK-WEE-S17991790",)], "header string"))
    assert {r.header: r.fitness for r in df.collect()} == {"B-HK-WFE-S17991790": 100, "B-CHK-WEE-S17991790": 76}
    groups = [(1, "B-CHK-WEE-S17991790"), (1, "B-HK-WFE-S17991790"), (2, "B-TW-UET-S18010794"), (2, "B-TW-UEI-S18010794")]
    best = vote.best_header(frame(spark, groups, "g int, header string"), ["g"])
    assert {r.g: r.best for r in best.collect()} == {1: "B-HK-WFE-S17991790", 2: "B-TW-UEI-S18010794"}


def test_ambiguity(spark):
    df = frame(spark, [("B-FD-020H-S18020267",), ("B-FD-ABCD-S18020267",), ("B-TW-UEL-S18011737",)], "h string")
    got = {r.h: r.i for r in df.select("h", T.ambiguity(F.col("h")).alias("i")).collect()}
    assert got["B-FD-020H-S18020267"].is_ambiguous and "02OH" in got["B-FD-020H-S18020267"].codes
    assert not got["B-FD-ABCD-S18020267"].is_ambiguous
    assert got["B-TW-UEL-S18011737"].codes == ["UEI"]


@pytest.mark.parametrize("others, least, want, applied", [(["02OH", "02OH"], 1, "02OH", True), (["02OH"], 2, "020H", False)])
def test_support(spark, others, least, want, applied):
    h = "B-FD-{}-S18020267"
    base = frame(spark, [(1, h.format("020H"))], "g int, header string")
    said = frame(spark, [(1, h.format(c)) for c in ["020H", *others]], "g int, text string")
    got = vote.resolve_by_support(base, said, ["g"], least).first()
    assert (got.resolved, got.applied) == (h.format(want), applied)


MATCHES = [
    ("B-E-UUY-R4092558", "B-E-UUY-R4092528", False),
    ("B-HK-ZN1-S179780077", "B-HK-ZN1-S17978007", True),
    ("B-E-UUY-R4092533", "B-E-UUY-R4092533", True),
    ("B-TW-UET-S18010794", "B-TW-UEI-S18010792", False),
    ("B-TW-UET-S18010794", "B-TW-UEI-S18010794", True),
    ("", "B-E-UUY-R4092533", False),
]


@pytest.mark.parametrize("likeness", [M.edit_similarity, M.matching_ratio])
def test_matches(spark, likeness):
    df = frame(spark, MATCHES, "h1 string, h2 string, want boolean")
    one = S.with_header_fields(df.withColumn("header", F.col("h1"))).withColumn("a", F.struct("norm", "n_parts", "lead", "serial", "strict"))
    two = S.with_header_fields(one.select("h1", "h2", "want", "a").withColumn("header", F.col("h2"))).withColumn("b", F.struct("norm", "n_parts", "lead", "serial", "strict"))
    got = two.select("h1", "h2", M.headers_match(F.col("a"), F.col("b"), SHIPPED, likeness).alias("m")).collect()
    want = {(a, b): w for a, b, w in MATCHES}
    if likeness is M.edit_similarity:
        want["B-HK-ZN1-S179780077", "B-HK-ZN1-S17978007"] = True
    assert {(r.h1, r.h2): r.m for r in got} == want


def test_ratio_has_an_order(spark):
    df = frame(spark, [("tide", "diet")], "a string, b string").select(M.matching_ratio(F.col("a"), F.col("b")).alias("x"), M.matching_ratio(F.col("b"), F.col("a")).alias("y"))
    assert tuple(df.first()) == (0.25, 0.5)


def test_alignment(spark):
    pairs = [("B-FD-020H-S18020267", "B-FD-02OH-S18020267"), ("B-FD-SF5-S18020267", "B-FD-5E5-S18020267"), ("B-TW-UEL-S18011737", "B-TW-UEI-S18011737")]
    df = frame(spark, pairs, "a string, b string").select(F.col("a"), M.aligned(T.for_alignment(F.col("a")), T.for_alignment(F.col("b"))).alias("p"))
    for r in df.collect():
        assert len(r.p) >= len(r.a) - 2
        assert 7 in [x.target for x in r.p]


def test_width_rule(spark):
    h = "B-FD-020H-S18020267"
    rows = [(h, {5: 10.0, 7: 13.0}), (h, {5: 10.0, 7: 10.5}), (h, {7: 13.0}), (h, {})]
    got = frame(spark, rows, "h string, w map<int,double>").select(propagate.width_rule(F.col("h"), F.col("w"))).collect()
    assert [r[0] for r in got] == ["B-FD-02OH-S18020267", h, h, h]


def test_suspicious(spark):
    df = frame(spark, [("B-CHK-WEE-S17991790",), ("B-HK-WFE-S17991790",)], "h string").select(S.suspicious(F.col("h")))
    assert [r[0] for r in df.collect()] == [True, False]


def test_method_vote(spark):
    rows = [(1, t, 95.0) for t in ["B-TW-UEL-S18011737", "B-TW-UEI-S18011757", "B-TW-UEI-S18011757"]] + [(1, "", 10.0)]
    got = vote.method_vote(frame(spark, rows, "g int, text string, confidence double"), ["g"]).first()
    assert got.header == "B-TW-UEI-S18011757" and got.freq_ratio == pytest.approx(2 / 3)


def test_early_exit(spark):
    h = "B-TW-UEI-S18011757"
    rows = [(1, 1, h, 95.0), (1, 2, "B-TW-UEL-S18011737", 95.0), (1, 3, h, 95.0), (1, 4, h, 95.0)]
    got = recognise.early_exit(frame(spark, rows, "g int, attempt_no int, text string, confidence double"), ["g"])
    assert sorted((r.attempt_no, r.exits) for r in got.collect()) == [(1, False), (2, False), (3, True)]


def test_scale_vote(spark):
    schema = "g int, idx int, text string, score int, strict boolean, freq_ratio double, scale double, fitness int"
    rows = [(1, 0, "B-E-UUY-R4092533EE", 89, False, 1.0, 2.0, 75), (1, 1, "B-E-UUY-R4092533", 89, False, 1.0, 3.0, 75), (1, 2, "B-E-UUY-R4092533", 89, False, 1.0, 6.0, 75)]
    rows += [(2, 0, "B-E-UUY-X", 89, False, 1.0, 6.0, 75), (2, 1, "B-E-UUY-R4092533", 202, True, 1.0, 2.0, 100)]
    for likeness in (M.edit_similarity, M.matching_ratio):
        got = vote.scale_vote(frame(spark, rows, schema), ["g"], likeness)
        assert {r.g: r.text for r in got.collect()} == {1: "B-E-UUY-R4092533", 2: "B-E-UUY-R4092533"}


def page_rows(spark, rows):
    return frame(spark, [("d", i, h, f) for i, h, f in rows], "doc string, page_idx int, header string, flags string")


def test_rescue(spark):
    old, new = "B-FD-020H-S18020267", "B-FD-02OH-S18020267"
    flag = "glyph_disambiguation_skipped:no_char_boxes"
    for flags, want in ((flag, new), ("x", old)):
        pages = page_rows(spark, [(15, old, flags), (16, old, flags)])
        readings = frame(spark, [("d", 15, new)], "doc string, page_idx int, reading string")
        assert [r.header for r in propagate.rescue(pages, readings, ["doc"]).collect()] == [want, want]


def test_harmonize(spark):
    old, new, g = "B-FD-020H-S18020267", "B-FD-02OH-S18020267", "glyph_disambiguated:x"
    rows = [(14, new, g), (15, new, g), (16, old, ""), (17, old, ""), (18, old, "")]
    got = propagate.harmonize(page_rows(spark, rows), ["doc"]).collect()
    assert {r.header for r in got} == {new} and sorted(r.page_idx for r in got if r.updated) == [16, 17, 18]
    for rows in ([(1, old, g), (2, old, "")], [(1, old, ""), (2, new, "")], [(1, old, g), (2, new, g)]):
        assert not any(r.updated for r in propagate.harmonize(page_rows(spark, rows), ["doc"]).collect())


def test_glyph_votes(spark):
    h = "B-FD-020H-S18020267"
    schema = "g int, header string, pos int, ch string, votes int"
    rows = [(1, h, 7, "O", 2), (1, h, 7, "0", 0), (2, h, 7, "O", 1), (3, h, 5, "O", 9), (4, "B-TW-UEL-S18011737", 7, "I", 2)]
    got = {r.g: r.refined for r in propagate.glyph_vote(frame(spark, rows, schema), ["g"]).collect()}
    assert got == {1: "B-FD-02OH-S18020267", 2: h, 3: h, 4: "B-TW-UEI-S18011737"}


def test_context(spark):
    rows = [("a", 31, 32, "B-E-UUY-R4092527"), ("a", 33, 33, "B-E-UUY-R40925274"), ("a", 34, 34, "B-E-UUY-R4092527"), ("b", 7, 8, "B-E-UUY-R4092558"), ("b", 9, 10, "B-E-UUY-R4092528")]
    got = segment.correct_by_context(frame(spark, rows, "doc string, start_page int, end_page int, header string"), ["doc"])
    assert sorted(map(tuple, got.collect())) == [("a", 31, 34, "B-E-UUY-R4092527"), ("b", 7, 8, "B-E-UUY-R4092558"), ("b", 9, 10, "B-E-UUY-R4092528")]


def test_segments_hold_against_their_first_page(spark):
    # each page is close to the one before, but the third is far from the first
    rows = [("d", i, h) for i, h in enumerate(["AAAAAAAAAAAAAAAAAAAA", "AAAAAAAAAAAAAAAAAACC", "AAAAAAAAAAAAAAAACCCC", ""])]
    got = segment.assign_segments(frame(spark, rows, "doc string, page_idx int, header string").where("header != ''"), ["doc"])
    assert sorted((r.page_idx, r.segment) for r in got.collect()) == [(0, 0), (1, 0), (2, 1)]


def test_breaker(spark):
    cfg = replace(SHIPPED, breaker_failures=2, breaker_seconds=60)
    events = [(1, 0.0, True), (2, 1.0, True), (3, 2.0, False), (4, 62.0, True), (5, 123.0, False), (6, 124.0, False)]
    df = frame(spark, [(1, *e) for e in events], "k long, event_id long, ts double, failed boolean")
    got = [(r.event_id, r.state, r.allowed) for r in state.circuit_breaker(df, "k", cfg).orderBy("event_id").collect()]
    assert got == [(1, "CLOSED", True), (2, "OPEN", True), (3, "OPEN", False), (4, "OPEN", True), (5, "CLOSED", True), (6, "CLOSED", True)]


def test_names(spark):
    cases = [("a b/c", "a_bc"), ("--", "unnamed"), ("é-x", "é_x"), ("", "unnamed"), (None, "unnamed"), ("x" * 120, "x" * 100), ("a__--b", "a_b")]
    got = frame(spark, cases, "t string, want string").select(T.safe_name(F.col("t")), "want").collect()
    assert all(a == b for a, b in got)
    groups = frame(spark, [("d", 0, 1, "A-1"), ("d", 2, 3, "A/-1"), ("d", 4, 4, "B")], "doc string, start_page int, end_page int, header string")
    docs = frame(spark, [("d", 5, "x"), ("e", 7, "y")], "doc string, total_pages long, original string")
    got = manifest.split_manifest(groups, docs, ["doc"], "original").orderBy("doc", "idx").collect()
    assert [(r.doc, r.file_name, r.start_page, r.end_page) for r in got] == [("d", "A_1.pdf", 0, 1), ("d", "A_1_02.pdf", 2, 3), ("d", "B.pdf", 4, 4), ("e", "UNKNOWN.pdf", 0, 6)]


def test_unique_paths_of_many(spark):
    """Each of many equal paths gets the next free number, however many there are; taken numbers are passed."""
    taken = {0, 1, 4, 5, 900, 5000}
    old = frame(spark, [("a" + f"_{i}" * (i > 0) + ".pdf",) for i in taken], "path string")
    wanted = frame(spark, [(i, "a.pdf") for i in range(2000)] + [(9000, "b")], "id int, path string")
    got = {r.id: r.unique_path for r in manifest.unique_paths(wanted, old).collect()}
    free = [i for i in range(2005) if i not in taken]
    assert got == {i: f"a_{n}.pdf" for i, n in enumerate(free)} | {9000: "b"}


def test_names_of_odd_texts(spark):
    """Only a name's own ends are trimmed, not what stands before a last line feed; letters and digits as in the SQL."""
    cases = [("x" * 98 + " \nrest", "x" * 98 + "_\n"), ("a -\n", "a_\n"), ("a_\r\n", "a_\r\n"), ("x²½Ⅷ", "x²½Ⅷ"), ("e\u0301ⓐ‿x", "ex"), ("a\u00a0b\u000bc\u2028d\te\n-", "abcd\te\n")]
    got = frame(spark, cases, "t string, want string").select(T.safe_name(F.col("t")), "want").collect()
    assert [r[0] for r in got] == [r[1] for r in got]


def test_fallback(spark):
    cases = [("", 90.0, "empty_text"), ("B-HK-WFE-S17975643", 90.0, "passed"), ("B-HK-WFE-S17975643", 50.0, "low_confidence(50.0%)"), ("b?", 90.0, "regex_failed, invalid_chars(?b)")]
    got = frame(spark, cases, "t string, c double, want string").select(recognise.fallback_reason(F.col("t"), F.col("c")), "want").collect()
    assert all(a == b for a, b in got)


def test_legacy(spark):
    cases = [("BL-HK-WFE-817975643-", "B-HK-WFE-S17975643"), ("-P-F-W1A-S17995875", "P-F-W1A-S17995875"), ("x", "x"), ("", "")]
    got = frame(spark, cases, "t string, want string").select(L.corrections(F.col("t")), "want").collect()
    assert all(a == b for a, b in got)
    best = frame(spark, [("B-HK-WFE-S17975643",)], "t string").select(L.score(F.col("t")), L.quality(F.col("t"))).first()
    assert tuple(best) == (290, 115)
    assert frame(spark, [("P-F-W1A-S17995875COA2",)], "t string").select(L.clean_serial(F.col("t"))).first()[0] == "P-F-W1A-S17995875"


def test_config(tmp_path):
    assert one_way("S:5, x:y,bad,AB:C") == {"S": "5", "X": "Y"}
    assert both_ways("O:0") == {"O": "0", "0": "O"} and canonical("O:0") == {"O": "0", "0": "0"}
    assert merged("O:0,S:5", "I:L,O:0") == "O:0,S:5,I:L"
    for bad in ({"top": 101}, {"first_scale": 9.0}, {"pages": (0,)}):
        with pytest.raises(ValueError):
            HeaderConfig(**bad)
    path = tmp_path / "c.ini"
    path.write_text("[Settings]\npages_to_read = all\nserial_digits_exact = 0\npattern_serial_max = 9\nheader_similarity_threshold = 0.85\n")
    cfg = load(str(path))
    assert (cfg.pages, cfg.exact_digits, cfg.serial, cfg.similarity) == ((), 0, (7, 9), 0.85)

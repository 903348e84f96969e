"""Label-file parsing (FIXTURES A2, A3)."""

from hypothesis import given, settings
from hypothesis import strategies as st

from starmart.plans import star
import pytest

from starmart.sources import labels as L

LABEL_TEXT = """/* TAGA - words before the list */
  value taga
   'AAA'\t=\t'SPRINGVILLE, OR          '
   101 =  'ALBION'
   'X=Y' = 'two signs'
   no sign here
   9 = 'Last' ;
/* TAGB - next
   1 = Business
*/
;
"""

PORT_TEXT = """/* PORTS */
   'AAA'\t=\t'SPRINGVILLE, OR          '
   'BBB'\t=\t'LAKESIDE, VA #ARPT'
   'CCC'\t=\t'HARBOR AZ'
   'DDD'\t=\t'A, B, XX'
   'EEE'\t=\t'TORONTO, CANADA'
;
"""


def _texts(spark, *texts):
    return spark.createDataFrame([(f"f{i}", t) for i, t in enumerate(texts)], "source string, text string")


def test_section_pairs(spark):
    texts = _texts(spark, LABEL_TEXT)
    got = [(r.code, r.value) for r in L.label_dictionary(texts, "TAGA").orderBy("item_no").collect()]
    assert got == [("AAA", "SPRINGVILLE, OR"), ("101", "ALBION"), ("9", "Last")]
    got_b = [(r.code, r.value) for r in L.label_dictionary(texts, "TAGB").collect()]
    assert got_b == [("1", "Business")]


def test_rejects_are_visible(spark):
    texts = _texts(spark, LABEL_TEXT)
    rejected = [r.item.strip() for r in L.label_dictionary(texts, "TAGA", rejects=True).collect()]
    assert "'X=Y' = 'two signs'" in rejected and "no sign here" in rejected


def test_missing_tag_or_terminator_fails_unless_allowed(spark):
    texts = _texts(spark, LABEL_TEXT, "/* TAGA only\n 1 = 'x'\n")
    for tag in ("TAGA", "NOPE"):
        with pytest.raises(Exception, match="is missing"):
            L.label_dictionary(texts, tag).collect()
        with pytest.raises(Exception, match="is missing"):
            L.label_dictionary_pair(texts, tag).collect()
    out = L.label_dictionary(texts, "TAGA", required=False)
    assert {r.source for r in out.collect()} == {"f0"}
    assert L.label_dictionary(texts, "NOPE", required=False).count() == 0


def test_empty_section(spark):
    assert L.label_dictionary(_texts(spark, "/* EMPTY */ ;"), "EMPTY").count() == 0


def test_two_files_at_once(spark):
    texts = _texts(spark, LABEL_TEXT, LABEL_TEXT.replace("ALBION", "BOREA"))
    got = sorted((r.source, r.code, r.value) for r in L.label_dictionary(texts, "TAGA").collect())
    assert ("f0", "101", "ALBION") in got and ("f1", "101", "BOREA") in got and len(got) == 6


def test_port_pairs_and_non_us_filter(spark):
    texts = _texts(spark, PORT_TEXT)
    pairs = L.label_dictionary_pair(texts, "PORTS")
    got = sorted((r.code, r.value1, r.value2) for r in pairs.collect())
    assert got == [("AAA", "SPRINGVILLE", "OR"), ("BBB", "LAKESIDE", "VA #ARPT"), ("EEE", "TORONTO", "CANADA")]
    codes = pairs.selectExpr("code", "value1 AS port", "value2 AS state_code")
    kept = sorted(r.code for r in star.build_port_codes(codes).collect())
    assert kept == ["AAA", "BBB"]


def test_read_texts_from_files(spark, scratch, tmp_path):
    path = tmp_path / "labels.SAS"
    path.write_text(LABEL_TEXT)
    texts = L.read_texts(spark, str(path))
    got = sorted(r.code for r in L.label_dictionary(texts, "TAGA").collect())
    assert got == ["101", "9", "AAA"]


SAS_LIKE = """/* I94CIT & I94RES - countries, valid or not */
  value cntry
   582 =  'ALBION (sea, air, no land)'
   236 =  'BOREA'
   999 =  'INVALID: NOWHERE'
;
/* I94PORT - ports of entry */
  value $ports
   'SPV'\t=\t'SPRINGVILLE, OR        '
   'HBR'\t=\t'HARBOR AZ             '
   'XYZ'\t=\t'SOMEWHERE, ON, CANADA'
   'TOR'\t=\t'TORONTO, CANADA'
;
/* I94MODE - travel modes */
  value modes
   1 = 'Air'
   9 = 'Not reported' ;
/* I94ADDR - states */
  value states
   'OR'='OREGON'
   '99'='Other'
;
/* I94BIR - age */
/* I94VISA - visa classes:
   1 = Business
   2 = Pleasure
   3 = Student
*/
"""


def test_code_tables_from_one_text(spark, scratch):
    from starmart.plans import codes
    with pytest.raises(Exception, match="is missing"):
        codes.code_tables(_texts(spark, SAS_LIKE))["i94_visa"].collect()
    tables = codes.code_tables(_texts(spark, SAS_LIKE), required=False)
    assert sorted(tuple(r) for r in tables["i94_country"].collect()) == [
        (236, "BOREA"), (582, "ALBION (sea, air, no land)"),
        (999, "INVALID: NOWHERE")]
    assert sorted(tuple(r) for r in tables["i94_port"].collect()) == [("SPV", "SPRINGVILLE", "OR"),
                                                                       ("TOR", "TORONTO", "CANADA")]
    assert [tuple(r) for r in tables["i94_model"].orderBy("code").collect()] == [(1, "Air"), (9, "Not reported")]
    assert sorted(tuple(r) for r in tables["i94_state_addrl"].collect()) == [("99", "Other"),
                                                                              ("OR", "OREGON")]
    # the age search text runs on to the next ';' and so picks up the visa list
    assert tables["i94_visa"].count() == 0  # no ';' after it in this text
    out = scratch("codes")
    paths = codes.write_code_tables(_texts(spark, SAS_LIKE + ";\n"), out)
    assert set(paths) == {"i94_country", "i94_port", "i94_model", "i94_state_addrl", "i94_visa"}
    visa = spark.read.option("header", True).csv(paths["i94_visa"])
    assert sorted(tuple(r) for r in visa.collect()) == [("1", "Business"), ("2", "Pleasure"), ("3", "Student")]
    odd = SAS_LIKE.replace("9 = 'Not", "x9 = 'Not")
    with pytest.raises(Exception, match="not a number: x9"):
        codes.code_tables(_texts(spark, odd))["i94_model"].collect()


def _model(text, tag, pair=False):
    """The parsing rules, stated directly in Python: cut from the tag to the
    next ';', keep lines with exactly one '=', trim blanks, then single and
    double quotes (values: blanks again); for pairs, exactly one comma."""
    start = text.find(tag)
    if start < 0:
        return []
    end = text.find(";", start)
    if end < 0:
        return []
    out = []
    for line in text[start:end].splitlines():
        parts = line.split("=")
        if len(parts) != 2:
            continue
        code = parts[0].strip().strip("'").strip('"')
        value = parts[1].strip().strip("'").strip('"').strip()
        if pair:
            halves = value.split(",")
            if len(halves) != 2:
                continue
            out.append((code, halves[0].strip(), halves[1].strip()))
        else:
            out.append((code, value))
    return out


LINE = st.builds(lambda a, q, b: f"{a}{q}{b}{q}",
                 st.text(alphabet=" \t'\"=abc,1", max_size=6), st.sampled_from(["", "'", '"']),
                 st.text(alphabet=" \t'\"=xyz,2", max_size=8))


@settings(max_examples=25, deadline=None)
@given(st.lists(st.tuples(LINE, st.sampled_from(["\n", "\r\n", "\r"])), max_size=8), st.booleans(), st.booleans())
def test_parser_matches_the_rules(spark, lines, closed, pair):
    body = "".join(line + brk for line, brk in lines)
    text = "head = 'x'\n/* TAG list */\n" + body + (";\nafter = 'y'" if closed else "")
    texts = _texts(spark, text)
    if pair:
        got = sorted((r.code, r.value1, r.value2) for r in L.label_dictionary_pair(texts, "TAG", required=False).collect())
    else:
        got = sorted((r.code, r.value) for r in L.label_dictionary(texts, "TAG", required=False).collect())
    assert got == sorted(_model(text, "TAG", pair))

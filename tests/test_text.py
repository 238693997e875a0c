import unicodedata

import pytest
from pyspark.sql import functions as F

from kindred.functions import text
from kindred.functions.text import NFKC_STABLE_RANGES, normalize_records


def apply(spark, form, *values):
    frame = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, t string")
    return [r.x for r in frame.select("i", form(F.col("t")).alias("x")).orderBy("i").collect()]


def test_basic_keeps_letters_and_digits(spark):
    got = apply(spark, text.basic_text, "  Acme, Pvt. Ltd.!", "***", None, "मुंबई बैंक", "Ünï-Cöde 12b")
    assert got == ["acme pvt ltd", "", None, "म बई ब क", "ünï cöde 12b"]


def test_rich_text_folds_and_keeps_marks(spark):
    got = apply(spark, text.rich_text, "मुंबई बैंक", "ＡＣＭＥ ①½ ﬁ", None, "  ", "a\tb\u00a0c", "e\u0301t\u00e9")
    assert got == ["मुंबई बैंक", "acme 11 2 fi", "", "", "a b c", "été"]


def test_stable_ranges_are_stable():
    """No character that is not composed may change under NFKC, alone or after another."""
    for low, high in NFKC_STABLE_RANGES:
        for code in range(low, high + 1):
            char = chr(code)
            assert unicodedata.normalize("NFKC", char) == char
            assert unicodedata.combining(char) == 0
            for before in "a가か":
                assert unicodedata.normalize("NFKC", before + char) == before + char


def test_nfkc_of_every_character(spark):
    """All assigned characters, alone, after a base letter and with a mark, against Python's tables."""
    chars = [chr(c) for c in range(0x110000) if unicodedata.category(chr(c)) not in ("Cn", "Cs", "Co")]
    rows = [form.format(c) for form in ("{}", "a{}", "{}\u0301", "\u1100{}\u11a8") for c in chars]
    frame = spark.createDataFrame([(r,) for r in rows], "t string").select("t", text.nfkc(F.col("t")).alias("x"))
    wrong = [r.t for r in frame.collect() if r.x != unicodedata.normalize("NFKC", r.t)]
    assert wrong == []
    assert apply(spark, text.nfkc, None, "") == [None, ""]


def test_rich_form_needs_no_python_worker(spark):
    frame = spark.createDataFrame([("x",)], "t string").select(text.rich_address(F.col("t")))
    plan = frame._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan


@pytest.mark.parametrize(
    "raw, name, core",
    [
        ("Acme Pvt. Ltd.", "acme private limited", "acme"),
        ("Foo Corp", "foo corp", "foo"),
        ("Bar Co", "bar co", "bar"),
        ("Foo Tech Corp", "foo technology corp", "foo technology"),
        ("Incorporated", "inc", ""),
        ("Intl. Pharma Mgmt Grp LLC", "international pharmaceuticals management group llc",
         "international pharmaceuticals management group"),
        (None, "", ""),
    ],
)
def test_names(spark, raw, name, core):
    assert apply(spark, text.rich_name, raw) == [name]
    assert apply(spark, text.core_name, raw) == [core]


def test_addresses(spark):
    raw = "12 North Main Street, Suite 5"
    assert apply(spark, text.rich_address, raw, "9 Foo Blvd / SW", None) == ["12 n main st ste 5", "9 foo bd sw", ""]
    assert apply(spark, text.address_words, raw, "--", None) == [["12", "n", "main", "st", "ste", "5"], [], []]
    assert apply(spark, text.address_numbers, "12 ٣٤ a5", "none", None) == [["12", "٣٤", "5"], [], []]


def test_normalize_records(spark):
    raw = spark.createDataFrame(
        [("S1-1", "Foo Tech, Ltd", None, " US ")],
        "entity_id string, business_name string, business_address string, country string",
    )
    assert normalize_records(raw).first() == ("S1-1", "us", "foo tech ltd", None)
    assert normalize_records(raw, fill_missing=True).first() == ("S1-1", "us", "foo tech ltd", "")
    assert normalize_records(raw, "rich").first() == ("S1-1", "us", "foo technology limited", "")

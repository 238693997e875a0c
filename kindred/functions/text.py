"""Text normalisers as column expressions.

Two families. The *basic* one keeps letters and digits only; it is the pipeline
default. The *rich* one also folds compatibility characters (NFKC), keeps combining
marks, and maps abbreviations; it is the better choice for scripts such as Devanagari,
whose vowel signs the basic one turns into spaces.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kindred.functions.vocabulary import ADDRESS_WORDS, LEGAL_WORDS, NAME_WORDS

BASIC_NOISE = r"[^\p{L}\p{N}]+"
RICH_NOISE = r"[^\p{L}\p{M}\p{N}]+"

# Characters NFKC leaves alone whatever surrounds them: ASCII, Latin letters with
# diacritics, Cyrillic, kana, CJK ideographs and Hangul syllables. Any other character
# (marks, full-width forms, ligatures, jamo) sends its text through the composition.
NFKC_STABLE_RANGES = [
    (0x00, 0x7F),
    (0xC0, 0x131),
    (0x134, 0x13E),
    (0x141, 0x148),
    (0x14A, 0x17E),
    (0x400, 0x481),
    (0x3041, 0x3096),
    (0x30A1, 0x30FA),
    (0x4E00, 0x9FFF),
    (0xAC00, 0xD7A3),
]
NFKC_UNSTABLE = "[^" + "".join(f"\\x{{{a:X}}}-\\x{{{b:X}}}" for a, b in NFKC_STABLE_RANGES) + "]"


def nfkc(text: Column) -> Column:
    """NFKC form, by the Unicode library that Spark ships for its collations, where the rows
    are. Only texts that NFKC could change are handed to it."""
    composed = F.java_method(F.lit("com.ibm.icu.text.Normalizer"), F.lit("compose"), text, F.lit(True))
    return F.when(text.rlike(NFKC_UNSTABLE), composed).otherwise(text)


def basic_text(text: Column) -> Column:
    return F.trim(F.regexp_replace(F.lower(text), BASIC_NOISE, " "))


def basic_country(country: Column) -> Column:
    return F.lower(F.trim(country))


def rich_text(text: Column) -> Column:
    """NFKC, lower case, letters, marks and digits only, single spaces; NULL gives ''."""
    folded = F.regexp_replace(F.lower(nfkc(text)), RICH_NOISE, " ")
    return F.coalesce(F.trim(folded), F.lit(""))


def words(text: Column) -> Column:
    """Words of a normalised text; the empty text has none."""
    return F.filter(F.split(text, " "), lambda w: w != "")


def _replace_words(text: Column, table: dict[str, str]) -> Column:
    lookup = F.create_map(*[F.lit(x) for item in table.items() for x in item])
    return F.transform(words(text), lambda w: F.coalesce(lookup[w], w))


def rich_name(name: Column) -> Column:
    return F.array_join(_replace_words(rich_text(name), NAME_WORDS), " ")


def core_name(name: Column) -> Column:
    """The rich name without words for the legal form."""
    kept = F.filter(_replace_words(rich_text(name), NAME_WORDS), lambda w: ~w.isin(LEGAL_WORDS))
    return F.array_join(kept, " ")


def rich_address(address: Column) -> Column:
    return F.array_join(_replace_words(rich_text(address), ADDRESS_WORDS), " ")


def address_words(address: Column) -> Column:
    return _replace_words(rich_text(address), ADDRESS_WORDS)


def address_numbers(address: Column) -> Column:
    """Runs of decimal digits of any script."""
    return F.regexp_extract_all(rich_address(address), F.lit(r"\p{Nd}+"), F.lit(0))


def normalize_records(
    records: DataFrame, normalizer: str = "basic", fill_missing: bool = False
) -> DataFrame:
    """Records with ``country``, ``name`` and ``address`` in normal form.

    ``normalizer`` is ``"basic"`` or ``"rich"``. The basic form keeps NULL fields NULL
    unless ``fill_missing`` turns them into ''; the rich form never yields NULL.
    Columns other than the raw fields are carried along.
    """
    forms = {
        "basic": (basic_country, basic_text, basic_text),
        "rich": (rich_text, rich_name, rich_address),
    }
    country, name, address = forms[normalizer]
    fields = {
        "country": country(F.col("country")),
        "name": name(F.col("business_name")),
        "address": address(F.col("business_address")),
    }
    if fill_missing:
        fields = {k: F.coalesce(v, F.lit("")) for k, v in fields.items()}
    carried = [c for c in records.columns if c == "source"]
    return records.select("entity_id", *[v.alias(k) for k, v in fields.items()], *carried)

"""Blocking keys of normalised records.

========  =====================================================
key_type  block_key
========  =====================================================
1         country | whole name
2         country | first word | last word of the name
3         country | first word | second word of the name
4         country | first number | first word after it, of the address
5         country | a rare word of the name
6         country | a rare word of the address
========  =====================================================

``guard_empty=False`` is the looser variant: key 4 may lack its word, and rare-word keys
may lack the country.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kindred.functions import parts

NAME_WORD, ADDRESS_WORD = 5, 6
WORD_FIELDS = {NAME_WORD: "name", ADDRESS_WORD: "address"}
RARE_LOW, RARE_HIGH = 2, 100

# Keys are exploded as plain texts that start with the digit of their type: arrays of
# texts stay in generated code where arrays of structs would not.


def _joined(*fields: Column) -> Column:
    """Fields joined by bars; NULL when one of them is NULL."""
    with_bars = [x for f in fields for x in (F.lit("|"), f)][1:]
    return F.concat(*with_bars)


def _fixed_keys(guard_empty: bool) -> list[Column]:
    """Keys 1 to 4, NULL where a record has none."""
    country, name, address = F.col("country"), F.col("name"), F.col("address")
    first = parts.first_word(name)
    second = parts.second_word(name)
    number = parts.first_number(address)
    street = parts.word_after_number(address)
    named = (country != "") & (name != "")
    numbered = (country != "") & (number != "")
    if guard_empty:
        numbered = numbered & (street != "")
    keys = [
        F.when(named, _joined(country, name)),
        F.when(named, _joined(country, first, parts.last_word(name))),
        F.when(named & (second != ""), _joined(country, first, second)),
        F.when(numbered, _joined(country, number, street)),
    ]
    return [F.concat(F.lit(str(i)), k) for i, k in enumerate(keys, 1)]


def _tagged_words(key_type: int, distinct_words: bool, guard_empty: bool) -> Column:
    """Words of the field, each with its key type in front; none without a country."""
    tag = str(key_type)
    text = F.concat(F.lit(tag), F.replace(WORD_FIELDS[key_type], F.lit(" "), F.lit(f" {tag}")))
    words = F.split(text, " ")
    if distinct_words:
        words = F.array_distinct(words)
    usable = F.col("country") != "" if guard_empty else F.col("country").isNotNull()
    return F.coalesce(F.when(usable, words), F.array().cast("array<string>"))


def _exploded(records: DataFrame, texts: Column, carry: tuple[str, ...] = ()) -> DataFrame:
    carried = [c for c in ("entity_id", "source", *carry) if c in records.columns]
    split = records.select(*carried, "country", F.explode(texts).alias("text")).select(
        *carried,
        "country",
        F.substring("text", 1, 1).alias("tag"),
        F.expr("substring(text, 2)").alias("body"),
    )
    body = F.col("body")
    is_word = F.col("tag") >= str(NAME_WORD)
    return split.filter(F.when(is_word, parts.is_index_word(body)).otherwise(body.isNotNull())).select(
        *carried,
        F.col("tag").cast("int").alias("key_type"),
        F.when(is_word, _joined(F.col("country"), body)).otherwise(body).alias("block_key"),
    )


def _all_words(distinct_words: bool, guard_empty: bool) -> list[Column]:
    return [_tagged_words(t, distinct_words, guard_empty) for t in WORD_FIELDS]


def record_keys(
    records: DataFrame, distinct_words: bool = True, guard_empty: bool = True, carry: tuple[str, ...] = ()
) -> DataFrame:
    """Keys 1 to 4 of every record, and a key of type 5 or 6 for every index word, rare
    or not, in one pass over the records. Columns named by ``carry`` stay.

    With ``distinct_words=False`` a word gives as many rows as it has uses.
    """
    fixed = F.array(*_fixed_keys(guard_empty))
    return _exploded(records, F.concat(fixed, *_all_words(distinct_words, guard_empty)), carry)


def basic_keys(records: DataFrame, guard_empty: bool = True) -> DataFrame:
    """Keys 1 to 4, each once per entity."""
    return _exploded(records, F.array(*_fixed_keys(guard_empty))).distinct()


def field_words(records: DataFrame, field: str) -> DataFrame:
    """One row per word of ``field``, repeats included."""
    carried = [c for c in ("entity_id", "source") if c in records.columns]
    return records.select(*carried, "country", F.explode(F.split(field, " ")).alias("word"))


def _own_exchange(column: str) -> Column:
    """One grouping column more than the join that follows needs, implied by the others.

    The table of rare words then has to be exchanged for the join, so that both inputs
    of the join are plain exchanges and adaptive execution can split a word that very
    many records use. The table is small next to the words.
    """
    return F.length(column).alias("length")


def rare_words(others: DataFrame, field: str, low: int = RARE_LOW, high: int = RARE_HIGH) -> DataFrame:
    """``(country, word)`` with ``low`` to ``high`` uses in all other sources together."""
    return (
        field_words(others, field)
        .filter(parts.is_index_word(F.col("word")))
        .groupBy("country", "word", _own_exchange("word"))
        .agg(F.count("*").alias("uses"))
        .filter(F.col("uses").between(low, high))
        .select("country", "word")
    )


def rare_keys(
    records: DataFrame, rare: DataFrame, key_type: int, guard_empty: bool = True
) -> DataFrame:
    """Keys of type 5 or 6: the words of each record found in the ``rare`` table."""
    words = field_words(records, WORD_FIELDS[key_type]).filter(parts.is_index_word(F.col("word")))
    if guard_empty:
        words = words.filter("country <> ''")
    found = words.join(rare, ["country", "word"], "left_semi")
    carried = [c for c in ("entity_id", "source") if c in records.columns]
    return found.select(
        *carried,
        F.lit(key_type).alias("key_type"),
        _joined(F.col("country"), F.col("word")).alias("block_key"),
    ).distinct()


def all_keys(
    records: DataFrame,
    others: DataFrame,
    guard_empty: bool = True,
    low: int = RARE_LOW,
    high: int = RARE_HIGH,
) -> DataFrame:
    """All six kinds of key of ``records``, rare words judged on ``others``.

    Words of names and addresses are taken together, as keys, in one pass on each side.
    """
    uses = _exploded(others, F.concat(*_all_words(False, guard_empty)))
    rare = (
        uses.groupBy("key_type", "block_key", _own_exchange("block_key"))
        .agg(F.count("*").alias("uses"))
        .filter(F.col("uses").between(low, high))
    )
    words = _exploded(records, F.concat(*_all_words(True, guard_empty)))
    found = words.join(rare, ["key_type", "block_key"], "left_semi").distinct()
    return basic_keys(records, guard_empty).unionByName(found)

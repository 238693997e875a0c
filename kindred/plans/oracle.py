"""The same queries as SQL for DuckDB, put together from named subqueries.

Written against the definition of each operator and not against the Spark plans: parts
of fields come from list functions, candidates from pairs, lists from grouped pairs.
"""

from __future__ import annotations

import re

from kindred.functions.vocabulary import ADDRESS_WORDS, LEGAL_WORDS, NAME_WORDS
from kindred.operators.evaluate import DEFAULT_THRESHOLD, THRESHOLDS
from kindred.operators.pairs import SCORE_WEIGHTS
from kindred.plans.catalog import (
    CAP_3,
    CAP_20,
    DOCUMENTS,
    FIRST_ROW,
    GAPS,
    LAST_ROW,
    LIMIT,
    PAGE_SIZE,
    PAGES,
    THRESHOLD,
)
from kindred.schemas import FEATURES

CAP = 100
_VALIDATION = "('0x' || substr(md5(source1_entity_id), 1, 8))::BIGINT % 5 = 0"

RAW = {
    PAGES: r"""
        SELECT concat(upper(source), '-', lpad(CAST(page_id AS VARCHAR), 9, '0')) AS entity_id,
               regexp_extract(html, '<title>([^<]*)</title>', 1) AS business_name,
               url AS business_address,
               regexp_extract(html, '<html lang="([a-z]+)', 1) AS country,
               source
        FROM (SELECT *, CASE regexp_extract(url, '\.example\.([a-z]+)/', 1)
                             WHEN 'com' THEN 's1' WHEN 'net' THEN 's2' ELSE 's3' END AS source
              FROM pages)""",
    DOCUMENTS: r"""
        SELECT concat(upper(feed), '-', lpad(CAST(doc_id AS VARCHAR), 9, '0'), '-',
                      lpad(CAST(line_no - 1 AS VARCHAR), 5, '0')) AS entity_id,
               nullif(regexp_extract(line, '^([^.!?]*)', 1), '') AS business_name,
               nullif(regexp_replace(line, '^[^.!?]*[.!?]*', ''), '') AS business_address,
               concat(' ', upper(lang)) AS country,
               feed AS source
        FROM (SELECT doc_id, lang,
                     CASE WHEN TRY_CAST(substr(source, 4) AS INT) < 7 THEN 's1'
                          WHEN TRY_CAST(substr(source, 4) AS INT) < 14 THEN 's2' ELSE 's3' END AS feed,
                     unnest(string_split(text, chr(10))) AS line,
                     generate_subscripts(string_split(text, chr(10)), 1) AS line_no
              FROM documents)""",
}

RAW[GAPS] = f"""
        SELECT entity_id, CASE WHEN k % 7 <> 0 THEN business_name END AS business_name,
               CASE WHEN k % 3 = 0 THEN CAST(k % 10 AS VARCHAR)
                    WHEN k % 11 <> 0 THEN business_address END AS business_address,
               CASE WHEN k % 13 = 0 THEN '' ELSE country END AS country, source
        FROM (SELECT *, CAST(substr(entity_id, 4) AS BIGINT) AS k FROM ({RAW[PAGES]}))"""

_BASIC = r"trim(regexp_replace(lower({}), '[^\p{{L}}\p{{N}}]+', ' ', 'g'))"
_RICH = r"coalesce(trim(regexp_replace(lower({}), '[^\p{{L}}\p{{M}}\p{{N}}]+', ' ', 'g')), '')"


def _ctes(dataset: str, guard: bool, filled: bool, cap: int) -> dict[str, str]:
    basic = {f: _BASIC.format(f"business_{f}") for f in ("name", "address")}
    country = "lower(trim(country))"
    if filled:
        basic = {f: f"coalesce({e}, '')" for f, e in basic.items()}
        country = f"coalesce({country}, '')"
    copy_key = "md5(coalesce(country, '') || '|' || coalesce(name, ''))"
    if dataset == DOCUMENTS:
        copy_key = """md5(coalesce(country, '') || '|' || coalesce(name, '') || '|' || coalesce(address, ''))
               || right(entity_id, 6)"""
    word_country = "country <> ''" if guard else "country IS NOT NULL"
    street_guard = "AND street <> ''" if guard else ""

    def eq(a):
        return f"a.{a} <> '' AND a.{a} = b.{a}"

    def flag(test):
        return f"CAST(CASE WHEN {test} THEN 1 ELSE 0 END AS BIGINT)"

    def inside(f):
        return f"a.{f} <> '' AND b.{f} <> '' AND (contains(a.{f}, b.{f}) OR contains(b.{f}, a.{f}))"

    def ratio(f):
        return (
            f"CASE WHEN greatest(length(a.{f}), length(b.{f})) = 0 THEN 0.0::DOUBLE ELSE "
            f"least(length(a.{f}), length(b.{f}))::DOUBLE / greatest(length(a.{f}), length(b.{f})) END"
        )

    features = {
        "country_match": flag("a.country <> '' AND a.country = b.country"),
        "name_exact": flag("a.name <> '' AND a.name = b.name"),
        "name_first_match": flag(eq("n_first")),
        "name_last_match": flag(eq("n_last")),
        "name_first_two_match": flag(eq("n_two")),
        "name_contains": flag(inside("name")),
        "name_length_diff": "CAST(abs(length(a.name) - length(b.name)) AS BIGINT)",
        "name_length_ratio": ratio("name"),
        "address_exact": flag("a.address <> '' AND a.address = b.address"),
        "address_first_match": flag(eq("a_first")),
        "address_number_match": flag("a.number <> '' AND a.number = b.number"),
        "address_contains": flag(inside("address")),
        "address_length_diff": "CAST(abs(length(a.address) - length(b.address)) AS BIGINT)",
        "address_length_ratio": ratio("address"),
        "name_missing": flag("a.name = '' OR b.name = ''"),
        "address_missing": flag("a.address = '' OR b.address = ''"),
    }
    assert list(features) == FEATURES
    feature_sql = ",\n               ".join(f"{e} AS {f}" for f, e in features.items())
    loose = dict(features)
    for f, part in {"name_first": "n_first", "name_last": "n_last", "name_first_two": "n_two", "address_first": "a_first"}.items():
        loose[f"{f}_match"] = flag(f"a.{part} = b.{part}")
    loose_sql = ",\n               ".join(f"{e} AS {f}" for f, e in loose.items())
    score = "0.0::DOUBLE"
    for f, w in SCORE_WEIGHTS.items():
        score = f"({score} + {w}::DOUBLE * coalesce({f}::DOUBLE, 0.0))"

    def swept(column):
        return f"sum(CASE WHEN probability >= t THEN {column} ELSE 0 END)"

    thresholds = ", ".join(f"{t}::DOUBLE" for t in THRESHOLDS)
    return {
        "raw": RAW[dataset],
        "rec": f"""
        SELECT entity_id, {country} AS country, {basic["name"]} AS name,
               {basic["address"]} AS address, source
        FROM raw""",
        "part": r"""
        SELECT *, split_part(name, ' ', 1) AS n_first, string_split(name, ' ')[-1] AS n_last,
               split_part(name, ' ', 2) AS n_second,
               CASE WHEN name IS NULL THEN NULL WHEN contains(name, ' ')
                    THEN split_part(name, ' ', 1) || ' ' || split_part(name, ' ', 2) ELSE '' END AS n_two,
               split_part(address, ' ', 1) AS a_first,
               regexp_extract(address, '[0-9]+', 0) AS number,
               split_part(regexp_replace(address, '^[0-9]+ *', ''), ' ', 1) AS street
        FROM rec""",
        "basic": f"""
        SELECT DISTINCT entity_id, source, 1 AS key_type, country || '|' || name AS block_key
        FROM part WHERE country <> '' AND name <> ''
        UNION ALL
        SELECT DISTINCT entity_id, source, 2, country || '|' || n_first || '|' || n_last
        FROM part WHERE country <> '' AND name <> ''
        UNION ALL
        SELECT DISTINCT entity_id, source, 3, country || '|' || n_first || '|' || n_second
        FROM part WHERE country <> '' AND n_second <> ''
        UNION ALL
        SELECT DISTINCT entity_id, source, 4, country || '|' || number || '|' || street
        FROM part WHERE country <> '' AND number <> '' {street_guard}""",
        "word": """
        SELECT * FROM (
            SELECT entity_id, source, country, 5 AS key_type, unnest(string_split(name, ' ')) AS word
            FROM rec
            UNION ALL
            SELECT entity_id, source, country, 6, unnest(string_split(address, ' ')) FROM rec)
        WHERE length(word) >= 3 AND NOT regexp_full_match(word, '[0-9]+')""",
        "rare": """
        SELECT key_type, country, word FROM word WHERE source <> 's1'
        GROUP BY key_type, country, word HAVING count(*) BETWEEN 2 AND 100""",
        "rare_key": f"""
        SELECT DISTINCT w.entity_id, w.source, w.key_type, w.country || '|' || w.word AS block_key
        FROM word w JOIN rare USING (key_type, country, word) WHERE w.{word_country}""",
        "key": "SELECT * FROM basic UNION ALL SELECT * FROM rare_key",
        "block": f"""
        SELECT key_type, block_key, source, list(entity_id ORDER BY entity_id) AS ids
        FROM key WHERE source <> 's1' GROUP BY ALL HAVING count(*) <= {cap}""",
        "cand": """
        SELECT DISTINCT entity_id AS source1_entity_id, unnest(ids) AS candidate_entity_id,
               block.source AS source
        FROM (SELECT * FROM key WHERE source = 's1') k JOIN block USING (key_type, block_key)""",
        "copies": f"""
        SELECT *, {copy_key} AS copy_key FROM rec""",
        "truth": """
        SELECT a.entity_id AS source1_entity_id,
               coalesce(string_agg(b.entity_id, ',' ORDER BY b.entity_id), '') AS matched_entity_ids
        FROM copies a LEFT JOIN (SELECT * FROM copies WHERE source <> 's1') b USING (copy_key)
        WHERE a.source = 's1' GROUP BY a.entity_id""",
        "pair": """
        SELECT source1_entity_id, trim(unnest(string_split(matched_entity_ids, ','))) AS entity_id
        FROM truth WHERE matched_entity_ids <> ''""",
        "found": """
        SELECT p.source1_entity_id, p.entity_id,
               CASE WHEN EXISTS (SELECT 1 FROM cand c
                                 WHERE c.source1_entity_id = p.source1_entity_id
                                   AND c.candidate_entity_id = p.entity_id) THEN 1 ELSE 0 END AS found
        FROM pair p""",
        "labelled": """
        SELECT c.*, CASE WHEN p.entity_id IS NULL THEN 0 ELSE 1 END AS label
        FROM cand c LEFT JOIN (SELECT DISTINCT * FROM pair) p
          ON p.source1_entity_id = c.source1_entity_id AND p.entity_id = c.candidate_entity_id""",
        "feature": f"""
        SELECT c.source1_entity_id, c.candidate_entity_id, c.source, c.label,
               {feature_sql}
        FROM labelled c
        JOIN part a ON a.entity_id = c.source1_entity_id AND a.source = 's1'
        JOIN part b ON b.entity_id = c.candidate_entity_id AND b.source = c.source""",
        "feature_loose": f"""
        SELECT c.source1_entity_id, c.candidate_entity_id, c.source, c.label,
               {loose_sql}
        FROM labelled c
        JOIN part a ON a.entity_id = c.source1_entity_id AND a.source = 's1'
        JOIN part b ON b.entity_id = c.candidate_entity_id AND b.source = c.source""",
        "scored": f"SELECT *, {score} AS probability FROM feature",
        "matched": f"SELECT * FROM scored WHERE probability >= {THRESHOLD}",
        "per_s1": """
        SELECT r.entity_id AS source1_entity_id, count(c.candidate_entity_id) AS n_candidates
        FROM rec r LEFT JOIN cand c ON c.source1_entity_id = r.entity_id
        WHERE r.source = 's1' GROUP BY r.entity_id""",
        "sweep": f"""
        SELECT t AS threshold, {swept("1")}::BIGINT AS predicted_pairs,
               {swept("label")}::BIGINT AS true_positives, sum(label)::BIGINT AS positives
        FROM scored, (SELECT unnest([{thresholds}]) AS t) GROUP BY t""",
        "swept": """
        SELECT threshold, predicted_pairs, true_positives,
               CASE WHEN predicted_pairs = 0 THEN 0.0::DOUBLE
                    ELSE true_positives::DOUBLE / predicted_pairs END AS precision,
               CASE WHEN positives = 0 THEN 0.0::DOUBLE
                    ELSE true_positives::DOUBLE / positives END AS recall,
               CASE WHEN predicted_pairs + positives = 0 THEN 0.0::DOUBLE
                    ELSE 1.25::DOUBLE * true_positives / (1.25::DOUBLE * true_positives
                         + (predicted_pairs - true_positives)
                         + 0.25::DOUBLE * (positives - true_positives)) END AS f05
        FROM sweep""",
        "hit": """
        SELECT source1_entity_id, entity_id, max(p) AS p, max(t) AS t FROM (
            SELECT source1_entity_id, candidate_entity_id AS entity_id, 1 AS p, 0 AS t FROM matched
            UNION ALL SELECT source1_entity_id, entity_id, 0, 1 FROM pair) GROUP BY ALL""",
        "entity": """
        SELECT source1_entity_id, tp, fp, fn,
               CASE WHEN tp + fp + fn = 0 THEN 1.0::DOUBLE
                    WHEN tp = 0 THEN 0.0::DOUBLE
                    ELSE 1.25::DOUBLE * tp / (1.25::DOUBLE * tp + fp + 0.25::DOUBLE * fn) END AS f05
        FROM (SELECT r.entity_id AS source1_entity_id,
                     count(*) FILTER (p = 1 AND t = 1) AS tp,
                     count(*) FILTER (p = 1 AND t = 0) AS fp,
                     count(*) FILTER (p = 0 AND t = 1) AS fn
              FROM rec r LEFT JOIN hit h ON h.source1_entity_id = r.entity_id
              WHERE r.source = 's1' GROUP BY r.entity_id)""",
        "result": """
        SELECT r.entity_id AS source1_entity_id,
               coalesce(string_agg(DISTINCT m.candidate_entity_id, ',' ORDER BY m.candidate_entity_id), '')
                   AS matched_entity_ids
        FROM rec r LEFT JOIN matched m ON m.source1_entity_id = r.entity_id
        WHERE r.source = 's1' GROUP BY r.entity_id""",
        # The first split of a boosted tree, from all cuts of all features.
        "train_row": f"SELECT * FROM feature WHERE NOT ({_VALIDATION})",
        "base": "SELECT count(*)::DOUBLE AS n, sum(label)::DOUBLE AS positive FROM train_row",
        "field": f"""
        SELECT label, unnest([{', '.join(f"{{'place': {i}, 'feature': '{f}', 'v': {f}::DOUBLE}}" for i, f in enumerate(FEATURES))}],
               recursive := true) FROM train_row""",
        "counted": "SELECT place, feature, v, count(*) AS n, sum(label) AS p FROM field GROUP BY ALL",
        "lost": "SELECT place, n, p FROM counted WHERE v IS NULL",
        "cut": """
        SELECT place, feature, v + (lead(v) OVER w - v) / 2 AS cut, sum(n) OVER w AS n, sum(p) OVER w AS p
        FROM counted WHERE v IS NOT NULL WINDOW w AS (PARTITION BY place ORDER BY v)""",
        "side": """
        SELECT c.place, feature, coalesce(cut, 'infinity'::DOUBLE) AS cut, false AS lost_left, c.n, c.p
        FROM cut c LEFT JOIN lost l ON l.place = c.place
        WHERE cut IS NOT NULL OR l.n > 0
        UNION ALL
        SELECT c.place, feature, cut, true, c.n + l.n, c.p + l.p FROM cut c JOIN lost l ON l.place = c.place WHERE cut IS NOT NULL""",
        "gain_split": """
        SELECT * EXCLUDE (n, p), n, gl * gl / (hl + 1) + gr * gr / (hr + 1) AS gain, -gl / (hl + 1) AS left_value, -gr / (hr + 1) AS right_value
        FROM (SELECT s.*, s.n * q - s.p AS gl, s.p - s.n * q AS gr, s.n * q * (1 - q) AS hl, (b.n - s.n) * q * (1 - q) AS hr
              FROM side s CROSS JOIN (SELECT *, positive / n AS q FROM base) b WHERE s.n >= 50 AND b.n - s.n >= 50)
        WHERE hl >= 0.001 AND hr >= 0.001""",
        "stump_split": "SELECT * FROM gain_split ORDER BY round(gain, 6) DESC, place, lost_left, cut LIMIT 1",
        "stump": f"""
        SELECT f.source1_entity_id, f.candidate_entity_id, f.label,
               1 / (1 + exp(-(ln(b.positive / (b.n - b.positive)) + CASE
                 WHEN coalesce(list_extract([{', '.join(f'f.{f}::DOUBLE' for f in FEATURES)}], s.place + 1) < s.cut,
                               s.lost_left) THEN left_value ELSE right_value END))) AS score
        FROM feature f CROSS JOIN base b CROSS JOIN stump_split s""",
        "stump_sweep": f"""
        SELECT t.threshold, count(*) FILTER (label = 1) AS tp, count(*) AS predicted,
               (SELECT sum(label) FROM stump WHERE {_VALIDATION}) AS positives
        FROM (SELECT unnest({THRESHOLDS}) AS threshold) t JOIN stump ON score >= threshold
        WHERE {_VALIDATION} GROUP BY 1""",
        "stump_threshold": f"""
        SELECT coalesce(arg_max(threshold, (1.25 * tp / (1.25 * tp + predicted - tp + 0.25 * (positives - tp)), -threshold)),
                        {DEFAULT_THRESHOLD}) AS threshold FROM stump_sweep WHERE tp > 0""",
        # Faulty result file.
        "fault_row": """
        SELECT t.source1_entity_id, matched_entity_ids AS ids, country, name, address
        FROM truth t JOIN rec r ON r.entity_id = t.source1_entity_id WHERE length(name) >= 5""",
        "file_row": """
        SELECT source1_entity_id,
               CASE WHEN country = 'de' AND ids <> '' THEN ids || ',' || ids
                    WHEN country = 'fr' THEN concat_ws(',', nullif(ids, ''), source1_entity_id)
                    WHEN length(name) > 150 THEN 'X-' || source1_entity_id
                    ELSE ids END AS ids
        FROM fault_row
        UNION ALL SELECT source1_entity_id, ids FROM fault_row WHERE country = 'es'
        UNION ALL SELECT entity_id, '' FROM rec WHERE source = 's2' AND country = 'es'""",
        "file_id": """
        SELECT DISTINCT source1_entity_id, unnest(string_split(ids, ',')) AS id
        FROM file_row WHERE ids <> ''""",
        "s2_truth": r"""
        SELECT source1_entity_id, regexp_replace(matched_entity_ids, ',?S3-.*$', '') AS ids FROM truth""",
        "finding": """
        SELECT 'duplicate_row' AS rule, source1_entity_id AS offender FROM file_row
        GROUP BY source1_entity_id HAVING count(*) > 1
        UNION ALL
        SELECT DISTINCT 'repeated_id', source1_entity_id FROM file_row
        WHERE len(string_split(ids, ',')) <> len(list_distinct(string_split(ids, ',')))
        UNION ALL
        SELECT 'missing_required', entity_id FROM rec WHERE source = 's1'
           AND entity_id NOT IN (SELECT source1_entity_id FROM file_row)
        UNION ALL
        SELECT DISTINCT 'extra_row', source1_entity_id FROM file_row
        WHERE source1_entity_id NOT IN (SELECT entity_id FROM rec WHERE source = 's1')
        UNION ALL
        SELECT DISTINCT 'self_match', id FROM file_id WHERE id LIKE 'S1-%'
        UNION ALL
        SELECT DISTINCT 'wrong_prefix', id FROM file_id WHERE NOT regexp_matches(id, '^S[123]-')
        UNION ALL
        SELECT DISTINCT 'unknown_id', id FROM file_id WHERE regexp_matches(id, '^S[23]-')
           AND id NOT IN (SELECT entity_id FROM rec WHERE source <> 's1' AND address IS NOT NULL)
        UNION ALL
        SELECT 'malformed_row', 'note ' || entity_id FROM rec WHERE source = 's3' AND country = 'fr'
        UNION ALL
        SELECT DISTINCT 'not_a_candidate', source1_entity_id FROM file_id f
        WHERE NOT EXISTS (SELECT 1 FROM (SELECT source1_entity_id, unnest(string_split(ids, ',')) AS id
                                         FROM s2_truth) s
                          WHERE s.source1_entity_id = f.source1_entity_id AND s.id = f.id)""",
        "file_finding": """
        SELECT 'matching' AS file, 'unknown_id' AS rule, 'error' AS severity, entity_id AS offender
        FROM pair
        WHERE entity_id NOT IN (SELECT entity_id FROM rec WHERE source <> 's1' AND address IS NOT NULL)
        UNION
        SELECT 'candidate', 'unknown_id', 'error', entity_id FROM pair WHERE entity_id LIKE 'S2-%'
           AND entity_id NOT IN (SELECT entity_id FROM rec WHERE source <> 's1' AND address IS NOT NULL)
        UNION
        SELECT 'matching', 'not_a_candidate', 'warning', source1_entity_id FROM pair
        WHERE entity_id LIKE 'S3-%'""",
    }


def _sql(
    body: str, dataset: str, guard: bool = True, filled: bool = False, cap: int = CAP, only: str = ""
) -> str:
    """``body`` after the named subqueries it needs, in order; ``only`` restricts the sweep."""
    ctes = _ctes(dataset, guard, filled, cap)
    ctes["scored"] += f" {only}"
    names = "|".join(ctes)
    needed: list[str] = []

    def visit(text: str) -> None:
        for found in re.findall(rf"(?:FROM|JOIN)\s+({names})\b", text):
            if found not in needed and ctes[found] is not text:
                visit(ctes[found])
                if found not in needed:
                    needed.append(found)

    visit(body)
    if not needed:
        return body
    listed = ",\n".join(f"{n} AS MATERIALIZED ({ctes[n]})" for n in needed)
    return f"WITH {listed}\n{body}"


def _word_map(table: dict[str, str], words: str) -> str:
    entries = ", ".join(f"'{k}': '{v}'" for k, v in table.items())
    return f"list_transform({words}, lambda w: coalesce(MAP {{{entries}}}[w], w))"


def _normal(expression: str) -> str:
    return _sql(f"SELECT entity_id, {expression} AS normal FROM raw", DOCUMENTS)


def _words(field: str) -> str:
    return f"list_filter(string_split({_RICH.format(field)}, ' '), lambda w: w <> '')"


_name_words = _word_map(NAME_WORDS, _words("business_name"))
_address_words = _word_map(ADDRESS_WORDS, _words("business_address"))
_legal = ", ".join(f"'{w}'" for w in LEGAL_WORDS)


def _joined(words: str, by: str = " ") -> str:
    return f"coalesce(array_to_string({words}, '{by}'), '')"


_PAIR = "source1_entity_id, candidate_entity_id, source"
_FEATURES = ", ".join(FEATURES)
_TOTALS = ", ".join(
    f"sum(round({f} * 1000000)::BIGINT)::BIGINT AS {f}"
    if f.endswith("_ratio")
    else f"sum({f})::BIGINT AS {f}"
    for f in FEATURES
)
_TOTAL_SQL = (
    f"SELECT source1_entity_id, count(*) AS pairs, {_TOTALS} FROM feature GROUP BY source1_entity_id"
)
_RESULT_SQL = "SELECT * FROM result"
_LISTS_SQL = """
SELECT r.entity_id AS source1_entity_id,
       coalesce(string_agg(DISTINCT c.candidate_entity_id, ',' ORDER BY c.candidate_entity_id), '')
           AS candidate_entity_ids
FROM rec r LEFT JOIN cand c ON c.source1_entity_id = r.entity_id
WHERE r.source = 's1' GROUP BY r.entity_id"""
_LABELLED_SQL = f"SELECT {_PAIR}, label::INT AS label, {_FEATURES} FROM feature"
_BLOCK_SQL = "SELECT key_type, block_key, source, array_to_string(ids, ',') AS entity_ids FROM block"


def _offenders(rule: str) -> str:
    return _sql(f"SELECT offender FROM finding WHERE rule = '{rule}'", DOCUMENTS)


def _report(source: str, severity: str, columns: str = "rule") -> str:
    return f"""
SELECT {columns}, {severity} AS severity, count(*) AS n,
       array_to_string(list(offender ORDER BY offender)[1:5], ', ') AS examples
FROM {source} GROUP BY ALL"""


def _recall(suffix: str, **options) -> dict[str, str]:
    bodies = {
        "pair_recall": """SELECT count(*) AS true_pairs, sum(found)::BIGINT AS found_pairs,
        sum(found)::DOUBLE / count(*) AS pair_recall FROM found""",
        "entities_any_match": "SELECT DISTINCT source1_entity_id FROM found WHERE found = 1",
        "entities_all_match": "SELECT source1_entity_id FROM found GROUP BY ALL HAVING sum(found) = count(*)",
        "blocking_metrics": """
SELECT (SELECT count(*) FROM found) AS true_pairs,
       (SELECT sum(found)::BIGINT FROM found) AS found_pairs,
       (SELECT count(DISTINCT source1_entity_id) FROM found) AS entities_with_truth,
       (SELECT count(DISTINCT source1_entity_id) FROM found WHERE found = 1) AS entities_any_found,
       (SELECT count(*) FROM (SELECT source1_entity_id FROM found GROUP BY ALL
                              HAVING sum(found) = count(*))) AS entities_all_found,
       sum(n_candidates)::BIGINT AS candidate_pairs,
       sum(n_candidates)::DOUBLE / count(*) AS avg_candidates,
       max(n_candidates) AS max_candidates,
       count(*) FILTER (n_candidates = 0) AS zero_candidate_s1
FROM per_s1""",
    }
    return {name + suffix: _sql(body, DOCUMENTS, **options) for name, body in bodies.items()}


ORACLE: dict[str, str] = _recall("") | _recall("_cap3", cap=CAP_3) | {
    "scan_sources": _sql("SELECT * FROM raw", DOCUMENTS),
    "scan_pages": _sql("SELECT * FROM raw", PAGES),
    "tsv_roundtrip": _sql("SELECT * EXCLUDE (source) FROM raw", DOCUMENTS),
    "source_counts": _sql("SELECT source, count(*) AS n FROM raw GROUP BY source", DOCUMENTS),
    "limit_source": _sql(
        f"SELECT * FROM rec WHERE source = 's1' ORDER BY entity_id LIMIT {LIMIT}", DOCUMENTS
    ),
    "s1_pages": _sql(
        f"""SELECT (row_number() OVER (ORDER BY entity_id) - 1) // {PAGE_SIZE} AS page, entity_id
        FROM rec WHERE source = 's1'""",
        DOCUMENTS,
    ),
    "s1_row_range": _sql(
        f"""SELECT * FROM (SELECT entity_id, row_number() OVER (ORDER BY entity_id) AS row_number
                           FROM rec WHERE source = 's1')
        WHERE row_number BETWEEN {FIRST_ROW} AND {LAST_ROW}""",
        DOCUMENTS,
    ),
    "candidate_records": _sql("SELECT * FROM rec WHERE source <> 's1'", DOCUMENTS),
    "match_targets": _sql("SELECT DISTINCT entity_id FROM rec WHERE source <> 's1'", DOCUMENTS),
    "normalize_basic": _sql("SELECT * FROM rec", DOCUMENTS),
    "normalize_rich": _sql(
        f"""SELECT entity_id, {_RICH.format("country")} AS country, {_joined(_name_words)} AS name,
        {_joined(_address_words)} AS address, source FROM raw""",
        DOCUMENTS,
    ),
    "normalize_text": _normal(_RICH.format("business_name")),
    "normalize_name": _normal(_joined(_name_words)),
    "normalize_name_core": _normal(
        _joined(f"list_filter({_name_words}, lambda w: w NOT IN ({_legal}))")
    ),
    "normalize_address": _normal(_joined(_address_words)),
    # Folding full-width letters and digits gives the field's own form.
    "normalize_text_wide": _normal(_RICH.format("business_name")),
    "normalize_address_wide": _normal(_joined(_address_words)),
    "normalize_country": _normal(_RICH.format("country")),
    "address_token_array": _normal(_joined(_address_words, ",")),
    "address_numbers": _normal(
        _joined(rf"regexp_extract_all({_joined(_address_words)}, '\p{{Nd}}+')", ",")
    ),
    "name_tokens": _sql(
        "SELECT entity_id, source, country, unnest(string_split(name, ' ')) AS word FROM rec", DOCUMENTS
    ),
    "address_tokens": _sql(
        "SELECT entity_id, source, country, unnest(string_split(address, ' ')) AS word FROM rec",
        DOCUMENTS,
    ),
    "rare_name_tokens": _sql("SELECT country, word FROM rare WHERE key_type = 5", DOCUMENTS),
    "rare_address_tokens": _sql("SELECT country, word FROM rare WHERE key_type = 6", DOCUMENTS),
    "keys_basic": _sql("SELECT * FROM basic", DOCUMENTS),
    "keys_basic_pages": _sql("SELECT * FROM basic", PAGES),
    "keys_basic_unguarded": _sql("SELECT * FROM basic", DOCUMENTS, guard=False),
    "keys_rare_name": _sql("SELECT * FROM rare_key WHERE key_type = 5", DOCUMENTS),
    "keys_rare_address": _sql("SELECT * FROM rare_key WHERE key_type = 6", DOCUMENTS),
    "keys_all": _sql("SELECT * FROM key", DOCUMENTS),
    "keys_all_unguarded": _sql("SELECT * FROM key", PAGES, guard=False),
    "block_sizes": _sql(
        f"""SELECT key_type, block_key, source, count(*) AS n FROM key WHERE source <> 's1'
        GROUP BY ALL HAVING count(*) <= {CAP}""",
        DOCUMENTS,
    ),
    "blocks": _sql(_BLOCK_SQL, DOCUMENTS),
    "blocks_cap20": _sql(_BLOCK_SQL, DOCUMENTS, cap=CAP_20),
    "candidate_pairs": _sql("SELECT * FROM cand", PAGES),
    "candidate_pairs_cap20": _sql("SELECT * FROM cand", PAGES, cap=CAP_20),
    "candidate_pairs_gaps": _sql("SELECT * FROM cand", GAPS),
    "candidate_pairs_unguarded": _sql("SELECT * FROM cand", GAPS, guard=False),
    "candidate_lists": _sql(_LISTS_SQL, DOCUMENTS),
    "candidate_lists_cap20": _sql(_LISTS_SQL, DOCUMENTS, cap=CAP_20),
    "candidate_lists_per_source": _sql(
        """
SELECT r.entity_id AS source1_entity_id,
       coalesce(string_agg(candidate_entity_id, ',' ORDER BY candidate_entity_id)
                FILTER (c.source = 's2'), '') AS candidate_s2_ids,
       coalesce(string_agg(candidate_entity_id, ',' ORDER BY candidate_entity_id)
                FILTER (c.source = 's3'), '') AS candidate_s3_ids
FROM rec r LEFT JOIN cand c ON c.source1_entity_id = r.entity_id
WHERE r.source = 's1' GROUP BY r.entity_id""",
        DOCUMENTS,
    ),
    "true_pairs": _sql("SELECT * FROM pair", DOCUMENTS),
    "truth_semi": _sql(
        """SELECT * FROM truth WHERE source1_entity_id IN
        (SELECT entity_id FROM rec WHERE source = 's1' AND address <> '')""",
        DOCUMENTS,
    ),
    "label_pairs": _sql(f"SELECT {_PAIR}, label::INT AS label FROM labelled", PAGES),
    "label_counts": _sql(
        """SELECT sum(label)::BIGINT AS positive_pairs, sum(1 - label)::BIGINT AS negative_pairs,
        count(*) AS training_pairs FROM labelled""",
        DOCUMENTS,
    ),
    "entity_split": _sql(
        """SELECT DISTINCT source1_entity_id,
        CASE WHEN ('0x' || substr(md5(source1_entity_id), 1, 8))::BIGINT % 5 = 0
             THEN 'validation' ELSE 'train' END AS split FROM cand""",
        DOCUMENTS,
    ),
    "entity_split_rows": _sql(
        f"""SELECT {_PAIR}, label::INT AS label, 'validation' AS split FROM labelled
        WHERE ('0x' || substr(md5(source1_entity_id), 1, 8))::BIGINT % 5 = 0""",
        PAGES,
    ),
    "pair_features": _sql(f"SELECT {_PAIR}, {_FEATURES} FROM feature", PAGES),
    "pair_features_unguarded": _sql(f"SELECT {_PAIR}, {_FEATURES} FROM feature_loose", PAGES),
    "pair_features_gaps": _sql(f"SELECT {_PAIR}, {_FEATURES} FROM feature", GAPS),
    "pair_features_filled": _sql(f"SELECT {_PAIR}, {_FEATURES} FROM feature", GAPS, filled=True),
    "labelled_features": _sql(_LABELLED_SQL, PAGES),
    "feature_totals": _sql(_TOTAL_SQL, DOCUMENTS),
    "feature_totals_unguarded": _sql(
        _TOTAL_SQL.replace("FROM feature", "FROM feature_loose"), DOCUMENTS
    ),
    "feature_totals_filled": _sql(_TOTAL_SQL, DOCUMENTS, filled=True),
    "feature_roundtrip": _sql(_LABELLED_SQL, PAGES),
    "candidates_per_s1": _sql("SELECT * FROM per_s1", DOCUMENTS),
    "zero_candidate_s1": _sql(
        "SELECT source1_entity_id FROM per_s1 WHERE n_candidates = 0", DOCUMENTS
    ),
    "blocking_summary": _sql(
        """
SELECT (SELECT count(*) FROM rec WHERE source = 's1') AS s1_rows,
       (SELECT count(*) FROM rec WHERE source = 's2') AS s2_rows,
       (SELECT count(*) FROM rec WHERE source = 's3') AS s3_rows,
       sum(n_candidates)::BIGINT AS candidate_pairs,
       sum(n_candidates)::DOUBLE / count(*) AS avg_candidates,
       count(*) FILTER (n_candidates = 0) AS zero_candidate_s1
FROM per_s1""",
        DOCUMENTS,
    ),
    "threshold_filter": _sql(f"SELECT {_PAIR}, probability FROM matched", PAGES),
    "threshold_sweep": _sql("SELECT * FROM swept", DOCUMENTS),
    "threshold_sweep_validation": _sql("SELECT * FROM swept", DOCUMENTS, only="WHERE %s" % _VALIDATION),
    "best_threshold": _sql(
        f"""SELECT coalesce((SELECT threshold FROM swept WHERE f05 > 0
                             ORDER BY f05 DESC, threshold LIMIT 1), {DEFAULT_THRESHOLD}::DOUBLE)
                   AS best_threshold,
                   max(f05) AS best_f05 FROM swept""",
        DOCUMENTS,
    ),
    "entity_f05": _sql("SELECT * FROM entity", DOCUMENTS),
    "macro_f05": _sql(
        "SELECT count(*) AS entities, round(avg(f05), 9) AS macro_f05 FROM entity", DOCUMENTS
    ),
    "result_lists": _sql(_RESULT_SQL, DOCUMENTS),
    "result_lists_pages": _sql(_RESULT_SQL, PAGES),
    "predict_summary": _sql(
        f"""SELECT (SELECT count(*) FROM rec WHERE source = 's1') AS s1_rows,
        count(*) AS candidate_pairs,
        count(*) FILTER (probability >= {THRESHOLD}) AS predicted_pairs,
        count(DISTINCT source1_entity_id) FILTER (probability >= {THRESHOLD}) AS s1_with_match,
        {THRESHOLD}::DOUBLE AS threshold FROM scored""",
        DOCUMENTS,
    ),
    "dq_duplicate_rows": _offenders("duplicate_row"),
    "dq_intra_dupes": _offenders("repeated_id"),
    "dq_missing_required": _offenders("missing_required"),
    "dq_extra_rows": _offenders("extra_row"),
    "dq_self_match": _offenders("self_match"),
    "dq_wrong_prefix": _offenders("wrong_prefix"),
    "dq_unknown_ids": _offenders("unknown_id"),
    "dq_malformed": _sql("SELECT offender AS line FROM finding WHERE rule = 'malformed_row'", DOCUMENTS),
    "dq_malformed_lines": _sql(
        """
SELECT place, value AS line FROM (
  SELECT value, row_number() OVER (ORDER BY value) AS place FROM (
    SELECT source1_entity_id || chr(9) || ids AS value FROM file_row
    UNION ALL SELECT 'note ' || entity_id FROM rec WHERE source = 's3' AND country = 'fr'))
WHERE NOT contains(value, chr(9))""",
        DOCUMENTS,
    ),
    "dq_match_subset": _offenders("not_a_candidate"),
    "dq_row_stats": _sql(
        """SELECT count(*) AS n_rows, count(*) FILTER (ids = '') AS empty_rows,
        count(*) FILTER (ids <> '') AS non_empty_rows FROM file_row""",
        DOCUMENTS,
    ),
    "dq_report": _sql(
        _report("finding", "CASE WHEN rule = 'not_a_candidate' THEN 'warning' ELSE 'error' END"), DOCUMENTS
    ),
    "dq_header": """
SELECT * FROM (VALUES
    ('unexpected_header', 'source1_entity_id' || chr(9) || 'candidate_entity_ids'),
    ('comma_header', 'source1_entity_id,candidate_entity_ids')) v(rule, offender)
WHERE EXISTS (SELECT 1 FROM documents)""",
    "dq_files": _sql(_report("file_finding", "severity", "file, rule"), DOCUMENTS),
    "dq_file_faults": _sql(
        """
SELECT * FROM (VALUES ('missing', 'matching', 'file_missing', 'error', 1::BIGINT),
                      ('empty', 'matching', 'file_empty', 'error', 1),
                      ('commas', 'matching', 'comma_header', 'error', 1),
                      ('no candidates', 'candidate', 'candidates_missing', 'warning', 1),
                      ('no ids', 'matching', 'id_check_off', 'warning', 1)) v("case", file, rule, severity, n)
UNION ALL
SELECT 'no candidates', 'matching', 'unknown_id', 'error', count(DISTINCT entity_id) FROM pair
WHERE entity_id LIKE 'S3-%' HAVING count(*) > 0""",
        DOCUMENTS,
    ),
    "file_ids": _sql("SELECT DISTINCT entity_id FROM raw WHERE source = 's1'", DOCUMENTS),
    "file_match_targets": _sql("SELECT DISTINCT entity_id FROM raw WHERE source <> 's1'", DOCUMENTS),
    "file_truth": _sql(
        """SELECT * FROM pair WHERE source1_entity_id IN
        (SELECT entity_id FROM rec WHERE source = 's1' AND address <> '')""",
        DOCUMENTS,
    ),
    "file_pipeline": _sql(
        f"SELECT * FROM result JOIN ({_LISTS_SQL}) USING (source1_entity_id)", DOCUMENTS
    ),
    "gbt_score": _sql(
        f"""
SELECT count(*) AS pairs, count(*) FILTER ({_VALIDATION}) AS validation_pairs,
       sum(label)::BIGINT AS positive_pairs, count(*) FILTER (name_length_diff IS NULL) AS pairs_without_length,
       count(*) AS scored_pairs, true AS entities_on_one_side, true AS as_good_as_constant
FROM feature""",
        GAPS,
    ),
    "gbt_roundtrip": _sql(
        """SELECT count(*) AS pairs, count(*) AS equal_scores, true AS threshold_kept, true AS features_kept,
        0::BIGINT AS accepted_without_score, true AS forest_kept FROM cand""",
        GAPS,
    ),
    "gbt_first_splits": _sql("SELECT feature, round(max(gain), 6) AS gain FROM gain_split GROUP BY feature", GAPS),
    "gbt_stump": _sql("SELECT round(score, 9) AS probability, count(*) AS pairs FROM stump GROUP BY 1", GAPS),
    "file_matcher": _sql(
        """
SELECT entity_id AS source1_entity_id, coalesce(ids, '') AS matched_entity_ids
FROM rec LEFT JOIN (
  SELECT source1_entity_id, string_agg(candidate_entity_id, ',' ORDER BY candidate_entity_id) AS ids
  FROM stump JOIN stump_threshold ON score >= threshold GROUP BY source1_entity_id
) ON entity_id = source1_entity_id WHERE source = 's1'""",
        GAPS,
    ),
}

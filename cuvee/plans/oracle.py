"""The registered queries in plain SQL over the driver tables, for the queries that SQL can express exactly."""

from __future__ import annotations

from cuvee.functions.words import PUNCTUATION, STOP_WORDS
from cuvee.plans.catalog import MEAN_MIN_COUNT, POOL_COUNTS, SETTINGS, TEST_SIZE
from cuvee.plans.fixture import REVIEWS_NO_TEXT_SQL, REVIEWS_SQL
from cuvee.schema import POOLED, ROLES

CATS = ROLES.categorical
R = f"r AS ({REVIEWS_NO_TEXT_SQL})"


def fold(x: str) -> str:
    return f"replace(strip_accents({x}), 'ß', 'ss')"


def norm(x: str, missing: str = "_missing_") -> str:
    return fold(f"lower(coalesce({x}, '{missing}'))")


YEAR = r"CAST(nullif(regexp_extract(title, '(\d{4,})', 1), '') AS DOUBLE)"


def stripped(x: str) -> str:
    out = rf"regexp_replace({x}, '(\d+ )', '', 'g')"
    out = rf"regexp_replace({out}, '\((.+)\)\s*$', '')"
    return rf"regexp_replace({out}, '\s{{2,}}', ' ', 'g')"


def rounded(x: str) -> str:
    return f"round_even(({x}) * CAST(10 AS DOUBLE), 0) / CAST(10 AS DOUBLE)"


def percent(condition: str) -> str:
    return rounded(f"CAST(100 AS DOUBLE) * count(*) FILTER (WHERE {condition}) / count(*)")


# The word rules one after the other, each without look-around: what stands apart is padded with blanks.
_WORD_RULES = [
    (r"[ \t\n\r\f\x0b]+", " "),
    (r'(^|[ (\[{<])"', r"\1 `` "),
    (r"(^|[^.])\.([\])}>\"']*)( |$)", r"\1 . \2\3"),
    (r"(\.\.\.|--)", r" \1 "),
    (r'([;@#$%&?!\[\](){}<>"])', r" \1 "),
    (r"([:,])", r" \1 "),
    (r" ([:,]) ([0-9])", r"\1\2"),
    (r'"', "''"),
    (r"([^' ])('s|'m|'d|'ll|'re|'ve|'|n't)( |$)", r"\1 \2\3"),
    (r"\b(?:(can)(not)|(gim)(me)|(gon)(na)|(got)(ta))\b", r"\1\3\5\7 \2\4\6\8"),
    (r"\b(?:(lem)(me)|(wan)(na)|(more)('n)|(d)('ye))\b", r"\1\3\5\7 \2\4\6\8"),
    (r"( 't)(is|was)\b", r"\1 \2"),
]


def quoted(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def words(x: str) -> str:
    for pattern, replacement in _WORD_RULES:
        x = f"regexp_replace({x}, {quoted(pattern)}, {quoted(replacement)}, 'g')"
    return f"string_split({x}, ' ')"


def histogram(source: str, bins: int, outputs: str = "bin, from_value, to_value, n") -> str:
    """``source`` selects one column x."""
    return f"""WITH {R}, v AS ({source}),
b AS (SELECT min(x) AS lo, max(x) AS hi, (max(x) - min(x)) / {bins} AS w FROM v),
g AS (SELECT least(CAST(floor((x - lo) / (hi - lo) * {bins}) AS BIGINT), {bins - 1}) AS k, x, lo, w
      FROM v, b WHERE x IS NOT NULL),
c AS (SELECT k - CASE WHEN x < k * w + lo THEN 1 ELSE 0 END
               + CASE WHEN x >= (k + 1) * w + lo AND k <> {bins - 1} THEN 1 ELSE 0 END AS bin, count(*) AS n
      FROM g GROUP BY 1),
h AS (SELECT s.bin, s.bin * w + lo AS from_value,
             CASE WHEN s.bin = {bins - 1} THEN hi ELSE (s.bin + 1) * w + lo END AS to_value,
             coalesce(c.n, 0) AS n
      FROM (SELECT unnest(range({bins})) AS bin) s LEFT JOIN c ON c.bin = s.bin, b)
SELECT {outputs} FROM h"""


def by_column(source: str, value: str = "{c}", extra: str = "") -> str:
    """(column, value) rows of all category columns of ``source``."""
    return " UNION ALL ".join(
        f"SELECT '{c}' AS \"column\", {value.format(c=c)} AS value{extra} FROM {source}" for c in CATS
    )


CLEAN = f"n AS (SELECT row_id, points, price, {', '.join(f'{norm(c)} AS {c}' for c in CATS)} FROM r)"
IS_TEST = f"row_id < CAST(floor((SELECT count(*) FROM r) * {TEST_SIZE}) AS BIGINT)"
SPLIT = f"""{R}, {CLEAN}, test AS (SELECT * FROM n WHERE {IS_TEST}), train AS (SELECT * FROM n WHERE NOT {IS_TEST})"""
LONG_TRAIN = f"long AS ({by_column('train', extra=', points')})"

# Errors of predicting the training mean of the winery.
ERRORS = f"""{SPLIT},
m AS (SELECT winery, avg(points) AS mean FROM train GROUP BY winery HAVING count(*) >= 10),
mid AS (SELECT median(price) AS price FROM train),
p AS (SELECT t.row_id, CAST(t.points AS DOUBLE) AS label, coalesce(t.price, mid.price) AS price,
             coalesce(m.mean, (SELECT avg(points) FROM train)) AS prediction
      FROM test t LEFT JOIN m ON m.winery = t.winery, mid),
e AS (SELECT *, label - prediction AS error, abs(label - prediction) AS abs_error FROM p)"""


def target_means(min_count: int) -> str:
    return f"""{LONG_TRAIN},
m AS (SELECT "column", value, count(*) AS n, avg(points) AS mean FROM long GROUP BY ALL HAVING count(*) >= {min_count})"""


def price_line(direction: str, condition: str) -> str:
    return f"""SELECT '{direction}' AS direction, count(price) AS n, min(price) AS min_price,
median(price) AS median_price, {rounded('avg(price)')} AS mean_price, max(price) AS max_price FROM e WHERE {condition}"""


def term_weights(source: str, sublinear: bool) -> str:
    """``source`` selects (row_id, t) with t the normalised text."""
    tf = "1 + ln(CAST(tf AS DOUBLE))" if sublinear else "CAST(tf AS DOUBLE)"
    return rf"""WITH {R}, s AS ({source}),
t AS (SELECT row_id, unnest(regexp_extract_all(t, '\b\w\w+\b')) AS term FROM s),
c AS (SELECT row_id, term, count(*) AS tf FROM t GROUP BY ALL),
v AS (SELECT term, CAST(row_number() OVER (ORDER BY term) - 1 AS INTEGER) AS term_id,
             ln((CAST(1 AS DOUBLE) + (SELECT count(*) FROM s)) / (CAST(1 AS DOUBLE) + count(*))) + 1 AS idf
      FROM c GROUP BY term),
w AS (SELECT row_id, term_id, ({tf}) * idf AS w FROM c JOIN v USING (term))
SELECT row_id, term_id, round(w / sqrt(sum(w * w) OVER (PARTITION BY row_id)), 6) AS weight FROM w"""


def pooled(frequent: str, source: str) -> str:
    columns = ", ".join(
        f"CASE WHEN {c} IN (SELECT value FROM {frequent} WHERE \"column\" = '{c}') THEN {c} ELSE '_other_' END AS {c}"
        for c in CATS
    )
    return f"SELECT row_id, {columns} FROM {source}"


def frequent(source: str, counts: dict[str, int]) -> str:
    return " UNION ALL ".join(
        f"SELECT '{c}' AS \"column\", {c} AS value FROM {source} GROUP BY {c} HAVING count({c}) >= {k}"
        for c, k in counts.items()
    )


TRAIN_COUNTS = {c: int(n * (1 - TEST_SIZE)) for c, n in POOL_COUNTS.items()}
FITTED_POOL = f"{SPLIT}, f AS ({frequent('train', TRAIN_COUNTS)})"

_VIEW = {
    "country": fold("lower(country)"),
    "designation": fold("lower(designation)"),
    **{c: c for c in ("province", "region_1", "region_2", "taster_name", "taster_twitter_handle", "variety", "winery")},
    "title": f"lower({stripped('title')})",
    "year": f"CAST({YEAR} AS VARCHAR)",
    "price": "CAST(price AS VARCHAR)",
}


def viewed(label: bool) -> str:
    parts = []
    for c, x in _VIEW.items():
        if label and c == "price":
            continue
        if label and c not in ("title", "year"):
            x = f"coalesce({x}, 'missing')"
        parts.append(f"SELECT '{c}' AS \"column\", {x} AS value FROM r")
    return " UNION ALL ".join(parts)


STOPPED = ", ".join(quoted(w) for w in [*STOP_WORDS, *PUNCTUATION, ""])
# How the symbols of the query are spelled, written out once more.
SPELLED = {
    "½": "1/2", "°": "deg", "€": "EUR", "©": "(c)", "£": "PS", "¡": "!", "×": "x", "•": "*", "™": "(tm)", "–": "-", "—": "--",
    "“": '"', "”": '"', "’": "'", "…": "...", "±": "+-", "¿": "?", "÷": "/", "º": "o",
}
OUT_OF_FOLD = " ".join(
    f""", {c}_o AS (SELECT {c} AS v, fold, sum(count(*)) OVER (PARTITION BY {c}) - count(*) AS n,
                        sum(sum(points)) OVER (PARTITION BY {c}) - sum(points) AS s FROM f GROUP BY {c}, fold)"""
    for c in ("country", "winery")
)
GAPS = "SELECT c_custkey * 10 + 1000 AS row_id FROM customer"

ORACLE: dict[str, str] = {
    "normalize_categories": f"""WITH {R} SELECT row_id, {', '.join(f'{norm(c)} AS {c}' for c in [*CATS, 'designation'])}
FROM r""",
    "fold_documents": f"SELECT doc_id, {norm('text')} AS text FROM documents",
    "title_year": f"WITH {R} SELECT row_id, {YEAR} AS year FROM r",
    "title_clean": f"WITH {R} SELECT row_id, {stripped(norm('title'))} AS title FROM r",
    "title_geo_mismatch": rf"""WITH {R}, g AS MATERIALIZED (
  SELECT row_id, nullif(regexp_extract(title, '\((.+)\)\s*$', 1), '') AS title_geo, province, region_1, region_2 FROM r)
SELECT * FROM g WHERE title_geo IS NOT NULL AND title_geo IS DISTINCT FROM province
  AND title_geo IS DISTINCT FROM region_1 AND title_geo IS DISTINCT FROM region_2""",
    "implication_violations": f"""WITH {R}
SELECT count(*) FILTER (WHERE taster_name IS NULL AND taster_twitter_handle IS NOT NULL) AS violations FROM r""",
    "document_tokens": f"""WITH t AS (SELECT doc_id AS row_id, unnest({words(norm('text'))}) AS term FROM documents)
SELECT row_id, term, CAST(count(*) AS INTEGER) AS n FROM t WHERE term NOT IN ({STOPPED}) GROUP BY ALL""",
    "document_words": f"""SELECT doc_id AS row_id, array_to_string(list_filter({words(norm('text'))}, lambda t: t NOT IN ({STOPPED})), ' ') AS words
FROM documents""",
    "csv_scan": REVIEWS_SQL,
    "csv_malformed": """
WITH c AS (SELECT c_custkey AS k, CASE WHEN c_custkey % 3 = 1 THEN 13 ELSE 14 END + CASE WHEN c_custkey % 13 = 1 THEN 2 ELSE 0 END AS cells
           FROM customer),
r AS (SELECT CASE WHEN cells <> 14 THEN 'wrong number of cells' WHEN k % 7 = 1 THEN 'no row id'
                  WHEN k % 5 = 1 THEN 'points is no int' WHEN k % 11 = 1 THEN 'price is no double' ELSE 'sound' END AS reason FROM c)
SELECT reason, count(*) AS n FROM r GROUP BY reason""",
    "fold_symbols": f"""SELECT p_partkey, strip_accents(p_name) || [{', '.join(quoted(x) for x in SPELLED.values())}]
    [CAST(p_partkey % {len(SPELLED)} AS INTEGER) + 1] || 'e' AS name FROM part""",
    "histogram_nan": histogram(
        "SELECT CASE WHEN event_id % 11 <> 0 AND event_id % 13 <> 0 THEN CAST(value AS DOUBLE) END AS x FROM events", 10
    ),
    "split_hash": f"""WITH {R} SELECT row_id, CASE WHEN CAST('0x' || left(md5('7:' || row_id), 15) AS BIGINT) % 1000000 < 200000
    THEN 'test' ELSE 'train' END AS split FROM r""",
    "sample_rows": """SELECT o_orderkey, o_totalprice FROM orders
ORDER BY CAST('0x' || left(md5('7:' || o_orderkey), 15) AS BIGINT), o_orderkey LIMIT 1000""",
    "split_gaps": f"""WITH g AS ({GAPS})
SELECT row_id, CASE WHEN row_number() OVER (ORDER BY row_id) <= floor(count(*) OVER () * {TEST_SIZE}) THEN 'test' ELSE 'train' END AS split FROM g""",
    "kfold_gaps": f"WITH g AS ({GAPS}) SELECT row_id, CAST(ntile(7) OVER (ORDER BY row_id) - 1 AS INTEGER) AS fold FROM g",
    "target_mean_out_of_fold": f"""WITH {SPLIT}, f AS (SELECT *, CAST(row_id % 5 AS INTEGER) AS fold FROM train)
{OUT_OF_FOLD}, m AS (SELECT a.fold, (SELECT avg(points) FROM f WHERE f.fold <> a.fold) AS mean FROM (SELECT DISTINCT fold FROM f) a)
SELECT f.row_id, round(CASE WHEN c.n >= 20 THEN c.s / c.n ELSE m.mean END, 6) AS country,
       round(CASE WHEN w.n >= 20 THEN w.s / w.n ELSE m.mean END, 6) AS winery
FROM f JOIN m USING (fold) LEFT JOIN country_o c ON c.v = f.country AND c.fold = f.fold LEFT JOIN winery_o w ON w.v = f.winery AND w.fold = f.fold""",
    "feature_names": f"""WITH {SPLIT}, {LONG_TRAIN},
counts AS (SELECT "column" AS c, value, count(*) AS n FROM long GROUP BY ALL),
levels AS (SELECT DISTINCT c, CASE WHEN n >= CASE c WHEN 'winery' THEN {SETTINGS.pool_min_count_winery} ELSE {SETTINGS.pool_min_count} END
                                   THEN value ELSE '{POOLED}' END AS level FROM counts),
lines AS (
  SELECT 0 AS block, 0 AS part, i - 1 AS ordinal, [{', '.join(map(quoted, ROLES.numeric))}][i] AS source_col, 'numeric' AS kind, NULL AS level,
         [{', '.join(map(quoted, ROLES.numeric))}][i] AS name FROM (SELECT unnest(range(1, {len(ROLES.numeric) + 1})) AS i)
  UNION ALL SELECT 1, 0, i - 1, [{', '.join(map(quoted, CATS))}][i], 'mean', NULL, [{', '.join(map(quoted, CATS))}][i] || '_avg_points'
  FROM (SELECT unnest(range(1, {len(CATS) + 1})) AS i)
  UNION ALL SELECT 2, list_position([{', '.join(map(quoted, CATS))}], c), row_number() OVER (PARTITION BY c ORDER BY level) - 1, c, 'level', level,
         c || '_' || level FROM levels
  UNION ALL SELECT 3, p, i, c, 'topic', NULL, c || '_topic_' || i
  FROM (SELECT p, c, unnest(range(k)) AS i FROM (VALUES {', '.join(f"({p}, {quoted(c)}, {SETTINGS.topics[c]})" for p, c in enumerate(ROLES.text))}) t(p, c, k)))
SELECT CAST(row_number() OVER (ORDER BY block, part, ordinal) - 1 AS INTEGER) AS feature_idx, name, source_col, kind, level,
       CAST(ordinal AS INTEGER) AS ordinal FROM lines""",
    "search_checks": """SELECT * FROM (VALUES ('rows', 500), ('candidates', 100), ('folds', 5), ('best rank', 1), ('wrong means', 0)) t(name, n)""",
    "topic_checks": f"""SELECT 'texts' AS name, count(*) AS n FROM documents
WHERE regexp_matches(array_to_string(list_filter({words(norm('text'))}, lambda t: t NOT IN ({STOPPED})), ' '), '\\w\\w')
UNION ALL SELECT 'below zero', 0 UNION ALL SELECT 'off the optimum', 0 UNION ALL SELECT 'rising rounds', 0""",
    "feature_checks": f"""SELECT 'train' AS name, count(*) - CAST(floor(count(*) * {TEST_SIZE}) AS BIGINT) AS n FROM orders
UNION ALL SELECT 'test', CAST(floor(count(*) * {TEST_SIZE}) AS BIGINT) FROM orders
UNION ALL SELECT 'wrong width', 0 UNION ALL SELECT 'not a number', 0 UNION ALL SELECT 'names twice', 0""",
    "forest_checks": f"""SELECT 'predictions' AS name, CAST(floor(count(*) * {TEST_SIZE}) AS BIGINT) AS n FROM orders
UNION ALL SELECT 'beyond the labels', 0 UNION ALL SELECT 'kept', 29 UNION ALL SELECT 'unnamed', 0 UNION ALL SELECT 'top', 20
UNION ALL SELECT 'misplaced', 0""",
    "profile_columns": f"""WITH {R}, v AS ({viewed(False)})
SELECT "column", count(*) AS n_rows, count(*) - count(value) AS n_missing,
       count(DISTINCT value) + CASE WHEN count(*) > count(value) THEN 1 ELSE 0 END AS n_distinct
FROM v GROUP BY "column\"""",
    "distinct_estimates": f"""WITH {R}, v AS ({viewed(False)})
SELECT "column", count(*) AS n_rows, count(*) - count(value) AS n_missing,
       count(DISTINCT value) + CASE WHEN count(*) > count(value) THEN 1 ELSE 0 END AS n_distinct, true AS within
FROM v GROUP BY "column\"""",
    "value_counts_all": f"""WITH {R}, v AS ({viewed(True)}) SELECT "column", value, count(*) AS n FROM v GROUP BY ALL""",
    "value_counts": f"""WITH {R} SELECT variety AS value, count(*) AS n FROM r WHERE variety IS NOT NULL GROUP BY variety
ORDER BY n DESC, value""",
    "year_counts": f"""WITH {R} SELECT {YEAR} AS value, count(*) AS n FROM r GROUP BY 1 ORDER BY n DESC, value NULLS FIRST""",
    "event_counts": "SELECT user_id AS value, count(*) AS n FROM events GROUP BY user_id ORDER BY n DESC, value",
    "points_histogram": histogram("SELECT CAST(points AS DOUBLE) AS x FROM r", 10),
    "price_histogram": histogram("SELECT price AS x FROM r WHERE price < 950", 25),
    "lineitem_histogram": histogram("SELECT l_extendedprice AS x FROM lineitem", 100),
    "split_prefix": f"WITH {R} SELECT row_id, CASE WHEN {IS_TEST} THEN 'test' ELSE 'train' END AS split FROM r",
    "split_stored": f"WITH {R} SELECT row_id, points, winery FROM r WHERE NOT {IS_TEST}",
    "kfold_assign": f"WITH {R} SELECT row_id, CAST(ntile(7) OVER (ORDER BY row_id) - 1 AS INTEGER) AS fold FROM r",
    "ordered_positions": "SELECT c_name, row_number() OVER (ORDER BY c_name) - 1 AS position FROM customer",
    "impute_median": f"""WITH {R}, y AS (SELECT row_id, {YEAR} AS year, price FROM r),
m AS (SELECT median(year) AS year, median(price) AS price FROM y)
SELECT row_id, coalesce(y.year, m.year) AS year, round(coalesce(y.price, m.price), 6) AS price FROM y, m""",
    "event_median": """WITH v AS (SELECT event_id, CASE WHEN event_type <> 'error' THEN value END AS value FROM events)
SELECT event_id, round(coalesce(value, (SELECT median(value) FROM v)), 6) AS value FROM v""",
    "target_mean_table": f"""WITH {SPLIT}, {target_means(10)}
SELECT "column", value, n, round(mean, 6) AS mean FROM m""",
    "target_mean_encode": f"""WITH {SPLIT}, {target_means(MEAN_MIN_COUNT)}, o AS (SELECT avg(points) AS mean FROM train)
SELECT t.row_id, {', '.join(f'round(coalesce(m_{c}.mean, o.mean), 6) AS {c}_avg_points' for c in CATS)}
FROM test t CROSS JOIN o
{' '.join(f"LEFT JOIN m m_{c} ON m_{c}.column = '{c}' AND m_{c}.value = t.{c}" for c in CATS)}""",
    "label_mean_encode": """WITH l AS (SELECT d.source, d.lang, l.quality FROM documents d JOIN labels l USING (doc_id)),
s AS (SELECT source, avg(quality) AS mean FROM l GROUP BY source HAVING count(*) >= 20),
g AS (SELECT lang, avg(quality) AS mean FROM l GROUP BY lang HAVING count(*) >= 20),
o AS (SELECT avg(quality) AS mean FROM l)
SELECT d.doc_id, round(coalesce(s.mean, o.mean), 6) AS source_avg_quality,
       round(coalesce(g.mean, o.mean), 6) AS lang_avg_quality
FROM documents d CROSS JOIN o LEFT JOIN s ON s.source = d.source LEFT JOIN g ON g.lang = d.lang""",
    "lineitem_mean_encode": """WITH p AS (
  SELECT l_partkey, avg(l_quantity) AS mean FROM lineitem GROUP BY l_partkey HAVING count(*) >= 30),
s AS (SELECT l_suppkey, avg(l_quantity) AS mean FROM lineitem GROUP BY l_suppkey HAVING count(*) >= 30),
o AS (SELECT avg(l_quantity) AS mean FROM lineitem)
SELECT l.l_orderkey, l.l_quantity, round(coalesce(p.mean, o.mean), 6) AS l_partkey_avg_l_quantity,
       round(coalesce(s.mean, o.mean), 6) AS l_suppkey_avg_l_quantity
FROM lineitem l CROSS JOIN o LEFT JOIN p ON p.l_partkey = l.l_partkey LEFT JOIN s ON s.l_suppkey = l.l_suppkey""",
    "pool_rare": f"""WITH {R}, {CLEAN}, f AS ({frequent('n', POOL_COUNTS)}) {pooled('f', 'n')}""",
    "pool_rare_fitted": f"WITH {FITTED_POOL} {pooled('f', 'test')}",
    "one_hot": f"""WITH {FITTED_POOL}, pt AS ({pooled('f', 'train')}), pe AS ({pooled('f', 'test')}),
levels AS (SELECT DISTINCT * FROM ({' UNION ALL '.join(
        f'''SELECT {i} AS rank, '{c}' AS "column", {c} AS value FROM pt''' for i, c in enumerate(CATS))})),
d AS (SELECT "column", value, row_number() OVER (ORDER BY rank, value) - 1 AS idx FROM levels),
x AS ({by_column('pe', extra=', row_id')})
SELECT x.row_id, x."column", d.idx FROM x JOIN d ON d."column" = x."column" AND d.value = x.value""",
    "tfidf_raw": term_weights(f"SELECT row_id, {norm('designation')} AS t FROM r", sublinear=False),
    "tfidf_sublinear": term_weights(f"SELECT doc_id AS row_id, {norm('text')} AS t FROM documents", sublinear=True),
    "error_rows": f"""WITH {ERRORS} SELECT row_id, label, round(price, 6) AS price, round(prediction, 6) AS prediction,
round(error, 6) AS error, round(abs_error, 6) AS abs_error FROM e""",
    "error_bands": f"""WITH {ERRORS}
SELECT 'below 0.5' AS band, {percent('abs_error < 0.5')} AS pct FROM e
UNION ALL SELECT 'at most 1', {percent('abs_error <= 1')} FROM e
UNION ALL SELECT 'at most 2', {percent('abs_error <= 2')} FROM e
UNION ALL SELECT 'at most 3', {percent('abs_error <= 3')} FROM e""",
    "error_direction": f"""WITH {ERRORS}
SELECT 'under' AS direction, 2 AS points, 'over' AS direction_as_reported, {percent('error > 2')} AS pct FROM e
UNION ALL SELECT 'under', 3, 'over', {percent('error > 3')} FROM e
UNION ALL SELECT 'over', 2, 'under', {percent('error < -2')} FROM e
UNION ALL SELECT 'over', 3, 'under', {percent('error < -3')} FROM e""",
    "error_summary": f"""WITH {ERRORS} SELECT count(*) AS n, {rounded('avg(abs_error)')} AS mae,
{rounded('median(abs_error)')} AS median_ae, {rounded('sqrt(avg(error * error))')} AS rmse,
{rounded('avg(sqrt(error * error))')} AS rmse_as_reported, {rounded('min(abs_error)')} AS min_ae,
{rounded('max(abs_error)')} AS max_ae FROM e""",
    "error_histogram": histogram(f"WITH {ERRORS} SELECT error AS x FROM e", 10, "bin, n"),
    "price_by_error_direction": f"""WITH {ERRORS} {price_line('all', 'true')}
UNION ALL {price_line('under', 'error > 3')} UNION ALL {price_line('over', 'error < -3')}""",
    "bias_by_score": f"WITH {ERRORS} SELECT label, count(*) AS n, round(avg(error), 6) AS mean_error FROM e GROUP BY label",
    "calibration_bins": f"""WITH {ERRORS} SELECT label, floor(prediction) AS predicted_from, count(*) AS n FROM e
GROUP BY ALL""",
    "axis_bounds": f"""WITH {ERRORS} SELECT round(least(min(label), min(prediction)), 6) AS lower,
round(greatest(max(label), max(prediction)), 6) AS upper FROM e""",
}

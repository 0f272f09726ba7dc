"""DuckDB SQL for the training-data queries that SQL can express."""

_LOWER = "translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_WORDS = (
    "regexp_extract_all(" + _LOWER.format("coalesce(text, '')") + r", '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"
)

WINNOWING = f"""
WITH d AS (SELECT doc_id, {_WORDS} AS w FROM documents),
b AS (SELECT item_id, {_WORDS} AS w FROM benchmark),
runs AS (
  SELECT DISTINCT item_id, least(10, len(w)) AS n,
         array_to_string(w[i : i + least(10, len(w)) - 1], ' ') AS t
  FROM (SELECT item_id, w, unnest(range(1, len(w) - least(10, len(w)) + 2)) AS i FROM b WHERE len(w) > 0)
),
doc_runs AS (
  SELECT doc_id, n, i, array_to_string(w[i : i + n - 1], ' ') AS t
  FROM (SELECT doc_id, w, n, unnest(range(1, len(w) - n + 2)) AS i
        FROM d, (SELECT DISTINCT n FROM runs) WHERE len(w) >= n)
),
hits AS (SELECT doc_id, i, n, item_id FROM doc_runs JOIN runs USING (n, t)),
words AS (
  SELECT doc_id, count(DISTINCT p) AS n_hit
  FROM (SELECT doc_id, unnest(range(i, i + n)) AS p FROM (SELECT DISTINCT doc_id, i, n FROM hits))
  GROUP BY doc_id
),
items AS (
  SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS listed
  FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS item FROM hits) GROUP BY doc_id
)
SELECT d.doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit,
       coalesce(n_items, 0) AS n_items, sha256(coalesce(listed, '')) AS items_sha256,
       coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN words USING (doc_id) LEFT JOIN items USING (doc_id)
"""


def _fits(host: str, path: str) -> str:
    return f"(host = '{host}' OR ends_with(host, '.{host}')) AND starts_with(path, '{path}')"


URL_FILTER = f"""
WITH r AS (
  SELECT page_id, CASE WHEN position('://' IN url) > 0
    THEN substr(url, position('://' IN url) + 3) ELSE '' END AS rest FROM pages
),
u AS (
  SELECT page_id, {_LOWER.format("regexp_extract(rest, '^([^/?#]*)', 1)")} AS host,
         regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path FROM r
),
v AS (
  SELECT page_id, host, path, CASE
    WHEN {_fits("example.org", "/en/1")} THEN 'example.org/en/1'
    WHEN {_fits("example.org", "/es/")} THEN 'example.org/es/'
    WHEN {_fits("com", "/fr/")} THEN 'com/fr/'
    WHEN {_fits("com", "/de/")} THEN 'com/de/'
    WHEN {_fits("org", "/")} THEN 'org/' END AS rule FROM u
)
SELECT page_id, host, path, rule,
       CASE WHEN rule IN ('example.org/es/', 'example.org/en/1', 'com/de/') THEN 'block' ELSE 'allow' END AS verdict
FROM v
"""

_SPACE = "' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)"

LINE_DEDUP = f"""
WITH d AS (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS ls FROM documents),
l AS (SELECT doc_id, i, ls[i] AS line, {_LOWER.format(f"trim(ls[i], {_SPACE})")} AS k
      FROM (SELECT doc_id, ls, unnest(range(1, len(ls) + 1)) AS i FROM d)),
f AS (SELECT k, min(doc_id) AS first_id FROM l WHERE length(k) >= 10 GROUP BY k),
m AS (SELECT doc_id, i, line, coalesce(doc_id > first_id, false) AS gone FROM l LEFT JOIN f USING (k))
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (WHERE gone) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY i) FILTER (WHERE NOT gone), '')) AS kept_sha256
FROM m GROUP BY doc_id
"""

_FIELD = "coalesce(strlen(CAST({0} AS VARCHAR)) || ':' || CAST({0} AS VARCHAR), '-')"
_STEP = "CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END"  # of CRC-32, one bit
_TREE_LEVELS = 12  # enough for 8^12 leaves


def _leaf(text: str) -> str:
    return "sha256(" + " || ".join(_FIELD.format(c) for c in ("doc_id", "source", "lang", "n_chars", text)) + ")"


def _tree(name: str) -> str:
    """Levels and runs of eight over ``<name>l0`` (g, i, d)."""
    out = ""
    for k in range(_TREE_LEVELS):
        out += f"""
{name}c{k} AS MATERIALIZED (SELECT *, count(*) OVER (PARTITION BY g) AS c FROM {name}l{k}),
{name}r{k} AS MATERIALIZED (
  SELECT g, i // 8 AS p, list(d ORDER BY i) AS ds FROM {name}c{k} WHERE c > 1 GROUP BY g, i // 8),
{name}l{k + 1} AS MATERIALIZED (
  SELECT g, p AS i, sha256(array_to_string(ds, '')) AS d FROM {name}r{k}
  UNION ALL SELECT g, i, d FROM {name}c{k} WHERE c = 1),"""
    return out


def _fold(name: str, source: str) -> str:
    """``<name>f<levels>`` from ``source`` (doc_id, d, g, i, h, cur, proof) up the tree ``name``."""
    out = f"\n{name}f0 AS (SELECT * FROM {source}),"
    for k in range(_TREE_LEVELS):
        left = "array_to_string(ds[1 : i % 8], '')"
        right = "array_to_string(ds[i % 8 + 2 :], '')"
        out += f"""
{name}f{k + 1} AS MATERIALIZED (
  SELECT doc_id, d, g, i // 8 AS i, h, proof || coalesce({left} || {right}, '') AS proof,
         CASE WHEN ds IS NULL THEN cur ELSE sha256({left} || cur || {right}) END AS cur
  FROM (SELECT * FROM {name}f{k} LEFT JOIN (SELECT g AS rg, p, ds FROM {name}r{k}) ON g = rg AND i // 8 = p)),"""
    return out


MERKLE = f"""
WITH crc_table AS (
  SELECT list_transform(range(256),
    lambda n: list_reduce(list_prepend(n, range(8)), lambda c, _: {_STEP})) AS t
),
ids AS (
  SELECT doc_id, xor(list_reduce(list_prepend(4294967295, list_transform(
             range(1, 1 + length(CAST(doc_id AS VARCHAR))), lambda i: ascii(substr(CAST(doc_id AS VARCHAR), i, 1)))),
           lambda c, b: xor(c >> 8, t[(xor(c, b) & 255) + 1])), 4294967295) AS crc
  FROM (SELECT DISTINCT doc_id FROM documents), crc_table
),
leaves AS MATERIALIZED (
  SELECT doc_id, lang, {_leaf("text")} AS d,
         CASE WHEN crc % 3 = 0 THEN {_leaf(_LOWER.format("text"))} ELSE {_leaf("text")} END AS shown
  FROM documents LEFT JOIN ids USING (doc_id)
),
langs AS (SELECT lang, row_number() OVER (ORDER BY lang NULLS FIRST) - 1 AS h FROM (SELECT DISTINCT lang FROM leaves)),
placed AS MATERIALIZED (
  SELECT doc_id, h AS g, row_number() OVER (PARTITION BY h ORDER BY doc_id NULLS FIRST, d) - 1 AS i, d, shown
  FROM leaves JOIN langs ON leaves.lang IS NOT DISTINCT FROM langs.lang
),
al0 AS (SELECT g, i, d FROM placed),{_tree("a")}
bl0 AS (SELECT 0 AS g, g AS i, d FROM al{_TREE_LEVELS}),{_tree("b")}
start AS (SELECT doc_id, d, g, i, g AS h, '' AS proof, shown AS cur FROM placed),{_fold("a", "start")}
middle AS (SELECT doc_id, d, 0 AS g, h AS i, h, proof, cur FROM af{_TREE_LEVELS}),{_fold("b", "middle")}
tops AS (SELECT g AS h, d AS subroot FROM al{_TREE_LEVELS})
SELECT doc_id, f.d AS leaf, subroot, r.d AS root, sha256(proof) AS proof_sha256, cur AS folded_root,
       cur = r.d AS verified
FROM bf{_TREE_LEVELS} f JOIN tops USING (h), bl{_TREE_LEVELS} r
"""

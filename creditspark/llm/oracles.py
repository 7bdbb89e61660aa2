"""The registered text queries as DuckDB SQL, where SQL can express them.

Left out are queries whose rows come from a fitted model or a tokenizer (op1, op2, op6, op10, op11), from
patterns with look-around (op3), or whose SQL is too slow on whole tables (op9, op13); tests compare
those with brute force.
"""

from __future__ import annotations

from . import quality, sharding

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
FOLDED = f"translate(coalesce(text, ''), '{UPPER}', '{LOWER}')"
SPACED = r"[^\x20\x09-\x0D]+"
ALNUM = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"

NEAR = rf"""
WITH RECURSIVE w AS (SELECT doc_id, regexp_extract_all({FOLDED}, '{SPACED}') AS ws FROM documents),
sh AS (
  SELECT DISTINCT doc_id, array_to_string(ws[k:k + 4], ' ') AS s
  FROM (SELECT doc_id, ws, unnest(range(1, len(ws) - 3)) AS k FROM w WHERE len(ws) >= 5)
  UNION ALL SELECT doc_id, array_to_string(ws, ' ') FROM w WHERE len(ws) BETWEEN 1 AND 4
),
n AS (SELECT doc_id, count(*) AS n FROM sh GROUP BY doc_id),
met AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS i FROM sh a JOIN sh b ON a.s = b.s AND a.doc_id < b.doc_id GROUP BY ALL),
link AS (SELECT a, b FROM met JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 100 * i >= 75 * (x.n + y.n - i)),
both_ways AS (SELECT a, b FROM link UNION ALL SELECT b, a FROM link),
reach AS (SELECT doc_id, doc_id AS r FROM documents UNION SELECT reach.doc_id, b FROM reach JOIN both_ways ON r = a),
least_id AS (SELECT doc_id, min(r) AS component_id FROM reach GROUP BY doc_id)
SELECT d.doc_id, coalesce(n.n, 0) AS n_shingles, component_id, d.doc_id = component_id AS kept
FROM documents d LEFT JOIN n ON n.doc_id = d.doc_id JOIN least_id l ON l.doc_id = d.doc_id
"""

DECONTAMINATE = rf"""
WITH w AS (SELECT doc_id, regexp_extract_all({FOLDED}, '{ALNUM}') AS ws FROM documents),
i AS (SELECT item_id, regexp_extract_all({FOLDED}, '{ALNUM}') AS ws FROM benchmark),
iw AS (
  SELECT DISTINCT item_id, n, array_to_string(ws[k:k + n - 1], ' ') AS win
  FROM (SELECT item_id, ws, least(len(ws), 13) AS n, unnest(range(1, len(ws) - least(len(ws), 13) + 2)) AS k FROM i WHERE len(ws) > 0)
),
sizes AS (SELECT DISTINCT n FROM iw),
dw AS (
  SELECT doc_id, k, n, array_to_string(ws[k:k + n - 1], ' ') AS win
  FROM (SELECT doc_id, ws, unnest(range(1, len(ws) + 1)) AS k FROM w), sizes WHERE k + n - 1 <= len(ws)
),
hit AS (SELECT doc_id, k, n, item_id FROM dw JOIN iw USING (n, win)),
pos AS (SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT doc_id, unnest(range(k, k + n)) AS p FROM hit) GROUP BY doc_id),
ids AS (SELECT doc_id, list_sort(list(DISTINCT CAST(item_id AS VARCHAR))) AS ids FROM hit GROUP BY doc_id)
SELECT w.doc_id, CAST(len(ws) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(len(ids), 0) AS n_items,
       sha256(coalesce(array_to_string(ids, ','), '')) AS items_sha256,
       coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(ws) AS contaminated
FROM w LEFT JOIN pos USING (doc_id) LEFT JOIN ids USING (doc_id)
"""

SHARDS = f"""
WITH b AS (
  SELECT doc_id, strlen(coalesce(text, '')) AS n_bytes,
         lpad(bin(CAST('0x' || substr(md5(CAST(doc_id AS VARCHAR)), 1, 15) AS BIGINT)), 60, '0') AS bits
  FROM documents
),
sums AS (
  SELECT d, substr(bits, 1, d) AS shard, CAST(sum(n_bytes) AS BIGINT) AS shard_bytes, count(*) AS n
  FROM b, range(0, 61) t(d) GROUP BY ALL
),
fits AS (SELECT * FROM sums WHERE shard_bytes <= {sharding.LIMIT} OR n = 1),
least_d AS (SELECT doc_id, min(d) AS d FROM b JOIN fits ON fits.shard = substr(bits, 1, d) GROUP BY doc_id)
SELECT b.doc_id, n_bytes, fits.shard, least_d.d AS depth, shard_bytes
FROM b JOIN least_d USING (doc_id) JOIN fits ON fits.d = least_d.d AND fits.shard = substr(bits, 1, least_d.d)
"""

_VALUES = {
    "word_length": "(word_chars * 100) // greatest(n_words, 1)",
    "symbols": "(n_symbols * 10000) // greatest(word_chars, 1)",
    "capitals": "(n_capitals * 10000) // greatest(word_chars, 1)",
    "dup_lines": "(n_dup_lines * 10000) // greatest(n_lines, 1)",
    "repeats": "(n_repeat_words * 10000) // greatest(n_words, 1)",
}


def _quality() -> str:
    def quantiles(name: str, by: str) -> str:
        group = f"{by}, measure" if by else "measure"
        return f"""
{name} AS (
  SELECT {group}, max(total) AS n,
         {", ".join(f"min(CASE WHEN 100 * upto >= {p} * total THEN bucket END) AS q{p}" for p in (25, 50, 75))}
  FROM (SELECT *, sum(n) OVER (PARTITION BY {group} ORDER BY bucket) AS upto, sum(n) OVER (PARTITION BY {group}) AS total
        FROM (SELECT {group}, bucket, count(*) AS n FROM sketch GROUP BY ALL))
  GROUP BY {group}
)"""

    long = " UNION ALL ".join(f"SELECT lang, source, '{m}' AS measure, {x} AS x FROM c WHERE n_words > 0" for m, x in _VALUES.items())
    q = lambda c: f"CASE WHEN o.n >= {quality.MIN_GROUP} THEN o.{c} WHEN l.n >= {quality.MIN_GROUP} THEN l.{c} ELSE g.{c} END"
    margin = "CASE o.measure " + " ".join(f"WHEN '{m}' THEN {v}" for m, v in quality.MEASURES.items()) + " END"
    most = ", ".join(f"max(CASE WHEN measure = '{m}' THEN most END) AS most_{m}" for m in _VALUES)
    failed = ", ".join(f"CASE WHEN {x} > most_{m} THEN '{m}' END" for m, x in _VALUES.items())
    return rf"""
WITH t AS (SELECT doc_id, lang, source, coalesce(text, '') AS text, regexp_extract_all(coalesce(text, ''), '{SPACED}') AS ws FROM documents),
win AS (
  SELECT doc_id, k, array_to_string(ws[k:k + 7], ' ') AS s FROM (SELECT doc_id, ws, unnest(range(1, len(ws) - 6)) AS k FROM t WHERE len(ws) >= 8)
),
rep AS (
  SELECT doc_id, count(DISTINCT p) AS n FROM (
    SELECT doc_id, unnest(range(k, k + 8)) AS p FROM (SELECT *, count(*) OVER (PARTITION BY doc_id, s) AS c FROM win) WHERE c > 1
  ) GROUP BY doc_id
),
c AS (
  SELECT doc_id, lang, source, CAST(len(ws) AS BIGINT) AS n_words, length(array_to_string(ws, '')) AS word_chars,
         length(text) - length(translate(text, '#*$%&|<>', '')) AS n_symbols,
         length(text) - length(translate(text, '{UPPER}', '')) AS n_capitals,
         len(lines) AS n_lines, len(lines) - len(list_distinct(lines)) AS n_dup_lines, coalesce(rep.n, 0) AS n_repeat_words
  FROM (SELECT *, list_filter(string_split(text, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS lines FROM t) LEFT JOIN rep USING (doc_id)
),
sketch AS (
  SELECT lang, source, measure, x - x % CAST(2 ** greatest(length(bin(x)) - 6, 0) AS BIGINT) AS bucket FROM ({long})
), {quantiles("own", "lang, source")}, {quantiles("of_lang", "lang")}, {quantiles("of_all", "")},
most AS (
  SELECT lang, source, {most} FROM (
    SELECT o.lang, o.source, o.measure,
           greatest({q("q75")} + {quality.SPREADS} * ({q("q75")} - {q("q25")}), {q("q50")} + {margin}) AS most
    FROM own o JOIN of_lang l ON o.lang IS NOT DISTINCT FROM l.lang AND o.measure = l.measure JOIN of_all g ON o.measure = g.measure
  ) GROUP BY lang, source
),
j AS (
  SELECT c.*, n_words < {quality.MIN_WORDS} OR 100 * n_repeat_words > {quality.MAX_REPEAT_PERCENT} * n_words AS base_failed,
         list_filter([{failed}], lambda x: x IS NOT NULL) AS failed
  FROM c LEFT JOIN most m ON c.lang IS NOT DISTINCT FROM m.lang AND c.source IS NOT DISTINCT FROM m.source
)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, NOT base_failed AND len(failed) = 0 AS kept,
       array_to_string(failed, ',') AS failed
FROM j
"""


def _sized(column: str) -> str:
    return f"coalesce(strlen({column}::VARCHAR) || ':' || {column}::VARCHAR, '-')"


def _leaf(more: int = 0) -> str:
    columns = ("doc_id", "source", "lang", f"(n_chars::BIGINT + {more})", "text")
    return f"sha256({' || '.join(map(_sized, columns))})"


# Checksum of a decimal number, bit by bit.
CRC32 = """xor(list_reduce(
  list_prepend(4294967295::UBIGINT, list_transform(string_split(doc_id::VARCHAR, ''), lambda c: ascii(c)::UBIGINT)),
  lambda c, b: list_reduce(list_prepend(xor(c, b), [0, 0, 0, 0, 0, 0, 0, 0]::UBIGINT[]),
    lambda y, z: xor(y >> 1, CASE WHEN y & 1 = 1 THEN 3988292384::UBIGINT ELSE 0::UBIGINT END))), 4294967295::UBIGINT)"""

MANIFEST = rf"""
WITH RECURSIVE leaves AS (
  SELECT doc_id, lang, {_leaf()} AS leaf, CASE WHEN {CRC32} % 7 = 0 THEN {_leaf(1)} ELSE {_leaf()} END AS changed,
    row_number() OVER (PARTITION BY lang ORDER BY doc_id) - 1 AS pos, count(*) OVER (PARTITION BY lang) AS n
  FROM documents
),
node AS (
  SELECT lang, 0 AS level, pos, n, leaf AS h FROM leaves
  UNION ALL
  SELECT lang, level + 1, pos // 2, (n + 1) // 2, sha256(string_agg(h, '' ORDER BY pos)) FROM node WHERE n > 1 GROUP BY lang, level, pos // 2, n
),
subroots AS (
  SELECT lang, h, row_number() OVER (ORDER BY lang NULLS FIRST) - 1 AS pos, count(*) OVER () AS n FROM node WHERE n = 1
),
high AS (
  SELECT 0 AS level, pos, n, h FROM subroots
  UNION ALL
  SELECT level + 1, pos // 2, (n + 1) // 2, sha256(string_agg(h, '' ORDER BY pos)) FROM high WHERE n > 1 GROUP BY level, pos // 2, n
),
low_steps AS (
  SELECT l.doc_id, list(CASE WHEN s.h IS NULL THEN 's' WHEN o.pos % 2 = 1 THEN 'l' || s.h ELSE 'r' || s.h END ORDER BY o.level) AS steps
  FROM leaves l JOIN node o ON o.lang IS NOT DISTINCT FROM l.lang AND o.n > 1 AND o.pos = l.pos >> o.level
  LEFT JOIN node s ON s.lang IS NOT DISTINCT FROM l.lang AND s.level = o.level AND s.pos = xor(o.pos, 1)
  GROUP BY l.doc_id
),
high_steps AS (
  SELECT l.lang, list(CASE WHEN s.h IS NULL THEN 's' WHEN o.pos % 2 = 1 THEN 'l' || s.h ELSE 'r' || s.h END ORDER BY o.level) AS steps
  FROM subroots l JOIN high o ON o.n > 1 AND o.pos = l.pos >> o.level LEFT JOIN high s ON s.level = o.level AND s.pos = xor(o.pos, 1)
  GROUP BY l.lang
),
path AS (
  SELECT l.doc_id, l.leaf, l.changed, r.h AS subroot, list_concat(coalesce(a.steps, []), coalesce(b.steps, [])) AS steps
  FROM leaves l JOIN subroots r ON r.lang IS NOT DISTINCT FROM l.lang
  LEFT JOIN low_steps a ON a.doc_id = l.doc_id LEFT JOIN high_steps b ON b.lang IS NOT DISTINCT FROM l.lang
),
done AS (
  SELECT *, (SELECT h FROM high WHERE n = 1) AS root, list_reduce(list_prepend(changed, steps), lambda a, x: sha256(
    CASE substr(x, 1, 1) WHEN 'l' THEN substr(x, 2) || a WHEN 'r' THEN a || substr(x, 2) ELSE a END)) AS folded_root
  FROM path
)
SELECT doc_id, leaf, subroot, root, sha256(array_to_string(list_transform(steps, lambda x: substr(x, 2)), '')) AS proof_sha256,
  folded_root, folded_root = root AS verified
FROM done
"""


ORACLES: dict[str, str] = {
    "op4_quality_rules": _quality(),
    "op5_near_duplicates": NEAR,
    "op7_shards": SHARDS,
    "op8_decontaminate": DECONTAMINATE,
    "op12_manifest": MANIFEST,
}

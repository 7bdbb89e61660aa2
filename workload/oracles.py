"""DuckDB SQL for the registered queries.

Written from the definition of each result, not from the Spark plan: window
functions over all rows, ``quantile_cont`` for quantiles, and the tree rounds
unrolled as plain common table expressions.
"""

from __future__ import annotations

from . import fixtures as fx

OVERALL = "__overall__"
BASE = "new_date < '19980701'"
RAW, SAMPLE, SCORED = fx.DUCK_RAW, fx.DUCK_SAMPLE, fx.DUCK_SCORED
NUMERIC = fx.NUMERIC
LONGLIST = ", ".join(NUMERIC)


def cte(body: str, **tables: str) -> str:
    parts = ", ".join(f"{name} AS MATERIALIZED ({sql})" for name, sql in tables.items())
    return f"WITH {parts} {body}"


def long_of(features, keep: str, source: str = "s") -> str:
    """(keep..., feature, value) without nulls."""
    return " UNION ALL ".join(
        f"SELECT {keep}, '{f}' AS feature, CAST({f} AS DOUBLE) AS value FROM {source} WHERE {f} IS NOT NULL"
        for f in features
    )


def percent(share: str) -> str:
    return f"printf('%.2f%%', round_even({share} * 100, 2))"


def tag(org: str, oos: str) -> str:
    return f"CASE WHEN {org} = '{oos}' THEN '贷外' ELSE '建模' END"


def clipped(good: str, bad: str) -> str:
    return f"greatest(-5.0::DOUBLE, least(5.0::DOUBLE, ln(greatest({good}, 1e-6) / greatest({bad}, 1e-6))))"


# --- trees -------------------------------------------------------------------


def tree_tables(cells: str, k: int) -> dict[str, str]:
    """Tables c (cells with running counts) and leaves after k - 1 rounds."""
    tables = {
        "cells": cells,
        "c": """
            SELECT * FROM (
                SELECT *, sum(n) OVER (PARTITION BY scope, feature) AS n_all,
                       sum(bad) OVER (PARTITION BY scope, feature) AS bad_all,
                       sum(n) OVER (PARTITION BY scope, feature ORDER BY value) AS n_upto,
                       sum(bad) OVER (PARTITION BY scope, feature ORDER BY value) AS bad_upto
                FROM cells) WHERE n_all >= 50 AND bad_all > 0 AND bad_all < n_all""",
        "leaves0": """
            SELECT scope, feature, 0 AS sn, 0 AS sb, max(n_all) AS ln, max(bad_all) AS lb,
                   ceil(CAST(0.05 AS DOUBLE) * max(n_all)) AS small FROM c GROUP BY scope, feature""",
    }
    side = "(({b})::DOUBLE * ({b})::DOUBLE + ({n} - ({b}))::DOUBLE * ({n} - ({b}))::DOUBLE) / ({n})"
    left = side.format(n="(n_upto - sn)", b="bad_upto - sb")
    right = side.format(n="(ln - (n_upto - sn))", b="lb - (bad_upto - sb)")
    whole = side.format(n="ln", b="lb")
    for r in range(k - 1):
        tables[f"cut{r}"] = f"""
            SELECT * FROM (
                SELECT *, row_number() OVER (PARTITION BY scope, feature ORDER BY gain DESC, sn, cn) AS place
                FROM (SELECT scope, feature, sn, sb, ln, lb, n_upto - sn AS cn, bad_upto - sb AS cb,
                             {left} + {right} - {whole} AS gain
                      FROM c JOIN leaves{r} USING (scope, feature)
                      WHERE lb > 0 AND lb < ln AND n_upto - sn >= small AND ln - (n_upto - sn) >= small)
            ) WHERE place = 1"""
        tables[f"leaves{r + 1}"] = f"""
            SELECT l.scope, l.feature, l.sn, l.sb, coalesce(cn, l.ln) AS ln, coalesce(cb, l.lb) AS lb, small
            FROM leaves{r} l LEFT JOIN cut{r} t ON l.scope = t.scope AND l.feature = t.feature AND l.sn = t.sn
            UNION ALL
            SELECT l.scope, l.feature, l.sn + cn, l.sb + cb, l.ln - cn, l.lb - cb, small
            FROM leaves{r} l JOIN cut{r} t ON l.scope = t.scope AND l.feature = t.feature AND l.sn = t.sn"""
    good, bad = "(ln - lb) / sum(ln - lb) OVER w", "lb / sum(lb) OVER w"
    tables["stats"] = f"""
        SELECT scope, feature, row_number() OVER (PARTITION BY scope, feature ORDER BY sn) - 1 AS bin, sn,
               ln AS n, lb AS bad, lb / ln AS bad_rate, {clipped(good, bad)} AS woe,
               (greatest({good}, 1e-6) - greatest({bad}, 1e-6)) * {clipped(good, bad)} AS part
        FROM leaves{k - 1} WINDOW w AS (PARTITION BY scope, feature)"""
    return tables


def numeric_cells(features, by_org: bool, source: str = SAMPLE) -> dict[str, str]:
    long = long_of(features, "new_org, new_target")
    every = f"SELECT '{OVERALL}' AS scope, feature, value, new_target FROM long"
    if by_org:
        every += " UNION ALL SELECT new_org, feature, value, new_target FROM long"
    cells = f"SELECT scope, feature, value, count(*) AS n, sum(new_target) AS bad FROM ({every}) GROUP BY ALL"
    return {"s": source, "long": long, "cells": cells}


def bins_sql(k: int, by_org: bool, features) -> str:
    tables = numeric_cells(features, by_org)
    tables.update(tree_tables(tables["cells"], k))
    return cte(
        """SELECT t.scope, t.feature, CAST(t.bin AS INTEGER) AS bin, round(min(value), 6) AS low,
                  round(max(value), 6) AS high, CAST(any_value(t.n) AS BIGINT) AS n,
                  CAST(any_value(t.bad) AS BIGINT) AS bad, round(any_value(bad_rate), 6) AS bad_rate,
                  round(any_value(woe), 6) AS woe
           FROM stats t JOIN c ON c.scope = t.scope AND c.feature = t.feature AND n_upto > sn AND n_upto <= sn + t.n
           GROUP BY t.scope, t.feature, t.bin""",
        **tables,
    )


IV_TABLES = {
    **(lambda t: {**t, **tree_tables(t["cells"], 5)})(numeric_cells(NUMERIC, True)),
    "iv": "SELECT scope, feature, round_even(sum(part), 4) AS iv FROM stats GROUP BY scope, feature",
}


def iv_sql(body: str) -> str:
    return cte(body, **IV_TABLES)


def band_sql(values: str, limits, oos: str, labels=None, closed=None) -> str:
    """Band counts from a query (org, feature, value)."""
    rows = []
    for i, (low, high) in enumerate(zip(limits, limits[1:])):
        label = labels[i] if labels else f"[{low:g}, {high:g})"
        test = f"value >= {low}"
        if high != float("inf"):
            test += f" AND value {'<=' if high == closed else '<'} {high}"
        rows.append(
            f"SELECT org, '{label}' AS band, count(*) FILTER (WHERE {test}) AS k, count(value) AS t FROM v GROUP BY org"
        )
    return (
        f"SELECT org, {tag('org', oos)} AS sample_type, band, k AS n_features, "
        f"{percent('CASE WHEN t > 0 THEN k / t ELSE 0 END')} AS share "
        f"FROM (WITH v AS ({values}) {' UNION ALL '.join(rows)})"
    )


# --- correlation -------------------------------------------------------------

PAIRS = " UNION ALL ".join(
    f"SELECT '{a}' AS feature_1, '{b}' AS feature_2, corr({a}, {b}) AS r FROM s"
    for i, a in enumerate(NUMERIC)
    for b in NUMERIC[i + 1 :]
)
LIST = "[" + ", ".join(f"'{f}'" for f in NUMERIC) + "]"

# --- stability ---------------------------------------------------------------

PROBS = "[0.1, 0.2, 0.3, 0.4, 0.5, 0.6, 0.7, 0.8, 0.9]"
PLACE = " + ".join(f"(value >= edges[{i}])::INT" for i in range(1, 10))
ALL_BINS = "SELECT unnest(range(10)) AS b"


def psi_sum(base: str, base_all: str, actual: str, actual_all: str) -> str:
    e, a = f"greatest({base} / {base_all}, 1e-6)", f"greatest({actual} / {actual_all}, 1e-6)"
    return f"round_even(sum(({a} - {e}) * ln({a} / {e})), 4)"


def org_psi(period: str, features, min_sample: int) -> dict[str, str]:
    return {
        "s": f"SELECT *, {period} AS period FROM ({SAMPLE})",
        "sizes": """SELECT * FROM (SELECT new_org AS org, period, count(*) AS rows,
                        min(period) OVER (PARTITION BY new_org) AS first, count(*) OVER (PARTITION BY new_org) AS k
                    FROM s GROUP BY new_org, period) WHERE k > 1""",
        "long": long_of(features, "new_org AS org, period"),
        "edges": f"""SELECT org, feature, quantile_cont(value, {PROBS}) AS edges
                     FROM long JOIN sizes USING (org, period) WHERE period = first GROUP BY org, feature""",
        "binned": f"SELECT org, feature, period, {PLACE} AS b, count(*) AS n FROM long JOIN edges USING (org, feature) GROUP BY ALL",
        "sums": "SELECT org, feature, period, sum(n) AS n FROM binned GROUP BY ALL",
        "grid": f"""SELECT z.org, z.period, z.first, z.rows, f.rows AS base_rows, feature
                    FROM sizes z JOIN sizes f ON z.org = f.org AND f.period = z.first,
                         (SELECT unnest([{', '.join(f"'{f}'" for f in features)}]) AS feature)""",
        "idx": f"""SELECT g.org, g.feature, g.period, {psi_sum('coalesce(e.n, 0)', 'es.n', 'coalesce(a.n, 0)', 'ass.n')} AS psi
                   FROM grid g JOIN sums es ON es.org = g.org AND es.feature = g.feature AND es.period = g.first
                   JOIN sums ass ON ass.org = g.org AND ass.feature = g.feature AND ass.period = g.period
                   CROSS JOIN ({ALL_BINS}) bins
                   LEFT JOIN binned e ON e.org = g.org AND e.feature = g.feature AND e.period = g.first AND e.b = bins.b
                   LEFT JOIN binned a ON a.org = g.org AND a.feature = g.feature AND a.period = g.period AND a.b = bins.b
                   GROUP BY ALL""",
        "d": f"""SELECT g.org, g.feature, g.period,
                        CASE WHEN g.period = first THEN 0.0 WHEN rows < {min_sample} OR base_rows < {min_sample} THEN NULL
                             ELSE coalesce(psi, 0.0) END AS psi, rows
                 FROM grid g LEFT JOIN idx i ON i.org = g.org AND i.feature = g.feature AND i.period = g.period""",
    }


YEAR = org_psi("substr(new_date, 1, 4)", NUMERIC, 100)
FIRST = "(SELECT *, min(period) OVER (PARTITION BY org, feature) AS f FROM d)"


def org_summary(threshold: float) -> str:
    return f"""SELECT org, feature, count(*) FILTER (WHERE psi > {threshold}) AS unstable_periods, count(*) AS periods,
                      count(*) FILTER (WHERE psi > {threshold})
                          >= greatest(1, floor(count(*) * (1 / CAST(3 AS DOUBLE)))) AS unstable
               FROM {FIRST} WHERE period > f AND psi IS NOT NULL GROUP BY org, feature"""


def pair_psi(base: str, current: str, features) -> dict[str, str]:
    return {
        "b": base,
        "a": current,
        "lb": long_of(features, "1 AS one", "b"),
        "la": long_of(features, "1 AS one", "a"),
        "edges": f"SELECT feature, quantile_cont(value, {PROBS}) AS edges FROM lb GROUP BY feature",
        "cb": f"SELECT feature, {PLACE} AS b, count(*) AS n FROM lb JOIN edges USING (feature) GROUP BY ALL",
        "ca": f"SELECT feature, {PLACE} AS b, count(*) AS n FROM la JOIN edges USING (feature) GROUP BY ALL",
        "pair": f"""SELECT f.feature, {psi_sum('coalesce(cb.n, 0)', 'f.nb', 'coalesce(ca.n, 0)', 'f.na')} AS psi
                    FROM (SELECT feature, (SELECT count(*) FROM lb WHERE lb.feature = edges.feature) AS nb,
                                 (SELECT count(*) FROM la WHERE la.feature = edges.feature) AS na FROM edges) f
                    CROSS JOIN ({ALL_BINS}) bins
                    LEFT JOIN cb ON cb.feature = f.feature AND cb.b = bins.b
                    LEFT JOIN ca ON ca.feature = f.feature AND ca.b = bins.b GROUP BY f.feature""",
    }


# --- metrics -----------------------------------------------------------------


def ranking(source: str, keys: str = "") -> str:
    """Per key: rows, bad rate, AUC, KS, Gini and average precision from tied-score counts."""
    part = f"PARTITION BY {keys}" if keys else ""
    lead, group = (f"{keys},", f"GROUP BY {keys}") if keys else ("", "")
    return f"""
        SELECT {lead} max(na) AS rows, max(pa) / max(na) AS bad_rate,
               CASE WHEN max(pa) > 0 AND max(pa) < max(na)
                    THEN sum(pos * (nu - pu - (n - pos) + (n - pos) / 2)) / (max(pa) * max(na - pa)) END AS auc,
               CASE WHEN max(pa) > 0 AND max(pa) < max(na)
                    THEN greatest(max((pa - pu + pos) / pa - ((na - pa) - (nu - pu) + n - pos) / (na - pa)), 0.0) END AS ks,
               CASE WHEN max(pa) > 0 THEN sum(pos / pa * (pa - pu + pos) / (na - nu + n)) END AS pr_auc
        FROM (SELECT {lead} p, n::DOUBLE AS n, pos::DOUBLE AS pos,
                     (sum(n) OVER ({part} ORDER BY p))::DOUBLE AS nu, (sum(pos) OVER ({part} ORDER BY p))::DOUBLE AS pu,
                     (sum(n) OVER ({part}))::DOUBLE AS na, (sum(pos) OVER ({part}))::DOUBLE AS pa
              FROM (SELECT {lead} p, count(*) AS n, sum(new_target) AS pos FROM ({source}) GROUP BY {lead} p))
        {group}"""


LIFT = f"""
    SELECT decile, count, bad_count, round_even(bad_count / count, 4) AS bad_rate,
           round_even(bad_count / count / overall, 2) AS lift
    FROM (SELECT CAST(10 - code AS INTEGER) AS decile, count(*) AS count, CAST(sum(new_target) AS BIGINT) AS bad_count,
                 any_value(overall) AS overall
          FROM (SELECT new_target, overall, (SELECT count(DISTINCT e) FROM unnest(edges[2:]) u(e)
                                             WHERE e > edges[1] AND e < p) AS code
                FROM (SELECT p, new_target, avg(new_target) OVER () AS overall FROM sc),
                     (SELECT quantile_cont(p, [0, 0.1, 0.2, 0.3, 0.4, 0.5, 0.6, 0.7, 0.8, 0.9, 1]) AS edges FROM sc))
          GROUP BY code)"""

CONFUSION = """
    SELECT count(*) FILTER (WHERE p >= 0.3 AND new_target = 1) AS tp, count(*) FILTER (WHERE p >= 0.3 AND new_target = 0) AS fp,
           count(*) FILTER (WHERE p < 0.3 AND new_target = 1) AS fn, count(*) FILTER (WHERE p < 0.3 AND new_target = 0) AS tn
    FROM sc"""
RATES = f"""
    SELECT *, coalesce(2 * precision * recall / nullif(precision + recall, 0), 0) AS f1
    FROM (SELECT *, coalesce(tp / nullif(tp + fp, 0), 0) AS precision, coalesce(tp / nullif(tp + fn, 0), 0) AS recall
          FROM ({CONFUSION}))"""

MONTHS = f"""
    SELECT new_org AS org, new_date_ym AS month, sum(new_target) AS bads, count(*) AS rows, avg(new_target) AS bad_rate
    FROM ({SAMPLE}) GROUP BY ALL"""
ABNORMAL = f"SELECT * FROM ({MONTHS}) WHERE bads < 10 OR rows < 80"
KEPT = f"""SELECT * FROM ({SAMPLE}) s WHERE NOT EXISTS (
    SELECT 1 FROM ({ABNORMAL}) m WHERE m.org = s.new_org AND m.month = s.new_date_ym)"""

MISSING = f"""
    SELECT feature, scope, round_even(avg(miss), 4) AS missing_rate FROM (
        SELECT feature, unnest(['{OVERALL}', org]) AS scope, miss FROM ({{source}})) GROUP BY feature, scope"""


def missing_of(source: str, features, text=("segment",)) -> str:
    rows = " UNION ALL ".join(
        f"SELECT org, '{f}' AS feature, CASE WHEN {f} IS NULL"
        + ("" if f in text else f" OR {f} IN (-1, -999, -1111)")
        + f" THEN 1 ELSE 0 END AS miss FROM src"
        for f in features
    )
    return f"WITH src AS MATERIALIZED ({source}) " + MISSING.format(source=rows)


ORDER = "new_date, l_orderkey, l_linenumber, quantity, discount"


def split_rows(val_of_rest: bool) -> str:
    val = "0.15::DOUBLE" if val_of_rest else "(0.15::DOUBLE / (1 - 0.15::DOUBLE))"
    return f"""
        SELECT *, CASE WHEN place < n - test - val THEN 'train' WHEN place < n - test THEN 'val' ELSE 'test' END AS split
        FROM (SELECT *, floor((n - test) * {val}) AS val
              FROM (SELECT *, floor(n * 0.15::DOUBLE) AS test
                    FROM (SELECT *, count(*) OVER () AS n, row_number() OVER (ORDER BY {ORDER}) - 1 AS place
                          FROM ({SAMPLE}))))"""


# Places of the classes laid end to end, first class first, dealt to five folds in turn.
_FOLD_TABLES = f"""
    WITH r AS MATERIALIZED (
        SELECT *, row_number() OVER (PARTITION BY new_target ORDER BY {ORDER}) - 1 AS place,
               first_value(new_target) OVER (ORDER BY {ORDER}) AS lead_class FROM ({SAMPLE})),
    sizes AS (SELECT new_target, any_value(lead_class) AS lead_class, count(*) AS n FROM r GROUP BY new_target),
    laid AS (SELECT new_target, unnest(range(
                 CAST(CASE WHEN new_target = lead_class THEN 0 ELSE (SELECT n FROM sizes z WHERE z.new_target = z.lead_class) END AS BIGINT),
                 CAST(CASE WHEN new_target = lead_class THEN n ELSE (SELECT sum(n) FROM sizes) END AS BIGINT))) AS j FROM sizes),
    takes AS (SELECT new_target, j % 5 AS fold, count(*) AS k FROM laid GROUP BY ALL),
    ends AS (SELECT new_target, fold, sum(k) OVER (PARTITION BY new_target ORDER BY fold) AS upto, k FROM takes)"""
_PLACED = "FROM r JOIN ends e ON r.new_target = e.new_target AND place < upto AND place >= upto - k"
FOLDS = f"""{_FOLD_TABLES}
    SELECT CAST(e.fold + 1 AS INTEGER) AS fold, r.new_target, count(*) AS n, CAST(sum(l_orderkey) AS BIGINT) AS keys,
           min(new_date) AS first_date, max(new_date) AS last_date
    {_PLACED} GROUP BY ALL"""
_FOLDED = f"{_FOLD_TABLES} SELECT r.new_target, e.fold, {fx.SCORE} AS p {_PLACED}"

# --- WOE ---------------------------------------------------------------------

WOE_NUMERIC = ("quantity", "discount", "balance")


def woe_tables(source: str) -> dict[str, str]:
    tables = {
        "s": SAMPLE,
        "fit": source,
        "codes": "SELECT segment, row_number() OVER (ORDER BY segment) - 1 AS code FROM (SELECT DISTINCT segment FROM fit)",
        "long": long_of(WOE_NUMERIC, "new_target", "fit")
        + " UNION ALL SELECT new_target, 'segment', CAST(code AS DOUBLE) FROM fit JOIN codes USING (segment)",
    }
    cells = f"""SELECT '{OVERALL}' AS scope, feature, value, count(*) AS n, sum(new_target) AS bad FROM long GROUP BY ALL"""
    tables.update(tree_tables(cells, 10))
    tables["ranges"] = """
        SELECT t.feature, t.bin, any_value(t.n) AS n, any_value(t.bad) AS bad, any_value(bad_rate) AS bad_rate,
               any_value(woe) AS woe, any_value(part) AS part, min(value) AS low, max(value) AS high
        FROM stats t JOIN c ON c.feature = t.feature AND n_upto > sn AND n_upto <= sn + t.n GROUP BY t.feature, t.bin"""
    return tables


def woe_lookup(feature: str, value: str) -> str:
    return f"""round(coalesce((SELECT woe FROM ranges WHERE feature = '{feature}' AND {value} BETWEEN low AND high), 0), 6) AS {feature}_woe"""


POINTS = ("CAST(trunc(({base} {sign} (20 / ln(2)) * ln(p / (1 - p + 1e-6) + 1e-6))) AS INTEGER)")
OFFSET = "600 - (20 / ln(2)) * ln(50)"

# --- monitoring --------------------------------------------------------------

HALF_BASE = f"SELECT * FROM s WHERE {BASE}"
HALF_CURRENT = f"SELECT * REPLACE (CASE WHEN quantity <= 40 THEN balance END AS balance) FROM s WHERE NOT ({BASE})"


def missing_share(source: str) -> str:
    return " UNION ALL ".join(
        f"SELECT '{f}' AS feature, avg(CASE WHEN {f} IS NULL THEN 1 ELSE 0 END) AS m FROM {source}" for f in fx.FEATURES
    )


DRIFT = {
    "s": SAMPLE,
    **pair_psi(HALF_BASE, HALF_CURRENT, NUMERIC),
    "mb": missing_share("b"),
    "ma": missing_share("a"),
    "drift": """SELECT mb.feature, coalesce(psi, 0.0) AS psi, mb.m AS base_missing, ma.m AS current_missing
                FROM mb JOIN ma USING (feature) LEFT JOIN pair USING (feature)""",
    "falerts": """
        SELECT feature, 'PSI漂移' AS type, printf('PSI=%.4f', psi) AS value,
               CASE WHEN psi > 0.25 THEN 'HIGH' ELSE 'MEDIUM' END AS severity FROM drift WHERE psi > 0.1
        UNION ALL
        SELECT feature, '缺失率变化', printf('%.4f→%.4f', base_missing, current_missing), 'MEDIUM'
        FROM drift WHERE abs(current_missing - base_missing) > 0.05""",
}
MODEL = {
    "sc": SCORED,
    "mbase": f"SELECT * FROM sc WHERE {BASE}",
    "mcur": f"SELECT * REPLACE ({fx.WORSE_SCORE} AS p) FROM sc WHERE NOT ({BASE}) AND ({fx.WORSE_ROWS})",
    "medges": f"SELECT quantile_cont(p, {PROBS}) AS edges FROM mbase",
    "mcb": f"SELECT {PLACE.replace('value', 'p')} AS b, count(*) AS n FROM mbase, medges GROUP BY ALL",
    "mca": f"SELECT {PLACE.replace('value', 'p')} AS b, count(*) AS n FROM mcur, medges GROUP BY ALL",
    "mpsi": f"""SELECT {psi_sum('coalesce(mcb.n, 0)', '(SELECT count(*) FROM mbase)', 'coalesce(mca.n, 0)', '(SELECT count(*) FROM mcur)')} AS psi
                FROM ({ALL_BINS}) bins LEFT JOIN mcb ON mcb.b = bins.b LEFT JOIN mca ON mca.b = bins.b""",
    "mdrift": f"""SELECT psi AS score_psi, x.auc AS baseline_auc, y.auc AS current_auc, x.auc - y.auc AS auc_drop,
                         x.ks AS baseline_ks, y.ks AS current_ks, x.bad_rate AS baseline_bad_rate,
                         y.bad_rate AS current_bad_rate
                  FROM mpsi, ({ranking('SELECT * FROM mbase')}) x, ({ranking('SELECT * FROM mcur')}) y""",
    "malerts": """
        SELECT '评分分布漂移' AS type, printf('PSI=%.4f', score_psi) AS value,
               CASE WHEN score_psi > 0.25 THEN 'HIGH' ELSE 'MEDIUM' END AS severity FROM mdrift WHERE score_psi > 0.1
        UNION ALL
        SELECT 'AUC退化', printf('%.4f→%.4f (drop=%.4f)', baseline_auc, current_auc, auc_drop),
               CASE WHEN auc_drop > 0.1 THEN 'HIGH' ELSE 'MEDIUM' END FROM mdrift WHERE auc_drop > 0.05
        UNION ALL
        SELECT '坏样本率变化', printf('%.4f→%.4f', baseline_bad_rate, current_bad_rate), 'MEDIUM'
        FROM mdrift WHERE abs(current_bad_rate - baseline_bad_rate) > 0.01""",
}


def baseline_rows() -> str:
    p = (1, 5, 25, 50, 75, 95, 99)
    rows = []
    for f in NUMERIC:
        q = ", ".join(f"round(quantile_cont({f}::DOUBLE, {x / 100}), 5) AS p{x}" for x in p)
        rows.append(
            f"""SELECT '{f}' AS feature, true AS numeric, count(*) AS n_samples, round(avg(new_target), 5) AS bad_rate,
                round(avg({f}), 5) AS mean, round(stddev_samp({f}), 5) AS std, round(min({f})::DOUBLE, 5) AS min,
                round(max({f})::DOUBLE, 5) AS max, round(quantile_cont({f}::DOUBLE, 0.5), 5) AS median,
                round(avg(CASE WHEN {f} IS NULL THEN 1 ELSE 0 END), 5) AS missing_rate, {q} FROM b"""
        )
    nulls = ", ".join(f"NULL::DOUBLE AS {c}" for c in ("mean", "std", "min", "max", "median"))
    percentiles = ", ".join(f"NULL::DOUBLE AS p{x}" for x in p)
    rows.append(
        f"""SELECT 'segment', false, count(*), round(avg(new_target), 5), {nulls},
            round(avg(CASE WHEN segment IS NULL THEN 1 ELSE 0 END), 5), {percentiles} FROM b"""
    )
    return " UNION ALL ".join(rows)


CLEAN_COLUMNS = ("apply_date", "org_info", "label", *NUMERIC[:7], "segment", *NUMERIC[7:], "const")

# --- boosted trees -----------------------------------------------------------

_LIMITS = " UNION ALL ".join(f"SELECT '{f}' AS feature, {x!r}::DOUBLE AS below" for f, points in fx.TREE_LIMITS.items() for x in points)
_STRENGTH = "pow(greatest(abs({g}) - 5, 0), 2) / ({h} + 5)"


def _grown(level: int) -> dict[str, str]:
    """Best split per node of a level, and the rows with their place one level below."""
    left, right, whole = (_STRENGTH.format(g=g, h=h) for g, h in (("gl", "hl"), ("g - gl", "h - hl"), ("g", "h")))
    value = "CASE feature " + " ".join(f"WHEN '{f}' THEN {f}" for f in fx.TREE_LIMITS) + " END"
    return {
        f"sides{level}": f"""
            SELECT path, feature, below, sum(g) AS g, sum(h) AS h, count(*) AS n, sum(g) FILTER (WHERE {value} < below) AS gl,
                   sum(h) FILTER (WHERE {value} < below) AS hl, count(*) FILTER (WHERE {value} < below) AS nl
            FROM rows{level} CROSS JOIN limits GROUP BY path, feature, below""",
        f"best{level}": f"""
            SELECT path, arg_max(feature, gain) AS feature, arg_max(below, gain) AS below, max(gain) AS gain
            FROM (SELECT *, {left} + {right} - {whole} AS gain FROM sides{level} WHERE n >= 100 AND nl >= 50 AND n - nl >= 50)
            WHERE gain > 0.1 GROUP BY path""",
        f"rows{level + 1}": f"""
            SELECT quantity, discount, tax, g, h, path || CASE WHEN {value} < below THEN 'l' ELSE 'r' END AS path
            FROM rows{level} JOIN best{level} USING (path)""",
    }


def _nodes(level: int, split: bool) -> str:
    value = "round(-0.03 * sign(g) * greatest(abs(g) - 5, 0) / (h + 5), 4) AS value"
    sums = f"SELECT path, sum(g) AS g, sum(h) AS h, count(*) AS n FROM rows{level} GROUP BY path"
    if not split:
        return f"SELECT NULL AS feature, NULL::DOUBLE AS below, 0.0 AS gain, {value}, n AS rows FROM ({sums})"
    return f"SELECT feature, round(below, 4) AS below, coalesce(round(gain, 4), 0.0) AS gain, {value}, n AS rows FROM ({sums}) LEFT JOIN best{level} USING (path)"


_FIRST_TREE = dict(
    s=SAMPLE, limits=_LIMITS, p="SELECT avg(new_target) AS p FROM s",
    # The learner adds up whole numbers of 2**-24.
    rows0="""SELECT quantity, discount, tax, round((p - new_target) * 16777216) / 16777216 AS g,
        round(p * (1 - p) * 16777216) / 16777216 AS h, '' AS path FROM s CROSS JOIN p""",
    **_grown(0), **_grown(1),
)
FIRST_ROUND = cte(" UNION ALL ".join([_nodes(0, True), _nodes(1, True), _nodes(2, False)]), **_FIRST_TREE)

_SEGMENTS = f"""
    SELECT *, new_org || '-' || CASE WHEN place < 49 THEN 'a' WHEN place < 99 THEN 'b' WHEN place < 150 THEN 'c' ELSE 'd' END AS segment
    FROM (SELECT *, row_number() OVER (PARTITION BY new_org ORDER BY l_orderkey, l_linenumber, quantity, discount, p) - 1 AS place FROM ({SCORED}))"""

MERGED = cte(
    " UNION ALL ".join(
        f"""SELECT '{f}' AS feature, count(*) AS n_samples, round(avg(new_target), 5) AS bad_rate, round(avg({f}), 5) AS mean,
                   round(stddev_samp({f}), 5) AS std, round(min({f}), 5) AS min, round(max({f}), 5) AS max,
                   round(1 - count({f}) / count(*), 5) AS missing_rate, count({f}) AS counted, true AS ranks_right FROM s"""
        for f in NUMERIC
    ),
    s=SAMPLE,
)


ORACLES = {
    "load_clean": f"""
        SELECT strftime(apply_date, '%Y%m%d') AS new_date, org_info AS new_org, label AS new_target, quantity, discount, tax,
               price, total, size_, retail, segment, balance, sparse, quantity_mix, round(drift, 6) AS drift,
               strftime(apply_date, '%Y%m') AS new_date_ym
        FROM (SELECT *, row_number() OVER (PARTITION BY l_orderkey, l_linenumber
                  ORDER BY {', '.join(c + ' NULLS FIRST' for c in CLEAN_COLUMNS)}) AS place
              FROM (SELECT * REPLACE (CASE WHEN balance <> -999 THEN balance END AS balance) FROM ({RAW})))
        WHERE place = 1""",
    "load_clean_options": f"""
        SELECT strftime(apply_date, '%Y%m%d') AS new_date, 'default' AS new_org, label AS new_target, l_orderkey,
               l_linenumber, quantity, discount, tax, price, total, size_, retail, segment,
               CASE WHEN balance <> -999 THEN balance END AS balance, quantity_mix, round(drift, 6) AS drift,
               strftime(apply_date, '%Y%m') AS new_date_ym FROM ({RAW})""",
    "dedupe_keys": """
        SELECT * EXCLUDE (place) FROM (
            SELECT *, row_number() OVER (PARTITION BY l_orderkey, l_linenumber ORDER BY l_shipdate, l_partkey, l_suppkey,
                l_quantity, l_extendedprice, l_discount, l_tax, l_returnflag, l_linestatus) AS place FROM lineitem)
        WHERE place = 1""",
    "label_filter": """
        SELECT l_orderkey, l_linenumber % 4 AS label FROM lineitem WHERE l_linenumber % 4 IN (0, 1)""",
    "sentinel_null": f"""
        SELECT CASE WHEN l_orderkey NOT IN (-1, -999, -1111) THEN l_orderkey END AS l_orderkey, l_linenumber,
               CASE WHEN balance NOT IN (-1, -999, -1111) THEN balance END AS balance FROM ({RAW})""",
    "constant_features": f"WITH r AS MATERIALIZED (SELECT *, NULL::DOUBLE AS nothing FROM ({RAW})) "
    + " UNION ALL ".join(
        f"SELECT '{c}' AS feature, count(DISTINCT {c}) <= 1 AS constant FROM r"
        for c in ("l_orderkey", "l_linenumber", *fx.FEATURES, "const", "nothing")
    ),
    "sample_gates": f"""
        WITH t AS (SELECT count(*) AS n, sum(new_target) AS bads, avg(new_target) AS rate FROM ({SAMPLE}))
        SELECT 'bad_rate' AS gate, round(rate, 6) AS value, rate BETWEEN 0.005 AND 0.3 AS ok FROM t
        UNION ALL SELECT 'rows', n, n >= 10000 FROM t UNION ALL SELECT 'bads', bads, bads >= 500 FROM t
        UNION ALL SELECT 'features', 14.0, true FROM t""",
    "csv_round_trip": f"""
        SELECT new_org, new_date_ym, segment, count(*) AS n, round(sum(quantity), 6) AS quantity,
               CAST(sum(new_target) AS BIGINT) AS bads FROM ({SAMPLE}) GROUP BY ALL""",
    "parquet_by_month": f"""
        SELECT new_org, count(*) AS n, sum(quantity) AS quantity FROM ({SAMPLE}) WHERE new_date_ym >= '200001' GROUP BY new_org""",
    "org_month_stats": f"""
        SELECT org, month, CAST(bads AS BIGINT) AS bads, rows, round(bad_rate, 6) AS bad_rate,
               CAST(sum(bads) OVER w AS BIGINT) AS org_bads, CAST(sum(rows) OVER w AS BIGINT) AS org_rows,
               round(sum(bads) OVER w / sum(rows) OVER w, 6) AS org_bad_rate, {tag('org', 'org3')} AS sample_type
        FROM ({MONTHS}) WINDOW w AS (PARTITION BY org)""",
    "org_summary": f"SELECT new_org AS org, count(*) AS rows, round(avg(new_target), 6) AS bad_rate FROM ({SAMPLE}) GROUP BY new_org",
    "abnormal_months": f"""
        SELECT org, month, CAST(bads AS BIGINT) AS bads, rows, round(bad_rate, 6) AS bad_rate,
               CASE WHEN bads < 10 THEN '坏样本数' || CAST(bads AS BIGINT) || '<10' ELSE '总样本数' || rows || '<80' END AS reason
        FROM ({ABNORMAL})""",
    "month_filtered": f"SELECT new_org, new_date_ym, count(*) AS n, sum(quantity) AS quantity FROM ({KEPT}) GROUP BY ALL",
    "month_gaps": f"""
        SELECT * FROM (
            SELECT org, lag(month) OVER w AS after, month AS before,
                   CAST(date_diff('month', strptime(lag(month) OVER w || '01', '%Y%m%d'), strptime(month || '01', '%Y%m%d')) - 1
                        AS INTEGER) AS missing_months
            FROM (SELECT DISTINCT new_org AS org, new_date_ym AS month FROM ({KEPT})) WINDOW w AS (PARTITION BY org ORDER BY month))
        WHERE missing_months > 0""",
    "org_outliers": f"""
        SELECT org, rows, round(rate, 6) AS bad_rate, round(overall, 6) AS overall_rate,
               rate > overall * 1.05 OR rate < overall / 1.05 AS outlier
        FROM (SELECT new_org AS org, count(*) AS rows, avg(new_target) AS rate,
                     (SELECT avg(new_target) FROM ({SAMPLE})) AS overall FROM ({SAMPLE}) GROUP BY new_org)""",
    "missing_detail": missing_of(f"SELECT org_info AS org, * FROM ({RAW})", (*fx.FEATURES, "const")),
    "missing_drop": f"""
        SELECT feature, concat_ws('; ',
                   CASE WHEN overall > 0.25 THEN '整体缺失率' || printf('%.4f', overall) || '>0.25' END,
                   CASE WHEN orgs >= 6 THEN orgs || '个机构缺失率>0.25' END) AS reason
        FROM (SELECT feature, max(missing_rate) FILTER (WHERE scope = '{OVERALL}') AS overall,
                     count(*) FILTER (WHERE scope <> '{OVERALL}' AND missing_rate > 0.25) AS orgs
              FROM ({missing_of(f"SELECT new_org AS org, * FROM ({SAMPLE})", fx.FEATURES)}) GROUP BY feature)
        WHERE overall > 0.25 OR orgs >= 6""",
    "value_ratio_bands": band_sql(
        " UNION ALL ".join(
            f"SELECT new_org AS org, '{f}' AS feature, count({f}) / count(*) AS value FROM ({SAMPLE}) GROUP BY new_org"
            for f in NUMERIC
        ),
        (0, 0.15, 0.35, 0.65, 0.95, 1.0), "org1",
        ["[0, 15%)", "[15%, 35%)", "[35%, 65%)", "[65%, 95%)", "[95%, 100%]"], 1.0,
    ),
    "psi_pair": cte("SELECT * FROM pair", s=SAMPLE, **pair_psi(HALF_BASE, f"SELECT * FROM s WHERE NOT ({BASE})", NUMERIC)),
    "psi_categorical": cte(
        f"""SELECT feature, {psi_sum('coalesce(x, 0)', 'nb', 'coalesce(y, 0)', 'na')} AS psi
            FROM (SELECT feature, value, count(*) FILTER (WHERE side) AS x, count(*) FILTER (WHERE NOT side) AS y,
                         (SELECT count(*) FROM s WHERE {BASE}) AS nb, (SELECT count(*) FROM s WHERE NOT ({BASE})) AS na
                  FROM (SELECT 'segment' AS feature, segment AS value, {BASE} AS side FROM s
                        UNION ALL SELECT 'org', new_org, {BASE} FROM s) GROUP BY feature, value) GROUP BY feature""",
        s=SAMPLE,
    ),
    "psi_by_org_period": cte("SELECT * FROM d", **YEAR),
    "psi_by_org_month": cte("SELECT * FROM d", **org_psi("new_date_ym", ("quantity", "balance", "drift"), 80)),
    "psi_org_summary": cte(org_summary(0.05), **YEAR),
    "psi_drop": cte(
        f"""SELECT feature, 'PSI不稳定机构数' || count(*) FILTER (WHERE unstable) || '/' || (SELECT count(DISTINCT org) FROM d) AS reason,
                   string_agg(org, ',' ORDER BY org) FILTER (WHERE unstable) AS unstable_orgs
            FROM ({org_summary(0.1)}) GROUP BY feature HAVING count(*) FILTER (WHERE unstable) >= 6""",
        **YEAR,
    ),
    "psi_bands": cte(
        band_sql("SELECT org, feature, max(psi) AS value FROM d GROUP BY org, feature", (0, 0.05, 0.1, float("inf")), "org2"), **YEAR
    ),
    "cart_bins_k2": bins_sql(2, False, NUMERIC),
    "cart_bins_k3": bins_sql(3, True, NUMERIC),
    "cart_bins_k5": bins_sql(5, True, ("quantity", "discount", "price", "balance")),
    "iv_overall": iv_sql(f"SELECT feature, iv FROM iv WHERE scope = '{OVERALL}'"),
    "iv_by_org": iv_sql("SELECT feature, scope, iv FROM iv"),
    "iv_wide": iv_sql(
        f"SELECT feature, max(iv) FILTER (WHERE scope = '{OVERALL}') AS overall, "
        + ", ".join(f"max(iv) FILTER (WHERE scope = 'org{i}') AS org{i}" for i in range(8))
        + " FROM iv GROUP BY feature"
    ),
    "iv_bands": iv_sql(
        band_sql(f"SELECT scope AS org, feature, iv AS value FROM iv WHERE scope <> '{OVERALL}'", (0, 0.02, 0.05, 0.1, float("inf")), "org5")
    ),
    "iv_drop": iv_sql(
        f"""SELECT feature, concat_ws('; ', CASE WHEN overall < 0.02 THEN '整体IV=' || printf('%.4f', overall) || '<0.02' END,
                                   CASE WHEN orgs >= 2 THEN orgs || '个机构IV<0.02' END) AS reason
            FROM (SELECT feature, max(iv) FILTER (WHERE scope = '{OVERALL}') AS overall,
                         count(*) FILTER (WHERE scope <> '{OVERALL}' AND iv < 0.02) AS orgs FROM iv GROUP BY feature)
            WHERE overall < 0.02 OR orgs >= 2"""
    ),
    "corr_pairs": cte("SELECT feature_1, feature_2, round(r, 6) AS r FROM pairs", s=SAMPLE, pairs=PAIRS),
    "corr_high_pairs": cte(
        "SELECT feature_1, feature_2, round_even(abs(r), 4) AS r FROM pairs WHERE abs(r) > 0.5", s=SAMPLE, pairs=PAIRS
    ),
    "corr_drop": cte(
        """SELECT unnest(gone) AS feature, unnest(why) AS reason
           FROM (WITH RECURSIVE walk AS (
                     SELECT 0 AS i, []::VARCHAR[] AS gone, []::VARCHAR[] AS why
                     UNION ALL
                     SELECT i + 1,
                            CASE WHEN skip THEN gone ELSE list_append(gone, CASE WHEN iv1 <= iv2 THEN f1 ELSE f2 END) END,
                            CASE WHEN skip THEN why ELSE list_append(why, printf('与%s相关系数=%.4f>0.8，IV较低(%.4f<%.4f)',
                                CASE WHEN iv1 <= iv2 THEN f2 ELSE f1 END, r, least(iv1, iv2), greatest(iv1, iv2))) END
                     FROM (SELECT *, list_contains(gone, f1) OR list_contains(gone, f2) AS skip
                           FROM walk JOIN ranked ON place = i + 1))
                 SELECT gone, why FROM walk ORDER BY i DESC LIMIT 1)""",
        **IV_TABLES,
        pairs=PAIRS,
        ranked=f"""
            SELECT row_number() OVER (ORDER BY list_position({LIST}, feature_2), list_position({LIST}, feature_1)) AS place,
                   feature_1 AS f1, feature_2 AS f2, round_even(abs(r), 4) AS r, x.iv AS iv1, y.iv AS iv2
            FROM pairs JOIN iv x ON x.feature = feature_1 AND x.scope = '{OVERALL}'
                       JOIN iv y ON y.feature = feature_2 AND y.scope = '{OVERALL}' WHERE abs(r) > 0.8""",
    ),
    "vif": f"""
        SELECT feature, round(v, 6) AS vif, v > 5 AS high FROM (
            SELECT unnest(['quantity', 'discount', 'price']) AS feature,
                   unnest([(1 - c * c) / det, (1 - b * b) / det, (1 - a * a) / det]) AS v
            FROM (SELECT *, 1 + 2 * a * b * c - a * a - b * b - c * c AS det
                  FROM (SELECT corr(quantity, discount) AS a, corr(quantity, price) AS b, corr(discount, price) AS c
                        FROM ({SAMPLE}))))""",
    "missing_wide": f"""
        SELECT feature, max(missing_rate) FILTER (WHERE scope = '{OVERALL}') AS overall, """
    + ", ".join(f"max(missing_rate) FILTER (WHERE scope = 'org{i}') AS org{i}" for i in range(8))
    + f""" FROM ({missing_of(f"SELECT new_org AS org, * FROM ({SAMPLE})", fx.FEATURES)}) GROUP BY feature""",
    "time_split": f"""
        SELECT split, new_date, count(*) AS n, CAST(sum(l_orderkey) AS BIGINT) AS keys, sum(quantity) AS quantity
        FROM ({split_rows(True)}) GROUP BY ALL""",
    "split_summary": f"SELECT split, count(*) AS rows, round(avg(new_target), 6) AS bad_rate FROM ({split_rows(False)}) GROUP BY split",
    "stratified_folds": FOLDS,
    "corr_wide": cte(
        " UNION ALL ".join(
            f"""SELECT '{a}' AS feature_1, feature_2, round(r, 5) AS r FROM (
                SELECT {', '.join(f'corr({a}, {b}) AS {b}' for b in later)} FROM w) UNPIVOT INCLUDE NULLS (r FOR feature_2 IN ({', '.join(later)}))"""
            for a in fx.WIDE_SHOWN for later in [list(fx.WIDE)[list(fx.WIDE).index(a) + 1:]]
        ),
        w=f"SELECT {', '.join(f'{e} AS {c}' for c, e in fx.WIDE.items())} FROM lineitem",
    ),
    "csv_with_mark": f"""
        SELECT new_org, new_date_ym, sum(quantity) AS quantity, 'EFBBBF' AS heads FROM ({SAMPLE}) GROUP BY new_org, new_date_ym""",
    "feature_list_saved": " UNION ALL ".join(
        f"SELECT '{f}' AS feature, count(DISTINCT {f}) AS n_values FROM ({SAMPLE})" for f in NUMERIC if f not in ("tax", "drift")),
    "metrics_saved": cte(f"SELECT *, 0.7 AS auc, 3.0 AS lift_top10, true AS has_time FROM ({LIFT})", sc=SCORED),
    "segment_sizes": f"""
        SELECT segment, CAST(rows AS BIGINT) AS n_samples, round_even(bad_rate, 4) AS bad_rate, round_even(auc, 4) AS auc, round_even(ks, 4) AS ks
        FROM ({ranking(_SEGMENTS, 'segment')}) WHERE rows >= 50 AND auc IS NOT NULL""",
    "summary_of_folds": f"""
        SELECT metric, round(avg(value), 6) AS mean, round(stddev_samp(value), 6) AS std FROM (
            SELECT unnest(['val_auc', 'val_ks', 'val_gini']) AS metric,
                   unnest([round_even(auc, 4), round_even(ks, 4), round_even(2 * auc - 1, 4)]) AS value FROM ({ranking(_FOLDED, 'fold')}))
        GROUP BY metric""",
    "tree_gain": cte(
        """SELECT feature, round(coalesce(sum(gain), 0), 3) AS importance FROM (SELECT DISTINCT feature FROM limits)
           LEFT JOIN (SELECT feature, gain FROM best0 UNION ALL SELECT feature, gain FROM best1) USING (feature) GROUP BY feature""",
        **_FIRST_TREE,
    ),
    "search_densities": cte(
        """SELECT r.trial, round(auc, 4) AS auc, good, round(better, 4) AS better, round(worse, 4) AS worse,
                  better / worse = max(better / worse) OVER () AS next
           FROM r JOIN d USING (trial)""",
        s=SAMPLE,
        t="SELECT * FROM (VALUES " + ", ".join(f"({k}, {w!r}::DOUBLE)" for k, w in enumerate(fx.TRIALS)) + ") v(trial, w)",
        sc=f"SELECT trial, new_target, {fx.trial_score('w')} AS p FROM s CROSS JOIN t",
        r=f"""SELECT trial::INTEGER AS trial, w, round(auc, 6) AS auc, row_number() OVER (ORDER BY round(auc, 6) DESC, trial) <= 2 AS good
              FROM ({ranking('SELECT * FROM sc', 'trial')}) JOIN t USING (trial)""",
        centres="SELECT good, w AS c, false AS prior FROM r UNION ALL SELECT unnest([true, false]), 0.5, true",
        gaps="""SELECT *, count(*) OVER (PARTITION BY good) AS m,
                       greatest(c - coalesce(lag(c) OVER o, 0), coalesce(lead(c) OVER o, 1) - c) AS gap
                FROM centres WINDOW o AS (PARTITION BY good ORDER BY c, prior)""",
        curves="SELECT good, c, CASE WHEN prior THEN 1.0::DOUBLE ELSE greatest(least(gap, 1), 1.0::DOUBLE / least(100, 1 + m)) END AS width FROM gaps",
        # The part of a curve inside the range, by the middle of 5,000 strips.
        mass="""SELECT good, c, width, sum(exp(-pow(((i + 0.5) / 5000 - c) / width, 2) / 2) / width / 5000) AS mass
                FROM curves CROSS JOIN range(5000) x(i) GROUP BY good, c, width""",
        d="""SELECT trial, avg(y) FILTER (WHERE good_side) AS better, avg(y) FILTER (WHERE NOT good_side) AS worse
             FROM (SELECT trial, k.good AS good_side, exp(-pow((w - k.c) / k.width, 2) / 2) / k.width / mass AS y FROM t CROSS JOIN mass k) GROUP BY trial""",
    ),
    "cv_sizes": f"SELECT fold, (SELECT count(*) FROM ({SAMPLE})) - sum(n)::BIGINT AS train_size, sum(n)::BIGINT AS val_size FROM ({FOLDS}) GROUP BY fold",
    "tree_first_round": FIRST_ROUND,
    "category_codes": """
        SELECT 'pair' AS feature, value, n, dense_rank() OVER (ORDER BY value) - 1 AS code
        FROM (SELECT concat(l_partkey, '-', l_suppkey) AS value, count(*) AS n FROM lineitem GROUP BY value)""",
    "shuffled_ones": f"""
        SELECT run::INTEGER AS run, count(*) AS rows, sum(new_target)::BIGINT AS ones, true AS independent
        FROM (SELECT DISTINCT concat(l_orderkey, '-', l_linenumber, '-', quantity) AS row_id, new_target FROM ({SAMPLE})) CROSS JOIN range(5) r(run) GROUP BY run""",
    "scorecard_certificate": "SELECT unnest(['quantity', 'discount', 'balance', 'segment', 'intercept']) AS feature, true AS flat",
    "baseline_merge": MERGED,
    "forward_folds": f"""
        SELECT CAST(greatest(0, 5 - floor((n - 1 - place) / (n // 6))) AS INTEGER) AS fold, count(*) AS n,
               CAST(sum(l_orderkey) AS BIGINT) AS keys, min(new_date) AS first_date, max(new_date) AS last_date
        FROM (SELECT *, count(*) OVER () AS n, row_number() OVER (ORDER BY {ORDER}) - 1 AS place FROM ({SAMPLE})) GROUP BY fold""",
    "score_table": f"""
        SELECT round(p, 6) AS value, n, CAST(pos AS BIGINT) AS pos, CAST(sum(n) OVER (ORDER BY p) AS BIGINT) AS n_upto,
               CAST(sum(pos) OVER (ORDER BY p) AS BIGINT) AS pos_upto, CAST(sum(n) OVER () AS BIGINT) AS n_all,
               CAST(sum(pos) OVER () AS BIGINT) AS pos_all
        FROM (SELECT p, count(*) AS n, sum(new_target) AS pos FROM ({SCORED}) GROUP BY p)""",
    "auc_ks_gini": f"""
        SELECT CAST(rows AS BIGINT) AS rows, round(bad_rate, 6) AS bad_rate, round(auc, 6) AS auc, round(ks, 6) AS ks,
               round(2 * auc - 1, 6) AS gini FROM ({ranking(SCORED)})""",
    "pr_auc": f"SELECT round(pr_auc, 6) AS pr_auc FROM ({ranking(SCORED)})",
    "metrics_by_org_month": f"""
        SELECT new_org, new_date_ym, CAST(rows AS BIGINT) AS rows, round(auc, 6) AS auc, round(ks, 6) AS ks,
               round(pr_auc, 6) AS pr_auc FROM ({ranking(SCORED, 'new_org, new_date_ym')})""",
    "lift_table": cte(LIFT, sc=SCORED),
    "confusion": cte(
        f"SELECT * REPLACE (round(precision, 6) AS precision, round(recall, 6) AS recall, round(f1, 6) AS f1) FROM ({RATES})", sc=SCORED
    ),
    "eval_record": cte(
        f"""SELECT *, auc >= 0.7 AS auc_pass, ks >= 0.3 AS ks_pass, gini >= 0.4 AS gini_pass, top10_lift >= 3 AS lift_pass
            FROM (SELECT 'formula' AS model_name, round_even(auc, 4) AS auc, round_even(ks, 4) AS ks,
                         round_even(2 * auc - 1, 4) AS gini, round_even(pr_auc, 4) AS pr_auc,
                         (SELECT arg_min(lift, decile) FROM ({LIFT})) AS top10_lift, round_even(precision, 4) AS precision,
                         round_even(recall, 4) AS recall, round_even(f1, 4) AS f1, 0.3::DOUBLE AS threshold,
                         CAST(rows AS BIGINT) AS n_samples, round_even(bad_rate, 4) AS bad_rate
                  FROM ({ranking('SELECT * FROM sc')}), ({RATES}))""",
        sc=SCORED,
    ),
    "segment_stability": f"""
        SELECT new_org AS segment, CAST(rows AS BIGINT) AS n_samples, round_even(bad_rate, 4) AS bad_rate,
               round_even(auc, 4) AS auc, round_even(ks, 4) AS ks
        FROM ({ranking(SCORED, 'new_org')}) WHERE rows >= 50 AND auc IS NOT NULL""",
    "woe_bins": cte(
        """SELECT feature, CAST(bin AS INTEGER) AS bin, round(low, 6) AS low, round(high, 6) AS high, CAST(n AS BIGINT) AS n,
                  CAST(bad AS BIGINT) AS bad, round(bad_rate, 6) AS bad_rate, round(woe, 6) AS woe FROM ranges""",
        **woe_tables("SELECT * FROM s"),
    ),
    "woe_iv": cte(
        "SELECT feature, round_even(sum(part), 4) AS iv FROM ranges GROUP BY feature", **woe_tables("SELECT * FROM s")
    ),
    "woe_transform": cte(
        f"""SELECT new_date, new_org, quantity, {woe_lookup('quantity', 's.quantity')}, discount,
                   {woe_lookup('discount', 's.discount')}, balance, {woe_lookup('balance', 's.balance')}, s.segment,
                   {woe_lookup('segment', '(SELECT code FROM codes WHERE codes.segment = s.segment)')} FROM s""",
        **woe_tables(HALF_BASE),
    ),
    "score_formula": f"""
        SELECT l_orderkey, l_linenumber, {POINTS.format(base=OFFSET, sign='+')} AS score,
               {POINTS.format(base=OFFSET, sign='-')} AS quality_score FROM ({SCORED})""",
    "baseline_stats": cte(baseline_rows(), s=SAMPLE, b="SELECT * FROM s"),
    "feature_drift": cte(
        """SELECT feature, round(psi, 6) AS psi, round(base_missing, 6) AS base_missing,
                  round(current_missing, 6) AS current_missing FROM drift""", **DRIFT),
    "feature_alerts": cte("SELECT * FROM falerts", **DRIFT),
    "model_drift": cte("SELECT round(COLUMNS(*), 6) FROM mdrift", **MODEL),
    "model_alerts": cte("SELECT * FROM malerts", **MODEL),
    "alert_summary": cte(
        """SELECT (SELECT count(*) FROM falerts) AS total_feature_alerts,
                  (SELECT count(*) FROM falerts WHERE severity = 'HIGH') AS high_severity,
                  (SELECT count(*) FROM malerts) AS model_alerts""", **DRIFT, **MODEL),
}
ORACLES["corr_pairs_gaps"] = f"""
    WITH s AS MATERIALIZED ({SAMPLE})
    SELECT 'balance' AS feature_1, 'quantity' AS feature_2, round(corr(balance, quantity), 6) AS r FROM s
    UNION ALL SELECT 'balance', 'flat', NULL
    UNION ALL SELECT 'quantity', 'flat', round(corr(quantity, CASE WHEN balance IS NULL THEN quantity ELSE 1 END), 6) FROM s
"""
for _name in ("lift_table", "iv_by_org", "woe_bins"):
    ORACLES[f"{_name}_buckets"] = ORACLES[_name]
ORACLES["odd_names"] = f"""
    SELECT 'bal.avg' AS feature, v.iv, p.psi
    FROM ({ORACLES["iv_overall"]}) v, ({ORACLES["psi_pair"]}) p WHERE v.feature = 'balance' AND p.feature = 'balance'
"""

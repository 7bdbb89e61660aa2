"""Credit samples derived from the test tables, as Spark frames and as SQL text.

The SELECT below is written once for both engines; only the date formatting
function differs.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from creditspark.plans.storage import is_small

# Limits between bins of the features of the tree that SQL grows too.
TREE_LIMITS = {
    "quantity": [5.5 + 5 * i for i in range(9)], "discount": [0.005 + 0.01 * i for i in range(10)], "tax": [0.005 + 0.01 * i for i in range(8)],
}

# Many columns out of few, by a rule that both engines read alike.
WIDE = {
    f"c{k}": f"CAST(CASE WHEN {'(l_orderkey + %d) %% 13 = 0' % k if k % 5 == 0 else '1 = 0'} THEN NULL "
             f"ELSE l_quantity * {k % 7 + 1} + l_linenumber * {k % 11} + (l_orderkey * {k + 1}) % 97 END AS DOUBLE)"
    for k in range(300)
}
WIDE_SHOWN = ("c0", "c63", "c64", "c250")

# Weights of twenty trials, spread over the range by the golden ratio, and the score of a trial.
TRIALS = [round((0.5 + 0.6180339887 * k) % 1, 6) for k in range(20)]


def trial_score(weight) -> str:
    return f"round(CAST({weight} AS DOUBLE) * quantity / 50 + (1 - CAST({weight} AS DOUBLE)) * 10 * discount, 9)"


TABLES = ("lineitem", "orders", "customer", "part", "supplier")

NUMERIC = (
    "quantity", "discount", "tax", "price", "total", "size_", "retail",
    "balance", "sparse", "quantity_mix", "drift",
)
FEATURES = (*NUMERIC, "segment")

RAW = """
SELECT l_orderkey, l_linenumber, l_shipdate AS apply_date,
       concat('org', CAST(s_nationkey % 8 AS {text})) AS org_info,
       CASE WHEN (l_quantity > 40 AND l_discount >= 0.05) OR c_acctbal < -500 THEN 1 ELSE 0 END AS label,
       l_quantity AS quantity, l_discount AS discount, l_tax AS tax, l_extendedprice AS price,
       o_totalprice AS total, p_size AS size_, p_retailprice AS retail, c_mktsegment AS segment,
       CASE WHEN l_linenumber % 3 = 0 THEN CAST(NULL AS DOUBLE)
            WHEN l_linenumber % 7 = 1 THEN CAST(-999 AS DOUBLE) ELSE c_acctbal END AS balance,
       CASE WHEN l_orderkey % 10 < 7 THEN CAST(NULL AS DOUBLE) ELSE l_tax END AS sparse,
       2 * l_quantity + 50 * l_discount AS quantity_mix,
       l_extendedprice * (1 + CAST(0.1 AS DOUBLE) * (year(l_shipdate) - 1995)) AS drift,
       1 AS const
FROM lineitem
JOIN orders ON l_orderkey = o_orderkey
JOIN customer ON o_custkey = c_custkey
JOIN part ON l_partkey = p_partkey
JOIN supplier ON l_suppkey = s_suppkey
"""

SPARK_RAW = RAW.format(text="STRING")
DUCK_RAW = RAW.format(text="VARCHAR")

# The cleaned sample without removal of repeated keys.
DUCK_SAMPLE = f"""
SELECT strftime(apply_date, '%Y%m%d') AS new_date, strftime(apply_date, '%Y%m') AS new_date_ym,
       org_info AS new_org, label AS new_target,
       CASE WHEN quantity NOT IN (-1, -999, -1111) THEN quantity END AS quantity,
       CASE WHEN discount NOT IN (-1, -999, -1111) THEN discount END AS discount,
       CASE WHEN tax NOT IN (-1, -999, -1111) THEN tax END AS tax,
       CASE WHEN price NOT IN (-1, -999, -1111) THEN price END AS price,
       CASE WHEN total NOT IN (-1, -999, -1111) THEN total END AS total,
       CASE WHEN size_ NOT IN (-1, -999, -1111) THEN size_ END AS size_,
       CASE WHEN retail NOT IN (-1, -999, -1111) THEN retail END AS retail,
       CASE WHEN balance NOT IN (-1, -999, -1111) THEN balance END AS balance,
       sparse, quantity_mix, drift, segment, l_orderkey, l_linenumber
FROM ({DUCK_RAW}) raw
"""

# Weights of the model-free score. Rounding makes equal scores equal in both engines.
SCORE = "round(1 / (1 + exp(-(-4 + CAST(0.06 AS DOUBLE) * quantity + 12 * discount))), 9)"

# A degraded half: its rows, and its score.
WORSE_ROWS = "new_target = 1 OR quantity <= 25"
WORSE_SCORE = SCORE.replace("0.06 AS DOUBLE", "-0.02 AS DOUBLE").replace("12 * discount", "0.5")


def read_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/lineitem.parquet")


def raw_sample(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The uncleaned application table."""
    tables = {name: spark.read.parquet(f"{sf_dir}/{name}.parquet") for name in TABLES if name != "lineitem"}
    tables["lineitem"] = read_lines(spark, sf_dir)
    # Orders meet their customers before the many more lines do, and few suppliers go to the lines.
    tables["orders"] = tables["orders"].join(tables.pop("customer"), F.col("o_custkey") == F.col("c_custkey"))
    suppliers = tables["supplier"].select("s_suppkey", "s_nationkey")
    tables["supplier"] = F.broadcast(suppliers) if is_small(suppliers) else suppliers
    return spark.sql(SPARK_RAW.replace("FROM lineitem", "FROM {lineitem}").replace("JOIN orders", "JOIN {orders}")
                     .replace("JOIN customer ON o_custkey = c_custkey\n", "").replace("JOIN part", "JOIN {part}")
                     .replace("JOIN supplier", "JOIN {supplier}"), **tables)


def sample(spark: SparkSession, sf_dir: str, *columns: str) -> DataFrame:
    """Cleaned sample with role columns; keys stay, repeated keys too."""
    from creditspark.sources.load import clean_sample

    raw = raw_sample(spark, sf_dir).drop("const")
    if columns:
        raw = raw.select("l_orderkey", "l_linenumber", "apply_date", "org_info", "label", *columns)
    return clean_sample(raw, "apply_date", "label", "org_info", drop_constants=False)


def scored(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(new_date, new_date_ym, new_org, new_target, p) with many tied scores."""
    return sample(spark, sf_dir, "quantity", "discount").withColumn("p", F.expr(SCORE))


DUCK_SCORED = f"""
SELECT new_date, new_date_ym, new_org, new_target, quantity, discount, l_orderkey, l_linenumber, {SCORE} AS p
FROM ({DUCK_SAMPLE}) clean
"""

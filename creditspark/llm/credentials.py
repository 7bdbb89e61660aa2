"""Secrets, with multipart credentials linked within scopes.

Strict spans (assign, access, hex) are always reported. Weak candidates - account names
(account), unlabelled key-like tokens (key), endpoints (endpoint) and assigned values below the
strict length (short) - are reported only if a part that completes them lies in the same scope: a
name needs a secret, a token or a short value needs an access identifier or a name, and an
endpoint needs both an identifier and a secret; a short value counts as secret. Two
spans share a scope if they are at most ``SCOPE`` characters apart in one document.

The interval join is an equi-join over cells of the document as long as the scope. Each
side is first reduced to the outermost span of each cell, which decides for a whole
neighbouring cell, so a cell full of parts never yields all its pairs.

Null and empty texts have no spans. Repeated rows and rows with null ids each get their own
row. An empty table gives no rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .spans import Pattern, find_spans, rank_of
from .tables import Scratch, back_to, free_name, numbered

STRICT = ("assign", "access", "hex")
WEAK = ("account", "endpoint", "key", "short")
KINDS = (*STRICT, *WEAK)
SCOPE = 400
MARK = "[secret]"
# Characters of an assigned value from which on it is a strict span.
ASSIGNED = 12

_VALUE = "[A-Za-z0-9+/_.=-]"
ASSIGN = r"""(?i:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?"""
PATTERNS = (
    Pattern("assign", ASSIGN + _VALUE + "++"),
    Pattern("access", "AKIA[A-Z0-9]{14,}+", "AKIA"),
    Pattern("hex", "[0-9a-f]{16,}+"),
    Pattern("account", r"""(?<![A-Za-z0-9])(?i:client_id|access_id|username|user|login|account)["']?\x20*[:=]\x20*["']?[A-Za-z0-9._@-]{3,}+"""),
    Pattern("endpoint", r"""(?i:https?|jdbc:[a-z]{2,20}|amqp|redis|mongodb)://[^\s"'<>]{3,}+""", "://"),
    Pattern("key", r"(?<![A-Za-z0-9+/_-])(?=[A-Za-z0-9+/_-]*[0-9])(?=[A-Za-z0-9+/_-]*[A-Z])(?=[A-Za-z0-9+/_-]*[a-z])[A-Za-z0-9+/_-]{20,}+={0,2}"),
)
# What each part counts as when credentials are put together.
ROLE = {"assign": "secret", "hex": "secret", "key": "secret", "short": "secret", "access": "id", "account": "id", "endpoint": "endpoint"}
NEEDS = {"account": ("secret",), "key": ("id",), "short": ("id",), "endpoint": ("id", "secret")}


def near(spans: DataFrame, roles: DataFrame, scope: int = SCOPE) -> DataFrame:
    """``(_row, start, end, kind, role)``: each span of ``spans`` with every role that ``roles`` has within ``scope``."""
    cell = F.floor(F.col("start") / scope)
    outermost = roles.groupBy("_row", cell.alias("cell"), "role").agg(F.min("start").alias("first"), F.max("start").alias("last"))
    probes = spans.select("_row", "start", "end", "kind", F.explode(F.array(cell - 1, cell, cell + 1)).alias("cell"), cell.alias("own"))
    met = probes.join(outermost, ["_row", "cell"]).where(
        (F.col("cell") == F.col("own"))
        | ((F.col("cell") > F.col("own")) & (F.col("first") <= F.col("start") + scope))
        | ((F.col("cell") < F.col("own")) & (F.col("last") >= F.col("start") - scope))
    )
    return met.select("_row", "start", "end", "kind", "role").distinct()


def secrets(docs: DataFrame, scope: int = SCOPE, scratch: Scratch | None = None) -> DataFrame:
    """Per row: ``_row``, ``doc_id`` and ``spans``, structs (start, rank, end, kind, base, linked, value)
    sorted by start, then kind as listed. ``linked`` names the roles of complementing parts in scope."""
    scratch = scratch or Scratch(docs.sparkSession)
    rows, found = find_spans(docs, PATTERNS, scratch)
    value = F.regexp_replace("value", "^" + ASSIGN, "")
    role = F.create_map(*[x for k, r in ROLE.items() for x in (F.lit(k), F.lit(r))])
    short = (F.col("kind") == "assign") & (F.length(value) < ASSIGNED)
    parts = found.withColumn("kind", F.when(short, "short").otherwise(F.col("kind"))).select(
        "_row", "kind", "start", "end", "value", F.element_at(role, F.col("kind")).alias("role"), F.col("kind").isin(*STRICT).alias("base")
    )
    # A weak span inside a strict one is a part of it, not a second secret.
    ordered = Window.partitionBy("_row").orderBy("start", F.desc("end"))
    reached = F.max(F.when(F.col("base"), F.col("end"))).over(ordered.rowsBetween(Window.unboundedPreceding, Window.currentRow))
    coming = F.min(F.when(F.col("base"), F.col("start"))).over(ordered.rowsBetween(Window.currentRow, Window.unboundedFollowing))
    free = F.col("base") | ((F.coalesce(reached, F.lit(-1)) <= F.col("start")) & (F.coalesce(coming, F.col("end")) >= F.col("end")))
    parts = scratch.write(parts.withColumn("free", free).where("free").drop("free"), "parts")

    linked = near(parts, parts.select("_row", "start", "role"), scope)
    linked = linked.groupBy("_row", "start", "end", "kind").agg(F.array_sort(F.collect_set("role")).alias("linked"))
    judged = parts.join(linked, ["_row", "start", "end", "kind"], "left").withColumn("linked", F.coalesce("linked", F.array().cast("array<string>")))
    needed = F.create_map(*[x for k, n in NEEDS.items() for x in (F.lit(k), F.array(*map(F.lit, n)))])
    complete = F.size(F.array_except(F.element_at(needed, F.col("kind")), F.col("linked"))) == 0
    kept = judged.where(F.col("base") | complete)
    one = F.struct("start", rank_of(F.col("kind"), KINDS).alias("rank"), "end", "kind", "base", "linked", "value")
    per_row = kept.groupBy("_row").agg(F.array_sort(F.collect_list(one)).alias("spans"))
    empty = F.array().cast(per_row.schema["spans"].dataType)
    return rows.join(per_row, "_row", "left").withColumn("spans", F.coalesce("spans", empty))


def redacted(docs: DataFrame, mark: str = MARK, scratch: Scratch | None = None) -> DataFrame:
    """``docs`` with every reported span replaced by ``mark``; overlapping spans give one mark."""
    scratch = scratch or Scratch(docs.sparkSession)
    table = numbered(docs, scratch)
    name = free_name(table, "__llm_spans")
    found = secrets(table, scratch=scratch).where(F.size("spans") > 0).select("_row", F.col("spans").alias(name))
    joined = back_to(table, scratch.write(found, "found"), "left")
    scratch.keep("numbered", "found")
    # Stretches of merged spans: each keeps the text between the last end and its start.
    step = lambda a, s: F.struct(
        F.greatest(a["at"], s["end"]).alias("at"),
        F.when(s["start"] < a["at"], a["out"]).otherwise(
            F.concat(a["out"], F.substring(F.col("text"), a["at"].cast("int") + 1, (s["start"] - a["at"]).cast("int")), F.lit(mark))
        ).alias("out"),
    )
    begin = F.struct(F.lit(0).cast("long").alias("at"), F.lit("").alias("out"))
    text = F.aggregate(name, begin, step, lambda a: F.concat(a["out"], F.substring(F.col("text"), a["at"].cast("int") + 1, F.length("text"))))
    return joined.withColumn("text", F.when(F.size(name) > 0, text).otherwise(F.col("text"))).select(docs.columns)

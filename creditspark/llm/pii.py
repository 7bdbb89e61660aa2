"""Personal data by weak supervision: labelers vote on candidate spans, expectation
maximisation weighs them, and a span classifier trained on the outcome decides.

Candidates come from patterns: the strict kinds (email, ip, card, phone) and loose ones
(account, email_spelled, person, phone_local). Four labelers vote yes, no or nothing on
each: the strict form of the value, a gazetteer (top-level domains, given names, card
prefixes), cue words before the span, and the characters around it. Votes are counted per
kind and vote pattern over the whole corpus (a table bounded by kinds x 3^4), expectation
maximisation estimates every labeler's reliability per kind from those counts, and a naive
Bayes classifier over votes and length class is trained on the resulting soft labels. Strict
spans are always reported; a loose one where the classifier says so and no strict span overlaps it.

Null and empty texts have no spans. Repeated rows and rows with null ids each get their own
row. An empty table, or one without candidates, gives rows without spans.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .spans import Pattern, find_spans, rank_of
from .tables import Scratch

STRICT = ("email", "ip", "card", "phone")
LOOSE = ("account", "email_spelled", "person", "phone_local")
KINDS = (*STRICT, *LOOSE)
LABELERS = ("form", "gazetteer", "cue", "border")
ROUNDS = 50
KEEP = 0.5

# Matching runs from the first character that can begin a match, without giving characters
# back; nothing follows that would need them, so this finds the same spans in linear time.
_CHAIN = r"(?<![0-9])(?<![0-9][\x20-])[0-9](?:[\x20-]?[0-9]){%s}+(?![\x20-]?[0-9])"
PATTERNS = (
    Pattern("email", r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++", "@"),
    Pattern("ip", r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++", "."),
    Pattern("card", _CHAIN % "15,18"),
    Pattern("phone", r"\+[0-9][\x20().0-9-]+[0-9]", "+"),
    Pattern("account", _CHAIN % "11,14"),
    Pattern("email_spelled", r"[A-Za-z0-9._%+-]{1,64}\x20?[\[(](?:at|AT)[\])]\x20?[A-Za-z0-9-]{1,64}\x20?(?:\.|[\[(](?:dot|DOT)[\])])\x20?[A-Za-z]{2,12}"),
    Pattern("person", r"(?<![A-Za-z])(?:Mr|Mrs|Ms|Dr|Name|Contact|Author|name|contact|author)(?:\.|:)?\x20[A-Z][a-z]{1,30}\x20[A-Z][a-z]{1,30}(?![A-Za-z])"),
    Pattern("phone_local", r"(?<![0-9+.(-])(?<![0-9]\x20)\(?[0-9]{3}\)?[\x20.-][0-9]{3}[\x20.-][0-9]{4}(?![0-9]|[.-][0-9])"),
)

# Cue words, common domains, given names.
CUES = r"(?i)(?:e-?mail|mail|contact|write|phone|tel|call|mobile|fax|card|visa|account|iban|ip|host|server|addr|name|author|dear|mr|mrs|dr)\W{0,3}(?:\w{0,12}\W{1,3})?$"
DOMAINS = ("com", "org", "net", "edu", "gov", "io", "de", "fr", "es", "uk", "info")
NAMES = (
    "Alice", "Anna", "Carlos", "Charles", "Claire", "David", "Elena", "Emma", "Hans", "James", "Jan", "Jean", "John",
    "Jose", "Julia", "Karl", "Laura", "Lucas", "Maria", "Marie", "Martin", "Mary", "Michael", "Paul", "Peter", "Pierre",
    "Robert", "Sarah", "Sofia", "Thomas", "William",
)


def digits(value: Column) -> Column:
    return F.regexp_replace(value, "[^0-9]", "")


def luhn(value: Column) -> Column:
    """True if the digits of ``value`` pass the Luhn test."""
    d = F.reverse(digits(value))
    def weigh(i: Column) -> Column:
        x = F.substring(d, i + 1, F.lit(1)).cast("int") * (1 + i % 2)
        return F.when(x > 9, x - 9).otherwise(x)
    return F.aggregate(F.sequence(F.lit(0), F.length(d) - 1), F.lit(0), lambda a, i: a + weigh(i)) % 10 == 0


def small_parts(value: Column) -> Column:
    """True if all dot-separated numbers are at most 255."""
    def small(p: Column) -> Column:
        short = F.regexp_replace(p, "^0+(?=[0-9])", "")
        return F.when(F.length(short) <= 3, short.cast("int") <= 255).otherwise(False)
    return F.forall(F.split(value, r"\."), small)


def strict_form(kind: Column, value: Column) -> Column:
    """The contract's checks of the strict kinds; null for loose ones."""
    n = F.length(digits(value))
    return (
        F.when(kind == "email", True).when(kind == "ip", small_parts(value))
        .when(kind == "card", n.between(16, 19) & luhn(value)).when(kind == "phone", n.between(8, 15))
    )


def _vote(yes: Column, no: Column) -> Column:
    return F.when(yes, 1).when(no, -1).otherwise(0)


def votes(spans: DataFrame) -> DataFrame:
    kind, value = F.col("kind"), F.col("value")
    strict = strict_form(kind, value)
    n = F.length(digits(value))
    domain = F.lower(F.regexp_extract(value, r"([A-Za-z]+)[^A-Za-z]*$", 1))
    name = F.regexp_extract(value, r"([A-Z][a-z]+) [A-Z][a-z]+$", 1)
    ends = (F.right("before", F.lit(1)).rlike(r"[\w@]"), F.left("after", F.lit(1)).rlike(r"[\w@]"))
    mails, numbers = kind.isin("email", "email_spelled"), kind.isin("card", "account")
    return spans.select(
        "*",
        F.coalesce(strict, F.lit(False)).alias("base"),
        F.when(strict.isNotNull(), _vote(strict, ~strict))
        .when(kind == "account", _vote(n.between(13, 15) & luhn(value), F.lit(False)))
        .when(kind == "phone_local", _vote(value.rlike(r"^\([2-9][0-9]{2}\)|^[2-9][0-9]{2}[-.]"), value.rlike("^[01]")))
        .otherwise(0).alias("form"),
        F.when(mails, _vote(domain.isin(*DOMAINS), F.lit(False)))
        .when(kind == "person", _vote(name.isin(*NAMES), F.lit(False)))
        .when(numbers, _vote(digits(value).rlike("^(?:4|5[1-5]|3[47]|6)"), digits(value).rlike("^0")))
        .otherwise(0).alias("gazetteer"),
        _vote(F.col("before").rlike(CUES) | value.rlike(r"^(?:Mr|Mrs|Ms|Dr|Contact|contact)"), F.lit(False)).alias("cue"),
        F.when(ends[0] | ends[1], -1).otherwise(0).alias("border"),
        F.least(F.length(value) / 8, F.lit(7)).cast("int").alias("size"),
    )


def reliabilities(counts: list[tuple], rounds: int = ROUNDS) -> tuple[dict, dict]:
    """Expectation maximisation over vote patterns ``(kind, votes, n)``.

    Returns the share of true spans per kind and, per (kind, labeler, truth, vote), its chance.
    Labelers start out as better than chance; a kind without votes stays undecided below one half.
    """
    share = {kind: 0.4 for kind, _, _ in counts}
    chance = {
        (kind, l, t, v): (0.6 if (v == 1) == t and v else 0.3 if v == 0 else 0.1)
        for kind in share for l in range(len(LABELERS)) for t in (True, False) for v in (-1, 0, 1)
    }
    for _ in range(rounds):
        total: dict = {}
        seen: dict = {}
        for kind, pattern, n in counts:
            p = posterior(kind, pattern, share, chance)
            for t, w in ((True, n * p), (False, n * (1 - p))):
                total[kind, t] = total.get((kind, t), 0.0) + w
                for l, v in enumerate(pattern):
                    seen[kind, l, t, v] = seen.get((kind, l, t, v), 0.0) + w
        for kind in share:
            yes, no = total[kind, True], total[kind, False]
            share[kind] = (yes + 1) / (yes + no + 2.5)
            for l in range(len(LABELERS)):
                for t, all_of in ((True, yes), (False, no)):
                    for v in (-1, 0, 1):
                        prior = 0.6 if (v == 1) == t and v else 0.3 if v == 0 else 0.1
                        chance[kind, l, t, v] = (seen.get((kind, l, t, v), 0.0) + 10 * prior) / (all_of + 10)
    return share, chance


def posterior(kind: str, pattern: tuple, share: dict, chance: dict) -> float:
    """Chance that a span with these votes is personal data. Silence of a labeler counts for nothing."""
    odds = math.log(share[kind] / (1 - share[kind]))
    for l, v in enumerate(pattern):
        if v:
            odds += math.log(chance[kind, l, True, v] / chance[kind, l, False, v])
    return 1 / (1 + math.exp(-max(-30.0, min(30.0, odds))))


def classifier(counts: list[tuple], share: dict, chance: dict) -> list[tuple]:
    """Naive Bayes over votes and length class, from soft labels: (kind, votes, size, score) per pattern."""
    total: dict = {}
    seen: dict = {}
    for kind, pattern, size, n in counts:
        p = posterior(kind, pattern, share, chance)
        for t, w in ((True, n * p), (False, n * (1 - p))):
            total[kind, t] = total.get((kind, t), 0.0) + w
            for feature in (*enumerate(pattern), ("size", size)):
                seen[kind, t, feature] = seen.get((kind, t, feature), 0.0) + w
    scored = []
    for kind, pattern, size, n in counts:
        yes, no = total[kind, True] + 1, total[kind, False] + 1
        odds = math.log(yes / no)
        for feature in (*enumerate(pattern), ("size", size)):
            odds += math.log((seen.get((kind, True, feature), 0.0) + 0.5) / yes) - math.log((seen.get((kind, False, feature), 0.0) + 0.5) / no)
        scored.append((kind, *pattern, size, 1 / (1 + math.exp(-max(-30.0, min(30.0, odds))))))
    return scored


def personal_data(docs: DataFrame, keep: float = KEEP, scratch: Scratch | None = None) -> DataFrame:
    """Per row: ``_row``, ``doc_id`` and ``spans``, structs (rank, start, end, kind, base, score, value)
    sorted by kind as listed, then start."""
    spark = docs.sparkSession
    scratch = scratch or Scratch(spark)
    rows, found = find_spans(docs, PATTERNS, scratch)
    voted = scratch.write(votes(found), "votes")
    by_pattern = voted.groupBy("kind", *LABELERS, "size").count().collect()
    counts = [(r["kind"], tuple(r[l] for l in LABELERS), r["size"], r["count"]) for r in by_pattern]
    share, chance = reliabilities([(k, v, n) for k, v, _, n in counts])
    scored = spark.createDataFrame(classifier(counts, share, chance), "kind string, " + ", ".join(f"{l} int" for l in LABELERS) + ", size int, score double")
    judged = voted.join(F.broadcast(scored), ["kind", *LABELERS, "size"])

    # Loose spans that touch a strict one are the strict one's business.
    ordered = Window.partitionBy("_row").orderBy("start", "end")
    reached = F.max(F.when(F.col("base"), F.col("end"))).over(ordered.rowsBetween(Window.unboundedPreceding, -1))
    coming = F.min(F.when(F.col("base"), F.col("start"))).over(ordered.rowsBetween(1, Window.unboundedFollowing))
    clear = (F.coalesce(reached, F.lit(-1)) <= F.col("start")) & (F.coalesce(coming, F.col("end")) >= F.col("end"))
    kept = judged.withColumn("clear", clear).where(
        F.col("base") | (F.col("clear") & (F.col("score") >= keep) & F.col("kind").isin(*LOOSE))
    )
    one = F.struct(rank_of(F.col("kind"), KINDS).alias("rank"), "start", "end", "kind", "base", "score", "value")
    per_row = kept.groupBy("_row").agg(F.array_sort(F.collect_list(one)).alias("spans"))
    joined = rows.join(per_row, "_row", "left")
    empty = F.array().cast(per_row.schema["spans"].dataType)
    return joined.withColumn("spans", F.coalesce("spans", empty))

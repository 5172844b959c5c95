"""Personal data by weak supervision.

Patterns propose candidate spans. Five labelers vote on each (yes, no, or no vote): the strict
pattern with its check, a number check, gazetteers, the words before it, and what it touches.
Expectation-maximisation over the table of vote patterns estimates how reliable each labeler is
and with that the chance that a candidate is personal data. A logistic regression on features of
the span is then trained on those chances and decides. Spans of the strict patterns always stay;
the regression adds others.

All of it is DataFrame code. Texts are read once; the vote patterns are counted over all candidates
and the table of patterns, which has a fixed bound (kinds times votes), is what the
estimation and the training see.
"""

from __future__ import annotations

from math import exp, log

from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import let, settle

#: Kinds in the order in which spans with equal starts are listed.
KINDS = ["email", "ip", "card", "phone", "name"]
LABELERS = ["strict", "checked", "listed", "context", "free"]
ACCEPT = 0.5
ROUNDS = 40

# Common top-level domains, international calling codes, card issuer prefixes and
# given names, as public lists have them.
DOMAINS = "com org net edu gov io info biz co uk de fr es it nl eu ch at be pl us ca au jp cn in br example test".split()
CALLING = "1 7 20 27 30 31 32 33 34 36 39 40 41 43 44 45 46 47 48 49 51 52 54 55 56 57 60 61 62 63 64 65 66 81 82 84 86 90 91 351 353 358 420".split()
ISSUERS = "4|5[1-5]|2[2-7]|3[47]|6011|65|35|30|36"
GIVEN = (
    "James Mary Robert Patricia John Jennifer Michael Linda David Elizabeth William Barbara Richard Susan Joseph Jessica "
    "Thomas Sarah Charles Karen Daniel Nancy Matthew Lisa Anthony Mark Paul Steven Anna Maria Peter Hans Klaus Jean Pierre "
    "Marie Sophie Luc Claude Jacques Jose Juan Carlos Luis Miguel Carmen Pilar Antonio Francisco Julia Laura Stefan Wolfgang"
).split()
POSITIVE = "e-?mail|mailto|contact|tel|telephone|phone|call|mobile|fax|tél|telefon|teléfono|appel|card|visa|mastercard|karte|carte|tarjeta|ip|host|server|address|adresse|name|mr|mrs|ms|dr|herr|frau|señor|madame"
NEGATIVE = "version|release|order|invoice|isbn|issn|page|chapter|section|doi|sku|id|ref|serial|total|year"

_MAIL = "[A-Za-z0-9._%+-]"
#: (kind, whether a checked match is a base span, pattern). Matches begin where the plain pattern's
#: leftmost matches begin; look-behind and possessive repeats only keep long runs linear.
PATTERNS = [
    ("email", True, rf"(?:\G|(?<!{_MAIL})){_MAIL}++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++"),
    ("ip", True, r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}"),
    ("card", True, r"(?<![0-9])(?<![0-9][ -])[0-9](?:[ -]?[0-9]){13,18}+(?![ -]?[0-9])"),
    ("phone", True, r"\+[0-9][ ().0-9-]+[0-9]"),
    ("email", False, rf"(?<!{_MAIL}){_MAIL}{{1,64}}+ ?[(\[]at[)\]] ?[A-Za-z0-9-]{{1,63}}+ ?(?:\.|[(\[]dot[)\]]) ?[A-Za-z]{{2,12}}+"),
    ("ip", False, r"(?<![0-9A-Fa-f:])(?:[0-9A-Fa-f]{1,4}:){7}[0-9A-Fa-f]{1,4}(?![0-9A-Fa-f:])"),
    ("phone", False, r"(?<![0-9+(.-])(?<![0-9] )\(?[0-9]{2,4}\)?[ .-][0-9]{3,4}[ .-][0-9]{3,4}(?![0-9]|[ .-][0-9])"),
    ("name", False, rf"\b(?:{'|'.join(GIVEN)}) [A-ZÀ-Þ][a-zß-ÿ]+"),
]
_BLOCK = 64


def _running(sizes: Column) -> Column:
    """Running sums of an array, in blocks so that long arrays are not copied for every element."""
    none = F.array(F.lit(0).cast("long"))

    def total(a: Column) -> Column:
        return F.aggregate(a, F.lit(0).cast("long"), lambda s, x: s + x)

    def sums(a: Column) -> Column:
        blocks = F.sequence(F.lit(0), F.floor((F.size(a) - 1) / _BLOCK).cast("int"))
        before = F.aggregate(
            blocks, none, lambda s, b: F.concat(s, F.array(F.element_at(s, -1) + total(F.slice(a, b * _BLOCK + 1, _BLOCK))))
        )
        return let(
            before,
            lambda s: F.transform(
                a, lambda _, i: F.get(s, F.floor(i / _BLOCK).cast("int")) + total(F.slice(a, i - i % _BLOCK + 1, i % _BLOCK + 1))
            ),
        )

    return let(sizes, sums)


def matches(text: Column, pattern: str) -> Column:
    """Leftmost non-overlapping matches: structs of start, end, match, and what stands around it.

    Positions count code points. The pieces between matches give the positions, so that a text is
    read twice however many matches it has, and once if it has none.
    """
    kind = "array<struct<start:bigint,end:bigint,match:string,before:string,after:string>>"
    found = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))

    def spans(m: Column) -> Column:
        def placed(p: Column) -> Column:
            sizes = F.transform(m, lambda x, i: (F.length(F.get(p, i)) + F.length(x)).cast("long"))
            return let(
                _running(sizes),
                lambda ends: F.transform(
                    m,
                    lambda x, i: F.struct(
                        (F.get(ends, i) - F.length(x)).alias("start"),
                        F.get(ends, i).alias("end"),
                        x.alias("match"),
                        F.right(F.get(p, i), F.lit(40)).alias("before"),
                        F.left(F.get(p, i + 1), F.lit(8)).alias("after"),
                    ),
                ).cast(kind),
            )

        return F.when(F.size(m) > 0, let(F.split(text, pattern, -1), placed)).otherwise(F.array().cast(kind))

    return let(found, spans)


def _luhn(digits: Column) -> Column:
    """Whether the digits pass the Luhn check."""
    doubled = F.array(*[F.lit(x) for x in (0, 2, 4, 6, 8, 1, 3, 5, 7, 9)])

    def digit(i: Column) -> Column:
        value = F.substr(F.reverse(digits), i, F.lit(1)).cast("int")
        return F.when(i % 2 == 0, F.get(doubled, value)).otherwise(value)

    return F.aggregate(F.sequence(F.lit(1), F.greatest(F.length(digits), F.lit(1))), F.lit(0), lambda s, i: s + digit(i)) % 10 == 0


def _vote(yes: Column, no: Column | None = None) -> Column:
    against = F.when(no, -1).otherwise(0) if no is not None else F.lit(0)
    return F.when(yes, 1).otherwise(against).cast("int")


def candidates(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per candidate: doc, body, kind, start, end, base, votes and features."""
    body = F.coalesce(F.col(text).cast("string"), F.lit(""))
    rows = docs.select(F.col(key).alias("doc"), F.xxhash64(body).alias("body"), body.alias("text"))

    def marked(kind: str, strict: bool, pattern: str) -> Column:
        mark = [F.lit(kind).alias("kind"), F.lit(strict).alias("strict")]
        return F.transform(matches(F.col("text"), pattern), lambda m: F.struct(*mark, m.alias("m")))

    spans = rows.select("doc", "body", F.explode(F.concat(*[marked(*p) for p in PATTERNS])).alias("c")).select(
        "doc", "body", "c.kind", F.col("c.strict").alias("by_pattern"), "c.m.*"
    )
    digits, count = F.col("digits"), F.col("count")
    spans = spans.withColumn("digits", F.regexp_replace("match", "[^0-9]", "")).withColumn("count", F.length("digits"))
    octets = F.col("match").rlike(r"^0*(25[0-5]|2[0-4][0-9]|1?[0-9]{1,2})(\.0*(25[0-5]|2[0-4][0-9]|1?[0-9]{1,2})){3}$")
    checked = (
        F.when(F.col("kind") == "ip", octets)
        .when(F.col("kind") == "card", _luhn(digits))
        .when(F.col("kind") == "phone", count.between(10, 15))
        .otherwise(True)
    )
    spans = spans.withColumn("passes", checked)
    checked = F.col("passes")
    low = F.lower("before")
    near = low.rlike(rf"(?:^|[^\p{{L}}])(?:{POSITIVE})[^\p{{L}}]{{0,4}}(?:\p{{L}}+[^\p{{L}}]{{1,3}}){{0,2}}$")
    against = low.rlike(rf"(?:^|[^\p{{L}}])(?:{NEGATIVE})[^\p{{L}}]{{0,4}}$")
    touches = F.col("before").rlike(r"[\p{L}0-9_/=#-]$") | F.col("after").rlike(r"^[\p{L}0-9_/]")
    listed = (
        F.when(F.col("kind") == "email", F.lower(F.regexp_extract(F.right("match", F.lit(12)), "([A-Za-z]+)$", 1)).isin(DOMAINS))
        .when(F.col("kind") == "card", digits.rlike(f"^(?:{ISSUERS})"))
        .when((F.col("kind") == "phone") & F.col("by_pattern"), digits.rlike(f"^(?:{'|'.join(CALLING)})"))
        .when(F.col("kind") == "phone", digits.rlike("^0"))
        .when(F.col("kind") == "ip", ~digits.rlike("^0"))
        .otherwise(True)
    )
    base = F.col("by_pattern") & checked
    numeric = F.col("kind").isin("ip", "card", "phone")
    return spans.select(
        "doc",
        "body",
        "kind",
        "start",
        "end",
        base.alias("base"),
        _vote(base, F.col("by_pattern") & ~checked).alias("strict"),
        _vote(numeric & checked, numeric & ~checked).alias("checked"),
        _vote(listed, ~listed).alias("listed"),
        _vote(near, against).alias("context"),
        _vote(F.lit(False), touches).alias("free"),
        F.col("match").rlike("[ ()-]").cast("int").alias("spaced"),
        (count >= 14).cast("int").alias("long_number"),
        count.between(9, 13).cast("int").alias("mid_number"),
    )


def reliabilities(counted: list[tuple], rounds: int = ROUNDS) -> dict[tuple, float]:
    """The chance of each (kind, votes) pattern, by expectation-maximisation.

    ``counted`` has (kind, votes, count) rows, votes being a tuple of 1, -1 and 0. Given the truth,
    labelers err on their own, with a rate for each vote; rates are smoothed so that a
    vote seen once decides nothing. The start is the majority of the votes.
    """
    chance = {(k, v): 1 / (1 + exp(-2.0 * sum(v))) for k, v, _ in counted}
    for _ in range(rounds):
        rate: dict[tuple, float] = {}
        whole = {0: 2.0, 1: 2.0}
        prior: dict[str, list[float]] = {}
        for kind, votes, n in counted:
            for truth in (0, 1):
                share = n * (chance[kind, votes] if truth else 1 - chance[kind, votes])
                whole[truth] += share
                prior.setdefault(kind, [1.0, 1.0])[truth] += share
                for labeler, vote in enumerate(votes):
                    rate[labeler, vote, truth] = rate.get((labeler, vote, truth), 0.0) + share
        for kind, votes, _ in counted:
            odds = log(prior[kind][1] / prior[kind][0])
            for labeler, vote in enumerate(votes):
                if vote:
                    yes, no = ((rate.get((labeler, vote, t), 0.0) + 1) / (whole[t] + 2) for t in (1, 0))
                    odds += log(yes / no)
            chance[kind, votes] = 1 / (1 + exp(-max(-30.0, min(30.0, odds))))
    return chance


FEATURES = [f"is_{k}" for k in KINDS] + ["strict", "checked", "listed", "context", "free", "spaced", "long_number", "mid_number"]


def _with_kinds(df: DataFrame) -> DataFrame:
    return df.withColumns({f"is_{k}": (F.col("kind") == k).cast("int") for k in KINDS})


def classifier(found: DataFrame) -> Column:
    """The chance that a row of candidates is personal data, as a column expression."""
    shapes = ["kind", *LABELERS, "spaced", "long_number", "mid_number"]
    table = settle(found.groupBy(*shapes).agg(F.count("*").alias("n")).coalesce(1), "votes")
    counted: dict[tuple, int] = {}
    for r in table.groupBy("kind", *LABELERS).agg(F.sum("n").alias("n")).collect():
        counted[r["kind"], tuple(r[x] for x in LABELERS)] = r["n"]
    chance = reliabilities(sorted((k, v, n) for (k, v), n in counted.items()))
    weight = F.lit(0.5)
    for (kind, votes), p in sorted(chance.items()):
        same = F.concat_ws(" ", "kind", *LABELERS) == " ".join([kind, *map(str, votes)])
        weight = F.when(same, F.lit(p)).otherwise(weight)
    soft = _with_kinds(table).withColumn("p", weight)
    rows = soft.select(*FEATURES, F.lit(1.0).alias("label"), (F.col("n") * F.col("p")).alias("w")).unionByName(
        soft.select(*FEATURES, F.lit(0.0).alias("label"), (F.col("n") * (1 - F.col("p"))).alias("w"))
    )
    rows = settle(rows.where("w > 0").coalesce(1), "soft-labels")
    if rows.select("label").distinct().count() < 2:
        return F.lit(1.0 if chance and max(chance.values()) > ACCEPT else 0.0)
    vectors = VectorAssembler(inputCols=FEATURES, outputCol="features").transform(rows)
    model = LogisticRegression(weightCol="w", regParam=1e-3, maxIter=30).fit(vectors)
    margin = F.lit(float(model.intercept))
    for name, w in zip(FEATURES, model.coefficients.toArray(), strict=True):
        value = (F.col("kind") == name[3:]).cast("int") if name.startswith("is_") else F.col(name)
        margin = margin + F.lit(float(w)) * value
    return 1 / (1 + F.exp(-margin))


def find(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc, body, base, added) of each document with spans: sorted arrays of (start, rank, kind, end).

    An added span that overlaps a base span says nothing new and is left out.
    """
    found = settle(candidates(docs, key, text), "candidates")
    scored = found.withColumn("chance", classifier(found)).where(F.col("base") | (F.col("chance") >= ACCEPT))
    rank = F.array_position(F.array(*map(F.lit, KINDS)), F.col("kind")).cast("int")
    span = F.struct("start", rank.alias("rank"), "kind", "end")
    spans = scored.groupBy("doc", "body").agg(
        F.array_sort(F.collect_set(F.when(F.col("base"), span))).alias("base"),
        F.array_sort(F.collect_set(F.when(~F.col("base"), span))).alias("extra"),
    )
    clear = F.filter(
        "extra", lambda e: ~F.exists("base", lambda b: (b["start"] < e["end"]) & (e["start"] < b["end"]))
    )
    return spans.select("doc", "body", "base", clear.alias("added"))


def _listed(spans: Column) -> Column:
    return F.concat_ws(
        ",", F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string")))
    )


def report(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Base counts, the hash of the base spans and all spans of every row, whole texts.

    Null and empty texts have no spans. Repeated rows get a row each, a null key is kept, other
    columns are ignored, an empty table gives an empty result.
    """
    found = find(docs, key, text).alias("f")
    body = F.xxhash64(F.coalesce(F.col(text).cast("string"), F.lit("")))
    rows = docs.select(F.col(key).alias("doc"), body.alias("body")).alias("r")
    none = F.array().cast("array<struct<start:bigint,rank:int,kind:string,end:bigint>>")
    both = rows.join(found, F.expr("r.doc <=> f.doc and r.body = f.body"), "left").select(
        F.col("r.doc").alias(key), F.coalesce("f.base", none).alias("base"), F.coalesce("f.added", none).alias("added")
    )
    kinds = F.transform("base", lambda s: s["kind"])
    counts = [(F.size(kinds) - F.size(F.array_remove(kinds, k))).cast("long").alias(f"n_{k}") for k in KINDS[:4]]
    return both.select(
        key,
        *counts,
        F.sha2(_listed(F.col("base")), 256).alias("base_sha256"),
        _listed(F.array_sort(F.concat("base", "added"))).alias("spans"),
    )

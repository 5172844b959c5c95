"""Secrets in texts: a scan for candidates and a random forest that removes false positives.

Every run of 16 or more letters, digits and the signs of common encodings is a candidate. The
forest sees its length, how its characters change from class to class, how much of it a dictionary
covers, the path of its document and the words around it, and is trained on labelled findings.

The dictionary is made of the letter runs that the corpus itself uses often. Coverage is worked out
once per different candidate. All of it is DataFrame code; the forest is Spark's own.
"""

from __future__ import annotations

from pyspark.ml.classification import RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import held_out, settle
from tidemark.llm.pii import matches

LEAST = 16
CANDIDATE = rf"(?<![A-Za-z0-9+/_-])[A-Za-z0-9+/_-]{{{LEAST},}}+={{0,2}}"
#: A letter run is a dictionary word if the corpus has it this often.
COMMON = 5
#: Labelled findings that the forest is trained on, at most, per label.
SAMPLE = 4_000
TREES, DEPTH, SEED = 20, 6, 13
ACCEPT = 0.5
NAMES = "token|secret|passw(?:or)?d|passwd|pwd|api[_-]?key|access[_-]?key|private[_-]?key|key|auth|credential|bearer"
EXAMPLES = "example|sample|dummy|test|fake|placeholder|redacted"
FEATURES = [
    "length", "digits", "uppers", "hexes", "kinds", "changes", "vowel_changes", "covered",
    "path_code", "path_example", "slashes", "named", "assigned", "quoted", "example_near", "word_before",
]


def candidates(docs: DataFrame, key: str = "doc_id", text: str = "text", path: str | None = "source") -> DataFrame:
    """(doc, body, path, start, end, match, before, after): every candidate of every whole text."""
    body = F.coalesce(F.col(text).cast("string"), F.lit(""))
    known = path is not None and path in docs.columns
    where = F.coalesce(F.col(path).cast("string"), F.lit("")) if known else F.lit("")
    rows = docs.select(F.col(key).alias("doc"), F.xxhash64(body).alias("body"), where.alias("path"), body.alias("text"))
    return rows.select("doc", "body", "path", F.explode(matches(F.col("text"), CANDIDATE)).alias("c")).select(
        "doc", "body", "path", "c.*"
    )


def dictionary(docs: DataFrame, text: str = "text", common: int = COMMON) -> DataFrame:
    """(run): the letter runs of four or more that the corpus has at least ``common`` times."""
    runs = F.regexp_extract_all(F.lower(F.col(text).cast("string")), F.lit("[a-z]{4,}"), F.lit(0))
    return (
        docs.select(F.explode(runs).alias("run")).groupBy("run").agg(F.count("*").alias("n")).where(F.col("n") >= common).select("run")
    )


def coverage(found: DataFrame, words: DataFrame) -> DataFrame:
    """(match, covered): the share of each different candidate that dictionary words make up."""
    runs = F.regexp_extract_all(F.lower("match"), F.lit("[a-z]{4,}"), F.lit(0))
    each = found.select("match").distinct()
    known = each.select("match", F.explode(runs).alias("run")).join(words, "run")
    return known.groupBy("match").agg(F.sum(F.length("run")).alias("n")).select(
        "match", (F.col("n") / F.length("match")).alias("covered")
    )


def _share(pattern: str) -> Column:
    return F.regexp_count("match", F.lit(pattern)) / F.length("match")


def with_features(found: DataFrame, words: DataFrame) -> DataFrame:
    """The candidates with one column per feature."""
    low, path = F.lower("before"), F.lower("path")
    word = F.regexp_extract(low, r"(\p{L}+)[^\p{L}]*$", 1)
    flag = {
        "path_code": path.rlike(r"\.(?:py|js|ts|java|go|rb|env|ya?ml|json|toml|cfg|ini|sh)$"),
        "path_example": path.rlike(f"(?:{EXAMPLES}|doc|readme)"),
        "named": low.rlike(rf"(?:{NAMES})[^\p{{L}}\p{{N}}]{{0,6}}$"),
        "assigned": low.rlike(r"[=:]\s*[\"']?$"),
        "quoted": low.rlike("[\"'`]$") & F.col("after").rlike("^[\"'`]"),
        "example_near": low.rlike(f"(?:{EXAMPLES})") | F.lower("after").rlike(f"(?:{EXAMPLES})"),
    }
    return (
        found.join(coverage(found, words), "match", "left")
        .withColumns({k: v.cast("double") for k, v in flag.items()})
        .withColumns(
            {
                "length": F.log1p(F.length("match")),
                "digits": _share("[0-9]"),
                "uppers": _share("[A-Z]"),
                "hexes": _share("[0-9a-fA-F]"),
                "kinds": F.size(F.array_distinct(F.split("match", ""))) / F.least(F.length("match"), F.lit(64)),
                "changes": _share("(?<=[0-9])[A-Za-z]|(?<=[A-Za-z])[0-9]|(?<=[a-z])[A-Z]"),
                "vowel_changes": _share("(?<=[aeiouAEIOU])[b-df-hj-np-tv-zB-DF-HJ-NP-TV-Z]"),
                "covered": F.coalesce("covered", F.lit(0.0)),
                "slashes": _share("/"),
                "word_before": F.pmod(F.xxhash64(word), F.lit(16)).cast("double"),
            }
        )
    )


def train(labelled: DataFrame, bound: int = SAMPLE):
    """A forest from candidates with features and a ``label``, or None if only one label occurs.

    At most ``bound`` rows of each label are used, in the order of a hash, so that the same
    findings give the same forest.
    """
    order = [F.xxhash64("match", "before", "start"), "match", "before", "start", "doc"]
    parts = [labelled.where(F.col("label") == v).orderBy(*order).limit(bound) for v in (0, 1)]
    rows = settle(parts[0].unionByName(parts[1]).select(*FEATURES, F.col("label").cast("double").alias("label")).coalesce(1), "findings")
    if rows.select("label").distinct().count() < 2:
        return None
    forest = RandomForestClassifier(numTrees=TREES, maxDepth=DEPTH, seed=SEED, featureSubsetStrategy="sqrt")
    return forest.fit(VectorAssembler(inputCols=FEATURES, outputCol="features").transform(rows))


def score(found: DataFrame, forest) -> DataFrame:
    """The candidates with the forest's chance that they are secrets; 0 without a forest."""
    if forest is None:
        return found.withColumn("chance", F.lit(0.0))
    vectors = VectorAssembler(inputCols=FEATURES, outputCol="features").transform(found)
    scored = forest.transform(vectors)
    return scored.withColumn("chance", F.get(vector_to_array("probability"), F.lit(1))).drop(
        "features", "rawPrediction", "probability", "prediction"
    )


def weak_labels(found: DataFrame) -> DataFrame:
    """Findings labelled by a rule, for corpora that come without labelled findings.

    A value assigned in quotes, with digits and letters and no dictionary word, is a secret. Runs of
    letters or of digits alone are not. All others, and the held-out fold, stay unlabelled.
    """
    mixed = F.col("digits").between(0.1, 0.9) & F.col("match").rlike("[A-Za-z]")
    secret = (F.col("assigned") == 1) & (F.col("quoted") == 1) & mixed & (F.col("covered") < 0.2)
    plain = F.col("match").rlike("^(?:[A-Za-z_-]+|[0-9-]+)$") & (F.col("assigned") == 0)
    label = F.when(secret, 1).when(plain, 0)
    return found.where(~held_out(F.col("doc"))).withColumn("label", label).where("label is not null")


def scan(
    docs: DataFrame, findings: DataFrame | None = None, key: str = "doc_id", text: str = "text", path: str | None = "source"
) -> DataFrame:
    """Every candidate with its features and ``chance``.

    ``findings`` has (doc, start, label) rows, label 1 for a true finding; without it labels
    come from ``weak_labels``.
    """
    found = settle(with_features(candidates(docs, key, text, path), dictionary(docs, text)), "secret-candidates")
    if findings is None:
        labelled = weak_labels(found)
    else:
        known = findings.groupBy("doc", "start").agg(F.min(F.col("label").cast("int")).alias("label"))
        labelled = found.join(known, ["doc", "start"])
    return score(found, train(labelled))


def report(docs: DataFrame, findings: DataFrame | None = None, key: str = "doc_id", text: str = "text", path: str | None = "source") -> DataFrame:
    """(key, n_candidates, n_secrets, secrets) of every row; secrets are start:end, comma-joined.

    Positions count code points, ends are exclusive. Null and empty texts have no candidates, a
    null path is an empty one. Repeated rows get a row each, a null key is kept, other columns are
    ignored, an empty table gives an empty result.
    """
    span = F.when(F.col("chance") >= ACCEPT, F.struct("start", "end"))
    found = (
        scan(docs, findings, key, text, path)
        .groupBy("doc", "body")
        .agg(F.collect_set("start").alias("starts"), F.array_sort(F.collect_set(span)).alias("spans"))
        .alias("f")
    )
    body = F.xxhash64(F.coalesce(F.col(text).cast("string"), F.lit("")))
    rows = docs.select(F.col(key).alias("doc"), body.alias("body")).alias("r")
    listed = F.transform("f.spans", lambda s: F.concat_ws(":", s["start"].cast("string"), s["end"].cast("string")))
    return rows.join(found, F.expr("r.doc <=> f.doc and r.body = f.body"), "left").select(
        F.col("r.doc").alias(key),
        F.greatest(F.size("f.starts"), F.lit(0)).cast("long").alias("n_candidates"),
        F.greatest(F.size("f.spans"), F.lit(0)).cast("long").alias("n_secrets"),
        F.coalesce(F.concat_ws(",", listed), F.lit("")).alias("secrets"),
    )

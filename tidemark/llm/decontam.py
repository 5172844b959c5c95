"""Benchmark decontamination by a broadcast hash set of normalised word windows.

Benchmark items are cut into windows of 10 words. The hash of every window of every document is
looked up in the set; what is found is compared word by word before it counts. The set is
broadcast in blocks of at most ``BLOCK`` windows, so that no block grows with the benchmark; a
larger benchmark takes more passes over the documents and gives the same result.

Everything is DataFrame code. Document windows stay inside the task that read the document: the
words of a document are not copied to its windows, and only hits are shuffled.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import ascii_lower, let, settle

#: ``[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+``, by what it holds: Java takes several times as long for the other.
WORD = "[a-z0-9\\x80-\\x{10FFFF}]+"
#: The same words before lower-casing.
RAW_WORD = "[a-zA-Z0-9\\x80-\\x{10FFFF}]+"
WINDOW = 10
BLOCK = 200_000


def words_of(text: Column) -> Column:
    """The words of a text in order; none for a null text."""
    lowered = ascii_lower(F.coalesce(text.cast("string"), F.lit("")))
    return F.regexp_extract_all(lowered, F.lit(WORD), F.lit(0))


def _window_hash(words: Column, place: Column, length: int) -> Column:
    """The hash of the window of so many words at a place; one that runs over the end equals no other."""
    return F.xxhash64(F.lit(length), *[F.get(words, place + k) for k in range(length)])


def benchmark_windows(items: DataFrame, key: str = "item_id", text: str = "text", window: int = WINDOW) -> DataFrame:
    """(length, hash, gram, items): each different window once, with the items that hold it.

    An item with fewer words than a window, but not none, is one window of all its words.
    """
    split = items.select(F.col(key).alias("item"), words_of(F.col(text)).alias("words")).where(F.size("words") > 0)
    length = F.least(F.size("words"), F.lit(window))
    grams = split.withColumn("length", length).select(
        "item",
        "length",
        F.explode(
            F.transform(
                F.sequence(F.lit(1), F.size("words") - F.col("length") + 1),
                lambda i: F.slice("words", i, F.col("length")),
            )
        ).alias("gram"),
    )
    hashed = F.lit(None).cast("long")
    for n in range(1, window + 1):
        of_n = F.xxhash64(F.lit(n), *[F.get("gram", F.lit(k)) for k in range(n)])
        hashed = F.when(F.col("length") == n, of_n).otherwise(hashed)
    return grams.groupBy("length", "gram").agg(F.collect_set("item").alias("items")).withColumn("hash", hashed)


def _keyed(docs: DataFrame, key: str, text: str) -> DataFrame:
    body = F.coalesce(F.col(text).cast("string"), F.lit(""))
    return docs.select(F.col(key).alias("doc"), F.xxhash64(body).alias("body"), body.alias("text"))


def hits(
    docs: DataFrame,
    items: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    item_key: str = "item_id",
    window: int = WINDOW,
    block: int = BLOCK,
) -> DataFrame:
    """(doc, body, spans, items) of each document with a hit; body is the hash of its text.

    ``spans`` are word ranges (start, end), end exclusive, sorted; ``items`` the items found.
    """
    grams = settle(benchmark_windows(items, item_key, "text", window), "windows")
    sizes = {r["length"]: r["n"] for r in grams.groupBy("length").agg(F.count("*").alias("n")).collect()}
    blocks = max(1, -(-sum(sizes.values()) // block))
    words = _keyed(docs, key, text).select("doc", "body", words_of(F.col("text")).alias("words"))
    # outer: before an inner explode Spark asks for the size of the array, and so finds all words twice
    places = words.select("doc", "body", "words", F.posexplode_outer("words").alias("start", "word"))
    hashes = [_window_hash(F.col("words"), F.col("start"), n) for n in sorted(sizes)] or [F.lit(0).cast("long")]
    one_hash = hashes[0] if len(hashes) == 1 else F.explode_outer(F.array(*hashes))
    windows = places.select("doc", "body", "words", "start", one_hash.alias("hash"))
    found = None
    for b in range(blocks):
        # not by ``hash``: Spark would test it on every window of the documents too, and hash each twice
        part = grams.where(F.pmod(F.xxhash64("gram"), F.lit(blocks)) == b) if blocks > 1 else grams
        one = (
            windows.join(F.broadcast(part), "hash")
            .where(F.slice("words", F.col("start") + 1, F.col("length")) == F.col("gram"))
            .select("doc", "body", F.struct("start", (F.col("start") + F.col("length")).alias("end")).alias("span"), "items")
        )
        found = one if found is None else found.unionByName(one)
    return found.groupBy("doc", "body").agg(
        F.array_sort(F.collect_set("span")).alias("spans"),
        F.array_distinct(F.flatten(F.collect_set("items"))).alias("items"),
    )


def covered(spans: Column) -> Column:
    """How many words sorted and possibly overlapping spans cover."""
    return F.aggregate(
        spans,
        F.struct(F.lit(0).cast("long").alias("n"), F.lit(0).cast("long").alias("until")),
        lambda at, s: F.struct(
            (at["n"] + F.greatest(F.lit(0), s["end"] - F.greatest(s["start"], at["until"]))).cast("long").alias("n"),
            F.greatest(at["until"], s["end"]).cast("long").alias("until"),
        ),
        lambda at: at["n"],
    )


def report(docs: DataFrame, items: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per document row: words, hit words, and the items whose windows occur.

    Null and empty texts have no words and no hits; items without words are never found. Repeated
    rows get a row each, a null key is kept, other columns are ignored. An empty table of
    documents gives an empty result, an empty benchmark no hits.
    """
    found = hits(docs, items, key, text)
    rows = _keyed(docs, key, text).select("doc", "body", F.regexp_count("text", F.lit(RAW_WORD)).cast("long").alias("n_words"))
    both = rows.alias("r").join(
        found.alias("h"), F.expr("r.doc <=> h.doc and r.body = h.body"), "left"
    )
    n_hit = F.coalesce(covered(F.col("h.spans")), F.lit(0).cast("long"))
    names = F.coalesce(
        F.array_sort(F.transform("h.items", lambda i: i.cast("string"))), F.array().cast("array<string>")
    )
    return both.select(
        F.col("r.doc").alias(key),
        "n_words",
        n_hit.alias("n_hit"),
        F.size(names).cast("long").alias("n_items"),
        F.sha2(F.concat_ws(",", names), 256).alias("items_sha256"),
        (n_hit > 0).alias("contaminated"),
    )


def decontaminate(
    docs: DataFrame, items: DataFrame, key: str = "doc_id", text: str = "text", remove: str = "documents"
) -> DataFrame:
    """The documents without benchmark passages, columns unchanged.

    ``remove="documents"`` drops every document with a hit; ``remove="spans"`` keeps it and cuts
    the hit words out of its text, with what stands between two hit words.
    """
    found = hits(docs, items, key, text).alias("h")
    body = F.xxhash64(F.coalesce(F.col(f"d.{text}").cast("string"), F.lit("")))
    match = F.col(f"d.{key}").eqNullSafe(F.col("h.doc")) & (body == F.col("h.body"))
    if remove == "documents":
        return docs.alias("d").join(found, match, "left_anti")
    joined = docs.alias("d").join(found, match, "left")
    source = F.col(f"d.{text}")
    words = F.regexp_extract_all(source, F.lit(RAW_WORD), F.lit(0))
    gaps = F.split(source, RAW_WORD, -1)
    hit = F.flatten(F.transform("h.spans", lambda s: F.sequence(s["start"], s["end"] - 1)))
    keep = F.array_except(F.sequence(F.lit(0), F.size(words)), hit)
    # after each kept word, and before the first one, the gap that follows stays
    cut = let(
        F.struct(words.alias("w"), gaps.alias("g"), keep.alias("k")),
        lambda x: F.concat(
            F.get(x["g"], F.lit(0)),
            F.array_join(
                F.transform(x["k"], lambda i: F.concat(F.coalesce(F.get(x["w"], i), F.lit("")), F.coalesce(F.get(x["g"], i + 1), F.lit("")))),
                "",
            ),
        ),
    )
    cleaned = F.when(F.col("h.spans").isNull(), source).otherwise(cut)
    return joined.select(*[cleaned.alias(c) if c == text else F.col(f"d.{c}") for c in docs.columns])

"""Lines whose template recurs across documents, by a log-template tree of fixed depth.

A line is parsed by its number of tokens, then by its leading tokens, then by the rest. Tokens with
a digit are variable fields and read as ``<*>`` everywhere. Behind the leading tokens a line of
``GENERAL`` tokens or more is cut into five even stretches; a template also arises from leaving any
one stretch variable. So two lines share a template if they are equal but for numbers and, in
longer lines, for one stretch of a fifth of the tokens. Changes scattered over several stretches are
not found, also where 0.8 of the tokens agree.

A template that occurs in at least two documents recurs. The document with the smallest key keeps
its lines, all other documents lose theirs, whatever their length; a line without a token is no line.

Only hashes of templates and places of lines are shuffled; texts move once, to meet the places of
their dropped lines. A template of very many lines is one row per task before the shuffle.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import fresh, let

GENERAL = 10
LEADING = 2
STRETCHES = 5
VARIABLE = "<*>"
#: A token with a digit, found from its first character so that long tokens cost no more.
_FIELD = "(?<!\\S)[^\\s0-9]*+[0-9]\\S*+"


def tokens_of(line: Column) -> Column:
    """The tokens of a line with variable fields masked."""
    masked = F.when(line.rlike("[0-9]"), F.regexp_replace(line, _FIELD, VARIABLE)).otherwise(line)
    return F.array_remove(F.split(masked, "[ \\t\\x0B\\f\\r]+"), "")


def template_keys(tokens: Column) -> Column:
    """The hashes of the templates of one line: it whole, then with each stretch left open."""

    def keys(w: Column) -> Column:
        n = F.size(w)
        rest = n - LEADING
        leaf = F.xxhash64(n, F.slice(w, 1, LEADING))

        def stretch(i: int) -> Column:
            start = F.floor(rest * i / STRETCHES)
            return F.xxhash64(F.slice(w, start.cast("int") + LEADING + 1, (F.floor(rest * (i + 1) / STRETCHES) - start).cast("int")))

        parts = F.array(*[stretch(i) for i in range(STRETCHES)])
        open_ones = let(
            parts,
            lambda p: F.array(
                *[F.xxhash64(leaf, F.lit(i), *[p[k] for k in range(STRETCHES) if k != i]) for i in range(STRETCHES)]
            ),
        )
        whole = F.array(F.xxhash64(n, w))
        return (
            F.when(n == 0, F.array().cast("array<bigint>")).when(n < GENERAL, whole).otherwise(F.concat(whole, open_ones))
        )

    return let(tokens, keys)


def _body(docs: DataFrame, text: str) -> Column:
    return F.xxhash64(F.coalesce(F.col(text).cast("string"), F.lit("")))


def dropped_lines(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc, body, places): which lines, from 0, a document loses; body is the hash of its text."""
    lines = docs.where(F.col(key).isNotNull()).select(
        F.col(key).alias("doc"), _body(docs, text).alias("body"), F.posexplode(F.split(F.col(text).cast("string"), "\n")).alias("place", "line")
    )
    keyed = lines.select("doc", "body", "place", F.explode(template_keys(tokens_of(F.col("line")))).alias("template"))
    recurring = (
        keyed.groupBy("template").agg(F.min("doc").alias("first"), F.max("doc").alias("last")).where("first < last").select("template", "first")
    )
    later = keyed.join(recurring, "template").where("first < doc")
    return later.groupBy("doc", "body").agg(F.collect_set("place").alias("places"))


def _joined(docs: DataFrame, key: str, text: str) -> DataFrame:
    found = dropped_lines(docs, key, text).alias("x")
    same = F.col(f"d.{key}").eqNullSafe(F.col("x.doc")) & (F.xxhash64(F.coalesce(F.col(f"d.{text}").cast("string"), F.lit(""))) == F.col("x.body"))
    return docs.alias("d").join(found, same, "left")


def _kept_text(text: Column) -> Column:
    """The text without the lines at ``x.places``."""
    lines = F.split(text, "\n")

    def rest(x: Column) -> Column:
        kept = F.array_except(F.sequence(F.lit(0), F.size(x["lines"]) - 1), x["places"])
        return F.array_join(F.transform(kept, lambda i: F.get(x["lines"], i)), "\n")

    return F.when(F.col("x.places").isNull(), text).otherwise(let(F.struct(lines.alias("lines"), F.col("x.places").alias("places")), rest))


def without_recurring(docs: DataFrame, key: str = "doc_id", text: str = "text", size: str | None = "n_chars") -> DataFrame:
    """The documents without their recurring lines, columns unchanged; ``size`` follows the text.

    A document whose every word stood in dropped lines repeats earlier documents whole and goes.
    Rows without a key keep all lines and count for no template. Null texts stay null. Rows that
    repeat a key are one document, so their lines do not recur by themselves. Empty tables give
    empty results.
    """
    kept = _kept_text(F.col(f"d.{text}").cast("string"))
    kept_, cut = fresh(docs, "kept", "cut")
    rows = _joined(docs, key, text).select(*[F.col(f"d.`{c}`").alias(c) for c in docs.columns], kept.alias(kept_), F.col("x.places").isNotNull().alias(cut))
    gone = F.col(cut) & ~F.col(kept_).rlike("\\S")

    def column(name: str) -> Column:
        if name == text:
            return F.col(kept_).alias(name)
        if name == size:
            return F.when(F.col(cut), F.length(kept_)).otherwise(F.col(name)).cast(docs.schema[name].dataType).alias(name)
        return F.col(f"`{name}`")

    return rows.where(~gone).select(*[column(c) for c in docs.columns])


def report(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, n_lines, n_dropped, text_sha256) of every row; the hash is of the text that is left."""
    source = F.coalesce(F.col(f"d.{text}").cast("string"), F.lit(""))
    return _joined(docs, key, text).select(
        F.col(f"d.{key}").alias(key),
        F.size(F.split(source, "\n")).cast("long").alias("n_lines"),
        F.greatest(F.size("x.places"), F.lit(0)).cast("long").alias("n_dropped"),
        F.sha2(_kept_text(source), 256).alias("text_sha256"),
    )

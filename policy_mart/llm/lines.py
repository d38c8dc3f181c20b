"""Line dedup by a fixed-depth tree of log templates."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ._work import Shelf, name

#: What a variable field becomes.
FIELD = "<*>"


def masked_tokens(line: Column) -> Column:
    """The tokens of a line, which blanks part; those with a digit are variable fields."""
    masked = F.when(line.rlike("[0-9]"), F.regexp_replace(line, "[^ ]*[0-9][^ ]*", FIELD)).otherwise(line)
    return F.array_remove(F.split(masked, " "), "")


def _text_id(text: Column) -> Column:
    return F.xxhash64(text, F.length(text))


def recurring_lines(docs: DataFrame, shelf: Shelf, text: str, depth: int, least_docs: int, constant: float) -> tuple[DataFrame, DataFrame]:
    """(lines, drops): every line of every distinct text, and the ids of lines to drop.

    A line descends by its number of tokens and its first `depth` tokens to a leaf. In a leaf, a
    token at a position is constant if at least `least_docs` lines have it there; all else is a
    variable field, and constants and fields make the line's template. A template recurs if at least
    `least_docs` different texts have it and at least the fraction `constant` of its positions behind the
    leading ones are constant.
    """
    exploded = docs.select(name(text).alias("_t")).filter(F.col("_t").isNotNull()).select(
        _text_id(F.col("_t")).alias("doc"), F.posexplode(F.split("_t", "\n")).alias("at", "line")
    )
    # A line of blanks has no tokens. This is said of the line, so that tokens are made once.
    tokens = exploded.filter(F.length(F.trim("line")) > 0).withColumn("tokens", masked_tokens(F.col("line")))
    leaf = F.xxhash64(F.size("tokens"), F.slice("tokens", 1, depth)).alias("leaf")
    # Equal texts are one text here: a copied document does not make its lines recur.
    narrow = tokens.select("doc", "at", F.xxhash64("line").alias("line"), leaf, F.size("tokens").alias("n"))
    lines = shelf.put(narrow.dropDuplicates(["doc", "at"]))
    leaves = lines.select("leaf", "doc").distinct().groupBy("leaf").count().filter(F.col("count") >= least_docs)
    # Joined by a shuffle at any size: there is no bound on the number of leaves.
    leaves = shelf.put(leaves.select("leaf")).hint("merge")
    # The distinct lines of leaves that could hold a recurring template, with the lines' frequency.
    weights = lines.join(leaves, "leaf", "left_semi").groupBy("line").agg(F.count(F.lit(1)).alias("times"))
    # Lines are shuffled as they are, and only those of such leaves are cut into tokens again.
    wide = tokens.select(leaf, F.col("line").alias("_line")).join(leaves, "leaf", "left_semi")
    wide = wide.select("leaf", F.xxhash64("_line").alias("line"), "_line").dropDuplicates(["line"]).join(weights, "line")
    kept = shelf.put(wide.select("leaf", "line", "times", masked_tokens(F.col("_line")).alias("tokens")))
    behind = kept.select(
        "line", "leaf", "times", F.posexplode(F.slice("tokens", depth + 1, 1 << 30)).alias("pos", "token")
    )
    constants = (
        behind.groupBy("leaf", "pos", "token").agg(F.sum("times").alias("seen")).filter(F.col("seen") >= least_docs)
    )
    fixed = (
        behind.join(constants.select("leaf", "pos", "token"), ["leaf", "pos", "token"], "left_semi")
        .groupBy("line")
        .agg(
            F.count(F.lit(1)).alias("fixed"),
            F.xxhash64(F.array_sort(F.collect_list(F.struct("pos", "token")))).alias("shape"),
        )
    )
    behind_n = F.greatest(F.size("tokens") - depth, F.lit(0))
    templates = (
        kept.join(fixed, "line", "left")
        .filter(F.coalesce(F.col("fixed"), F.lit(0)) >= constant * behind_n)
        .select("line", F.xxhash64("leaf", F.coalesce("shape", F.lit(0))).alias("template"))
    )
    holders = lines.select("line", "doc").distinct().join(templates, "line")
    recurring = (
        holders.select("template", "doc").distinct().groupBy("template").count().filter(F.col("count") >= least_docs)
    )
    drops = shelf.put(templates.join(recurring.select("template"), "template", "left_semi"))
    return lines, drops


def drop_recurring_lines(
    docs: DataFrame,
    text: str = "text",
    depth: int = 3,
    least_docs: int = 5,
    constant: float = 0.75,
    copy_share: float = 0.5,
) -> DataFrame:
    """`docs` without the lines whose template recurs across documents, and with `n_lines`,
    `dropped` (numbers of the lines dropped, from 0) and `is_copy`.

    See `recurring_lines` for templates. Equal texts count as one document, and a document of which
    more than `copy_share` of the tokens lie in recurring templates is taken for a copy of others
    (`is_copy`): it is left whole, for document dedup to decide on.

    Null texts stay null with 0 lines; an empty text is one line, kept. Lines without tokens are never
    dropped. Texts are split at line feeds and rejoined by them. Rows that agree in the text get the
    same result. Output columns replace input columns of the same name. An empty table gives an
    empty table. No text is gathered by its lines: lines are counted by hash, and a text that
    loses lines is joined with their numbers.
    """
    shelf = Shelf(docs.sparkSession, "line-templates")
    lines, drops = recurring_lines(docs, shelf, text, depth, least_docs, constant)
    marked = lines.join(drops.select("line", F.lit(True).alias("drop")), "line", "left")
    found = shelf.last(
        marked.groupBy("doc")
        .agg(
            F.sum(F.when(F.col("drop"), F.col("n")).otherwise(0)).alias("lost"),
            F.sum("n").alias("all"),
            F.sort_array(F.collect_list(F.when(F.col("drop"), F.col("at")))).alias("numbers"),
        )
        .filter(F.col("lost") > 0)
        .select(
            F.col("doc").alias("_llm_doc"),
            F.col("numbers").alias("_llm_numbers"),
            (F.col("lost") > F.lit(copy_share) * F.col("all")).alias("_llm_copy"),
        )
    )
    frame = docs.select("*", _text_id(name(text)).alias("_llm_doc")).join(found.hint("merge"), "_llm_doc", "left")
    is_copy = F.coalesce("_llm_copy", F.lit(False))
    none = F.array().cast("array<int>")
    frame = frame.withColumn("_llm_drop", F.when(is_copy | F.col("_llm_numbers").isNull(), none).otherwise(F.col("_llm_numbers")))
    split = F.split(name(text), "\n")
    # The kept lines stand between the dropped ones: as many slices as lines dropped, plus one.
    bounds = F.transform(
        F.sequence(F.lit(0), F.size("_llm_drop")),
        lambda i: F.struct(
            F.when(i == 0, F.lit(0)).otherwise(F.get("_llm_drop", i - 1) + 1).alias("first"),
            F.coalesce(F.get("_llm_drop", i), F.size(split)).alias("until"),
        ),
    )
    kept = F.flatten(F.transform(bounds, lambda b: F.slice(F.col("_llm_lines"), b["first"] + 1, b["until"] - b["first"])))
    frame = frame.withColumn("_llm_lines", F.when(F.size("_llm_drop") > 0, split))
    cleaned = F.when(F.size("_llm_drop") > 0, F.array_join(kept, "\n")).otherwise(name(text))
    return frame.select(
        *[cleaned.alias(c) if c.lower() == text.lower() else name(c) for c in docs.columns if c.lower() not in ("n_lines", "dropped", "is_copy")],
        F.when(name(text).isNull(), 0).otherwise(F.size(split)).cast("int").alias("n_lines"),
        F.col("_llm_drop").alias("dropped"),
        is_copy.alias("is_copy"),
    )

"""Mixing sources to target weights by random order and exact budgets; DataFrame functions only.

Every document gets a hash-random key. Within its source, the keys are ranged into buckets; bucket
totals are summed up over the small table of buckets, and a running sum inside each bucket completes
the distributed prefix sum. A source with a third of all rows is so spread over as many buckets as
its rows ask for.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from lodestrata.llm.work import stored

#: Rows of one bucket, about.
BUCKET_ROWS = 10_000
_HEX = 6


def n_words(text: str = "text"):
    """Number of words of a text: runs of characters other than space and 0x09-0x0D; null has none."""
    return F.coalesce(F.regexp_count(F.col(text).cast("string"), F.lit("[^ \\t-\\r]+")), F.lit(0)).cast("bigint")


def targets(sized: DataFrame, weights: tuple[int, ...] = (1, 2, 3), most_epochs: int = 3) -> DataFrame:
    """By source: its size and its target, from a table (source, size).

    Sources in code point order, null last, take the weights in turn. All sizes are shared by
    weight; a target stops at ``most_epochs`` times its source's size and what is above is shared
    anew. The level at which this ends is found in one pass: sources ordered by limit per weight
    fill up from the least, and a source is full if the level before it would overflow it. One row
    per source takes part, so the ordered windows here are over a small table. A source with no
    words has target 0.
    """
    by = sized.groupBy("source").agg(F.sum("size").alias("source_size"), F.count("*").alias("n_rows"))
    turn = Window.orderBy(F.col("source").isNull(), F.col("source"))
    w = F.element_at(F.array(*[F.lit(x) for x in weights]), (F.pmod(F.row_number().over(turn) - 1, F.lit(len(weights))) + 1).cast("int"))
    by = by.withColumn("weight", w.cast("bigint")).withColumn("most", F.col("source_size") * most_epochs)
    fill = Window.orderBy(F.col("most") / F.col("weight"), F.col("source").isNull(), F.col("source"))
    whole = Window.partitionBy()
    below = fill.rowsBetween(Window.unboundedPreceding, -1)
    rest = F.sum("source_size").over(whole) - F.coalesce(F.sum("most").over(below), F.lit(0))
    open_weight = F.sum("weight").over(whole) - F.coalesce(F.sum("weight").over(below), F.lit(0))
    by = by.withColumn("rest", rest).withColumn("open_weight", open_weight)
    by = by.withColumn("full", F.col("rest") / F.col("open_weight") >= F.col("most") / F.col("weight"))
    level = F.min(F.when(~F.col("full"), F.struct(F.col("most") / F.col("weight"), F.col("source").isNull(), F.col("source"), F.col("rest"), F.col("open_weight")))).over(whole)
    by = by.withColumn("level", level)
    target = F.when(F.col("full"), F.col("most").cast("double")).otherwise(F.col("weight") * F.col("level.rest") / F.col("level.open_weight"))
    return by.select("source", "source_size", "n_rows", target.cast("double").alias("target"))


def mix(docs: DataFrame, weights: tuple[int, ...] = (1, 2, 3), most_epochs: int = 3, carry: tuple[str, ...] = ()) -> DataFrame:
    """Per row of docs (doc_id, text, source): size, source_size, target and the words taken.

    A source's budget is its target to the nearest word. Whole epochs are taken while they fit; the
    last one follows the random order and cuts at the exact budget, so one document may be taken in
    part. Rows that are equal in all respects share a key, and any of them may come first. Null
    sources are a source; null or empty texts have size 0 and are taken 0 times.
    """
    key = F.md5(F.concat_ws("|", F.col("doc_id").cast("string"), F.lit("mix")))
    sized = docs.select("doc_id", "source", n_words().alias("size"), key.alias("_key"), *carry)
    small = stored(sized.drop(*carry), "sizes")  # so that the texts are read once for all totals
    goal = targets(small.select("source", "size"), weights, most_epochs)
    goal = goal.withColumn("budget", F.floor(F.col("target") + 0.5).cast("bigint")).withColumn("buckets", (F.col("n_rows") / BUCKET_ROWS).cast("bigint") + 1)
    goal = stored(goal.withColumnRenamed("source", "_source"), "targets")

    def placed(rows: DataFrame) -> DataFrame:
        """Rows with their source's figures and the bucket that their key falls in; keys are uniform, so their ranges are even."""
        d = rows.join(goal, rows["source"].eqNullSafe(goal["_source"])).drop("_source")
        position = F.conv(F.substring("_key", 1, _HEX), 16, 10).cast("bigint")
        return d.withColumn("_bucket", F.shiftright(position * F.col("buckets"), 4 * _HEX))

    sums = placed(small).groupBy("source", "_bucket").agg(F.sum("size").alias("_sum"))
    sums = sums.withColumn("_before", F.sum("_sum").over(Window.partitionBy("source").orderBy("_bucket")) - F.col("_sum")).select(F.col("source").alias("_s"), F.col("_bucket").alias("_b"), "_before")
    sums = stored(sums, "bucket-sums")  # a size that is known before the texts move, so a small one is broadcast and they are shuffled once
    inner = Window.partitionBy("source", "_bucket").orderBy("_key", "doc_id", "size").rowsBetween(Window.unboundedPreceding, 0)
    d = placed(sized if carry else small).withColumn("_within", F.sum("size").over(inner) - F.col("size"))
    d = d.join(sums, d["source"].eqNullSafe(sums["_s"]) & (d["_bucket"] == sums["_b"]))
    epochs = F.when(F.col("source_size") > 0, F.expr("budget div source_size")).otherwise(F.lit(0))
    part = F.greatest(F.lit(0), F.least(F.col("size"), F.col("budget") - epochs * F.col("source_size") - F.col("_before") - F.col("_within")))
    return d.select("doc_id", "source", "size", "source_size", "target", (epochs * F.col("size") + part).cast("bigint").alias("taken"), *carry)


def mixed_documents(docs: DataFrame, weights: tuple[int, ...] = (1, 2, 3), most_epochs: int = 3) -> DataFrame:
    """The documents of the mix, with the columns of ``docs``: a row for each whole time that one is taken, and one for a part.

    A part is the text's first words with what stands between them; n_chars follows the text where
    present. Documents without words are not in the mix.
    """
    rows = docs.select("doc_id", "source", "text", F.struct(*docs.columns).alias("_row"))
    d = mix(rows, weights, most_epochs, carry=("_row",)).filter("taken > 0")
    d = d.select("_row", F.expr("taken % size").alias("_part"), F.expr("cast(taken div size AS int)").alias("_whole"))
    d = d.select("_row", "_part", "_whole", F.explode(F.sequence(F.lit(1), F.col("_whole") + F.when(F.col("_part") > 0, 1).otherwise(0))).alias("_time"))
    words = F.split("_row.text", "(?<=[^ \\t-\\r])(?=[ \\t-\\r])")
    text = F.when(F.col("_time") > F.col("_whole"), F.array_join(F.slice(words, F.lit(1), F.col("_part").cast("int")), "")).otherwise(F.col("_row.text"))
    d = d.select("_row", text.alias("_text"))
    new = {"text": F.col("_text")}
    if "n_chars" in docs.columns:
        new["n_chars"] = F.length("_text").cast(docs.schema["n_chars"].dataType)
    return d.select(*[new.get(c, F.col("_row")[c]).alias(c) for c in docs.columns])

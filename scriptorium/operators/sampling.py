"""Draws and samples.  Every draw is a hash of (seed, index, slot)."""

from __future__ import annotations

import os

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.text import hash01
from ..scratch import Scratch


def draw(seed: int, index: Column, slot: str) -> Column:
    return hash01(F.lit(seed), index, F.lit(slot))


def draw_value(spec, u: Column, v: Column | None = None) -> Column:
    """A scalar, ``{min, max}`` or ``{choices: [{value, weight}]}``.

    Whole bounds give a whole number with both ends, others a number between them.
    ``v`` is a second draw for a choice that is itself a range.
    """
    if isinstance(spec, dict) and "choices" in spec:
        options = spec["choices"]
        picked = weighted_index([float(c.get("weight", 1.0)) for c in options], u)
        out = None
        for i, c in enumerate(options):
            value = draw_value(c["value"], u if v is None else v)
            out = F.when(picked == i, value) if out is None else out.when(picked == i, value)
        return out
    if isinstance(spec, dict) and "min" in spec:
        lo, hi = spec["min"], spec["max"]
        if hi < lo:
            raise ValueError("range: max is below min")
        if isinstance(lo, int) and isinstance(hi, int):
            return (F.lit(lo) + F.floor(u * (hi - lo + 1))).cast("int")
        return F.lit(float(lo)) + u * (float(hi) - float(lo))
    return F.lit(spec)


def weighted_index(weights: list[float], u: Column) -> Column:
    """Position of the first running sum that reaches the draw; negative weights count as
    none, and without any weight all positions are alike."""
    if not weights:
        raise ValueError("nothing to choose from")
    clean = [max(0.0, w) for w in weights]
    if sum(clean) <= 0:
        clean = [1.0] * len(weights)
    point, at, out = u * sum(clean), 0.0, None
    for i, w in enumerate(clean[:-1]):
        at += w
        test = point <= at
        out = F.when(test, F.lit(i)) if out is None else out.when(test, F.lit(i))
    return F.lit(0) if out is None else out.otherwise(F.lit(len(clean) - 1))


def draw_colour(spec: dict, seed: int, index: Column, slot: str) -> Column:
    return F.array(*[draw_value(spec[c], draw(seed, index, f"{slot}.{c}")).cast("int") for c in "rgb"])


def draw_style(df: DataFrame, recipe: dict, seed: int, index: str = "index", page: bool = False) -> DataFrame:
    """One struct ``style`` with every knob of a sample, drawn in a fixed order and once.

    Fonts that aren't there must be left out of the recipe's list before.
    """
    look, layout, fonts = recipe.get("rendering", {}), recipe.get("layout", {}), recipe["fonts"]
    i = F.col(index)
    font = weighted_index([float(f.get("weight", 1.0)) for f in fonts], draw(seed, i, "font"))
    number = lambda name, default, where: draw_value(where.get(name, default), draw(seed, i, name), draw(seed, i, f"{name}.in"))
    black, white = dict.fromkeys("rgb", 0), dict.fromkeys("rgb", 255)
    parts = [
        F.get(F.array(*[F.lit(str(f["path"])) for f in fonts]), font).alias("font_path"),
        number("font_size_pt", 14.0, look).cast("double").alias("font_size_pt"),
        number("dpi", 300, look).cast("int").alias("dpi"),
        draw_colour(look.get("ink_color", black), seed, i, "ink").alias("ink"),
        draw_colour(look.get("background_color", white), seed, i, "background").alias("background"),
        number("padding_px", 0, layout).cast("int").alias("padding_px"),
        number("line_spacing", 1.2, layout).cast("double").alias("line_spacing"),
    ]
    if page:
        parts.append(number("paragraph_spacing", 1.0, layout).cast("double").alias("paragraph_spacing"))
    return df.withColumn("style", F.struct(*parts))


def pick_from_texts(spark: SparkSession, texts: DataFrame, tokens: Column, count: int, seed: int, key: list[str] | None = None) -> DataFrame:
    """``count`` draws with replacement, uniform over all tokens of all texts: (index, token).

    ``tokens``: a text's tokens as an array; ``key`` orders the texts, else they are taken
    as they come.  Tokens are counted, not numbered: running sums of the texts' counts
    give each text its span of numbers, draws and spans meet in cells of numbers, and only
    texts that a draw hits are split into rows.
    """
    nothing = T.StructType([T.StructField("index", T.LongType()), T.StructField("token", T.StringType())])
    ordered = texts.repartitionByRange(*[F.col(c) for c in key]).sortWithinPartitions(*key) if key else texts
    place = [F.spark_partition_id().alias("part"), F.monotonically_increasing_id().alias("mono")]
    # Written once: a range partitioning that is done again draws other bounds.
    held = Scratch(spark, "tokens").write(ordered.select(tokens.alias("tokens"), *place).withColumn("n", F.size("tokens").cast("long")))
    parts = held.groupBy("part").agg(F.sum("n").alias("n"), F.count(F.lit(1)).alias("texts"))
    total, n_texts = held.agg(F.coalesce(F.sum(F.greatest("n", F.lit(0))), F.lit(0)), F.count(F.lit(1))).first()
    if not total:
        return spark.createDataFrame([], nothing)
    up_to = lambda w: w.rowsBetween(W.unboundedPreceding, -1)
    first = parts.select("part", F.coalesce(F.sum("n").over(up_to(W.orderBy("part"))), F.lit(0)).alias("first"))  # a row a partition
    inner = F.coalesce(F.sum("n").over(up_to(W.partitionBy("part").orderBy("mono"))), F.lit(0))
    spans = held.select("part", "mono", "n").withColumn("inner", inner).join(first, "part").where("n > 0").select("mono", (F.col("first") + F.col("inner")).alias("start"), "n")
    cell = max(1, total // n_texts)
    cells = F.sequence(F.floor(F.col("start") / cell), F.floor((F.col("start") + F.col("n") - 1) / cell))
    draws = spark.range(count).select(F.col("id").alias("index"), F.floor(hash01(F.lit(seed), F.col("id"), F.lit("pick")) * total).cast("long").alias("at"))
    spread = spans.select("mono", "start", "n", F.explode(cells).alias("cell"))
    hits = draws.withColumn("cell", F.floor(F.col("at") / cell)).join(spread, "cell").where((F.col("at") >= F.col("start")) & (F.col("at") < F.col("start") + F.col("n")))
    hits = Scratch(spark, "hits").write(hits.select("index", F.col("mono"), (F.col("at") - F.col("start")).cast("int").alias("pos")))
    split = held.select("mono", "tokens").join(hits.select("mono").distinct(), "mono", "left_semi").select("mono", F.posexplode("tokens").alias("pos", "token"))
    return hits.join(split, ["mono", "pos"]).select("index", "token")


def pick_tokens(spark: SparkSession, tokens: DataFrame, count: int, seed: int, token: str = "token", order: list[str] | None = None) -> DataFrame:
    """The same for tokens that are rows already."""
    return pick_from_texts(spark, tokens, F.array(F.col(token)), count, seed, order)


def workers(wanted: int | None = None, cpus: int | None = None) -> int:
    """All cores where there are two at most, else one less than there are, eight at most."""
    if wanted is not None:
        return max(1, wanted)
    n = cpus or os.cpu_count() or 1
    return n if n <= 2 else min(n - 1, 8)

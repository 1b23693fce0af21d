"""The rendering query draws every distinct word."""

import pytest
from pyspark.sql import functions as F

from scriptorium import queries
from scriptorium.operators import images, render


def test_every_word_is_drawn(spark, tmp_path):
    words = [f"w{i}" for i in range(230)] + ["\u5b57\u5b57"]  # more than 200, one that no font here can set
    texts = [" ".join(words), "w0 w0 w1"]
    spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string").write.parquet(str(tmp_path / "documents.parquet"))
    found = queries.ren_word_crops(spark, str(tmp_path))
    rows = found.collect()
    assert sorted(r["text"] for r in rows) == sorted(words)
    assert {r["status"] for r in rows if r["text"] == words[-1]} == {"skipped"}


def test_named_columns_draw_the_same_and_encode_nothing_else(spark, tmp_path):
    from pathlib import Path

    fonts = {str(p): p.read_bytes() for p in Path("/usr/share/fonts/truetype/dejavu").glob("DejaVuSansMono.ttf")}
    if not fonts:
        pytest.skip("no font here")
    style = F.struct(F.lit(next(iter(fonts))).alias("font_path"), F.lit(9.0).alias("font_size_pt"), F.lit(150).alias("dpi"), F.array(*[F.lit(0)] * 3).alias("ink"), F.array(*[F.lit(255)] * 3).alias("background"), F.lit(3).alias("padding_px"), F.lit(1.2).alias("line_spacing"))
    samples = spark.range(40).select(F.col("id").alias("index"), F.concat(F.lit("w"), F.col("id")).alias("text"), style.alias("style"))
    stages, names = [{"kind": "blur", "probability": 0.5, "sigma": 0.8}, {"kind": "noise", "stddev": 4}, {"kind": "skew", "angle_deg": [-2.0, 2.0], "probability": 0.5}], ["index", "status", "width", "height"]
    whole = render.render_rows(samples, "word_crops", fonts, stages=stages, seed=42)
    some = render.render_rows(samples, "word_crops", fonts, stages=stages, seed=42, columns=names)
    assert some.columns == names
    rows = whole.collect()
    assert sorted(some.collect()) == sorted(tuple(r[n] for n in names) for r in rows)
    assert all(images.png_decode(bytes(r["image"])).shape == (r["height"], r["width"], 3) for r in rows)


def test_words_are_dealt_in_more_tasks_than_cores(spark, tmp_path):
    spark.createDataFrame([(0, "a b")], "doc_id long, text string").write.parquet(str(tmp_path / "documents.parquet"))
    assert queries.ren_word_crops(spark, str(tmp_path)).rdd.getNumPartitions() >= 8 * spark.sparkContext.defaultParallelism

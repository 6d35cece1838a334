"""Scores of images from their objects, questions and shape, and subsets by score."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Category ids by role, and their weights.
FACILITIES, VEHICLES, AUXILIARY = (10, 13, 14), (2, 3, 4, 6, 8), (1, 12, 15)
WEIGHTS = {1: 0.5, 2: 3.0, 3: 4.0, 4: 3.0, 6: 4.0, 8: 4.0, 10: 4.0, 12: 1.0, 13: 4.0, 14: 3.0, 15: 0.5}
SHARES = (0.4, 0.35, 0.25)
#: Words sought in questions, and words that rule a match out.
KEYWORDS = ("road", "traffic", "car", "driver", "lane", "street", "crosswalk")
NEGATIVE = ("toy", "painting", "indoor")


def keyword_match(text: Column, words: tuple[str, ...] = KEYWORDS, negative: tuple[str, ...] = NEGATIVE) -> Column:
    """Whether a text has one of the words (whole, or with an s) and none of the negative ones."""
    low = F.lower(text)
    return low.rlike(r"\b(?:" + "|".join(words) + r")s?\b") & ~low.rlike(r"\b(?:" + "|".join(negative) + r")s?\b")


def _weight(category: Column) -> Column:
    return F.coalesce(F.element_at(F.create_map(*(F.lit(x) for kv in WEIGHTS.items() for x in kv)), category), F.lit(1.0))


def scores(images: DataFrame, instances: DataFrame, questions: DataFrame, shares: tuple[float, float, float] = SHARES, captions: DataFrame | None = None, words: tuple[str, ...] = KEYWORDS, negative: tuple[str, ...] = NEGATIVE) -> DataFrame:
    """(image_id, objects, category_score, text_score, scene_score, score) of every image.

    A matching question and a matching caption (image_id, caption), if there are any, count
    half each for the text; ``words`` and ``negative`` come from a keyword file where there is one.

    Repeated rows of an instance count once. Instances and questions are aggregated by
    image before they are joined, so an image with very many objects is one row by then.
    """
    one = instances.select("image_id", "id", "category_id").distinct()
    strong = F.col("category_id").isin(*FACILITIES, *VEHICLES)
    auxiliary = F.col("category_id").isin(*AUXILIARY)
    weight = F.when(strong, _weight(F.col("category_id"))).when(auxiliary, 0.3 * _weight(F.col("category_id"))).otherwise(0.0)
    objects = one.groupBy("image_id").agg(F.count("*").alias("objects"), F.sum(weight).alias("weight"), F.coalesce(F.max(strong), F.lit(False)).alias("strong"))
    held = questions.select("image_id", keyword_match(F.col("question"), words, negative).alias("asked"), F.lit(None).cast("boolean").alias("told"))
    if captions is not None:
        held = held.unionByName(captions.select("image_id", F.lit(None).cast("boolean").alias("asked"), keyword_match(F.col("caption"), words, negative).alias("told")))
    texts = held.groupBy("image_id").agg(*((F.coalesce(F.max(c), F.lit(False)).cast("double") * 0.5).alias(c) for c in ("asked", "told")))
    joined = images.select(F.col("id").alias("image_id"), "width", "height").join(objects, "image_id", "left").join(texts, "image_id", "left")
    n, w, aspect = F.coalesce("objects", F.lit(0)), F.coalesce("weight", F.lit(0.0)), F.col("width") / F.when(F.col("height") > 0, F.col("height"))
    category = F.when(F.coalesce("strong", F.lit(False)), 0.5 + F.least(F.lit(0.5), w / 15)).when(w > 0, F.least(F.lit(0.3), w / 20)).otherwise(0.0)
    text = F.coalesce("asked", F.lit(0.0)) + F.coalesce("told", F.lit(0.0))
    shape = F.when((F.col("width") > 0) & (aspect >= 1.5) & (aspect <= 2.5), 0.3).when((F.col("width") > 0) & (aspect > 2.5) & (aspect <= 3), 0.2).otherwise(0.0)
    crowd = F.when(n.between(5, 20), 0.2).when((n > 20) & (n <= 50), 0.1).otherwise(0.0)
    scored = joined.select("image_id", n.alias("objects"), category.alias("category_score"), text.alias("text_score"), F.least(F.lit(1.0), 0.5 + shape + crowd).alias("scene_score"))
    a, b, c = shares
    return scored.withColumn("score", F.least(F.lit(1.0), a * F.col("category_score") + b * F.col("text_score") + c * F.col("scene_score")))


def scenes(instances: DataFrame, categories: DataFrame) -> DataFrame:
    """(image_id, scene, objects): the most frequent supercategory of each image; 'mixed' for ties and images without one. ``categories`` is a bounded dimension table."""
    one = instances.select("image_id", "id", "category_id").distinct()
    named = one.join(categories.select(F.col("id").alias("category_id"), "supercategory"), "category_id", "left")
    counts = named.groupBy("image_id", "supercategory").agg(F.count("*").alias("n"))
    known = F.when(F.col("supercategory").isNotNull(), F.col("n"))
    best = counts.groupBy("image_id").agg(F.max(F.when(F.col("supercategory").isNotNull(), F.struct("n", "supercategory"))).alias("best"), F.collect_list(known).alias("ns"), F.sum("n").alias("objects"))
    tied = F.size(F.filter("ns", lambda x: x == F.col("best.n"))) != 1
    return best.select("image_id", F.when(F.col("best").isNull() | tied, "mixed").otherwise(F.col("best.supercategory")).alias("scene"), "objects")

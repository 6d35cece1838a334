"""Stores of samples, ground truth and checkpoints, and what is written to them."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lumisift.functions.records import target_text
from lumisift.operators.numbering import numbered

#: Fields of intermediate results, which aren't stored.
UNSTORED = ("top_k_indices", "top_k_values", "top_k", "vocab_size", "logits", "answer_token_ids", "allowed_answers")


def _pruned(value: Column, kind: T.DataType, drop: tuple[str, ...]) -> Column:
    if isinstance(kind, T.StructType):
        kept = [f for f in kind.fields if f.name not in drop]
        return F.when(value.isNotNull(), F.struct(*(_pruned(value[f.name], f.dataType, drop).alias(f.name) for f in kept)))
    if isinstance(kind, T.ArrayType):
        return F.transform(value, lambda v: _pruned(v, kind.elementType, drop))
    if isinstance(kind, T.MapType):
        return F.transform_values(F.map_filter(value, lambda k, _: ~k.isin(*drop)) if isinstance(kind.keyType, T.StringType) else value, lambda _, v: _pruned(v, kind.valueType, drop))
    return value


def pruned(df: DataFrame, drop: tuple[str, ...] = UNSTORED) -> DataFrame:
    """The table without the fields ``drop``, at any depth of structs, arrays and maps."""
    return df.select(*(_pruned(F.col(f"`{f.name}`"), f.dataType, drop).alias(f.name) for f in df.schema.fields if f.name not in drop))


def stored_name(path: Column, image_id: Column) -> Column:
    """The name a sample is stored under: the file name of its image without the ending, else its number in twelve digits, else its id; null without either."""
    stem = F.regexp_replace(F.regexp_extract(path, r"([^/]+)\z", 1), r"(?<=.)\.[^.]*\z", "")
    number = image_id.try_cast("long")
    numbered_name = F.concat(F.lit("COCO_val2014_"), F.lpad(number.cast("string"), 12, "0"))
    return F.when(stem != "", stem).otherwise(F.coalesce(numbered_name, image_id))


def is_storable(df: DataFrame) -> Column:
    """Whether a sample has an image and a task."""
    return F.coalesce((F.trim(F.col("image_id").cast("string")) != "") & (F.size("tasks") > 0), F.lit(False))


def save_samples(df: DataFrame, path: str) -> tuple[int, int]:
    """Appends the storable samples, pruned and with their names, as JSON lines; gives how many were saved and how many not, counted while writing."""
    counts = Observation("saved")
    ok = is_storable(df)
    seen = df.observe(counts, F.count_if(ok).alias("saved"), F.count_if(~ok).alias("failed"))
    pruned(seen.where(ok)).withColumn("stored_name", stored_name(F.col("image_path"), F.col("image_id").cast("string"))).write.mode("append").json(path)
    return counts.get["saved"], counts.get["failed"]


def saved_ids(samples: DataFrame) -> DataFrame:
    """The ids of stored samples, in order."""
    return samples.select("image_id").where("image_id is not null").distinct().orderBy("image_id")


def sample_of(samples: DataFrame, image_id: str) -> DataFrame:
    """The samples of an image: those of exactly this id, else those whose names hold it."""
    exact = samples.where(F.col("image_id") == image_id)
    return exact if not exact.isEmpty() else samples.where(F.contains(F.col("stored_name"), F.lit(image_id)))


def append_checkpoint(ids: DataFrame, path: str) -> None:
    """Adds processed ids to a checkpoint."""
    ids.write.mode("append").parquet(path)


def ground_truth(spark: SparkSession, path: str, make, mode: str = "auto") -> DataFrame:
    """The cached table, or the one that ``make()`` gives: 'auto' makes and stores it if there is none, 'rebuild' always, 'disabled' neither reads nor stores it."""
    if mode == "disabled":
        return make()
    if mode == "auto":
        try:
            return spark.read.parquet(path)
        except AnalysisException:
            pass
    make().write.mode("overwrite").parquet(path)
    return spark.read.parquet(path)


def training_samples(records: DataFrame, files: DataFrame | None = None) -> DataFrame:
    """The records that can be trained on: with a question, a target text and an image; ``files`` (path) are the images there are, if that is to be checked."""
    dist = F.col("soft_label.answer_distribution")
    rows = records.where("question <> '' and image_path <> ''").select(
        *(c for c in ("record_id",) if c in records.columns), F.col("image_path"), "question", target_text(F.col("cot_reasoning.reasoning_paragraph"), F.coalesce("hard_label.answer", "cot_reasoning.answer")).alias("target"), dist.alias("answer_distribution"),
        F.coalesce("hard_label.answer", "cot_reasoning.answer").alias("short_answer"), dist.isNotNull().alias("is_closed"), F.coalesce(F.col("question_category") == "open", F.lit(False)).alias("is_open"),
    ).where("target <> ''")
    return rows if files is None else resolved(rows, "image_path", files).where("resolved is not null").drop("image_path").withColumnRenamed("resolved", "image_path")


def resolved(df: DataFrame, path_col: str, files: DataFrame, root: str = "images") -> DataFrame:
    """Adds ``resolved``: the path if there is such a file, else that below ``root``, else any file of its name (the first by path); null without one."""
    name = lambda c: F.regexp_extract(c, r"([^/]+)\z", 1)
    listed = files.select("path").distinct()
    by_name = listed.groupBy(name(F.col("path")).alias("__name")).agg(F.min("path").alias("__any"))
    tried = df.withColumn("__name", name(F.col(path_col))).withColumn("__below", F.concat(F.lit(f"{root}/"), F.col(path_col)))
    joined = tried.join(listed.select(F.col("path").alias("__a")), F.col(path_col) == F.col("__a"), "left").join(listed.select(F.col("path").alias("__b")), F.col("__below") == F.col("__b"), "left")
    return joined.join(by_name, "__name", "left").withColumn("resolved", F.coalesce("__a", "__b", "__any")).drop("__name", "__below", "__a", "__b", "__any")


def subset(rows: DataFrame, kept: DataFrame, image_col: str, order: list[str], new_id: str = "new_id") -> DataFrame:
    """The annotations of the kept images (image_id), captions, questions, answers or key points alike, numbered anew from 1."""
    held = rows.join(kept.select(F.col("image_id").alias(image_col)), image_col, "left_semi")
    return numbered(held, order, new_id)


def pool(spark: SparkSession, path: str) -> DataFrame:
    """(category, answer, freq) of a pool file: an object of categories, each an object of answers and how often they occur."""
    rows = spark.read.text(path, wholetext=True).select(F.from_json("value", "map<string,map<string,bigint>>").alias("m"))
    return rows.select(F.explode("m").alias("category", "held")).select("category", F.explode("held").alias("answer", "freq"))


def scene_map(spark: SparkSession, path: str) -> DataFrame:
    """(image_id, primary_scene, scenes) of a scene file: an object of images."""
    rows = spark.read.text(path, wholetext=True).select(F.from_json("value", "map<string,struct<primary_scene:string,scenes:array<string>>>").alias("m"))
    return rows.select(F.explode("m").alias("image_id", "held")).select("image_id", "held.primary_scene", "held.scenes")

"""Readers and writers of records and annotation files, with explicit schemas."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Beginnings of file names that hold reports, not records.
REPORT_PREFIXES = ("cleaning_report", "merged_summary", "validation", "checkpoint", "pipeline", "visualization", "data_quality", "timing", "report")
SOFT = "struct<answer_distribution:map<string,double>,primary_answer:string,candidate_pool:array<string>>"
RECORD = f"image_id string, image_path string, question string, question_type string, question_category string, label_type string, hard_label struct<answer:string,confidence:double>, soft_label {SOFT}, cot_reasoning struct<reasoning_paragraph:string,answer:string>"
ANNOTATION = {
    "instances": "annotations array<struct<image_id:bigint,id:bigint,category_id:int,bbox:array<double>>>, categories array<struct<id:int,name:string,supercategory:string>>, images array<struct<id:bigint,file_name:string,width:int,height:int>>",
    "questions": "questions array<struct<question_id:bigint,image_id:bigint,question:string>>",
    "answers": "annotations array<struct<question_id:bigint,multiple_choice_answer:string,answers:array<struct<answer:string,answer_confidence:string>>>>",
    "keypoints": "annotations array<struct<image_id:bigint,id:bigint,category_id:int,num_keypoints:int,keypoints:array<double>>>",
    "captions": "annotations array<struct<image_id:bigint,id:bigint,caption:string>>",
}


def json_files(spark: SparkSession, path: str, schema: str, skip: tuple[str, ...] = REPORT_PREFIXES) -> DataFrame:
    """One record a file; unreadable files are left out, as are files whose names begin like reports."""
    rows = spark.read.schema(f"{schema}, _corrupt_record string").option("multiLine", True).option("mode", "PERMISSIVE").json(path)
    named = F.element_at(F.split(F.input_file_name(), "/"), -1)
    return rows.where(~named.rlike("^(?:" + "|".join(skip) + ")")).where("_corrupt_record is null").drop("_corrupt_record")


def json_lines(spark: SparkSession, path: str, schema: str = RECORD, most: int | None = None) -> DataFrame:
    """One record a line; blank and invalid lines are left out, and reading stops at ``most`` records if given."""
    rows = spark.read.schema(schema).option("mode", "DROPMALFORMED").json(path)
    return rows if most is None else rows.limit(most)


def annotations(spark: SparkSession, path: str, kind: str, field: str = "annotations") -> DataFrame:
    """The rows of one array of an annotation file."""
    return spark.read.schema(ANNOTATION[kind]).option("multiLine", True).json(path).select(F.explode(field).alias("row")).select("row.*")


def write_lines(df: DataFrame, path: str, split_by: str | None = None) -> None:
    """JSON lines, in one directory a value of ``split_by`` if given."""
    writer = df.write.mode("overwrite")
    (writer.partitionBy(split_by) if split_by else writer).json(path)


def keywords(path: str, negative_marker: str = "negative") -> tuple[list[str], list[str]]:
    """The words and the negative words of a sectioned keyword file: all after a comment with the marker are negative."""
    found: tuple[list[str], list[str]] = ([], [])
    negative = False
    with open(path, encoding="utf-8") as lines:
        for line in map(str.strip, lines):
            if line.startswith("#"):
                negative = negative or negative_marker in line.lower()
            elif line:
                found[negative].append(line.lower())
    return found


def remaining(all_ids: DataFrame, done: DataFrame, key: str) -> DataFrame:
    """The ids a checkpoint hasn't processed yet."""
    return all_ids.join(done.select(key), key, "left_anti")

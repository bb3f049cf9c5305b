"""Prompt versions as a small table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from docgate.functions.text import strip
from docgate.schemas import DEFAULT_PROMPT, PROMPTS


def prompt_table(prompts: DataFrame) -> DataFrame:
    """(version, text, sha256) of (version, text) rows; the text is stripped before hashing."""
    stripped = prompts.select("version", strip(F.col("text")).alias("text"))
    return stripped.withColumn("sha256", F.sha2("text", 256))


def prompts_from_dir(spark: SparkSession, path: str) -> DataFrame:
    """One prompt per ``<version>.txt`` file in ``path``."""
    files = spark.read.option("pathGlobFilter", "*.txt").text(path, wholetext=True)
    name = F.regexp_extract(F.col("_metadata.file_name"), r"^(.*)\.txt$", 1)
    return prompt_table(files.select(name.alias("version"), F.col("value").alias("text")))


def builtin_prompts(spark: SparkSession) -> DataFrame:
    """The prompts that ship with the package."""
    return prompt_table(spark.createDataFrame(list(PROMPTS.items()), "version STRING, text STRING"))


def load_prompt(prompts: DataFrame, version: str = DEFAULT_PROMPT) -> tuple[str, str]:
    """(text, sha256) of one version; unknown versions are an error."""
    found = prompts.where(F.col("version") == version).select("text", "sha256").head()
    if found is None:
        raise KeyError(f"unknown prompt version: {version}")
    return found["text"], found["sha256"]

"""What the operators share: reading the tables, words, stored intermediate tables."""

from __future__ import annotations

import hashlib
import re

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quayside.session import cut_lineage

# The ASCII white space that separates words.
SPACES = " \t\n\x0b\x0c\r"

_WORD = re.compile(r"[^\x20\x09-\x0D]+")
# Characters that str.split() takes for white space and the word pattern does not.
_OTHER_SPACE = re.compile(r"[\x1c-\x1f\x85\xa0  -     　]")


def table(spark: SparkSession, folder: str, name: str, *columns: str) -> DataFrame:
    df = spark.read.parquet(f"{folder}/{name}.parquet")
    return df.select(*columns) if columns else df


def words(text: str) -> list[str]:
    """The maximal runs of characters that are not ASCII white space."""
    return _WORD.findall(text) if _OTHER_SPACE.search(text) else text.split()


def sha256_hex(text: str) -> str:
    return hashlib.sha256(text.encode("utf-8", "surrogatepass")).hexdigest()


def remainder(doc_id: Column, modulus: int) -> Column:
    """crc32 of the id as text, modulo: the split into folds that the contracts name."""
    return F.crc32(doc_id.cast("string").cast("binary")) % modulus


def stored(df: DataFrame) -> DataFrame:
    """Write a frame that later jobs read to the shared folder; a lost executor then costs no recomputation."""
    return cut_lineage(df)


def partitions_of(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def free_name(df: DataFrame, name: str) -> str:
    """A column name that the frame does not have, whatever its case."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name

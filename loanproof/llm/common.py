"""What the operators of this subpackage share: tables, folds, words and byte tricks."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from loanproof.session import ship_package

#: The white space of every contract here: space and 0x09-0x0D. ``bytes.split()`` splits at exactly these.
WORD = r"[^\x20\x09-\x0D]+"
#: A-Z to a-z, all other bytes as they are.
LOWER_AZ = bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def fold(doc_id: Column, parts: int) -> Column:
    """crc32 of the id's decimal text, modulo ``parts``; null for a null id."""
    return F.crc32(doc_id.cast("string").cast("binary")) % parts


def texts(docs: DataFrame) -> DataFrame:
    """doc_id and text (null: empty) only, so columns of any other name cannot clash."""
    ship_package(docs.sparkSession)
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text"), F.lit("")).alias("text"))


def lower_words(text: str) -> list[bytes]:
    """The words of a text in UTF-8, A-Z lowered."""
    return text.encode("utf-8", "surrogatepass").translate(LOWER_AZ).split()


class Memo(dict):
    """A bounded memo in two generations: ``memo[key]`` computes once, rarely used keys fall out."""

    def __init__(self, compute, limit: int = 400_000):
        super().__init__()
        self.compute, self.limit, self.old = compute, limit // 2, {}

    def __missing__(self, key):
        value = self.old.get(key)
        if value is None:
            value = self.compute(key)
        if len(self) >= self.limit:
            self.old = dict(self)
            self.clear()
        self[key] = value
        return value

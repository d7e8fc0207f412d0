"""Small helpers shared by the training-data operators."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: ASCII white space of the contracts: space and the codes 9 to 13.
SPACE = " \t\n\x0b\x0c\r"


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def free_name(df: DataFrame, name: str) -> str:
    """``name``, or with more leading underscores when ``df`` has such a column already."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name = f"_{name}"
    return name


def id_remainder(doc_id: Column, modulus: int) -> Column:
    """crc32 of the id as text, modulo ``modulus`` (null id: null)."""
    return F.crc32(doc_id.cast("string")) % modulus


def tokenizer_path(name: str) -> str:
    """Place of a public tokenizer's file; the operators take it as a parameter."""
    import public_tokenizers

    return public_tokenizers.path(name)


def tokenizer_pattern() -> str:
    """Split pattern of the public byte-level rank files."""
    import public_tokenizers

    return public_tokenizers.PATTERN


#: Rows and bytes that travel to Python at once.
BATCH_ROWS, BATCH_BYTES = 2_000, 8 << 20


def in_small_batches(docs: DataFrame) -> DataFrame:
    """``docs``, whose session now hands texts to Python in small batches, so memory does not follow their length."""
    conf = docs.sparkSession.conf
    for key, most in (("maxRecordsPerBatch", BATCH_ROWS), ("maxBytesPerBatch", BATCH_BYTES)):
        name = f"spark.sql.execution.arrow.{key}"
        now = int(conf.get(name, str(most)).rstrip("b"))
        if now <= 0 or now > most:
            conf.set(name, str(most))
    return docs


class Remembered(dict):
    """A bounded memory of values by key that keeps what is in use.

    When it is full its entries are set aside; those that are asked for again come back, the others go the next time."""

    def __init__(self, most: int) -> None:
        super().__init__()
        self.most, self.aside = most, {}

    def unknown(self, keys: set) -> set:
        """The ``keys`` without a value. The values of all others are held from now on."""
        if len(self) > self.most:
            self.aside = dict(self)
            self.clear()
        new = keys - self.keys()
        back = new & self.aside.keys()
        self.update((k, self.aside[k]) for k in back)
        return new - back

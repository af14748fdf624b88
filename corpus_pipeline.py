"""A corpus from raw documents to packed sequences, each stage over all that the one before kept."""

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from tremora.llm import exact_dedup, minhash, packing, repeats, toxicity
from tremora.llm.common import table
from tremora.llm.queries import tokenizer_options
from tremora.session import written

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]

#: Bytes from which a repeated passage is cut: 51 words of four letters and a space. Words here have
#: some six bytes, so nearly all passages of over fifty words are longer, and few others are.
PASSAGE_BYTES = 255
#: Percent of shared shingles from which two texts are near-duplicates.
NEAR_PERCENT = 80


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that score as toxic go; the model is fitted on the corpus's labelled rows."""
    model = toxicity.fit(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    return toxicity.without_toxic(docs, model)


def drop_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts the row with the largest id stays."""
    return exact_dedup.deduplicated(docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near-duplicates the row with the smallest id stays."""
    return minhash.without_near_copies(docs, NEAR_PERCENT)


def cut_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Repeated passages are cut out of the texts; documents without any text left go."""
    return repeats.cut_texts(docs, PASSAGE_BYTES)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of token sequences, with their places in them."""
    return packing.pack_documents(docs, **tokenizer_options())


STAGES: list[tuple[str, Stage]] = [
    ("toxicity", drop_toxic),
    ("exact dedup", drop_copies),
    ("minhash near-dedup", drop_near_copies),
    ("suffix-array dedup", cut_repeats),
    ("packing", pack_sequences),
]

#: The toxicity stage is a fitted model, which SQL cannot express; tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for number, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if number < len(STAGES) - 1:
            docs = written(docs, name.replace(" ", "-"))
    return docs


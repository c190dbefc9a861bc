"""A corpus made ready for training: five stages, each written and read again.

1. language ID: documents without a language (no text, or no letter in it) go;
2. SimHash near-duplicates: one document of each group, the smallest id, stays;
3. suffix arrays: passages of 50 words or more that several texts share stay in the first
   document only, there at all their places; what recurs only inside one text stays;
4. personal data: what is found becomes surrogates;
5. packing: the ids of what is left, packed into sequences of 4,096.

Stages 1 to 4 return the columns of ``documents``; ``n_chars`` follows the text.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from netdays.llm import langid, packing, simhash, suffixes, surrogates
from netdays.llm.common import prepare, table, written
from netdays.llm.queries import END, SEQUENCE, word_model


def _counted(docs: DataFrame) -> DataFrame:
    """``n_chars`` of the text as it is now, where there is such a column."""
    if "n_chars" not in docs.columns:
        return docs
    kind = dict(docs.dtypes)["n_chars"]
    return docs.withColumn("n_chars", F.coalesce(F.length("text").cast(kind), F.col("n_chars")))


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a letter; null and empty texts go, and rows that repeat stay. A table
    without any language label keeps all of them, an empty one is empty."""
    prepare(spark)
    model = langid.fit(docs)
    if not model.languages:
        return langid.lettered(docs)
    # Only a text without a letter scores zero, whatever its language is called.
    return langid.identified(docs, model, "__lang", "__score").where("__score > 0").select(*docs.columns)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The smallest id of each group of near-duplicates; all empty and null texts are one group,
    rows that repeat id and text are one, and rows without an id stay."""
    prepare(spark)
    return simhash.one_of_each(docs, shingle=3, budget=3).select(*docs.columns)


def repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, without passages of 50 words that one of a smaller id has; texts of fewer
    words, null ones included, stay as they are."""
    prepare(spark)
    return _counted(suffixes.without_repeats(docs))


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, entities replaced by surrogates; a text without any, a null one included,
    stays as it is."""
    prepare(spark)
    return _counted(surrogates.replaced(docs))


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The ids of each text packed into sequences; one row per piece. A null text is empty, a row
    that repeats counts again, and an empty table gives an empty one."""
    prepare(spark)
    pieces = written(packing.tokenized(docs, word_model(), SEQUENCE, END, digest=True), "pieces")
    return packing.pack(pieces, SEQUENCE).select(
        "doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"
    )


STAGES = [
    ("language_id", language),
    ("simhash", near_duplicates),
    ("suffix_array", repeated_passages),
    ("surrogates", personal_data),
    ("packing", packed),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the whole of ``documents``."""
    rows = table(prepare(spark), sf_dir, "documents")
    for name, stage in STAGES:
        rows = written(stage(spark, rows, sf_dir), name)
    return rows


# Learned models, tries and tokenizers are beyond SQL; the tests hold the rows of a small table against brute force.
ORACLE_SQL = None

QUERIES = {"pipeline": run}
ORACLES: dict[str, str] = {}

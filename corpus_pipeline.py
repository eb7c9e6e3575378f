"""A corpus pipeline over table ``documents``: language, toxicity, near-duplicates, packing.

Every stage takes the rows the one before kept and applies one operator of ``tidemark.llm`` to all of
them. The first three return rows of ``documents`` unchanged; the last returns their packed pieces.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.llm import language, packing, simhash, toxicity
from tidemark.llm.common import load, scratch, ship, written

#: A text is rejected as toxic from this score on, as in the query of the operator.
TOXIC_FROM = 0.7


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps documents whose text has a language. Null texts and texts without a letter go; ids play no part.

    Where no language could be learned, every text with a letter stays.
    """
    ship(spark)
    model = language.train(docs)
    if not model.families:
        return docs.where(language.lettered(F.col("text")))
    return docs.where(language.prediction(model, F.col("text"))["lang_pred"] != language.UNKNOWN)


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps documents whose text scores below TOXIC_FROM; a null text scores as an empty one.

    Rows of equal texts score alike, so all of them stay or go; a score that ties with TOXIC_FROM goes. An empty
    table gives no rows, and a table without labels loses none.
    """
    ship(spark)
    model = toxicity.train(docs, load(spark, sf_dir, "labels"))
    return docs.where(toxicity.toxicity(model, F.col("text")) < TOXIC_FROM)


def _named(column: str) -> Column:
    return F.col("`" + column.replace("`", "``") + "`")


def _row_hash(docs: DataFrame) -> Column:
    """A hash of all columns; of types that have none, of their text."""

    def plain(field: T.StructField) -> Column:
        text = field.dataType.simpleString()
        return F.to_json(F.struct(_named(field.name))) if "map<" in text or "variant" in text else _named(field.name)

    return F.xxhash64(*[c for f in docs.schema.fields for c in (plain(f), _named(f.name).isNull())])


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps one row of each group of near-duplicates: of those with the smallest id the one whose columns hash lowest.

    Groups are of texts, not of ids: rows that share an id but not a group each stand for their own. Rows
    with a null id come last: one of them stays only where its group has no row with an id. Null, empty and blank
    texts are copies of each other. Of rows equal in all columns one stays; an empty table gives no rows. Other
    columns may have any name and type.
    """
    ship(spark)
    folder = scratch(spark)
    row = "row_hash"  # this and the names made of it must be free
    while any(c.lower().startswith(row) for c in docs.columns):
        row += "_"
    # a row is known by its id and hash; rows equal in both are equal, and one of them is enough
    hashed = docs.withColumn(row, _row_hash(docs))
    prints = written(simhash.fingerprints(hashed, kept=row), f"{folder}/fingerprints")
    labels = simhash.groups(prints, folder, distance=3)
    of_print = prints.groupBy("fp").agg(F.min(F.struct(F.col("doc_id").isNull().alias("nameless"), "doc_id", F.col(row).alias("hash"))).alias("first"))
    first = of_print.join(labels, "fp").groupBy("root").agg(F.min("first").alias("first"))
    first = written(first.select(F.col("first.doc_id").alias(f"{row}_id"), F.col("first.hash").alias(f"{row}_first")), f"{folder}/first")
    # the copies of a row are reduced in the tasks that read them, so that many of them do not meet in one
    single = hashed.dropDuplicates(["doc_id", row])
    same = F.col("doc_id").cast("long").eqNullSafe(F.col(f"{row}_id")) & (F.col(row) == F.col(f"{row}_first"))
    return single.join(first, same, "left_semi").select(*[_named(c) for c in docs.columns])


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents as pieces of sequences of 2048 tokens.

    A null text is packed as its end id, each of several equal rows as a document of its own, a very long text in
    many pieces; an empty table gives no rows.
    """
    ship(spark)
    return packing.pack(docs, capacity=2048, end_id=1)


STAGES = [
    ("language", identify_language),
    ("toxicity", drop_toxic),
    ("near_duplicates", drop_near_duplicates),
    ("packing", pack),
]

#: Learned decisions and token ids have no SQL; the stages are tested against plain versions instead.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages over documents; each result but the last is written and read again."""
    folder = scratch(spark)
    rows = load(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        rows = written(stage(spark, rows, sf_dir), f"{folder}/{name}")
    return STAGES[-1][1](spark, rows, sf_dir)


QUERIES = {"pipeline": (run, ORACLE_SQL)}

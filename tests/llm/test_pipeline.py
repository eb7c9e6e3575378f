"""Each stage of the pipeline against a plain version on its own input, and the registered queries' shapes."""

import os
from collections import Counter

import pytest
from pyspark.sql import functions as F
from test_simhash import plain_components, plain_fingerprint
from test_tokens import check_packing

import __spark_entry__ as contract
import corpus_pipeline
from tidemark.llm import toxicity
from tidemark.llm.common import load

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="test tables are not here")
STAGES = dict(corpus_pipeline.STAGES)


@pytest.fixture(scope="module")
def docs(spark):
    """The documents, with rows that a stage has to reject, to tell apart or to leave alone."""
    real = load(spark, SF, "documents")
    first = real.orderBy("doc_id").first()
    more = [
        (900_001, None, "en", "x", 0),
        (900_002, "", "en", "x", 0),
        (900_003, "123 ... !!! | 45", "en", "x", 16),
        (900_004, first["text"], "en", "x", 1),
        (first["doc_id"], first["text"], first["lang"], "again", 1),
        (None, first["text"], "en", "x", 1),
        (None, first["text"], "en", "x", 1),
    ]
    return real.unionByName(spark.createDataFrame(more, real.schema))


def rows(df):
    return Counter(tuple(r) for r in df.collect())


def test_language(spark, docs):
    got = STAGES["language"](spark, docs, SF)
    assert got.columns == docs.columns
    assert rows(got) == Counter(tuple(r) for r in docs.collect() if r["text"] and any(c.isalpha() for c in r["text"]))


def test_language_without_training_rows(spark, docs):
    unlabelled = docs.withColumn("lang", F.lit(None).cast("string"))
    got = STAGES["language"](spark, unlabelled, SF)
    assert rows(got) == Counter(tuple(r) for r in unlabelled.collect() if r["text"] and any(c.isalpha() for c in r["text"]))


def test_toxicity(spark, docs):
    got = STAGES["toxicity"](spark, docs, SF)
    score = toxicity.train(docs, load(spark, SF, "labels")).scorer()
    want = Counter(tuple(r) for r in docs.collect() if score(r["text"]) < 0.7)
    assert got.columns == docs.columns and rows(got) == want
    assert 0 < sum(want.values()) < docs.count()


def test_near_duplicates(spark, docs):
    got = STAGES["near_duplicates"](spark, docs, SF)
    groups = plain_components([(r["doc_id"], plain_fingerprint(r["text"])) for r in docs.collect()])
    kept = {i for i, _, component in groups if i is not None and i == component}
    ids = Counter(r["doc_id"] for r in got.collect())
    assert got.columns == docs.columns
    alone = {f for _, f, component in groups if component is None}  # groups without any id keep one row
    assert ids == Counter(dict.fromkeys(kept, 1)) + Counter({None: len(alone)})
    assert not rows(got) - rows(docs) and 900_004 not in ids


def test_near_duplicates_of_shared_ids(spark, docs):
    """A group is one of texts: an id that several of them share does not make them one, nor hide a smaller id's group."""
    texts = [r["text"] for r in docs.where("doc_id < 900000 AND n_chars > 300").orderBy("doc_id").limit(40).collect()]
    prints = {t: plain_fingerprint(t) for t in texts}
    apart = []
    for t in texts:
        if all((prints[t] ^ prints[o]).bit_count() > 12 for o in apart):
            apart.append(t)
    assert len(apart) >= 6
    x, y, *others = apart
    made = [(5, x), (5, y), (7, y), *[(9, t) for t in others], (9, others[0]), (8, others[1])]
    table = spark.createDataFrame([(i, t, "en", "x", 1) for i, t in made], docs.schema)
    got = Counter((r["doc_id"], r["text"]) for r in STAGES["near_duplicates"](spark, table, SF).collect())
    assert got == Counter([(5, x), (5, y), (8, others[1]), *[(9, t) for t in others if t != others[1]]])


def test_near_duplicates_without_ids_and_with_odd_columns(spark, docs):
    """Copies without an id go, and columns of any name and type neither clash nor crash."""
    text = "one two three four five six seven eight nine ten eleven twelve"
    made = [(None, text), (None, text), (3, text), (None, "quite another text, of which there are two"), (None, "quite another text, of which there are two")]
    odd = {"row_hash": F.lit("x"), "_row": F.lit(7), "first_id": F.lit(0), "`a.b`": F.lit(1), "tags": F.expr("map('k', doc_id)"), "deep": F.expr("array(map(1, 2))")}
    table = spark.createDataFrame([(i, t, "en", "x", 1) for i, t in made], docs.schema)
    table = table.select("*", *[c.alias(n.strip("`")) for n, c in odd.items()])
    got = STAGES["near_duplicates"](spark, table, SF)
    assert got.columns == table.columns
    assert Counter((r["doc_id"], r["text"]) for r in got.collect()) == Counter([made[2], made[3]])


def test_packing(docs):
    check_packing(docs, 2048)


def test_empty_tables(spark, docs):
    nothing = docs.where("false")
    for name, stage in corpus_pipeline.STAGES:
        assert stage(spark, nothing, SF).count() == 0, name


def test_the_whole_run(spark):
    packed = corpus_pipeline.run(spark, SF)
    assert packed.columns == ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"]
    kept = load(spark, SF, "documents")
    for name, stage in corpus_pipeline.STAGES[:-1]:
        kept = stage(spark, kept, SF)
    assert {r["doc_id"] for r in packed.select("doc_id").collect()} == {r["doc_id"] for r in kept.collect()}


COLUMNS = {
    "op1_simhash": {"doc_id": "bigint", "fingerprint": "string", "component_id": "bigint"},
    "op2_toxicity": {"doc_id": "bigint", "held_out": "boolean", "score": "double", "predicted": "int"},
    "op3_packing": dict.fromkeys(("doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"), "bigint"),
    "op4_ann_forest": {"query_id": "bigint", "rank": "int", "vec_id": "bigint", "score": "double"},
    "op5_quality_lm": {"doc_id": "bigint", "perplexity": "double", "keep": "boolean"},
    "op6_licenses": {"doc_id": "bigint", "license_id": "string"},
    "op7_exact_topk": {"query_id": "bigint", "rank": "int", "vec_id": "bigint", "score": "bigint"},
    "op8_token_counts": {"doc_id": "bigint", "n_tokens": "bigint"},
    "op9_sentencepiece": {"doc_id": "bigint", "n_tokens": "bigint", "ids_sha256": "string", "decoded_sha256": "string"},
    "op10_language": {"doc_id": "bigint", "held_out": "boolean", "lang_pred": "string", "score": "double"},
}


@pytest.mark.parametrize("name", COLUMNS)
def test_registered(spark, name):
    kinds = dict(contract.queries()[name](spark, SF).dtypes)
    assert COLUMNS[name].items() <= kinds.items()

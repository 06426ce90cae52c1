"""Ids come back as they were: 64-bit ones beside a null, and text."""

import public_tokenizers
import pytest
from pyspark.sql import functions as F

from tests.llm.helpers import docs, prose
from voltide.llm import (
    chaining, context_tree, packing, page_text, ppm_language, simhash, token_files, tree_bpe, tree_forest, whitening,
)

BYTE, WORD = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("word_bpe_49k.json")
IDS = [2**60 + 1, None, 2**60 + 3, 2**63 - 1, -(2**60) - 1]


def sixty_words(seed):
    return prose(60, seed)


@pytest.fixture
def table(spark):
    return docs(spark, [(i, sixty_words(k)) for k, i in enumerate(IDS)]).coalesce(1)


def ids(df, name="doc_id"):
    return sorted((r[name] for r in df.select(name).distinct().collect()), key=lambda x: (x is None, x))


WANT = sorted(IDS, key=lambda x: (x is None, x or 0))


@pytest.mark.parametrize("run", [
    lambda t, p: context_tree.score_documents(t, depth=2),
    lambda t, p: packing.pack_documents(t, BYTE),
    lambda t, p: tree_bpe.encode_documents(t, BYTE),
    lambda t, p: tree_bpe.encode_documents(t, BYTE, part=50),
    lambda t, p: tree_bpe.decode_documents(tree_bpe.encode_documents(t, BYTE), BYTE),
    lambda t, p: simhash.near_duplicates(t),
    lambda t, p: simhash.drop_near_duplicates(t),
    lambda t, p: chaining.drop_passages(t),
    lambda t, p: ppm_language.predict_languages(t),
    lambda t, p: token_files.write_tokens(t, WORD, p) or token_files.read_tokens(t.sparkSession, p),
])
def test_document_ids(table, tmp_path, run):
    assert ids(run(table, str(tmp_path / "t"))) == WANT


def test_components_are_ids(spark):
    text = sixty_words(1)
    got = simhash.near_duplicates(docs(spark, [(i, text) for i in IDS]).coalesce(1)).collect()
    assert {r["component_id"] for r in got} == {-(2**60) - 1}


def test_page_and_vector_ids(spark):
    pages = spark.createDataFrame(
        [(i, "https://a.org/", "<article><p>text</p></article>") for i in IDS], "page_id long, url string, html string")
    assert ids(page_text.extract_text(pages.coalesce(1)), "page_id") == WANT
    vectors = spark.createDataFrame(
        [(i, [1.0, float(k + 1)], 1) for k, i in enumerate(IDS)], "vec_id long, embedding array<float>, label int").coalesce(1)
    assert ids(tree_forest.near_vectors(vectors), "vec_id") == WANT
    assert ids(whitening.whiten(vectors), "vec_id") == WANT


def test_text_ids(spark):
    t = docs(spark, [(k, sixty_words(k)) for k in range(3)]).withColumn("doc_id", F.concat(F.lit("a-"), "doc_id"))
    for df in (context_tree.score_documents(t, depth=2), packing.pack_documents(t, BYTE),
               tree_bpe.encode_documents(t, BYTE), simhash.near_duplicates(t), ppm_language.predict_languages(t)):
        assert ids(df) == ["a-0", "a-1", "a-2"]


def test_rows_of_one_id_with_different_texts(spark):
    one, two = sixty_words(1), sixty_words(2)
    rows = [(5, one), (5, one), (5, two), (6, one + " more"), (7, two)]
    got = simhash.drop_near_duplicates(docs(spark, rows, extra=True)).collect()
    assert sorted((r["doc_id"], r["text"]) for r in got) == sorted([(5, one), (5, two)])


def test_columns_with_names_of_the_operators(spark):
    df = docs(spark, [(1, sixty_words(1)), (2, sixty_words(1)), (3, "x " + sixty_words(2))])
    for name in ("keep_", "tied_", "cut_id_", "cut_key_", "cut_ranges_", "cut_maybe_", "row", "text_hash", "text_key",
                 "maybe", "ranges", "group", "component_id", "node", "fp"):
        df = df.withColumn(name, F.lit("z"))
    near = simhash.drop_near_duplicates(df)
    assert near.columns == df.columns and {r["doc_id"] for r in near.collect()} == {1, 3}
    cut = chaining.drop_passages(df)
    assert cut.columns == df.columns and {r["doc_id"] for r in cut.collect()} == {1, 3}


def test_doubles_keep_their_width(spark):
    # rounded to 32 bits the cosine of the first two would be 1; squares of the others overflow
    rows = [(1, [1e300, 0.0], 1), (2, [1e300, 1e299], 1), (3, [0.0, 1e-300], 1), (4, [1e-310, 1e-300], 1)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int")
    got = {r["vec_id"]: r["component_id"] for r in tree_forest.near_vectors(df).collect()}
    assert got == {1: 1, 2: 1, 3: 3, 4: 3}


def test_a_vector_of_another_length_moves_no_others(spark):
    import numpy as np

    x = np.random.default_rng(1).standard_normal((600, 8))
    rows = [(k, v.tolist(), 1) for k, v in enumerate(x)] + [(9000, [1.0] * 32, 1)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int")
    read = tree_forest._read(df).where("vec IS NOT NULL").selectExpr(
        "node", "vec", "1L AS many", "concat(length(vec), ':1') AS space")
    routed = tree_forest._route(read, 0.93, 2, 50, 400, "<f4")
    sizes = routed.select(F.explode("leaves").alias("leaf")).groupBy("leaf").count().collect()
    assert max(r["count"] for r in sizes if r["leaf"] >= 0) < 300
    assert {r["leaf"]: r["count"] for r in sizes}[-1] == 1

"""The pipeline's stages one after another on odd documents: null ids and texts, repeated rows, clashing names, no rows."""

from pyspark.sql import functions as F

import corpus_pipeline
from ordertide.llm import langid
from ordertide.llm.common import table, written

SF = "/root/testdata/sf0.001"
DOCS = "doc_id long, text string, lang string, source string, n_chars long"
LONG = "the quick brown fox " * 30_000
NAMES = ("_told", "fp", "key", "_id", "lang_pred", "predicted", "words", "length", "component_id", "spans", "piece")


def through(spark, docs):
    """What each stage returns; all but the last must keep the columns."""
    out = []
    for name, stage in corpus_pipeline.STAGES:
        columns = docs.columns
        docs = written(stage(spark, docs, SF), name.replace(" ", "-").lower())
        out.append(docs)
        assert docs.columns == columns or name == corpus_pipeline.STAGES[-1][0]
    return out


def test_odd_documents(spark):
    item = table(spark, SF, "benchmark").where("text is not null").orderBy(F.desc(F.length("text"))).first().text
    rows = [
        (None, "a document without an id of its own"), (1, None), (2, ""), (3, LONG), (4, "same words here in a row of seven"),
        (4, "same words here in a row of seven"), (5, "12 34, 56."), (6, "token=abcdefghij and then some more words"),
        (7, "Same  Words here in a row of seven"), (8, item),
    ]
    docs = spark.createDataFrame([(i, t, None if i == 6 else "en", "s", len(t or "")) for i, t in rows], DOCS)
    for name in NAMES:
        docs = docs.withColumn(name, F.lit(name))
    told, apart, clean, blanked, placed = through(spark, docs)
    ids = lambda df: sorted((-1 if r.doc_id is None else r.doc_id for r in df.select("doc_id").distinct().collect()))
    assert ids(told) == [-1, 3, 4, 6, 7, 8] and told.count() == 7
    assert ids(apart) == [-1, 3, 4, 6, 8]
    assert ids(clean) == ids(blanked) == ids(placed) == [-1, 3, 4, 6]
    texts = {r.doc_id: r for r in blanked.collect()}
    assert "abcdefghij" not in texts[6].text and texts[6].n_chars == len(texts[6].text) and texts[3].text == LONG
    assert all(r[name] == name for r in texts.values() for name in NAMES)
    assert placed.where("doc_id = 3").agg(F.sum("length")).first()[0] > 100_000


def test_no_documents(spark):
    docs = spark.createDataFrame([], DOCS)
    assert [df.count() for df in through(spark, docs)] == [0] * 5
    assert langid.learn(docs) == {}

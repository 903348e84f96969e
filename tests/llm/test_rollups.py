from collections import Counter

import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from starmart.llm import rollups as R
from starmart.llm.tokens import vocabulary_path

CHANGES = "source string, lang string, tokenizer_version string, sign int, tokens long"


def totals(store):
    return {(r.source, r.lang, r.tokenizer_version): (r.documents, r.tokens) for r in store.totals().collect()}


def test_batches_replay_and_cancel(spark, scratch):
    store = R.RollupStore(spark, scratch("rollup"))
    assert totals(store) == {}
    first = spark.createDataFrame([("a", "en", "v1", 1, 10), ("a", "en", "v1", 1, 5), (None, None, "v1", 1, 0),
                                   ("b", "de", "v1", 1, 7)], CHANGES)
    assert store.commit("one", first) and not store.commit("one", first)
    assert totals(store) == {("a", "en", "v1"): (2, 15), (None, None, "v1"): (1, 0), ("b", "de", "v1"): (1, 7)}
    # a delete, a revised count and a change of source
    old = spark.createDataFrame([("a", "en", "v1", 5), ("b", "de", "v1", 7)], "source string, lang string, tokenizer_version string, tokens long")
    new = spark.createDataFrame([("a", "en", "v1", 6), ("c", "de", "v1", 9)], old.schema)
    assert store.commit("two", R.revisions(old, new).unionByName(spark.createDataFrame([("a", "en", "v1", -1, 10)], CHANGES)))
    for _ in range(2):
        assert not store.commit("two", first)
        assert totals(store) == {("a", "en", "v1"): (1, 6), (None, None, "v1"): (1, 0), ("c", "de", "v1"): (1, 9)}


def test_unfinished_commit_is_not_seen(spark, scratch):
    store = R.RollupStore(spark, scratch("rollup"))
    rows = spark.createDataFrame([("a", "en", "v1", 1, 10)], CHANGES)
    broken = rows.withColumn("tokens", F.raise_error(F.lit("lost")).cast("long"))
    with pytest.raises(Exception, match="lost"):
        store.commit("one", broken)
    assert totals(store) == {} and store.commit("one", rows) and totals(store) == {("a", "en", "v1"): (1, 10)}


def test_batch_ids_are_folder_names(spark, scratch):
    with pytest.raises(ValueError, match="batch id"):
        R.RollupStore(spark, scratch("rollup")).commit("../x", spark.createDataFrame([], CHANGES))


def test_documents_against_brute_force(spark, scratch):
    rows = [(1, "a b  c", "en", "s"), (2, None, "en", "s"), (3, "", None, "s"), (4, "Ünï 漢字 x", "de", None),
            (4, "Ünï 漢字 x", "de", None), (None, "no id", "en", "t"), (5, "long " * 9000, "en", "s")]
    docs = spark.createDataFrame([(i, t, g, s, 1, 2) for i, t, g, s in rows],
                                 "doc_id long, text string, lang string, source string, tokens int, sign int")
    library = Tokenizer.from_file(vocabulary_path())
    want = Counter()
    for _, t, lang, source in rows:
        for version, n in ((R.WORDS, len((t or "").split())),
                           (R.PIECES, len(library.encode(t or "", add_special_tokens=False).ids))):
            want[(source, lang, version, "documents")] += 1
            want[(source, lang, version, "tokens")] += n
    got = Counter()
    for r in R.load_and_revise(docs, R.RollupStore(spark, scratch("rollup"))).collect():
        got[(r.source, r.lang, r.tokenizer_version, "documents")] += r.documents
        got[(r.source, r.lang, r.tokenizer_version, "tokens")] += r.tokens
    assert got == want
    empty = R.load_and_revise(docs.limit(0), R.RollupStore(spark, scratch("rollup")))
    assert empty.count() == 0

import shutil
import zlib

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import corpus_pipeline
from starmart.llm import pii, toxicity
from starmart.llm.common import written
from starmart.llm.tokens import vocabulary_path
import test_decontamination as D
import test_pii as P
import test_simhash as S
import test_toxicity as X

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def tables(spark, tmp_path_factory):
    """The given documents with rows added: copies, NULL and empty texts, repeated and NULL ids, extra columns."""
    folder = tmp_path_factory.mktemp("sf")
    docs = pd.read_parquet(f"{SF}/documents.parquet")
    base = docs.iloc[3].to_dict()
    more = [{**base, "doc_id": 5000, "text": base["text"].upper()}, {**base, "doc_id": None, "text": None},
            {**base, "doc_id": None, "text": ""}, {**base, "doc_id": 5001, "text": "call +1 (203) 555-8282 or a@b.cd now"},
            {**base, "doc_id": 5001, "text": "call +1 (203) 555-8282 or a@b.cd now"}, {**base, "doc_id": 5002, "lang": None}]
    labelled = X.rows(300, 5)
    more += [{**base, "doc_id": 6000 + i, "text": t} for i, t, _ in labelled]
    docs = pd.concat([docs, pd.DataFrame(more)], ignore_index=True)
    docs["doc_id"] = docs["doc_id"].astype("Int64")
    docs["score"], docs["hash"], docs["kept_row"] = 1.5, "x", 7
    docs.to_parquet(folder / "documents.parquet")
    labels = pd.read_parquet(f"{SF}/labels.parquet")
    extra = pd.DataFrame([{"doc_id": 6000 + i, "quality": 1, "toxic": x} for i, _, x in labelled])
    pd.concat([labels, extra]).astype(labels.dtypes).to_parquet(folder / "labels.parquet")
    shutil.copy(f"{SF}/benchmark.parquet", folder / "benchmark.parquet")
    return str(folder)


@pytest.fixture(scope="module")
def results(spark, tables):
    docs, out = spark.read.parquet(f"{tables}/documents.parquet"), []
    for name, stage in corpus_pipeline.STAGES:
        before, docs = docs, written(spark, stage(spark, docs, tables), f"test-{name}")
        out.append((before, docs))
    return out


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def test_columns_are_kept(results):
    assert [n for n, _ in corpus_pipeline.STAGES] == ["toxicity", "near_duplicates", "decontamination", "pii", "packing"]
    for before, after in results[:-1]:
        assert before.schema.simpleString() == after.schema.simpleString()


def test_toxicity(spark, results, tables):
    before, after = results[0]
    model = toxicity.fit(before, spark.read.parquet(f"{tables}/labels.parquet"))
    text = before.columns.index("text")
    assert rows(after) == [r for r in rows(before) if model.score(r[text]) < 0.5]
    assert 0 < after.count() < before.count()


def test_near_duplicates(results):
    before, after = results[1]
    every = [r.asDict() for r in before.collect()]
    roots = S.brute_components([S.plain_fingerprint(r["text"]) for r in every])
    groups = {}
    for r, root in zip(every, roots):
        groups.setdefault(root, []).append(r["doc_id"])
    want = sorted((min((i for i in ids if i is not None), default=None) for ids in groups.values()), key=str)
    assert sorted((r.doc_id for r in after.collect()), key=str) == want
    assert set(map(str, rows(after))) <= set(map(str, rows(before)))


def test_decontamination(spark, results, tables):
    before, after = results[2]
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{tables}/benchmark.parquet").collect()]
    found = D.brute([(k, r.text) for k, r in enumerate(before.collect())], items)
    bad = {k for k, _ in found}
    want = sorted((tuple(r) for k, r in enumerate(before.collect()) if k not in bad), key=str)
    assert rows(after) == want and bad


def test_pii(results):
    before, after = results[3]
    model = pii.fit(before)
    spans = {(r.doc_id, r.pii_text): [tuple(s) for s in r.all_spans] for r in pii.with_spans(before, ["doc_id"], model).collect()}
    want = []
    for r in before.collect():
        d = r.asDict()
        if r.text is not None:
            out, at = "", 0
            for start, kind, end in spans[(r.doc_id, r.text)]:
                if start >= at:
                    out += r.text[at:start] + f"[{pii.KINDS[kind].upper()}]"
                at = max(at, end)
            d["text"] = out + r.text[at:]
            assert P.plain(r.text)[0] == [0] * 4 or out
            d["n_chars"] = len(d["text"])
        else:
            d["n_chars"] = None
        want.append(tuple(d[c] for c in after.columns))
    assert rows(after) == sorted(want, key=str)


def test_packing(results):
    before, after = results[4]
    library = Tokenizer.from_file(vocabulary_path())
    ids = {}
    for r in before.collect():
        ids.setdefault(r.doc_id, []).append(np.array([*library.encode(r.text or "", add_special_tokens=False).ids, 1], "<u4"))
    for p in after.collect():
        assert any(len(x) == p.doc_tokens and zlib.crc32(x[p.start:p.start + p.length].tobytes()) == p.ids_crc32
                   for x in ids[p.doc_id])
    assert after.agg(F.sum("length")).first()[0] == sum(len(x) for xs in ids.values() for x in xs)


def test_run_over_empty_documents(spark, tables, tmp_path):
    spark.read.parquet(f"{tables}/documents.parquet").limit(0).write.parquet(str(tmp_path / "documents.parquet"))
    for name in ("labels", "benchmark"):
        shutil.copy(f"{SF}/{name}.parquet", tmp_path / f"{name}.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0


def test_run_is_the_stages(spark, results, tables):
    ran, last = corpus_pipeline.run(spark, tables), results[-1][1]
    assert ran.agg(F.sum("length")).first() == last.agg(F.sum("length")).first() and ran.schema == last.schema

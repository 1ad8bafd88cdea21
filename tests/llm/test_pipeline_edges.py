"""Every stage of the pipeline on nulls, empty and very long texts, repeated rows, clashing columns, and on a table without rows."""

import collections
import re
import shutil

import pytest

import corpus_pipeline
from spoolwright.llm import nearcopies

SF = "/root/testdata/sf0.001"
WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def rows(df):
    return collections.Counter(tuple(r) for r in df.collect())


@pytest.fixture
def world(tmp_path):
    for name in ("labels", "benchmark"):
        shutil.copy(f"{SF}/{name}.parquet", tmp_path / f"{name}.parquet")
    return str(tmp_path)


def test_stages_keep_rows_and_columns_of_an_edge_table(spark, edge, world, tmp_path):
    bench = spark.read.parquet(f"{SF}/benchmark.parquet").orderBy("item_id").first()
    leaked = spark.createDataFrame([(99, f"{bench.text} and more words", "en", "s1", 0, "clash", "clash")], edge.schema)
    edge.unionByName(leaked).coalesce(2).write.parquet(f"{world}/documents.parquet")
    docs, kept = spark.read.parquet(f"{world}/documents.parquet"), {}
    for name, stage in corpus_pipeline.STAGES[:-1]:
        before = rows(docs)
        out = stage(spark, docs, world)
        assert out.columns == docs.columns, name
        path = str(tmp_path / f"stage_{name}")
        out.write.parquet(path)
        docs = spark.read.parquet(path)
        kept[name] = rows(docs)
        assert set(kept[name]) <= set(before), name
        if name != "mixing":
            assert all(n <= before[r] for r, n in kept[name].items()), name
    toxic, near, clean, mixed = (kept[n] for n, _ in corpus_pipeline.STAGES[:-1])
    texts = lambda c: {r[1] for r in c}
    # rows without an id or a text are no copies and stay; of the others, one row of each class does, and exact copies are of one
    loose = lambda c: {r: n for r, n in c.items() if r[0] is None or r[1] is None}
    assert loose(near) == loose(toxic)
    held = [r for r in near.elements() if r not in loose(near)]
    assert len({r[1] for r in held}) == len(held) and {t for t in texts(toxic) if t and len(WORD.findall(t)) == 1} <= texts(near)
    found = nearcopies.near_duplicates(spark.read.parquet(str(tmp_path / "stage_toxicity"))).collect()
    ids = collections.Counter(r[0] for r in toxic)
    classes = {r.class_id for r in found if r.doc_id is not None and not (ids[r.doc_id] == 1 and any(x[0] == r.doc_id and x[1] is None for x in toxic))}
    assert len(held) == len(classes)
    assert 99 in {r[0] for r in near} and 99 not in {r[0] for r in clean}  # the leaked item goes, and nothing else
    assert {r for r in near if r[0] != 99} == set(clean)
    assert sum(mixed.values()) > 0
    last = corpus_pipeline.STAGES[-1][1](spark, docs, world).collect()
    assert sorted((r.doc_id is not None, r.doc_id or 0) for r in last) == sorted((r[0] is not None, r[0] or 0) for r in mixed.elements())
    at = sorted((r.start, r.n_tokens) for r in last)
    assert at[0][0] == 0 and all(a + n == b for (a, n), (b, _) in zip(at, at[1:], strict=False))


def test_a_table_without_rows_runs_through(spark, nothing, world):
    nothing.write.parquet(f"{world}/documents.parquet")
    assert corpus_pipeline.run(spark, world).count() == 0

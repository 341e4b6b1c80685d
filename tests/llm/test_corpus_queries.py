"""Registered queries against their SQL, and the pipeline's stages against plain Python."""

import pytest

import corpus_pipeline
from checks.compare import connect, difference
from frostline.llm.common import stored
from frostline.llm.queries import QUERIES
from frostline.llm.sql import ORACLE


@pytest.fixture(scope="module")
def con(small):
    return connect(small)


@pytest.mark.parametrize("name", list(ORACLE))
def test_query_equals_sql(spark, con, small, name):
    assert difference(QUERIES[name](spark, small).toPandas(), con.execute(ORACLE[name]).df()) is None


def test_one_query_for_each_operator():
    assert sorted(int(n[2:].split("_")[0]) for n in QUERIES) == list(range(1, 14))


def test_stages_take_effect(spark, small):
    docs = spark.read.parquet(f"{small}/documents.parquet")
    names, tables = docs.columns, [docs]
    for i, (_, stage) in enumerate(corpus_pipeline.STAGES):
        tables.append(stored(stage(spark, tables[-1], small), f"test{i}"))
        if i < 4:
            assert tables[-1].columns == names
    raw, known, shorter, single, mixed, packed = (t.toPandas() for t in tables)

    assert set(known.doc_id) <= set(raw.doc_id) and len(known) >= 0.98 * len(raw)
    lines = {}
    for r in known.sort_values("doc_id").itertuples():
        for line in set(r.text.split("\n")):
            lines.setdefault(line, r.doc_id)
    for r in shorter.itertuples():
        own = r.text.split("\n")
        long_ones = [x for x in own if len(x.split()) >= 5 and not any(c.isdigit() for c in x)]
        assert all(lines[x] == r.doc_id for x in long_ones)
        assert r.n_chars == len(r.text)

    def shingles(text):
        w = text.lower().split()
        return {tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))}

    sets = [shingles(t) for t in single.text]
    for i, a in enumerate(sets):
        for b in sets[:i]:
            assert 5 * len(a & b) < 4 * len(a | b)
    assert set(single.doc_id) <= set(shorter.doc_id)
    assert set(mixed.doc_id) <= set(single.doc_id) and mixed.doc_id.value_counts().max() <= 3
    assert len(packed[packed.piece == 0]) == len(mixed)
    filled = packed.groupby("sequence_id")["length"].sum()
    assert filled.max() <= 1024
    for _, group in packed.sort_values("offset").groupby("sequence_id"):
        assert group.offset.tolist() == [0, *group.length.cumsum().tolist()[:-1]]


def test_empty_tables_go_through(spark, small, tmp_path):
    docs = spark.read.parquet(f"{small}/documents.parquet").limit(0)
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0
    spark.read.parquet(f"{small}/embeddings.parquet").limit(0).write.parquet(f"{tmp_path}/embeddings.parquet")
    spark.read.parquet(f"{small}/conversations.parquet").limit(0).write.parquet(f"{tmp_path}/conversations.parquet")
    for name, query in QUERIES.items():
        assert query(spark, str(tmp_path)).count() == (name == "op4_chat_trees"), name


def test_working_tables_go_when_the_next_stage_begins(spark, small):
    from frostline.llm.common import work_root

    def tables():
        place = spark._jvm.org.apache.hadoop.fs.Path(work_root(spark))
        files = place.getFileSystem(spark._jsc.hadoopConfiguration())
        return {str(f.getPath().getName()) for f in files.listStatus(place)}

    docs = stored(spark.read.parquet(f"{small}/documents.parquet"), "whole")
    names = [f for _, f in corpus_pipeline.STAGES]
    shorter = names[1](spark, docs, small)
    of_lines = tables()
    rows = sorted(shorter.collect())
    again = names[2](spark, shorter, small)  # not written in between: what it reads stays
    assert of_lines <= tables() and sorted(shorter.collect()) == rows and again.count() > 0
    written = stored(names[1](spark, docs, small), "written")
    before = tables()
    names[2](spark, written, small)
    gone = before - tables()
    assert gone and not any(name.startswith(("written", "whole")) for name in gone)

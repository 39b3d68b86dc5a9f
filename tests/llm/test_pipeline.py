import importlib
import sys
from collections import Counter

import duckdb
import pytest
from pyspark.sql import functions as F

import __spark_entry__
import corpus_pipeline
from driftwatch.llm import mixing

SF = "/root/testdata/sf0.01"
SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def steps(spark):
    """Input and output rows of each stage, one by one."""
    out, docs = [], spark.read.parquet(f"{SMALL}/documents.parquet")
    for name, stage in corpus_pipeline.STAGES:
        after = stage(spark, docs, SMALL).cache()
        out.append((name, docs, after))
        docs = after
    return out


def test_order_and_columns(steps):
    assert [name for name, *_ in steps] == ["language_id", "line_dedup", "minhash_near_dedup", "mixing", "packing"]
    for _, before, after in steps[:-1]:
        assert after.columns == before.columns and dict(after.dtypes) == dict(before.dtypes)
        assert after.count() > 0


def test_language_stage_keeps_rows_as_they_are(steps):
    _, before, after = steps[0]
    rows, kept = Counter(map(tuple, before.collect())), Counter(map(tuple, after.collect()))
    assert not kept - rows
    assert all(not any(c.isalpha() for c in (r[1] or "")) or len(r[1]) < 30 for r in (rows - kept))


def test_line_stage(steps):
    from tests.llm.test_lines import brute_texts

    _, before, after = steps[1]
    want = brute_texts([(r.doc_id, r.text) for r in before.collect()])
    got = {r.doc_id: r for r in after.collect()}
    assert {i: r.text for i, r in got.items()} == want and all(r.n_chars == len(r.text) for r in got.values())


def test_near_stage(steps):
    from tests.llm.test_neardup import brute

    _, before, after = steps[2]
    want = brute([(r.doc_id, r.text) for r in before.collect()], 5, 80)
    assert sorted(r.doc_id for r in after.collect()) == sorted(i for i, (_, c) in want.items() if i == c)


def test_mixing_stage(steps):
    _, before, after = steps[3]
    copies = {r.doc_id: r.copies for r in mixing.mix(before).collect()}
    rows = {r.doc_id: tuple(r) for r in before.collect()}
    assert Counter(map(tuple, after.collect())) == Counter({rows[i]: n for i, n in copies.items() if n})


def test_packing_stage(steps):
    from tests.llm.test_packing import ids_of

    _, before, after = steps[4]
    tokens = Counter()
    for r in before.collect():
        tokens[r.doc_id] += len(ids_of(r.text))
    got = Counter()
    for r in after.collect():
        got[r.doc_id] += r.length
    assert got == tokens


def test_run_applies_all_stages(spark, steps):
    got = sorted((r.doc_id, r.start, r.length, r.ids_crc32) for r in corpus_pipeline.run(spark, SMALL).collect())
    total = Counter()
    for i, _, n, _ in got:
        total[i] += n
    want = Counter()
    for r in steps[-1][2].collect():
        want[r.doc_id] += r.length
    assert total == want


def test_nulls_and_empty_input(spark):
    rows = [(None, None, None, None, None), (1, "", "en", "s", 0), (2, None, "en", None, 0), (3, "the dog and the cat sat on the mat of the house", "en", "s", 47), (3, "the dog and the cat sat on the mat of the house", "en", "s", 47)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    for start in (docs, docs.limit(0)):
        step = start
        for name, stage in corpus_pipeline.STAGES:
            step = stage(spark, step, SMALL)
        assert step.count() >= 0
    for name, stage in corpus_pipeline.STAGES[1:]:
        assert stage(spark, docs, SMALL).count() >= 0


def test_registered():
    assert "pipeline" in __spark_entry__.queries() and corpus_pipeline.ORACLE_SQL is None
    names = [n for n in __spark_entry__.queries() if n.startswith("op")]
    assert sorted(int(n[2:].split("_")[0]) for n in names) == list(range(1, 11))


def test_entry_works_without_the_operators(monkeypatch):
    """With the subpackage and the pipeline gone, the entry module still imports and keeps its other queries."""
    gone = [m for m in sys.modules if m.startswith("driftwatch.llm") or m in ("corpus_pipeline", "__spark_entry__")]
    for m in gone:
        monkeypatch.delitem(sys.modules, m)

    class Without:
        def find_spec(self, name, path=None, target=None):
            if name == "corpus_pipeline" or name.startswith("driftwatch.llm"):
                raise ModuleNotFoundError(f"No module named {name!r}", name=name)

    monkeypatch.setattr(sys, "meta_path", [Without(), *sys.meta_path])
    import driftwatch

    monkeypatch.delattr(driftwatch, "llm", raising=False)
    entry = importlib.import_module("__spark_entry__")
    assert entry.llm_queries is None and entry.corpus_pipeline is None
    assert "profile_month" in entry.queries() and not [n for n in entry.queries() if n.startswith("op")]
    monkeypatch.delitem(sys.modules, "__spark_entry__")


def test_language_stage_rejects_texts_of_no_learned_language(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    own = [r.text for r in docs.where("lang IS NOT NULL AND n_chars > 60").limit(8).collect()]
    clean = [t[:40].rsplit(" ", 1)[0] for t in own] + own
    foreign = ["καλημέρα κόσμε", "привет мир", "你好世界", "שלום עולם", "1234 :::", "", None]
    rows = [(10**9 + i, t, None, "s", len(t or "")) for i, t in enumerate(clean + foreign)]
    out = corpus_pipeline.language_id(spark, docs.unionByName(spark.createDataFrame(rows, docs.schema)), "")
    assert sorted(r.doc_id for r in out.where("doc_id >= 1000000000").collect()) == [10**9 + i for i in range(len(clean))]


def test_stages_take_columns_of_any_name(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").limit(60)
    names = ["__doc", "__drops", "__kept", "__copies", "__copy", "__source", "__first", "v", "root", "copies", "size", "words"]
    docs = docs.select("*", *[F.lit(k).alias(n) for k, n in enumerate(names)])
    for stage in (corpus_pipeline.line_dedup, corpus_pipeline.near_dedup, corpus_pipeline.mix):
        out = stage(spark, docs, "")
        assert out.columns == docs.columns and out.count() > 0

import __spark_entry__ as entry
import corpus_pipeline as p
from ticketlens.llm import chosen_path_join, template_decontam
from ticketlens.llm.queries import QUERIES, table
from tests.conftest import SF001


def test_every_query_is_registered():
    names = entry.queries()
    assert "pipeline" in names and set(QUERIES) <= set(names)
    assert sorted(int(n[2:].split("_")[0]) for n in QUERIES) == list(range(1, 14))


def test_stages_one_by_one(spark):
    docs = table(spark, SF001, "documents")
    kept = [docs]
    for name, stage in p.STAGES:
        out = stage(spark, kept[-1], SF001)
        path = p.scratch_path(spark, name)
        out.write.parquet(path)
        kept.append(spark.read.parquet(path))
    assert [len(k.columns) for k in kept[:5]] == [5] * 5 and kept[1].columns == docs.columns
    ids = [[r.doc_id for r in k.select("doc_id").collect()] for k in kept]
    good = {r.doc_id for r in table(spark, SF001, "labels").where("quality = 1").collect()}
    poor = {r.doc_id for r in table(spark, SF001, "labels").where("quality = 0").collect()}
    assert len(good - set(ids[1])) <= 1 and len(poor & set(ids[1])) <= 2
    classes = chosen_path_join.join(kept[1]).collect()
    assert sorted(ids[2]) == sorted({r.class_id for r in classes})
    leaks = {r.key.id for r in template_decontam.find(kept[2], table(spark, SF001, "benchmark")).collect()}
    assert sorted(ids[3]) == sorted(set(ids[2]) - leaks)
    assert set(ids[4]) <= set(ids[3]) and max(map(ids[4].count, ids[4])) <= 2
    assert sorted(ids[5]) == sorted(ids[4])
    whole = p.run(spark, SF001).collect()
    assert sorted(map(tuple, whole)) == sorted(map(tuple, kept[5].collect()))


def test_stages_on_odd_and_empty_tables(spark, odd_docs, no_docs):
    for docs, least in ((odd_docs, 1), (no_docs, 0)):
        kept = docs
        for name, stage in p.STAGES:
            out = stage(spark, kept, SF001)
            if name != p.STAGES[-1][0]:
                assert out.columns == docs.columns, name
            path = p.scratch_path(spark, name)
            out.write.parquet(path)
            kept = spark.read.parquet(path)
        assert kept.count() >= least and (least or kept.count() == 0)

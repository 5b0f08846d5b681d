import corpus_pipeline
import pytest

from cohortlens.llm import queries


def test_stages_in_order_keep_the_columns(spark, sf):
    rows = spark.read.parquet(f"{sf}/documents.parquet")
    columns, sizes = rows.columns, []
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality_rules", "near_duplicates", "secret_scan", "mixed_sources", "best_fit_packing"]
    for name, stage in corpus_pipeline.STAGES[:-1]:
        rows = corpus_pipeline.written(stage(spark, rows, sf), name)
        assert rows.columns == columns
        sizes.append(rows.count())
    assert rows.where("text is null").count() == 0 and sizes[0] >= sizes[1] == sizes[2]
    packed = corpus_pipeline.STAGES[-1][1](spark, rows, sf)
    assert packed.where("piece = 0").count() == sizes[-1]
    assert corpus_pipeline.run(spark, sf).count() == packed.count()


def test_stages_take_odd_tables(spark, sf, docs):
    text = " ".join(f"word{i}" for i in range(40))
    odd = [docs([]), docs([(1, None), (None, None, None)]), docs([(1, text), (1, text), (None, text, None), (2, text + " x"), (3, "few words")], extra=True)]
    for rows in odd:
        for name, stage in corpus_pipeline.STAGES:
            columns = rows.columns
            rows = corpus_pipeline.written(stage(spark, rows, sf), name)
            if name != "best_fit_packing":
                assert rows.columns == columns
    assert rows.count() >= 1


def test_near_duplicates_leave_one_of_each_group(spark, sf, docs):
    base = " ".join(f"word{i}" for i in range(200))
    rows = docs([(5, base), (3, base + " end"), (9, base), (7, "something else entirely"), (8, base.replace("word100", "changed"))])
    left = dict(corpus_pipeline.STAGES)["near_duplicates"](spark, rows, sf)
    assert sorted(r["doc_id"] for r in left.collect()) == [3, 7]


@pytest.mark.parametrize("name", sorted(queries.QUERIES))
def test_every_query_has_its_number_once(name):
    numbers = sorted(int(n[2:].split("_")[0]) for n in queries.QUERIES)
    assert numbers == list(range(1, 14)) and name.startswith("op")

import corpus_pipeline as C
from homeledger.llm import ppm, simhash, string_kernel
from tests.llm.helpers import awkward, clashing
from tests.llm.test_packing import check_pieces, reference_ids

SF = "/root/testdata/sf0.001"


def test_stages_decide_on_what_the_one_before_kept(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    assert [n for n, _ in C.STAGES] == ["language_id", "toxicity", "near_duplicates", "pack"]
    one = C.language_id(spark, docs, SF)
    lang = {r["doc_id"] for r in ppm.identify(docs).where("lang_pred <> 'und' AND score >= 0.5 AND bits_per_byte <= 7").collect()}
    assert {r["doc_id"] for r in one.collect()} == lang
    two = C.toxicity(spark, one, SF)
    clean = {r["doc_id"] for r in string_kernel.toxicity(one, labels).where("score < 0.5").collect()}
    assert {r["doc_id"] for r in two.collect()} == clean
    three = C.near_duplicates(spark, two, SF)
    first = {r["component_id"] for r in simhash.near_duplicates(two).collect()}
    assert {r["doc_id"] for r in three.collect()} == first and three.count() == len(first)
    assert one.columns == two.columns == three.columns == docs.columns
    kept = three.select("doc_id", "text").collect()
    pieces = C.run(spark, SF).collect()
    ids = dict(zip([d["doc_id"] for d in kept], reference_ids([d["text"] for d in kept])))
    assert {p["doc_id"] for p in pieces} == set(ids)
    check_pieces(pieces, ids)


def test_awkward_rows_pass_through_all_stages(spark):
    docs = clashing(awkward(spark))
    for rows in (docs, docs.where("doc_id = -1")):
        for name, stage in C.STAGES[:-1]:
            rows = stage(spark, rows, SF)
            assert rows.columns == docs.columns, name
        assert C.STAGES[-1][1](spark, rows, SF).count() >= rows.count()

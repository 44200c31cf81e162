import re

from homeledger.llm import quality_rules as Q
from homeledger.llm.queries import op5_quality_rules
from homeledger.plans.oracle_check import compare, duck_connection
from tests.llm.helpers import SF, awkward, check_edges


def brute(text):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    grams = [tuple(words[i:i + 3]) for i in range(len(words) - 2)]
    again = {g for g in grams if grams.count(g) > 1}
    covered = {i + k for i, g in enumerate(grams) if g in again for k in range(3)}
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    return (len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text), len(lines) - len(set(lines)), len(covered))


def test_whole_table_equals_sql(spark):
    got = op5_quality_rules(spark, SF).toPandas()
    assert compare(got, duck_connection(SF).execute(Q.duck_sql()).df()) is None


def test_no_python_in_the_plan(spark):
    plan = op5_quality_rules(spark, SF)._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Pandas|Arrow|Exchange", plan)


def test_counts_on_awkward_texts(spark):
    got = check_edges(spark, Q.quality_rules)
    names = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
    short = [d for d in awkward(spark).collect() if d["text"] is None or len(d["text"]) < 1000]
    extra = ["a b c a b c a b", "x\nx\n\n \ny\nx", "# * $ %&|<> ok", "a b c d a b c e b c d", "é è ß"]
    docs = spark.createDataFrame([(i, t) for i, t in enumerate([d["text"] for d in short] + extra)], "doc_id long, text string")
    want = {i: brute(t) for i, t in enumerate([d["text"] for d in short] + extra)}
    for r in Q.quality_rules(docs).collect():
        assert tuple(r[n] for n in names) == want[r["doc_id"]], r
        assert r["base_failed"] and not r["kept"]
    assert got.where("kept").count() == 0


def test_clean_kept_and_junk_left(spark):
    """Against the labels: nearly every good text with enough words stays, no bad one does."""
    sf = "/root/testdata/sf0.01"
    both = op5_quality_rules(spark, sf).join(spark.read.parquet(f"{sf}/labels.parquet"), "doc_id").where("NOT base_failed")
    r = both.selectExpr("avg(if(quality = 1, int(kept), null)) AS good", "avg(if(quality = 0, int(kept), null)) AS bad").first()
    assert r["good"] > 0.98 and r["bad"] < 0.1

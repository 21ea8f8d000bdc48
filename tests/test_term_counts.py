"""Document term counts: texts are hashed by id, terms are counted where they lie."""

from cinelake.operators import textfeat as X


def test_no_term_of_a_document_is_shuffled(spark):
    rows = [(1, "red fox red fox"), (1, "fox den"), (2, "red"), (3, None), (None, "owl"), (None, "owl owl")]
    df = X.term_counts(spark.createDataFrame(rows, "id long, text string"), "id", "text")
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert {(r.id, r.term): r.tf for r in df.collect()} == {
        (1, "red"): 2, (1, "fox"): 3, (1, "den"): 1, (1, "red fox"): 2, (1, "fox red"): 1, (1, "fox den"): 1, (2, "red"): 1,
        (None, "owl"): 3, (None, "owl owl"): 1}
    assert plan.count("Exchange ") == 1 and plan.index("Generate explode") < plan.index("Exchange hashpartitioning")     # the scan stands last

"""AGG-1, AGG-2 (C4), AGG-4 (C9), AGG-5 (C8), SNK-3."""

import nearframe as nf

NB = "query_id long, rank long, train_id long, label {t}, dist double"


def nb(spark, rows, t="int"):
    return spark.createDataFrame(rows, NB.format(t=t))


def test_vote_tie_goes_to_lowest_class(spark):
    """C4: 1-1-1 vote -> lowest class; 2-1 -> majority."""
    df = nb(spark, [(1, 1, 10, 7, 0.1), (1, 2, 11, 3, 0.2), (1, 3, 12, 5, 0.3), (2, 1, 10, 9, 0.1), (2, 2, 11, 9, 0.2), (2, 3, 12, 1, 0.3)])
    got = {r.query_id: r.prediction for r in nf.majority_vote(df).collect()}
    assert got == {1: 3, 2: 9}
    counts = sorted(tuple(r) for r in nf.vote_counts(df).collect())
    assert counts == [(1, 3, 1), (1, 5, 1), (1, 7, 1), (2, 1, 1), (2, 9, 2)]


def test_vote_string_labels(spark):
    df = nb(spark, [(1, 1, 10, "R", 0.1), (1, 2, 11, "A", 0.2), (1, 3, 12, "N", 0.3)], t="string")
    assert nf.majority_vote(df).first().prediction == "A"


def test_confusion_matrix_forms_and_accuracy(spark):
    pred = spark.createDataFrame(
        [(1, 0, 0), (2, 0, 1), (3, 1, 1), (4, 2, 1), (5, 2, None)], "query_id long, true_label int, prediction int"
    )
    long = sorted((tuple(r) for r in nf.confusion_matrix(pred, "long").collect()), key=lambda t: (t[0], t[1] is None, t[1] or 0))
    assert long == [(0, 0, 1), (0, 1, 1), (1, 1, 1), (2, 1, 1), (2, None, 1)]
    dense = {(r.true_label, r.predicted): r.n for r in nf.confusion_matrix(pred, "dense").collect()}
    # the query without a prediction is kept as an observed cell: all add up
    assert sum(dense.values()) == 5 and dense.pop((2, None)) == 1
    assert len(dense) == 9 and dense[(0, 0)] == 1 and dense[(2, 2)] == 0 and dense[(2, 1)] == 1
    wide = {r.true_label: r.asDict() for r in nf.confusion_matrix(pred, "wide").collect()}
    assert wide[0]["1"] == 1 and wide[1]["0"] == 0
    acc = nf.accuracy(pred).first()
    assert (acc.n_correct, acc.n_test) == (2, 5) and acc.accuracy == 40.0
    train = spark.range(7)
    s = nf.evaluation_summary(pred, train, 3).first()
    assert (s.k, s.n_test, s.n_train, s.n_correct, s.accuracy) == (3, 5, 7, 2, 40.0)


def test_classify_every_query_comes_back(spark):
    """C7: queries without usable features keep a row with a null prediction."""
    t = spark.createDataFrame([(1, 0.0, 1), (2, 1.0, 1), (3, 5.0, 2)], "id long, f0 double, label int")
    q = spark.createDataFrame([(10, 0.5, 1), (11, None, 2)], "id long, f0 double, label int")
    got = {r.query_id: (r.true_label, r.prediction) for r in nf.knn_classify(q, t, ["f0"], 2, query_label="label").collect()}
    assert got == {10: (1, 1), 11: (2, None)}

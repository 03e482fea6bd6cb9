"""Extra columns whose names the operators use inside come through unchanged."""

from clipyard.llm import decontaminate, pii, simhash

EXTRA = ["_id_key", "_row_key", "_once", "_masked", "_id", "_key"]


def _docs(spark):
    text = "alpha beta gamma delta epsilon zeta eta theta iota kappa"
    rows = [
        (1, text, "a", "b", 9, "x", 1, 2, "m", 3, 4),
        (2, text, "a", "b", 9, "y", 5, 6, "n", 7, 8),  # a copy: goes
        (3, "mail me at a.b@example.org today", "a", "b", 9, "z", 9, 10, "o", 11, 12),
        (4, None, "a", "b", 0, "w", 0, 0, "p", 0, 0),
    ]
    schema = "doc_id long, text string, lang string, source string, n_chars long, " + ", ".join(
        f"{n} {t}" for n, t in zip(EXTRA, ["string", "long", "long", "string", "long", "long"])
    )
    return spark.createDataFrame(rows, schema)


def test_simhash_keep_one_of_each(spark):
    docs = _docs(spark)
    kept = simhash.keep_one_of_each(docs)
    assert kept.columns == docs.columns
    assert sorted(tuple(r) for r in kept.collect()) == sorted(tuple(r) for r in docs.filter("doc_id != 2").collect())


def test_mask_pii(spark):
    docs = _docs(spark)
    masked = pii.mask_pii(pii.find_pii(docs))
    got = {r.doc_id: r for r in masked.collect()}
    assert got[3].text == "mail me at [EMAIL] today" and got[3]._masked == "o" and got[1]._id_key == "x"


def test_drop_contaminated(spark):
    docs = _docs(spark)
    items = spark.createDataFrame([(7, "alpha beta gamma delta epsilon zeta")], "item_id long, text string")
    left = decontaminate.drop_contaminated(docs, items)
    assert left.columns == docs.columns
    assert sorted(tuple(r) for r in left.collect()) == sorted(tuple(r) for r in docs.filter("doc_id > 2").collect())

"""What the fitted classifiers do with null ids, repeated ids, too many rows, one class and clashing columns."""

from pyspark.sql import functions as F

from tickforge.llm import language_id, line_crf

GOOD, BAD = "The river runs past the old mill and the green hills.\nA boat lies there.", "#### $$$ ||| @@@\n%%%% ^^^ ~~~"
ANY = lambda c: F.lit(True)


def texts(spark, rows):
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, quality int")


def test_null_ids_do_not_empty_the_language_model(spark):
    rows = [(None, "der Hund und die Katze", "de", 1)] * 50 + [(i, "the dog and the cat " * (1 + i % 3), "en", 1) for i in range(10)] + [(100 + i, "le chien et le chat " * (1 + i % 3), "fr", 1) for i in range(10)]
    d = texts(spark, rows).withColumn("_guess", F.lit("mine")).withColumn("lang_pred", F.lit("old"))
    model = language_id.train(d, max_docs=40)
    assert model.classes == ["en", "fr"]
    got = language_id.predict(d, model).collect()
    assert {r["_guess"] for r in got} == {"mine"} and len(got) == 70
    assert all(r["lang_pred"] == r["lang"] for r in got if r["doc_id"] is not None)


def test_repeated_ids_are_fitted_once(spark):
    rows = [(1, f"the same id again and again {i}", "en", 1) for i in range(300)] + [(2, "und noch eine andere Zeile", "de", 0)]
    d = texts(spark, rows)
    one = d.where("text in ('the same id again and again 0', 'und noch eine andere Zeile')")
    a, b = (language_id.train(x, max_docs=10) for x in (d, one))
    assert a.classes == b.classes == ["de", "en"]
    fitted = [line_crf.train(x, x.select("doc_id", "quality").distinct(), ANY) for x in (d, one)]
    assert [m.score(GOOD) for m in fitted][0] == [m.score(GOOD) for m in fitted][1]


def test_crf_bounds_and_odd_labels(spark):
    rows = [(i, GOOD if i % 2 else BAD, None, i % 2) for i in range(40)] + [(None, BAD, None, 1), (90, None, None, 0), (91, "", None, 0), (92, GOOD, None, None)]
    d = texts(spark, rows).withColumn("score", F.lit("clash"))
    labels = d.select("doc_id", "quality")
    model = line_crf.train(d, labels, ANY)
    assert model.score(GOOD) > 0.7 > 0.4 > model.score(BAD)
    assert model.score(GOOD) != line_crf.train(d, labels, ANY, max_lines=20).score(GOOD)
    assert line_crf.train(d, labels, ANY, max_lines=0).score(GOOD) == 0.5 == line_crf.train(d.limit(0), labels, ANY).score(GOOD)
    assert line_crf.train(d, labels.where("quality = 1"), ANY).score(GOOD) > 0.5
    assert line_crf.train(d, labels.where("quality is null"), ANY).score(BAD) == 0.5
    out = line_crf.score(d, model).collect()
    assert len(out) == len(rows) and all(0 <= r["score"] <= 1 for r in out)
    assert line_crf.score(d.limit(0), model).count() == 0

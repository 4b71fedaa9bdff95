"""Files in and out, model reload, submissions, and the row-by-row stages on a stream."""

import pytest
from pyspark.sql import functions as F

from ordinalis.catalog import views
from ordinalis.operators import agreement, sentiment
from ordinalis.plans import features
from ordinalis.schema import REVIEW_SCHEMA, TEST_SCHEMA
from ordinalis.sources import readers, writers
from ordinalis.streaming import scoring
from tests.small import small_settings

SMALL = small_settings()


@pytest.fixture(scope="module")
def reviews(spark):
    return views.reviews(spark, "/root/testdata/sf0.001").persist()


def test_csv_reads_quotes_line_breaks_and_missing_words(spark, tmp_path):
    (tmp_path / "train.csv").write_text(
        'id,review,score,thumbsUpCount,reviewCreatedVersion,replyContent,timeToReply\n'
        '1,"two\nlines, ""quoted""",4,3,2.7.0,NA,0 days 05:06:00\n2,,0,0,,None,\n3,None of it,1,1,1.0,ok,n/a\n')
    (tmp_path / "test.csv").write_text(
        'id,review,thumbsUpCount,reviewCreatedVersion,replyContent,timeToReply\n9,good,5,1.0,null,1 days\n')
    got = {r.id: r for r in readers.load_train_test(spark, str(tmp_path / "train.csv"), str(tmp_path / "test.csv")).collect()}
    assert got[1].review == 'two\nlines, "quoted"' and got[1].replyContent is None and got[1].score == 4
    assert got[2].review is None and got[2].replyContent is None and got[3].review == "None of it"
    assert got[3].timeToReply is None and got[9].score is None
    assert (got[1].split, got[9].split) == ("train", "test")


def test_columns_are_found_by_name(spark, tmp_path):
    (tmp_path / "t.csv").write_text(
        'translated_review,score,id,review,thumbsUpCount,language,reviewCreatedVersion,timeToReply,replyContent,else\n'
        'hello,4.0,7,salut,3,fr,1.0,1 days,ok,x\n,NA,8,b,9007199254740993,,,,,\n')
    got = {r.id: r for r in readers.load_reviews(spark, str(tmp_path / "t.csv")).collect()}
    assert (got[7].review, got[7].score, got[7].translated_review, got[7].language) == ("salut", 4, "hello", "fr")
    assert (got[8].score, got[8].thumbsUpCount, got[8].translated_review) == (None, 9007199254740993, None)
    assert "else" not in got[7].asDict()


@pytest.mark.parametrize("cell", ["4.5", "four", "99999999999"])
def test_bad_cells_fail_or_are_null_on_request(spark, tmp_path, cell):
    (tmp_path / "t.csv").write_text("id,review,score,thumbsUpCount,reviewCreatedVersion,replyContent,timeToReply\n"
                                    f"1,a,{cell},1,,,\n")
    with pytest.raises(Exception, match="not a value of type int"):
        readers.load_reviews(spark, str(tmp_path / "t.csv")).collect()
    assert readers.load_reviews(spark, str(tmp_path / "t.csv"), on_bad="null").first().score is None


def test_missing_columns_and_other_headers_are_refused(spark, tmp_path):
    (tmp_path / "t.csv").write_text("id,review\n1,a\n")
    with pytest.raises(ValueError, match="lacks the columns score"):
        readers.load_reviews(spark, str(tmp_path / "t.csv"))
    header = "id,review,score,thumbsUpCount,reviewCreatedVersion,replyContent,timeToReply"
    (tmp_path / "two").mkdir()
    (tmp_path / "two" / "a.csv").write_text(f"{header}\n1,a,1,1,,,\n")
    (tmp_path / "two" / "b.csv").write_text(header.replace("id,review", "review,id") + "\na,1,1,1,,,\n")
    with pytest.raises(Exception):
        readers.load_reviews(spark, str(tmp_path / "two"), multi_line=False).collect()


def test_parquet_route_and_id_check(spark, reviews, tmp_path):
    train, test = readers.split_train_test(reviews)
    train.withColumn("language", F.lit("en")).select(*reversed([*train.columns, "language"])).write.parquet(str(tmp_path / "a"))
    test.drop("score").write.parquet(str(tmp_path / "b"))
    both = readers.load_train_test(spark, str(tmp_path / "a"), str(tmp_path / "b"), "parquet")
    assert both.count() == reviews.count() and "language" in both.columns
    with pytest.raises(ValueError, match="unique and not null"):
        readers.load_train_test(spark, str(tmp_path / "a"), str(tmp_path / "a"), "parquet")


def test_an_interrupted_save_is_no_model(spark, reviews, tmp_path):
    import shutil

    path = str(tmp_path / "m")
    writers.save_model(sentiment.fit_sentiment_model(reviews, "review", "replyContent", SMALL), path)
    assert writers.model_complete(spark, path)
    shutil.copytree(f"{path}/metadata", str(tmp_path / "half" / "metadata"))
    assert not writers.model_complete(spark, str(tmp_path / "half"))


def test_schemas_differ_only_in_the_label():
    assert set(REVIEW_SCHEMA.names) - set(TEST_SCHEMA.names) == {"score"}


def test_stage_is_built_once(spark, tmp_path):
    path, built = str(tmp_path / "stage"), []

    def build():
        built.append(1)
        return spark.range(3)

    assert readers.materialize_or_load(spark, path, build).count() == 3
    assert readers.materialize_or_load(spark, path, build).count() == 3 and built == [1]


def test_submission_needs_the_same_ids(spark, tmp_path):
    template = spark.createDataFrame([("1", 0), ("2", 0)], "id string, value int")
    made = spark.createDataFrame([(2, 4), (1, 3)], "id long, label int")
    path = str(tmp_path / "submit")
    writers.write_submission(writers.submission(template, made), path)
    assert sorted(tuple(r) for r in readers.load_submission_template(spark, path).collect()) == [("1", 3), ("2", 4)]
    for wrong in (made.where("id = 1"), made.unionAll(spark.createDataFrame([(3, 0)], made.schema))):
        with pytest.raises(Exception, match="only in the template or only in the predictions: [23]"):
            writers.submission(template, wrong).collect()


def test_epoch_file_has_validation_columns_only_with_validation(spark, tmp_path):
    train = spark.createDataFrame([(1, 0.5, 0.6, 0.7), (2, 0.4, 0.7, 0.8)], "epoch int, loss double, accuracy double, qwk double")
    for name, validation, columns in (("a", None, 4), ("b", train, 7)):
        writers.write_epoch_metrics(train, str(tmp_path / name), validation)
        back = spark.read.option("header", True).csv(str(tmp_path / name))
        assert len(back.columns) == columns and back.count() == 2


def test_feature_csv_keeps_arrays(spark, tmp_path):
    df = spark.createDataFrame([(1, 'say "x",\ny', [0.25, 0.75])], "id int, t string, p array<double>")
    writers.write_features_csv(df, str(tmp_path / "f"))
    back = spark.read.option("header", True).option("escape", '"').option("multiLine", True).csv(str(tmp_path / "f")).first()
    assert tuple(back) == ("1", 'say "x",\ny', "[0.25,0.75]")


def test_report_round_trip(spark, tmp_path):
    table = agreement.evaluate(spark.createDataFrame([(0, 0), (1, 2)], "y int, p int"), "y", "p")
    writers.write_report(table, str(tmp_path / "r"))
    back = spark.read.schema(table.schema).json(str(tmp_path / "r"))
    assert sorted(map(str, back.collect())) == sorted(map(str, table.collect()))


def test_model_reload_and_stream_score_alike(spark, reviews, tmp_path):
    model = sentiment.fit_sentiment_model(reviews, "review", "replyContent", SMALL)
    writers.save_model(model, str(tmp_path / "model"))
    again = writers.load_model(spark, str(tmp_path / "model"))
    reviews.write.parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema(reviews.schema).parquet(str(tmp_path / "in"))
    query = scoring.write_scores(scoring.score_stream(stream, again, SMALL), str(tmp_path / "out"), str(tmp_path / "ckpt"))
    assert query.awaitTermination(120)
    batch = features.score_columns(sentiment.score_sentiment(
        features.text_features(reviews), model, "text", "replyContent"))
    columns = ["id", "text", "days_to_reply", "review_length", "sentiment_0", F.round("`0_prob`", 9)]
    out = spark.read.parquet(str(tmp_path / "out"))
    assert sorted(map(str, out.select(*columns).collect())) == sorted(map(str, batch.select(*columns).collect()))

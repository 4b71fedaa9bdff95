"""Large CSV files read in splits that cut through cells, against Spark's own reader in one task."""

import csv
import io
import random

import pytest
from pyspark.sql import functions as F

from ordinalis.sources import readers, splitcsv

HEADER = ["id", "review", "score", "thumbsUpCount", "reviewCreatedVersion", "replyContent", "timeToReply"]


@pytest.fixture
def splits(spark):
    """Sets the size of a split, and the batches that go to Python, for one test."""
    names = ("spark.sql.files.maxPartitionBytes", "spark.sql.execution.arrow.maxRecordsPerBatch")
    before = [spark.conf.get(name) for name in names]

    def sized(n, rows=10_000):
        for name, value in zip(names, (n, rows)):
            spark.conf.set(name, value)

    yield sized
    for name, value in zip(names, before):
        spark.conf.set(name, value)


def written(path, rows, end="\n", quoting=csv.QUOTE_MINIMAL, header=HEADER):
    out = io.StringIO()
    writer = csv.writer(out, lineterminator=end, quoting=quoting)
    writer.writerows([header, *rows])
    path.write_bytes(out.getvalue().encode())


def some_rows(n, seed):
    rng = random.Random(seed)
    cell = lambda: "".join(rng.choices(['a', 'é', '"', '""', "\n", "\n\n", "\r\n", ",", " ", "😀", "word"], k=rng.choice([0, 1, 5, 60])))
    return [[i, cell(), i % 5, i, "1.0", cell(), "0 days"] for i in range(n)]


@pytest.mark.parametrize("size,batch,n", [(1 << 20, 10_000, 40), (700, 7, 40), (64, 10_000, 6), (13, 2, 3)])
@pytest.mark.parametrize("end", ["\n", "\r\n"])
def test_rows_equal_those_of_one_task(spark, tmp_path, splits, size, batch, n, end):
    folder = tmp_path / "in"
    folder.mkdir()
    for i in range(3):
        written(folder / f"{i}.csv", some_rows(n, i), end, csv.QUOTE_ALL if i == 1 else csv.QUOTE_MINIMAL)
    one = readers.load_reviews(spark, str(folder)).collect()
    splits(size, batch)
    many = readers.load_reviews(spark, str(folder), split_files=True).collect()
    if end == "\r\n":  # Spark's reader then rewrites the line breaks of cells too; in splits they stay
        many = [str(r).replace("\\r\\n", "\\n") for r in many]
    assert len(many) == 3 * n and sorted(map(str, many)) == sorted(map(str, one))


def test_one_file_goes_to_many_tasks(spark, tmp_path, splits):
    written(tmp_path / "big.csv", some_rows(500, 1))
    splits(2000)
    df = readers.load_reviews(spark, str(tmp_path / "big.csv"), split_files=True)
    tasks = df.select(F.spark_partition_id().alias("p")).distinct().count()
    assert tasks > 8 and readers.load_reviews(spark, str(tmp_path / "big.csv")).rdd.getNumPartitions() == 1
    assert df.count() == 500


def test_a_cell_longer_than_several_splits(spark, tmp_path, splits):
    long = "line, with ""quotes""\n" * 300
    rows = [[1, "short", 1, 1, "v", "", ""], [2, long, 2, 2, "v", long, ""], [3, "\n", 3, 3, "v", "x\n", ""]]
    written(tmp_path / "a.csv", rows)
    splits(500)
    got = {r.id: (r.review, r.replyContent) for r in readers.load_reviews(spark, str(tmp_path / "a.csv"), split_files=True).collect()}
    assert got == {1: ("short", None), 2: (long, long), 3: ("\n", "x\n")}


def test_a_header_of_several_lines_and_empty_records(spark, tmp_path, splits):
    header = [*HEADER, "odd\nname\n" * 20]
    written(tmp_path / "a.csv", [[1, "x", 1, 1, "v", "", "", "y"]] * 2, header=header)
    with open(tmp_path / "a.csv", "a") as file:
        file.write("\n\n")
    splits(50)
    lines = splitcsv.records(spark, str(tmp_path / "a.csv")).collect()
    assert [r.header for r in lines].count(True) == 1 and len(lines) == 3
    assert splitcsv.cells(splitcsv.records(spark, str(tmp_path / "a.csv")), header).count() == 2


def test_a_last_record_without_line_end_and_an_empty_file(spark, tmp_path, splits):
    written(tmp_path / "a.csv", some_rows(20, 3))
    data = (tmp_path / "a.csv").read_bytes()
    (tmp_path / "a.csv").write_bytes(data.rstrip(b"\n"))
    splits(64)
    assert readers.load_reviews(spark, str(tmp_path / "a.csv"), split_files=True).count() == 20
    written(tmp_path / "none.csv", [])
    assert readers.load_reviews(spark, str(tmp_path / "none.csv"), split_files=True).count() == 0


def test_what_cannot_be_split_is_refused(spark, tmp_path, splits):
    written(tmp_path / "a.csv", some_rows(5, 1))
    with open(tmp_path / "a.csv", "a") as file:
        file.write('9,"open\n')
    with pytest.raises(ValueError, match="don't pair"):
        readers.load_reviews(spark, str(tmp_path / "a.csv"), split_files=True)
    folder = tmp_path / "two"
    folder.mkdir()
    written(folder / "a.csv", some_rows(5, 1))
    written(folder / "b.csv", some_rows(5, 1), header=HEADER[::-1])
    with pytest.raises(Exception, match="another header"):
        readers.load_reviews(spark, str(folder), split_files=True).collect()


def test_other_splits_in_the_second_scan_fail(spark, tmp_path, splits, monkeypatch):
    written(tmp_path / "a.csv", [[i, "a\nb\nc " * 20, 1, 1, "v", "", ""] for i in range(20)])
    splits(100)
    real = splitcsv.inside_quotes
    monkeypatch.setattr(splitcsv, "inside_quotes", lambda lines: {f: s[::2] for f, s in real(lines).items()})
    with pytest.raises(Exception, match="splits changed|parse|not a value"):
        readers.load_reviews(spark, str(tmp_path / "a.csv"), split_files=True).collect()


def test_a_task_of_the_query_reads_many_splits(spark, sf_dir, monkeypatch):
    """Splits stay at 16 KB; what grows with the files is how many of them a task reads."""
    from ordinalis.catalog import queries

    tasks, splits, load = [], [], queries.readers.load_reviews

    def watched(session, path, **options):
        lines = splitcsv._lines(session, path)
        tasks.append(lines.rdd.getNumPartitions())
        splits.append(lines.select("file", "split").distinct().count())
        return load(session, path, **options)

    monkeypatch.setattr(queries.readers, "load_reviews", watched)
    monkeypatch.setattr(queries, "REVIEWS_PER_FILE", 100)
    monkeypatch.setattr(spark.__class__.sparkContext.fget(spark).__class__, "defaultParallelism", property(lambda self: 2))
    rows = queries.QUERIES["load_reviews_split"](spark, sf_dir)
    assert rows.count() == 279 and splits[0] > tasks[0] and tasks[0] <= 5
    assert spark.conf.get("spark.sql.files.maxPartitionNum", None) is None

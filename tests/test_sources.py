from __future__ import annotations

import pytest
from pyspark.errors import PySparkException

from opine import session
from opine.plans import derived
from opine.sources import tables, tsv

HEADER = "id\tsentiment\treview\n"


def rows(df):
    return sorted(tuple(r) for r in df.collect())


@pytest.fixture
def folder(tmp_path):
    def write(**files):
        for name, content in files.items():
            (tmp_path / f"{name}.tsv").write_text(content)
        return str(tmp_path)

    return write


def test_quotes_stay(spark, folder):
    path = folder(a=HEADER + '"a"\t1\t"Good ""x"""\nb\t0\tbad\n')
    assert rows(tsv.read_labelled(spark, path)) == [('"a"', 1.0, '"Good ""x"""'), ("b", 0.0, "bad")]


def test_extra_fields_are_ignored_and_empty_ones_kept(spark, folder):
    path = folder(a=HEADER + "a\t1\tx\tmore\tand more\nb\t0\t\n c \t1\t  y \n")
    assert rows(tsv.read_labelled(spark, path)) == [(" c ", 1.0, "  y "), ("a", 1.0, "x"), ("b", 0.0, "")]


def test_short_line_fails_or_is_diverted(spark, folder):
    path = folder(a=HEADER + "a\t1\tx\nb\t0\n")
    with pytest.raises(PySparkException, match="short line"):
        tsv.read_labelled(spark, path).collect()
    with pytest.raises(PySparkException, match="short line"):
        tsv.read_labelled(spark, path).count()
    assert rows(tsv.read_labelled(spark, path, short_lines="drop")) == [("a", 1.0, "x")]
    assert tsv.read_labelled(spark, path, short_lines="drop").count() == 1
    assert rows(tsv.read_labelled(spark, path, short_lines="only")) == [("b\t0",)]
    assert tsv.read_labelled(spark, path, short_lines="only").count() == 1


def test_bad_label_fails(spark, folder):
    path = folder(a=HEADER + "a\tabc\tx\n")
    with pytest.raises(PySparkException, match="bad label: abc"):
        tsv.read_labelled(spark, path).collect()


def test_header_of_each_file_or_of_the_first(spark, folder):
    path = folder(a=HEADER + "a\t1\tx\n", b="b\t0\ty\nc\t0\tz\n")
    assert rows(tsv.read_labelled(spark, path, header="each_file")) == [("a", 1.0, "x"), ("c", 0.0, "z")]
    assert rows(tsv.read_labelled(spark, path)) == [
        ("a", 1.0, "x"),
        ("b", 0.0, "y"),
        ("c", 0.0, "z"),
    ]


def test_repeated_header_by_position_and_by_value(spark, folder):
    path = folder(a=HEADER + HEADER.replace("sentiment", "1") + "a\t1\tx\n" + HEADER)
    with pytest.raises(PySparkException, match="bad label"):
        tsv.read_labelled(spark, path).collect()
    assert rows(tsv.read_dropping_header_value(spark, path)) == [("a", "1", "x"), ("id", "1", "review")]


def test_the_first_file_by_name_holds_the_header(spark, folder):
    """Also where it is the smallest file."""
    many = "".join(f"{n}\t1\ttext {n}\n" for n in range(500))
    path = folder(part0=HEADER + "a\t0\tx\n", part1=many)
    assert tsv.read_labelled(spark, path).count() == 501
    assert tsv.read_dropping_header_value(spark, path).count() == 501
    assert tsv.read_dropping_header_value(spark, path).where("id = 'id'").isEmpty()


def test_empty_first_files_hold_no_header(spark, folder):
    path = folder(a="", b="", c=HEADER + "1\t1\tfirst\n", d="2\t0\tsecond\n")
    assert rows(tsv.read_labelled(spark, path)) == [("1", 1.0, "first"), ("2", 0.0, "second")]
    assert rows(tsv.read_dropping_header_value(spark, path)) == [("1", "1", "first"), ("2", "0", "second")]


def test_only_empty_files(spark, folder):
    path = folder(a="")
    assert rows(tsv.read_unlabelled(spark, path)) == [] and rows(tsv.read_dropping_header_value(spark, path)) == []


def test_unlabelled(spark, folder):
    path = folder(a="id\treview\n1\tone\n2\ttwo\tignored\n")
    assert rows(tsv.read_unlabelled(spark, path)) == [("1", "one"), ("2", "two")]


def test_written_tsv_reads_back(spark, tmp_path):
    texts = [("1", 'a "quoted" \\ text'), ("2", " blanks "), ("3", ""), ("4", "tab\there\nand line"), ("5", "#x")]
    path = str(tmp_path / "out")
    tsv.write_tsv(spark.createDataFrame(texts, "id string, review string"), path)
    expected = [*texts[:3], ("4", "tab here and line"), texts[4]]
    assert rows(tsv.read_unlabelled(spark, path, header="each_file")) == expected


def test_labelled_and_unlabelled_cover_all_documents_once(spark, tiny):
    everything = {r.doc_id for r in tables.all_reviews(spark, tiny).collect()}
    labelled = [r.doc_id for r in tables.labelled_reviews(spark, tiny).collect()]
    unlabelled = [r.doc_id for r in tables.unlabelled_reviews(spark, tiny).collect()]
    assert sorted(labelled + unlabelled) == sorted(everything)


def test_second_label(spark, tiny):
    toxic = tables.labelled_reviews(spark, tiny, "toxic")
    assert {r.label for r in toxic.select("label").distinct().collect()} <= {0.0, 1.0}


class FakeSpark:
    """Just enough of a session to answer where its shared folder is."""

    def __init__(self, master, folder=None):
        values = {"spark.checkpoint.dir": folder} if folder else {}
        self.conf = self
        self.sparkContext = self
        self.master = master
        self.applicationId = "app"
        self.get = values.get

    def getConf(self):
        return self


def test_shared_folder_comes_from_the_session():
    fake = FakeSpark("yarn", "hdfs://somewhere/shared/")
    assert session.shared_root(fake) == "hdfs://somewhere/shared"
    assert session.new_folder(fake, "x").startswith("hdfs://somewhere/shared/app/x-")
    assert session.new_folder(fake, "x") != session.new_folder(fake, "x")


def test_no_machine_local_folder_on_a_cluster():
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        session.shared_root(FakeSpark("yarn"))


def test_only_small_tables_are_spread(spark):
    df = spark.range(0, 100, 1, 3)
    assert session.spread(df, session.SPREAD_LIMIT_BYTES + 1) is df
    assert session.spread(df, 10 * session.SPREAD_PARTITION_BYTES).rdd.getNumPartitions() == 8
    assert session.dealt(df, "id", 5).rdd.getNumPartitions() == 5


def test_larger_tables_are_shared_out_where_asked(spark):
    df = spark.range(0, 100, 1, 1)
    assert session.shared_out(df, session.SPREAD_LIMIT_BYTES, "id") is df
    dealt = session.shared_out(df, session.SPREAD_LIMIT_BYTES + 1, "id")
    assert "hashpartitioning(id#" in dealt._jdf.queryExecution().executedPlan().toString()
    assert sorted(r.id for r in dealt.collect()) == list(range(100))


def test_staged_tables_are_made_again_after_clean_up(spark, tiny):
    first = derived.cleaned_reviews(spark, tiny)
    assert derived.cleaned_reviews(spark, tiny) is first
    rows_before = rows(first)
    session.remove_staged(spark)
    again = derived.cleaned_reviews(spark, tiny)
    assert again is not first
    assert rows(again) == rows_before

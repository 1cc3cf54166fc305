import glob
import os

import pytest

from linkmill.operators.classes import class_index
from linkmill.plans import lineage
from linkmill.plans.export_job import export_view, sort_export, sort_export_job
from linkmill.sinks import text as K
from linkmill.sources.labels import has_labels, read_label_map
from linkmill.sources.tables import read_export


@pytest.fixture(scope="module")
def source(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("csv") / "in.csv")
    with open(path, "w") as f:
        f.write("cca2,timestamp,v\nUS,9,a\nUS,10,b\n,5,c\nDE,7,d\nDE,7,e\n")
    return path


def body(path):
    parts = sorted(glob.glob(f"{path}/part-*"))
    return [line for p in parts for line in open(p).read().splitlines()]


def test_export_is_all_text(spark, source):
    assert set(t for _, t in read_export(spark, source).dtypes) == {"string"}


@pytest.mark.parametrize("single", [False, True])
def test_export_order_is_text_order_nulls_first_no_header(spark, source, tmp_path, single):
    out = str(tmp_path / "out")
    sort_export_job(spark, source, out, single_file=single)
    lines = body(out)
    assert lines[0] == ",5,c" and sorted(lines[1:3]) == ["DE,7,d", "DE,7,e"]
    assert lines[3:] == ["US,10,b", "US,9,a"]
    if single:
        assert len(glob.glob(f"{out}/part-*")) == 1
    with pytest.raises(Exception, match="(?i)already exists"):
        sort_export_job(spark, source, out, single_file=single)


def test_typed_order_and_view(spark, source):
    rows = read_export(spark, source)
    assert [r["v"] for r in sort_export(rows, as_text=False).collect()][-2:] == ["a", "b"]
    seen = export_view(rows)
    assert seen.columns == ["cca2", "timestamp", "v"]
    assert [r["v"] for r in seen.collect()] == ["c", "d", "e", "b", "a"]


def test_rank_sinks(spark, tmp_path):
    ranks = spark.createDataFrame([("a", 0.15), ("b", 1.5)], "node string, rank double")
    K.write_ranks_text(ranks, str(tmp_path / "t"))
    assert sorted(body(tmp_path / "t")) == ["a\t0.15", "b\t1.5"]
    K.write_ranks_text(ranks, str(tmp_path / "u"), as_tuple=True)
    assert sorted(body(tmp_path / "u")) == ["('a', 0.15)", "('b', 1.5)"]
    K.write_ranks_csv(ranks, str(tmp_path / "c"), single_file=True)
    assert sorted(body(tmp_path / "c")) == ["a,0.15", "b,1.5"]
    K.write_trace(ranks, str(tmp_path / "p"))
    assert spark.read.parquet(str(tmp_path / "p")).count() == 2


def test_label_map(spark, tmp_path):
    out = str(tmp_path)
    assert not has_labels(spark, out)
    names = spark.createDataFrame([("b:x",), ("a",), ("b:x",)], "class string")
    K.write_label_map(class_index(names), out)
    assert has_labels(spark, out)
    assert body(os.path.join(out, "labels.txt")) == ["0:a", "1:b:x"]
    assert [tuple(r) for r in read_label_map(spark, f"{out}/labels.txt").orderBy("label").collect()] == [
        (0, "a"),
        (1, "b:x"),
    ]


class FakeContext:
    def __init__(self, master, current):
        self.master, self.current = master, current

    def getCheckpointDir(self):
        return self.current

    def setCheckpointDir(self, path):
        self.current = path


class FakeSession:
    def __init__(self, master, named=None, current=None, warehouse=None):
        self.sparkContext = FakeContext(master, current)
        self.conf = {"spark.checkpoint.dir": named} if named else {}
        self.conf["spark.sql.warehouse.dir"] = warehouse


def test_shared_folder_comes_from_the_session():
    session = FakeSession("yarn", named="hdfs:///ck")
    assert lineage.shared_folder(session) == "hdfs:///ck"
    assert session.sparkContext.current == "hdfs:///ck"
    assert lineage.shared_folder(FakeSession("yarn", current="s3://b/ck")) == "s3://b/ck"
    own = lineage.shared_folder(FakeSession("yarn", warehouse="hdfs:///wh/"))
    assert own == "hdfs:///wh/linkmill-checkpoints"

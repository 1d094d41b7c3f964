"""SRC-1 .. SRC-3, SNK-1, SNK-2, SRT-1: files written by the test itself."""

import os
import tempfile

import pytest

from nearframe.sources import (
    read_points_arff,
    read_points_csv,
    read_points_text,
    read_predictions,
    write_points_arff,
    write_predictions,
)


@pytest.fixture()
def tmp():
    return tempfile.mkdtemp(prefix="nearframe-test-")


def test_csv_infer_and_schema(spark, tmp):
    path = os.path.join(tmp, "pts.csv")
    with open(path, "w") as f:
        f.write("1.5,2,0\n3.0,4,1\n")
    df = read_points_csv(spark, path)
    assert df.columns == ["_c0", "_c1", "_c2"] and [tuple(r) for r in df.orderBy("_c0").collect()] == [(1.5, 2, 0), (3.0, 4, 1)]
    typed = read_points_csv(spark, path, "x double, y double, label int")
    assert typed.schema["label"].dataType.simpleString() == "int"


def test_numeric_text_fails_on_bad_line(spark, tmp):
    path = os.path.join(tmp, "pts.txt")
    with open(path, "w") as f:
        f.write("1,2,0\n3,4,1\n")
    df = read_points_text(spark, path, 3)
    assert df.columns == ["f0", "f1", "label"] and df.count() == 2
    with open(path, "a") as f:
        f.write("@data\n")
    with pytest.raises(Exception):
        read_points_text(spark, path, 3).collect()


def test_arff_header_comments_missing(spark, tmp):
    path = os.path.join(tmp, "x.arff")
    with open(path, "w") as f:
        f.write(
            "% a comment\n@RELATION test\n\n@ATTRIBUTE a NUMERIC\n@attribute 'b b' real\n@attribute n integer\n"
            "@attribute class {0,1}\n@DATA\n1.0, 2.0, 3, 0\n% inside\n\n?, 4.5, 7, 1\n"
        )
    df = read_points_arff(spark, path)
    assert df.columns == ["a", "b b", "n", "class"]
    assert [tuple(r) for r in df.orderBy("n").collect()] == [(1.0, 2.0, 3, 0), (None, 4.5, 7, 1)]


def test_arff_roundtrip(spark, tmp):
    df = spark.createDataFrame([(1, 2.5, 3), (2, None, 4)], "id int, x double, label int")
    path = os.path.join(tmp, "rt")
    write_points_arff(df, path, "rt")
    back = read_points_arff(spark, path)
    assert sorted(tuple(r) for r in back.collect()) == [(1, 2.5, 3), (2, None, 4)]


def test_predictions_csv_and_ordered_tsv(spark, tmp):
    pred = spark.createDataFrame([(i, i % 3) for i in range(100, 0, -1)], "query_id long, prediction int").repartition(4)
    write_predictions(pred, os.path.join(tmp, "p.csv"))
    with pytest.raises(Exception):
        write_predictions(pred, os.path.join(tmp, "p.csv"))
    assert read_predictions(spark, os.path.join(tmp, "p.csv")).count() == 100
    write_predictions(pred, os.path.join(tmp, "p.tsv"), "tsv")
    folder = os.path.join(tmp, "p.tsv")
    lines = []
    for name in sorted(os.listdir(folder)):
        if name.startswith("part-"):
            with open(os.path.join(folder, name)) as f:
                lines += f.read().splitlines()
    assert [int(x.split("\t")[0]) for x in lines] == list(range(1, 101))


class _Conf(dict):
    def get(self, key, default=None):
        return dict.get(self, key, default)


class _Ctx:
    def __init__(self, master, current=None):
        self.master, self.current, self.set_to = master, current, None

    def getCheckpointDir(self):
        return self.current

    def setCheckpointDir(self, d):
        self.set_to = d


class _Session:
    def __init__(self, master, conf=None, current=None):
        self.sparkContext = _Ctx(master, current)
        self.conf = _Conf(conf or {})


def test_checkpoint_dir_comes_from_the_session():
    from nearframe.session import ensure_checkpoint_dir

    s = _Session("yarn", {"spark.checkpoint.dir": "hdfs:///shared/ckpt"})
    assert ensure_checkpoint_dir(s) == "hdfs:///shared/ckpt" and s.sparkContext.set_to == "hdfs:///shared/ckpt"
    s = _Session("yarn", current="hdfs:///already")
    assert ensure_checkpoint_dir(s) == "hdfs:///already" and s.sparkContext.set_to is None


def test_no_machine_local_checkpoint_folder_on_a_cluster():
    from nearframe.session import ensure_checkpoint_dir

    with pytest.raises(RuntimeError):
        ensure_checkpoint_dir(_Session("spark://master:7077"))
    local = _Session("local[4]")
    assert ensure_checkpoint_dir(local) == local.sparkContext.set_to


def test_arff_rows_that_look_like_comments_or_declarations(spark, tmp):
    path = os.path.join(tmp, "d")
    os.makedirs(path)
    for name, rows in (("a.arff", "foo,1,0\n@bar,2,1\n"), ("b.arff", "'%baz',3,1\n@database,3000000000,10\n")):
        with open(os.path.join(path, name), "w") as f:
            f.write("@relation r\n@attribute 'a name' string\n@attribute n integer\n@attribute class {0,1,10}\n@data\n" + rows)
    df = read_points_arff(spark, path)
    rows = sorted(tuple(r) for r in df.collect())
    assert df.columns == ["a name", "n", "class"] and [r[1:] for r in rows if r[0] != "@bar"] and ("@bar", 2, 1) in rows
    assert ("@database", 3000000000, 10) in rows and len(rows) == 4
    out = os.path.join(tmp, "w")
    write_points_arff(df, out)
    assert sorted(tuple(r)[:2] for r in read_points_arff(spark, out).collect()) == [r[:2] for r in rows]

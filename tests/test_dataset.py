import numpy as np
import pytest
from pyspark.sql import functions as F

from linkmill.operators import classes as C
from linkmill.operators import images as I
from linkmill.operators import records as R
from linkmill.plans import dataset_job as J
from linkmill.plans.dataset_job import prepare_image_dataset
from linkmill.plans.sizes import measured_bytes
from linkmill.sources import images as SI
from linkmill.sources import labels as SL
from linkmill.sources import tables as ST
from workload.dataset import _png

SIZES = {"rose": 7, "daisy": 5, "tulip": 9}


def pixels_of(name, i):
    h, w = 3 + i % 2, 5
    rnd = np.random.default_rng(len(name) * 100 + i)
    return h, w, rnd.integers(0, 256, size=(h, w, 3), dtype=np.uint8)


@pytest.fixture(scope="module")
def folder(tmp_path_factory):
    root = tmp_path_factory.mktemp("images")
    for name, n in SIZES.items():
        (root / name).mkdir()
        for i in range(n):
            h, w, image = pixels_of(name, i)
            (root / name / f"{i}.png").write_bytes(_png(w, h, image.tobytes()))
    return str(root)


def test_listing_opens_no_file(spark, folder):
    files = SI.list_image_files(spark, folder)
    assert {r["class"]: r["count"] for r in files.groupBy("class").count().collect()} == SIZES
    assert "content" not in files._jdf.queryExecution().executedPlan().toString()


def test_decoding_gives_rgb(spark, folder):
    for row in SI.read_images(spark, folder).collect():
        h, w, image = pixels_of(row["class"], int(row["path"].split("/")[-1][:-4]))
        assert (row["height"], row["width"], bytes(row["pixels"])) == (h, w, image.tobytes())


def test_headers_agree_with_decoding(spark, folder):
    files = SI.list_image_files(spark, folder, content=True)
    for row in files.select("path", SI.image_dims(F.col("encoded")).alias("d")).collect():
        i = int(row["path"].split("/")[-1][:-4])
        assert tuple(row["d"]) == (3 + i % 2, 5, 3)


def test_jpeg_header(spark):
    frame = b"\xff\xc2\x00\x11\x08\x01\x02\x03\x04\x03" + b"\0" * 9
    raw = b"\xff\xd8" + b"\xff\xe0\x00\x04ab" + b"\xff\xff\xff\xc4\x00\x03x" + frame
    many = b"\xff\xd8" + b"\xff\xe2\x01\x00" * 1 + b"i" * 254 + b"\xff\xfe\x00\x02" * 300 + frame
    frames = spark.createDataFrame([(raw,), (many,)], "encoded binary").select(SI.image_dims(F.col("encoded")).alias("d"))
    assert [tuple(r["d"]) for r in frames.collect()] == [(0x0102, 0x0304, 3)] * 2
    plan = frames._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan


@pytest.mark.parametrize("raw", [b"GIF89a", b"", None, b"\xff\xd8", b"\xff\xd8abcd", b"\xff\xd8\xff\xe0\x00\x04ab"])
def test_other_files_fail(spark, raw):
    with pytest.raises(Exception, match="neither a PNG nor a JPEG"):
        spark.createDataFrame([(raw,)], "encoded binary").select(SI.image_dims(F.col("encoded"))).collect()


def test_records_of_pixels_need_no_join(spark, folder, tmp_path, monkeypatch):
    """Sizes in the JVM, one scan of the contents, pixels from the row's own image."""
    plans = []
    monkeypatch.setattr(J, "write_shards", lambda df, *_: plans.append(df._jdf.queryExecution().executedPlan().toString()))
    for pixels in (False, True):
        J.prepare_image_dataset(spark, folder, str(tmp_path / f"{pixels}"), n_validation=2, pixels=pixels)
    encoded, decoded = plans
    assert "Python" not in encoded and "Arrow" not in encoded
    for plan in plans:
        above_the_dictionary = plan.split("InMemoryTableScan")[0]
        assert "SortMergeJoin" not in plan and above_the_dictionary.count("BroadcastHashJoin") == 1
        assert plan.count("FileScan binaryFile") + plan.count("FileScan image") >= 1
    assert "image" in decoded and "content#" not in decoded.split("InMemoryTableScan")[0]


def test_features_are_fitted_and_standardised(spark, folder):
    images = SI.read_images(spark, folder)
    for row in I.image_features(images, 4, 8).collect():
        h, w, image = pixels_of(row["class"], int(row["path"].split("/")[-1][:-4]))
        want = I.fit(image, 4, 8).astype(float)
        want = (want - want.mean()) / max(want.std(), 1 / np.sqrt(want.size))
        assert np.allclose(row["features"], want.ravel(), atol=1e-5)


def test_whole_job(spark, folder, tmp_path):
    out = str(tmp_path / "out")
    labels = prepare_image_dataset(spark, folder, out, n_validation=6, shards=4, image_format="png")
    assert sorted((r["label"], r["name"]) for r in labels.collect()) == [(0, "daisy"), (1, "rose"), (2, "tulip")]
    train = ST.read_image_records(spark, f"{out}/records", "train").collect()
    held = ST.read_image_records(spark, f"{out}/records", "validation").collect()
    assert (len(train), len(held)) == (15, 6)
    assert {r["shard_file"] for r in train} == {f"flowers_train_{i:05d}-of-00004" for i in range(4)}
    names = ["daisy", "rose", "tulip"]
    for row in train + held:
        name, i = row["path"].split("/")[-2], int(row["path"].split("/")[-1][:-4])
        h, w, image = pixels_of(name, i)
        assert bytes(row["encoded"]) == _png(w, h, image.tobytes())
        assert (row["height"], row["width"], names[row["label"]], row["format"]) == (h, w, name, "png")
    plan = ST.read_image_records(spark, f"{out}/records", "train")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(shard_file" in plan
    again = prepare_image_dataset(spark, "/does/not/exist", out)
    assert again.count() == 3
    info = ST.describe_split(spark, out, "train")
    assert (info.pattern, info.rows, info.classes, info.labels.count()) == ("flowers_train_*", 3320, 5, 3)
    assert ST.describe_split(spark, folder, "validation", "synsets").labels is None
    with pytest.raises(ValueError, match="unknown split"):
        ST.describe_split(spark, out, "test")
    with pytest.raises(ValueError, match="unknown split"):
        ST.read_image_records(spark, f"{out}/records", "test")


def test_class_lookup_fails_on_unknown_names(spark):
    files = spark.createDataFrame([("p", "b"), ("q", "a")], "path string, class string")
    classes = C.class_index(files)
    got = C.attach_class_id(files, classes).collect()
    assert sorted((r["path"], r["label"]) for r in got) == [("p", 1), ("q", 0)]
    with pytest.raises(Exception, match="unknown class: b"):
        C.attach_class_id(files, classes.where("name = 'a'")).collect()


def test_dictionaries_by_measured_size(spark):
    files = spark.range(90).selectExpr("concat('c', least(id % 45, 3)) AS class", "id AS path").repartition(4)
    classes = C.class_index(files)
    size = measured_bytes(classes)
    assert size > 4 * 8
    results = []
    for bound, broadcast in ((size, True), (size - 1, False)):
        found = C.attach_class_id(files, classes, max_bytes=bound)
        plan = found._jdf.queryExecution().optimizedPlan().toString()
        assert ("slice" not in plan) == broadcast and "strategy=broadcast" in plan  # the heavy keys, at least
        results.append(sorted(map(tuple, found.collect())))
    assert results[0] == results[1] and len(results[0]) == 90


def test_heavy_classes_are_sliced(spark, monkeypatch):
    monkeypatch.setattr(C, "MIN_SLICE_ROWS", 5)
    rows = [(f"p{i}", "heavy" if i % 3 else f"c{i}") for i in range(120)]
    files = spark.createDataFrame(rows, "path string, class string").repartition(3)
    found = C.attach_class_id(files, C.class_index(files), max_bytes=0)
    want = {name: label for label, name in enumerate(sorted({c for _, c in rows}))}
    assert sorted((r["path"], r["label"]) for r in found.collect()) == sorted((p, want[c]) for p, c in rows)
    with pytest.raises(Exception, match="unknown class"):
        C.attach_class_id(files, C.class_index(files).where("name <> 'heavy'"), max_bytes=0).collect()


def test_bytes_of_all_kinds(spark):
    row = spark.createDataFrame([("abc", b"12", [1, 2], None)], "s string, b binary, a array<int>, n int")
    assert measured_bytes(row) >= 3 + 2 + 8 and measured_bytes(row.limit(0)) == 0


def test_label_lines(lines_of):
    got = SL.parse_label_lines(lines_of(["0:a", "", "12:b:c", "3:"])).collect()
    assert [(r["label"], r["name"]) for r in got] == [(0, "a"), (12, "b:c"), (3, "")]


def test_synsets(spark, tmp_path, lines_of):
    (tmp_path / "ids").write_text("n3\nn1 \nn2\n")
    (tmp_path / "names").write_text("n1\tone\nn2\ttwo, dos\nn3\tthree\nn4\tfour\n")
    ids, names = str(tmp_path / "ids"), str(tmp_path / "names")
    want = [(0, "background"), (1, "three"), (2, "one"), (3, "two, dos")]
    for counts in ((3, 4), (None, None)):
        got = SL.read_synset_names(spark, ids, names, *counts).collect()
        assert sorted((r["label"], r["name"]) for r in got) == want
    with pytest.raises(ValueError, match="expected 1000"):
        SL.read_synset_names(spark, ids, names)
    with pytest.raises(Exception, match="two fields"):
        SL.parse_synset_names(lines_of(["n1 one"])).collect()
    missing = SL.parse_synset_names(lines_of(["n1\tone"]))
    with pytest.raises(Exception, match="no name for"):
        C.label_names(SL.number_synsets(spark.read.text(ids), "value"), missing).collect()


def test_defaults_and_boxes(spark):
    df = spark.createDataFrame([(None, 3), ("png", None)], "format string, label long")
    got = R.with_defaults(df, {"format": "jpeg", "label": -1, "text": "", "encoded": b""}).collect()
    assert [(r["format"], r["label"], r["text"], bytes(r["encoded"])) for r in got] == [
        ("jpeg", 3, "", b""),
        ("png", -1, "", b""),
    ]
    sides = "xmin array<double>, ymin array<double>, xmax array<double>, ymax array<double>"
    one = spark.createDataFrame([([1.0, 5.0], [2.0, 6.0], [3.0, 7.0], [4.0, 8.0])], sides)
    assert [tuple(b) for b in R.zip_boxes(one).first()["boxes"]] == [(2.0, 1.0, 4.0, 3.0), (6.0, 5.0, 8.0, 7.0)]
    uneven = spark.createDataFrame([([1.0], [2.0, 6.0], [3.0], [4.0])], sides)
    with pytest.raises(Exception, match="differ in number"):
        R.zip_boxes(uneven).collect()


def test_split_sizes(spark):
    df = spark.createDataFrame([("train",)] * 3 + [("validation",)], "split string")
    assert R.check_split(df, "train", {"train": 3}).count() == 3
    with pytest.raises(ValueError, match="expected 350"):
        R.check_split(df, "validation")
    with pytest.raises(ValueError, match="unknown split"):
        R.check_split(df, "test")


def test_synset_layout(spark, tmp_path):
    rows = spark.createDataFrame([("train-0", "jpeg"), ("validation-0", None)], "shard_file string, format string")
    rows.write.partitionBy("shard_file").parquet(str(tmp_path / "r"))
    got = ST.read_image_records(spark, str(tmp_path / "r"), "validation", "synsets").collect()
    assert [(r["format"], r["label"], r["text"]) for r in got] == [("jpeg", -1, "")]


def test_synthetic_rows(spark):
    rows = ST.synthetic_features(spark, 400, 4, seed=1).orderBy("id").collect()
    assert len({tuple(r["features"]) for r in rows}) == 400
    assert all(0 <= r["label"] < 1000 for r in rows) and len({r["label"] for r in rows}) > 100
    cells = np.array([r["features"] for r in rows])
    assert abs(cells.mean()) < 0.1 and abs(cells.std() - 1) < 0.1
    again = ST.with_synthetic_features(spark.range(400).repartition(3), 4, seed=1).orderBy("id").collect()
    assert again == rows and ST.synthetic_features(spark, 1, 4, seed=2).first() != rows[0]
    same = ST.synthetic_features(spark, 20, 4, repeat_one=True).collect()
    assert len({(tuple(r["features"]), r["label"]) for r in same}) == 1


def test_spread_small(spark):
    few = spark.range(10, numPartitions=1)
    assert ST.spread_small(few).rdd.getNumPartitions() == 8
    many = spark.range(10, numPartitions=9)
    assert ST.spread_small(many) is many


def test_split_without_rows(spark, tmp_path):
    rows = spark.createDataFrame([("flowers_validation_00000-of-00005", "png")], "shard_file string, format string")
    rows.write.partitionBy("shard_file").parquet(str(tmp_path / "r"))
    assert ST.read_image_records(spark, str(tmp_path / "r"), "train").count() == 0

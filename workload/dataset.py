"""Dataset preparation queries: classes, splits, shards, labels, records, images."""

from __future__ import annotations

import struct
import zlib

import numpy as np
import pandas as pd
from pyarrow import fs
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from linkmill.functions.text import base_name, parent_name
from linkmill.operators import classes as C
from linkmill.operators.images import image_features
from linkmill.operators.order import assign_shards, seeded_split
from linkmill.operators.records import check_split, with_defaults, zip_boxes
from linkmill.plans.dataset_job import prepare_image_dataset
from linkmill.plans.lineage import fresh_path
from linkmill.plans.training import Params, evaluate, save_params
from linkmill.sinks.shards import SHARD_FILE, write_shards
from linkmill.sinks.text import write_label_map
from linkmill.sources.images import image_dims, list_image_files, read_images
from linkmill.sources.labels import read_label_map, read_synset_names
from linkmill.sources.tables import read_image_records
from workload.graph import table

# --- file lists -----------------------------------------------------------------------


def file_list(spark, sf_dir) -> DataFrame:
    docs = table(spark, sf_dir, "documents", "doc_id", "source", "lang")
    path = F.concat(F.lit("/data/"), "source", F.lit("/"), "lang", F.lit("/"), "doc_id", F.lit(".jpg"))
    return docs.select(path.alias("path")).withColumn("class", parent_name(F.col("path")))


def class_index(spark, sf_dir):
    return C.class_index(file_list(spark, sf_dir))


def attach_class(spark, sf_dir):
    files = file_list(spark, sf_dir)
    return C.attach_class_id(files, C.class_index(files)).select("path", "label")


def attach_class_by_shuffle(spark, sf_dir):
    """The way of a dictionary too large to broadcast, with every class in slices of its own."""
    files = file_list(spark, sf_dir)
    usual, C.MIN_SLICE_ROWS = C.MIN_SLICE_ROWS, 10
    try:
        return C.attach_class_id(files, C.class_index(files), max_bytes=0).select("path", "label")
    finally:
        C.MIN_SLICE_ROWS = usual


def synset_names_by_shuffle(spark, sf_dir):
    supplier = table(spark, sf_dir, "supplier", "s_suppkey", "s_name")
    code = F.format_string("n%08d", "s_suppkey").alias("synset")
    listed = supplier.select(F.col("s_suppkey").alias("position"), code)
    return C.label_names(listed, supplier.select(code, F.col("s_name").alias("name")), max_bytes=0)


def seeded_split_query(spark, sf_dir):
    return seeded_split(file_list(spark, sf_dir), "path").select("path", "split")


def shards(spark, sf_dir):
    split = seeded_split(file_list(spark, sf_dir), "path")
    return assign_shards(split, "path").select("path", "split", "shard")


def shard_roundtrip(spark, sf_dir):
    """Shards written and read back by split; the defaults fill what is missing."""
    files = file_list(spark, sf_dir)
    labelled = C.attach_class_id(files, C.class_index(files)).drop("class")
    placed = assign_shards(seeded_split(labelled, "path"), "path")
    path = fresh_path(spark, "records")
    records = placed.withColumn("label", F.when(F.col("label") > 0, F.col("label").cast("long")))
    write_shards(records.withColumn("encoded", F.encode("path", "UTF-8")), path, "path")
    read = [read_image_records(spark, path, split) for split in ("train", "validation")]
    both = read[0].unionByName(read[1])
    return both.select("path", F.col(SHARD_FILE), "format", "label")


def split_check(spark, sf_dir):
    files = file_list(spark, sf_dir)
    rows = files.count()
    sizes = {"validation": min(rows, 350), "train": rows - min(rows, 350)}
    split = seeded_split(files, "path")
    checked = [check_split(split, name, sizes) for name in sizes]
    return checked[0].unionAll(checked[1]).groupBy("split").agg(F.count(F.lit(1)).alias("n"))


# --- dictionaries --------------------------------------------------------------------------


def label_map_roundtrip(spark, sf_dir):
    """Names with a colon of their own survive the text form."""
    docs = table(spark, sf_dir, "documents", "source", "lang")
    names = docs.select(F.concat_ws(":", "lang", "source").alias("class"))
    folder = fresh_path(spark, "labels")
    write_label_map(C.class_index(names), folder)
    return read_label_map(spark, f"{folder}/labels.txt")


def background_labels(spark, sf_dir):
    return C.with_background(C.class_index(file_list(spark, sf_dir)))


def synset_names(spark, sf_dir):
    """Both files written from the suppliers, the list in order over several parts, and read back."""
    supplier = table(spark, sf_dir, "supplier", "s_suppkey", "s_name")
    code = F.format_string("n%08d", "s_suppkey")
    listed, named = fresh_path(spark, "synsets"), fresh_path(spark, "names")
    supplier.select(F.concat(code, F.lit(" ")).alias("value")).orderBy("value").write.text(listed)
    supplier.select(F.concat(code, F.lit("\t"), "s_name").alias("value")).write.text(named)
    rows = supplier.count()
    return read_synset_names(spark, listed, named, rows, rows)


# --- records ------------------------------------------------------------------------------------


def box_records(spark, sf_dir) -> DataFrame:
    """One record per line item with one to three boxes."""
    items = table(
        spark,
        sf_dir,
        "lineitem",
        *("l_orderkey", "l_linenumber", "l_discount", "l_tax", "l_quantity"),
        spread=True,
    )
    n = F.col("l_linenumber") % 3 + 1

    def side(*values):
        return F.slice(F.array(*[F.col(v) if isinstance(v, str) else v for v in values]), F.lit(1), n)

    half = F.col("l_quantity") / 100
    return items.select(
        "l_orderkey",
        "l_linenumber",
        side("l_discount", "l_tax", half).alias("xmin"),
        side("l_tax", "l_discount", half).alias("ymin"),
        side(half, "l_discount", "l_tax").alias("xmax"),
        side(half, "l_tax", "l_discount").alias("ymax"),
    )


def zip_boxes_query(spark, sf_dir):
    boxes = zip_boxes(box_records(spark, sf_dir))
    # every record has a box; the outer form spares the scan a filter that zips all boxes first
    flat = boxes.select("l_orderkey", "l_linenumber", F.posexplode_outer("boxes").alias("box", "b"))
    return flat.select("l_orderkey", "l_linenumber", "box", "b.ymin", "b.xmin", "b.ymax", "b.xmax")


def record_defaults(spark, sf_dir):
    orders = table(spark, sf_dir, "orders", "o_orderkey", "o_custkey")
    key = F.col("o_orderkey")
    sparse = orders.select(
        "o_orderkey",
        F.when(key % 2 == 1, F.lit("png")).alias("format"),
        F.when(key % 5 != 0, F.col("o_custkey")).alias("label"),
    )
    return with_defaults(sparse, {"format": "jpeg", "label": -1, "text": ""})


# --- images -----------------------------------------------------------------------------------------


def _png(width: int, height: int, rgb: bytes) -> bytes:
    def chunk(kind: bytes, body: bytes) -> bytes:
        return struct.pack(">I", len(body)) + kind + body + struct.pack(">I", zlib.crc32(kind + body))

    lines = b"".join(b"\0" + rgb[y * width * 3 : (y + 1) * width * 3] for y in range(height))
    head = struct.pack(">IIBBBBB", width, height, 8, 2, 0, 0, 0)
    return b"\x89PNG\r\n\x1a\n" + chunk(b"IHDR", head) + chunk(b"IDAT", zlib.compress(lines)) + chunk(b"IEND", b"")


def image_folder(spark, sf_dir) -> str:
    """One PNG per vector, ``<label>/<vec_id>.png``, 8 pixels wide.

    Red is the scaled cell, green its position, blue the label; vectors with an
    odd id lose their last row of pixels.
    """
    root = fresh_path(spark, "images")
    target, base = fs.FileSystem.from_uri(root)
    target.create_dir(base)
    rows = table(spark, sf_dir, "embeddings", "vec_id", "embedding", "label", spread=True)
    red = F.transform("embedding", lambda v: F.pmod(F.floor(v.cast("double") * 1000), F.lit(256)).cast("int"))

    def write(batches):
        store, folder = fs.FileSystem.from_uri(root)
        for frame in batches:
            for vec_id, cells, label in frame.itertuples(index=False):
                height = 7 if vec_id % 2 else 8
                rgb = bytes(b for i in range(height * 8) for b in (int(cells[i]), i, int(label)))
                store.create_dir(f"{folder}/{label}")
                with store.open_output_stream(f"{folder}/{label}/{vec_id}.png") as out:
                    out.write(_png(8, height, rgb))
            yield pd.DataFrame({"n": [len(frame)]})

    rows.select("vec_id", red.alias("red"), "label").mapInPandas(write, "n long").agg(F.sum("n")).collect()
    return root


def vec_id():
    return F.regexp_replace(base_name(F.col("path")), r"\.png$", "").cast("long")


def image_files(spark, sf_dir):
    files = list_image_files(spark, image_folder(spark, sf_dir))
    return files.select(vec_id().alias("vec_id"), F.col("class").cast("int").alias("label"))


def image_sizes(spark, sf_dir):
    """Decoded sizes beside the sizes read from the file headers."""
    root = image_folder(spark, sf_dir)
    decoded = read_images(spark, root).select(
        "path", "height", "width", F.length("pixels").alias("n_bytes")
    )
    encoded = list_image_files(spark, root, content=True)
    headers = encoded.select("path", image_dims(F.col("encoded")).alias("d"))
    both = decoded.withColumn("vec_id", vec_id()).join(
        headers.select(vec_id().alias("vec_id"), "d"), "vec_id"
    )
    return both.select(
        "vec_id",
        "height",
        "width",
        "n_bytes",
        F.col("d.height").alias("header_height"),
        F.col("d.width").alias("header_width"),
        F.col("d.channels").alias("channels"),
    )


def image_features_query(spark, sf_dir):
    """Decoded pixels fitted to 9 x 6 and standardised."""
    images = read_images(spark, image_folder(spark, sf_dir))
    fitted = image_features(images.select(vec_id().alias("vec_id"), "height", "width", "pixels"), 9, 6)
    flat = fitted.select("vec_id", F.posexplode("features").alias("k", "value"))
    return flat.select("vec_id", "k", F.round(F.col("value").cast("double"), 3).alias("value"))


def image_dataset(spark, sf_dir):
    """The whole job: folder to shards, read back by split."""
    out = fresh_path(spark, "dataset")
    prepare_image_dataset(spark, image_folder(spark, sf_dir), out, n_validation=100, image_format="png")
    again = prepare_image_dataset(spark, "/nowhere", out)  # finished: nothing is read again
    both = both_splits(spark, out).join(again, "label")
    return both.select("file", "split", F.col(SHARD_FILE), "label", "name", "format", "height", "width")


def both_splits(spark, out) -> DataFrame:
    records = [
        read_image_records(spark, f"{out}/records", split).withColumn("split", F.lit(split))
        for split in ("train", "validation")
    ]
    return records[0].unionByName(records[1])


def split_features(spark, sf_dir) -> DataFrame:
    """Model input straight from the shards of both splits."""
    out = fresh_path(spark, "dataset")
    images = image_folder(spark, sf_dir)
    prepare_image_dataset(spark, images, out, n_validation=100, image_format="png", pixels=True)
    records = both_splits(spark, out).select("file", "split", "label", "height", "width", "pixels")
    return image_features(records, 9, 6)


def dataset_features(spark, sf_dir):
    flat = split_features(spark, sf_dir).select("file", "split", F.posexplode("features").alias("k", "value"))
    return flat.select("file", "split", "k", F.round(F.col("value").cast("double"), 3).alias("value"))


def dataset_evaluate(spark, sf_dir):
    """Saved parameters scored on the validation split, from shards to precision."""
    path = fresh_path(spark, "model")
    weights = np.sin(np.arange(162)[:, None] * 10 + np.arange(10)[None, :])
    save_params(spark, Params(weights, np.cos(np.arange(10))), path, 5)
    scored = evaluate(split_features(spark, sf_dir).where("split = 'validation'"), path)
    return scored.select("step", "correct", "total", F.round("precision", 6).alias("precision"))


# --- oracles --------------------------------------------------------------------------------------------

FILES_SQL = "files as (select concat('/data/', source, '/', lang, '/', doc_id, '.jpg') as path, lang from documents)"
CLASSES_SQL = """classes as (select (row_number() over (order by lang) - 1)::int as label, lang
  from (select distinct lang from documents))"""
PLACED_SQL = """placed as (select path, lang,
  row_number() over (order by md5(concat('0', path)), path) as place, count(*) over () as total from files)"""
SPLIT_SQL = """splits as (select path, lang, case when place <= 350 then 'validation' else 'train' end as split,
  case when place <= 350 then place - 1 else place - 351 end as pos,
  case when place <= 350 then least(total, 350) else total - 350 end as size from placed)"""
SHARD_SQL = f"with {FILES_SQL}, {PLACED_SQL}, {SPLIT_SQL}"
SHARD_OF = "(pos // ceil(size / 5.0)::bigint)::int"
IMAGE_SPLIT_SQL = """names as (select name, row_number() over (order by name) - 1 as label_id
  from (select distinct cast(label as varchar) as name from embeddings)),
images as (select vec_id, name, label_id, concat(name, '/', vec_id, '.png') as file
  from embeddings join names on name = cast(label as varchar)),
placed as (select *, row_number() over (order by md5(concat('0', file)), file) as place,
  count(*) over () as total from images),
splits as (select *, case when place <= 100 then 'validation' else 'train' end as split,
  case when place <= 100 then place - 1 else place - 101 end as pos,
  case when place <= 100 then least(total, 100) else total - 100 end as size from placed)"""
GRID_SQL = """px as (select vec_id, label, 8 - vec_id % 2 as h, embedding as e from embeddings),
grid as (select vec_id, (r * 6 + c) * 3 + ch as k,
    case when r - (9 - h) // 2 between 0 and h - 1 then
      case ch when 0 then ((floor(e[(r - (9 - h) // 2) * 8 + c + 2]::double * 1000)::bigint % 256) + 256) % 256
        when 1 then (r - (9 - h) // 2) * 8 + c + 1 else label end
    else 0 end::double as v
  from px, range(9) t(r), range(6) u(c), range(3) w(ch)),
standard as (select vec_id, k, (v - avg(v) over g) / greatest(stddev_pop(v) over g, 1 / sqrt(162.0)) as value
  from grid window g as (partition by vec_id))"""

QUERIES = {
    "class_index": (class_index, f"with {CLASSES_SQL} select label, lang as name from classes"),
    "attach_class": (
        attach_class,
        f"with {FILES_SQL}, {CLASSES_SQL} select path, label from files join classes using (lang)",
    ),
    "attach_class_by_shuffle": (
        attach_class_by_shuffle,
        f"with {FILES_SQL}, {CLASSES_SQL} select path, label from files join classes using (lang)",
    ),
    "synset_names_by_shuffle": (
        synset_names_by_shuffle,
        """select s_suppkey + 1 as label, s_name as name from supplier union all select 0, 'background'""",
    ),
    "seeded_split": (seeded_split_query, f"{SHARD_SQL} select path, split from splits"),
    "shards": (shards, f"{SHARD_SQL} select path, split, {SHARD_OF} as shard from splits"),
    "shard_roundtrip": (
        shard_roundtrip,
        f"""{SHARD_SQL}, {CLASSES_SQL} select path, label, 'png' as format,
          concat('flowers_', split, '_', printf('%05d-of-00005', {SHARD_OF})) as shard_file
        from splits join classes using (lang)""",
    ),
    "split_check": (split_check, f"{SHARD_SQL} select split, count(*) as n from splits group by split"),
    "label_map_roundtrip": (
        label_map_roundtrip,
        """select (row_number() over (order by name) - 1)::int as label, name
        from (select distinct concat(lang, ':', source) as name from documents)""",
    ),
    "background_labels": (
        background_labels,
        f"""with {CLASSES_SQL} select label + 1 as label, lang as name from classes
        union all select 0, 'background'""",
    ),
    "synset_names": (
        synset_names,
        """select row_number() over (order by printf('n%08d', s_suppkey)) as label, s_name as name from supplier
        union all select 0, 'background'""",
    ),
    "zip_boxes": (
        zip_boxes_query,
        """with sides as (select l_orderkey, l_linenumber, l_linenumber % 3 + 1 as n,
            [l_discount, l_tax, l_quantity / 100] as x0, [l_tax, l_discount, l_quantity / 100] as y0,
            [l_quantity / 100, l_discount, l_tax] as x1, [l_quantity / 100, l_tax, l_discount] as y1
          from lineitem)
        select l_orderkey, l_linenumber, box, y0[box + 1] as ymin, x0[box + 1] as xmin,
          y1[box + 1] as ymax, x1[box + 1] as xmax
        from sides, range(3) t(box) where box < n""",
    ),
    "record_defaults": (
        record_defaults,
        """select o_orderkey, case when o_orderkey % 2 = 1 then 'png' else 'jpeg' end as format,
          case when o_orderkey % 5 <> 0 then o_custkey else -1 end as label, '' as text from orders""",
    ),
    "image_files": (image_files, "select vec_id, label from embeddings"),
    "image_sizes": (
        image_sizes,
        """select vec_id, 8 - vec_id % 2 as height, 8 as width, (8 - vec_id % 2) * 24 as n_bytes,
          8 - vec_id % 2 as header_height, 8 as header_width, 3 as channels from embeddings""",
    ),
    "image_features": (
        image_features_query,
        f"with {GRID_SQL} select vec_id, k, round(value::float::double, 3) as value from standard",
    ),
    "image_dataset": (
        image_dataset,
        f"""with {IMAGE_SPLIT_SQL} select file, split, label_id as label, name, 'png' as format,
          8 - vec_id % 2 as height, 8 as width,
          concat('flowers_', split, '_', printf('%05d-of-00005', {SHARD_OF})) as shard_file
        from splits""",
    ),
    "dataset_features": (
        dataset_features,
        f"""with {IMAGE_SPLIT_SQL}, {GRID_SQL}
        select file, split, k, round(value::float::double, 3) as value from standard join splits using (vec_id)""",
    ),
    "dataset_evaluate": (
        dataset_evaluate,
        f"""with {IMAGE_SPLIT_SQL}, {GRID_SQL},
        z as (select vec_id, c, sum(value * sin(k * 10 + c)) + cos(c) as z
          from standard join splits using (vec_id), range(10) t(c) where split = 'validation' group by vec_id, c),
        hits as (select vec_id, max(case when c = label_id and z >= m then 1 else 0 end) as hit
          from (select *, max(z) over (partition by vec_id) as m from z) join splits using (vec_id) group by vec_id)
        select 5 as step, sum(hit) as correct, count(*) as total, round(avg(hit), 6) as precision from hits""",
    ),
}

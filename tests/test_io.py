"""Writers, readers and samplers not covered elsewhere."""

import json
import os

from pyspark.sql import functions as F

from hamper.operators.sampling import file_sample, hash_sample
from hamper.sinks.writers import read_back_count, recommendation_lists, write_recommendations, write_table
from hamper.sources.baskets import read_baskets, read_table
from hamper.sources.inventory import file_inventory, inventory_totals


def test_write_and_read_back_recommendations(spark, tmp_dir):
    recs = spark.createDataFrame([(1, 5, 1), (1, 6, 2), (2, 7, 1)], "basket long, item long, rank long")
    lists = recommendation_lists(recs)
    out = os.path.join(tmp_dir, "submission")
    write_recommendations(lists, out, k=100, model_type="popularity")
    assert read_back_count(spark, out).first().playlists == 2
    info = spark.read.json(f"{out}/submission_info").first()
    assert info.total_playlists == 2 and info.recommendations_per_playlist == 100
    back = {r.playlist_id: r.recommended_tracks for r in spark.read.json(f"{out}/playlists").collect()}
    assert back == {"1": ["5", "6"], "2": ["7"]}


def test_write_table_round_trip(spark, tmp_dir):
    df = spark.range(10).withColumn("is_train", F.col("id") < 8)
    write_table(df, os.path.join(tmp_dir, "t"), partition_by=["is_train"])
    back = read_table(spark, os.path.join(tmp_dir, "t"))
    assert back.count() == 10 and back.where(F.col("is_train").cast("boolean")).count() == 8


def _docs(path, n_files, per_file=2):
    for i in range(n_files):
        doc = {"playlists": [{"pid": i * per_file + j, "tracks": [{"track_uri": "t", "pos": 0}]}
                             for j in range(per_file)]}
        with open(os.path.join(path, f"baskets.part.{i}.json"), "w") as f:
            json.dump(doc, f)


def test_file_level_sample_keeps_whole_files(spark, tmp_dir):
    _docs(tmp_dir, 20)
    full = read_baskets(spark, tmp_dir)
    sampled = read_baskets(spark, tmp_dir, sample=0.5, sample_level="file")
    per_file = sampled.groupBy("_file").count().collect()
    assert 0 < len(per_file) < 20 and all(r["count"] == 2 for r in per_file)
    again = read_baskets(spark, tmp_dir, sample=0.5, sample_level="file")
    assert sorted(r.pid for r in again.collect()) == sorted(r.pid for r in sampled.collect())
    by_basket = read_baskets(spark, tmp_dir, sample=0.5, sample_level="basket")
    assert by_basket.count() < full.count()
    assert file_sample(full, 1.0).count() == full.count()


def test_hash_sample_fraction_bounds(spark):
    df = spark.range(5000).withColumnRenamed("id", "basket")
    n = hash_sample(df, ["basket"], 0.3).count()
    assert 1300 < n < 1700
    assert hash_sample(df, ["basket"], 0.0).count() == 0 and hash_sample(df, ["basket"], 1.0).count() == 5000


def test_inventory_without_contents(spark, tmp_dir):
    _docs(tmp_dir, 3)
    files = file_inventory(spark, tmp_dir, pattern="baskets.part.*.json")
    tot = inventory_totals(files).first()
    assert tot.files == 3 and tot.bytes == sum(os.path.getsize(os.path.join(tmp_dir, f)) for f in os.listdir(tmp_dir))
    plan = files._jdf.queryExecution().executedPlan().toString()
    assert "content" not in plan.split("ReadSchema")[-1].split("\n")[0]


def _files_opened(df):
    """Files of the scans under a frame's last run."""
    import re

    df.collect()
    plan = df._jdf.queryExecution().executedPlan()
    found, open_ = 0, [plan]
    while open_:
        node = open_.pop()
        if node.metrics().contains("numFiles"):
            found += node.metrics().apply("numFiles").value()
        if re.match("AdaptiveSparkPlan", node.nodeName()):
            open_.append(node.executedPlan())
        open_ += [node.children().apply(i) for i in range(node.children().size())]
    return found


def test_files_left_out_of_a_sample_are_not_opened(spark, tmp_dir):
    _docs(tmp_dir, 40)
    assert _files_opened(read_baskets(spark, tmp_dir)) == 40
    sampled = read_baskets(spark, tmp_dir, sample=0.25, sample_level="file")
    kept = sampled.select("_file").distinct().count()
    assert 0 < kept < 25 and _files_opened(sampled) == kept
    by_number = F.regexp_extract(F.col("_metadata.file_path"), r"part\.(\d+)\.", 1)
    part = read_baskets(spark, tmp_dir, sample=0.5, file_key=by_number)
    assert _files_opened(part) == part.select("_file").distinct().count() < 40


def test_lines_of_split_files_keep_their_numbers(spark, tmp_dir):
    """JSON lines of several splits, with empty, damaged and long lines and both line ends."""
    from hamper.sources.baskets import numbered_lines, read_request_baskets

    lines = {}
    for name, end in (("a.json", "\n"), ("b.json", "\r\n"), ("sub.json", "\n")):
        some = []
        for i in range(300):
            tracks = [{"track_uri": f"u{j}"} for j in range(i % 40)]
            one = {"test_id": f"{name}-{i}", "tracks": tracks}
            some.append("" if i % 17 == 3 else "{ damaged" if i % 29 == 5 else json.dumps([one, {}] if i % 2 else {"playlists": [one]}))
        lines[name] = some
        with open(os.path.join(tmp_dir, name), "w", newline="") as f:
            f.write(end.join(some) + (end if name != "a.json" else ""))
    spark.conf.set("spark.sql.files.maxPartitionBytes", "5000")
    try:
        assert spark.read.option("lineSep", "\n").text(tmp_dir).rdd.getNumPartitions() > 12
        got = sorted((r._file, r._doc, r._v) for r in numbered_lines(spark, tmp_dir).collect())
        keys = {r.request_key: (r.test_id, len(r.tracks)) for r in read_request_baskets(spark, tmp_dir, multiline=False).collect()}
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    assert got == sorted((n, i, v) for n, some in lines.items() for i, v in enumerate(some))
    expected = {}
    for name, some in lines.items():
        for i, v in enumerate(some):
            if v.startswith(("[", '{"')):
                doc = json.loads(v)
                for pos, r in enumerate(doc if isinstance(doc, list) else doc["playlists"]):
                    place = f"{name}:{i}:{pos}"
                    expected[place] = (r.get("test_id", f"unknown_{place}"), len(r.get("tracks", [])))
    assert keys == expected


def test_inventory_is_in_name_order(spark, tmp_dir):
    for i in (5, 1, 12, 3):
        os.makedirs(os.path.join(tmp_dir, f"d{i % 3}"), exist_ok=True)
        with open(os.path.join(tmp_dir, f"d{i % 3}", f"f{i:02}.txt"), "w") as f:
            f.write("x" * i)
    rows = file_inventory(spark, tmp_dir).collect()
    assert [(r.file_name, r.length) for r in rows] == [("f01.txt", 1), ("f03.txt", 3), ("f05.txt", 5), ("f12.txt", 12)]

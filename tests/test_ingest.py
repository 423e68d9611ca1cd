"""Incremental ingest across streams: checkpoints that are new, lost or interrupted lose and repeat nothing."""

import json
import os
import shutil

from hamper.streaming.ingest import ingest_increment, read_ingested, read_manifest


def deliver(folder, *ids):
    os.makedirs(folder, exist_ok=True)
    for i in ids:
        doc = {"playlists": [{"pid": i, "tracks": [{"track_uri": f"t{i}", "pos": 0}]}]}
        with open(os.path.join(folder, f"baskets.{i}.json"), "w") as f:
            json.dump(doc, f)


def pids(spark, dst):
    return sorted(r.pid for r in read_ingested(spark, dst).collect())


def test_two_sources_with_their_own_checkpoints(spark, tmp_dir):
    a, b, dst = (os.path.join(tmp_dir, n) for n in ("a", "b", "dst"))
    deliver(a, 1, 2, 3)
    deliver(b, 10)
    assert ingest_increment(spark, a, dst, os.path.join(tmp_dir, "ck-a")).first().baskets == 3
    last = ingest_increment(spark, b, dst, os.path.join(tmp_dir, "ck-b")).first()
    assert (last.files, last.baskets, last.interactions, last.new_files) == (4, 4, 4, 1)
    assert pids(spark, dst) == [1, 2, 3, 10]
    deliver(a, 4)
    deliver(b, 11)
    ingest_increment(spark, a, dst, os.path.join(tmp_dir, "ck-a"))
    assert ingest_increment(spark, b, dst, os.path.join(tmp_dir, "ck-b")).first().baskets == 6
    assert pids(spark, dst) == [1, 2, 3, 4, 10, 11]
    assert read_manifest(spark, dst).select("stream").distinct().count() == 2


def test_lost_checkpoint_after_the_sources_are_gone(spark, tmp_dir):
    src, dst, ck = (os.path.join(tmp_dir, n) for n in ("src", "dst", "ck"))
    deliver(src, 1, 2)
    ingest_increment(spark, src, dst, ck)
    shutil.rmtree(ck)
    shutil.rmtree(src)
    deliver(src, 2, 3)          # one name is known, one is new
    last = ingest_increment(spark, src, dst, ck).first()
    assert (last.files, last.baskets, last.new_baskets) == (3, 3, 1) and pids(spark, dst) == [1, 2, 3]


def test_a_batch_that_ends_between_its_writes(spark, tmp_dir, monkeypatch):
    """Baskets without their manifest don't count; the same batch comes again and replaces them."""
    src, dst, ck = (os.path.join(tmp_dir, n) for n in ("src", "dst", "ck"))
    deliver(src, 1, 2)
    ingest_increment(spark, src, dst, ck)
    stream = read_manifest(spark, dst).first().stream
    manifest = os.path.join(dst, "files", f"stream={stream}")
    shutil.move(manifest, os.path.join(tmp_dir, "gone"))
    assert pids(spark, dst) == [] and read_manifest(spark, dst).count() == 0
    # Spark forgets that the batch ended: the next run repeats it under its number
    for f in os.listdir(os.path.join(ck, "commits")):
        os.remove(os.path.join(ck, "commits", f))
    assert ingest_increment(spark, src, dst, ck).first().baskets == 2
    assert pids(spark, dst) == [1, 2] and os.listdir(os.path.join(dst, "baskets", f"stream={stream}")) == ["batch=0"]


def test_a_batch_run_again_after_its_manifest(spark, tmp_dir):
    src, dst, ck = (os.path.join(tmp_dir, n) for n in ("src", "dst", "ck"))
    deliver(src, 1, 2)
    ingest_increment(spark, src, dst, ck)
    for f in os.listdir(os.path.join(ck, "commits")):
        os.remove(os.path.join(ck, "commits", f))
    last = ingest_increment(spark, src, dst, ck).first()
    assert (last.files, last.baskets) == (2, 2) and pids(spark, dst) == [1, 2]


def test_nothing_ingested_yet(spark, tmp_dir):
    src, dst = os.path.join(tmp_dir, "src"), os.path.join(tmp_dir, "dst")
    os.makedirs(src)
    last = ingest_increment(spark, src, dst, os.path.join(tmp_dir, "ck")).first()
    assert (last.files, last.baskets, last.batches) == (0, 0, 0) and pids(spark, dst) == []


def test_registered_increments_come_in_bounded_files(spark, monkeypatch):
    """Files of a delivery hold so many lines, however many there are, and each is taken once (F14)."""
    import os

    from hamper.plans import catalog as C
    from hamper.session import recorded_scratch

    monkeypatch.setattr(C, "LINES_PER_FILE", 100)
    C.clear_memo()
    sf = "/root/testdata/sf0.001"
    lines = spark.read.parquet(f"{sf}/lineitem.parquet")
    with recorded_scratch() as folders:
        got = C.QUERIES["ingest_increment"](spark, sf).first()
    assert (got.interactions, got.held, got.failed, got.new_files) == (lines.count(), lines.count(), 1, 0)
    assert got.baskets == lines.select("l_orderkey").distinct().count()
    sources = [f for f in folders if os.path.basename(f).startswith(("ingest-src-0", "ingest-src-1")) and spark.read.text(f).count()]
    counts = [len([x for x in os.listdir(f.removeprefix("file:")) if x.startswith("part-")]) for f in sources]
    assert len(counts) == 2 and min(counts) > 8

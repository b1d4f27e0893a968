"""Readers and writers on small files."""

import json
import os
import tarfile

import numpy as np
import pytest
from pyspark.sql import functions as F

from cliploom.sources import clips, tables


@pytest.fixture
def dataset(tmp_path):
    for name, n in (("motions/a.npz", 3), ("motions/nested/b.npz", 2)):
        clips.save_motion(f"{tmp_path}/{name}", np.arange(n * 4).reshape(n, 4))
    (tmp_path / "manifest.json").write_text(json.dumps({"motions_subdir": "motions", "timestep": 0.02}))
    return tmp_path


def test_data_source(spark, dataset):
    df = clips.read_motions(spark, f"{dataset}/motions")
    assert sorted((r.motion, r.step, r.qpos[0]) for r in df.collect()) == [("a.npz", 0, 0), ("a.npz", 1, 4), ("a.npz", 2, 8), ("nested/b.npz", 0, 0), ("nested/b.npz", 1, 4)]
    assert df.filter("motion = 'a.npz'").count() == 3
    clips.write_motions(df.filter("motion = 'a.npz'"), f"{dataset}/out")
    assert np.array_equal(clips.load_motion(f"{dataset}/out/a.npz"), np.arange(12).reshape(3, 4))
    known = clips.copy_subset(df, spark.createDataFrame([("nested/b.npz",)], "motion string"), f"{dataset}/sub", 0.02, dataset_name="x")
    assert known["num_motions"] == 1 and known == clips.load_manifest(f"{dataset}/sub")
    with pytest.raises(FileNotFoundError):
        clips.read_motions(spark, f"{dataset}/none")


def test_load_motion(tmp_path):
    np.savez(tmp_path / "v.npz", qpos=np.arange(3))
    assert clips.load_motion(f"{tmp_path}/v.npz").shape == (1, 3)
    np.savez(tmp_path / "x.npz", other=1)
    with pytest.raises(KeyError):
        clips.load_motion(f"{tmp_path}/x.npz")
    np.savez(tmp_path / "c.npz", qpos=np.zeros((1, 2, 3)))
    with pytest.raises(ValueError, match="dimensions"):
        clips.load_motion(f"{tmp_path}/c.npz")


def test_views_and_roots(dataset):
    assert clips.find_root(f"{dataset}/motions/nested") == dataset
    assert clips.resolve_view(str(dataset), ["nested/b.npz", "motions/a.npz"]) == ["nested/b.npz", "a.npz"]
    for bad, error in ((["../x.npz"], ValueError), (["/a.npz"], ValueError), (["a.txt"], ValueError), (["no.npz"], FileNotFoundError), (["a.npz", "motions/a.npz"], ValueError)):
        with pytest.raises(error):
            clips.resolve_view(str(dataset), bad)
    os.symlink("/etc/hostname", dataset / "motions/link.npz")
    with pytest.raises(ValueError, match="link"):
        clips.resolve_view(str(dataset), ["link.npz"])
    (dataset / "view.txt").write_text("# no\n\n a.npz \n")
    assert clips.view_names(str(dataset), path="view.txt") == ["a.npz"]
    with pytest.raises(ValueError, match="either"):
        clips.view_names(str(dataset))
    os.remove(dataset / "motions/link.npz")
    found = clips.collect_motions([f"{dataset}/motions", f"{dataset}/motions/a.npz"])
    assert [p.name for p in found] == ["a.npz", "b.npz"]


def test_legacy(spark, tmp_path):
    for name, n in (("x", 2), ("y", 1)):
        os.makedirs(tmp_path / name)
        np.savez(tmp_path / name / "motion.npz", **{f: np.ones((n, 1, 3)) for f in clips.LEGACY})
        (tmp_path / name / "meta.json").write_text(json.dumps({"fps": 50, "length": n}))
    df, meta = clips.read_legacy(spark, str(tmp_path))
    assert meta == {"fps": 50} and df.count() == 3 and clips.dataset_kind(str(tmp_path)) == "legacy"
    (tmp_path / "y/meta.json").write_text(json.dumps({"fps": 60, "length": 1}))
    with pytest.raises(ValueError, match="meta"):
        clips.read_legacy(spark, str(tmp_path))


def test_csv(spark, tmp_path):
    (tmp_path / "p.csv").write_text("\n".join(",".join(str(i + j) for j in range(36)) for i in range(2)))
    out = tables.walk_csv_to_qpos(tables.read_positional_csv(spark, f"{tmp_path}/p.csv", 36)).orderBy("line").collect()
    assert out[0].qpos[:8] == [0, 1, 2, 6, 3, 4, 5, 7] and len(out[1].qpos) == 36
    with pytest.raises(Exception, match="expected 35"):
        tables.read_positional_csv(spark, f"{tmp_path}/p.csv", 35).collect()
    (tmp_path / "n.csv").write_text("Frame,tx,ty,tz,rx,ry,rz,j\n0,100,0,0,0,0,90,180\n")
    named = tables.read_named_csv(spark, f"{tmp_path}/n.csv", ["tx", "ty", "tz", "rx", "ry", "rz", "j"])
    q = tables.suit_csv_to_qpos(named, ["tx", "ty", "tz"], ["rx", "ry", "rz"], ["j"]).first().qpos
    assert np.allclose(q, [1, 0, 0, np.sqrt(0.5), 0, 0, np.sqrt(0.5), np.pi])
    with pytest.raises(ValueError, match="nope"):
        tables.read_named_csv(spark, f"{tmp_path}/n.csv", ["nope"])


def test_frame_slice(spark):
    df = spark.range(10)
    assert [r.id for r in tables.frame_slice(df, F.col("id"), 2, -1, 3).collect()] == [2, 5, 8]
    assert [r.id for r in tables.frame_slice(df, F.col("id"), 2, 6, 0).collect()] == [2, 3, 4, 5]


def test_scores(spark, tmp_path):
    (tmp_path / "s.json").write_text(json.dumps({"details": [{"motion": "a", "physical_score": "91.5"}, {"motion": "b", "physical_score": 3}]}))
    assert [tuple(r) for r in tables.read_scores(spark, f"{tmp_path}/s.json").collect()] == [("a", 91.5), ("b", 3.0)]
    (tmp_path / "bad.json").write_text(json.dumps({"details": [{"motion": "a", "physical_score": "x"}]}))
    with pytest.raises(Exception, match="needs a motion"):
        tables.read_scores(spark, f"{tmp_path}/bad.json").collect()


def test_raw_fields_and_archives(tmp_path):
    np.arange(6, dtype=np.float32).tofile(tmp_path / "f.memmap")
    (tmp_path / "meta.json").write_text(json.dumps({"f": {"dtype": "torch.float32", "shape": [2, 3]}, "g": {"dtype": "torch.bool", "shape": [1]}}))
    assert clips.load_raw_field(str(tmp_path), "f").tolist() == [[0, 1, 2], [3, 4, 5]]
    with pytest.raises(ValueError, match="unsupported"):
        clips.load_raw_field(str(tmp_path), "g")
    with tarfile.open(tmp_path / "t.tar", "w") as t:
        t.add(tmp_path / "meta.json", "../out.json")
    with pytest.raises(ValueError, match="unsafe"):
        clips.safe_extract(f"{tmp_path}/t.tar", f"{tmp_path}/to")


def test_segments_npz(tmp_path):
    np.savez(tmp_path / "g.npz", root_pos=np.zeros((3, 3)), root_rot=np.ones((3, 4)), dof_pos=np.zeros((3, 2)))
    assert clips.load_segments_npz(f"{tmp_path}/g.npz")["dof_pos"].shape == (3, 2)
    np.savez(tmp_path / "h.npz", root_pos=np.zeros((2, 3)), root_rot=np.ones((3, 4)), dof_pos=np.zeros((3, 2)))
    with pytest.raises(ValueError, match="shapes"):
        clips.load_segments_npz(f"{tmp_path}/h.npz")


def test_cache(spark, dataset):
    key = clips.cache_key(f"{dataset}/motions", 50.0, ["a.npz"])
    assert key == clips.cache_key(f"{dataset}/motions", 50.0, ["a.npz"]) and len(key) == 16
    built = []

    def build():
        built.append(1)
        return spark.range(3)

    assert clips.cached(spark, f"{dataset}/cache", key, build).count() == clips.cached(spark, f"{dataset}/cache", key, build).count() == 3
    assert built == [1]
    assert clips.cached(spark, f"{dataset}/cache", key, build, {"stride": 2}).count() == 3 and built == [1, 1]  # other settings

    def late():
        clips.cached(spark, f"{dataset}/cache", "race", lambda: spark.range(5), {"v": 1})  # another builder is first
        return spark.range(7)

    assert clips.cached(spark, f"{dataset}/cache", "race", late, {"v": 1}).count() == 5
    assert sorted(p.name for p in (dataset / "cache").iterdir()) == sorted([key, "race"])
    os.utime(dataset / "motions/a.npz", (1, 1))
    assert key != clips.cache_key(f"{dataset}/motions", 50.0, ["a.npz"])


def test_report(spark, tmp_path):
    rows = spark.createDataFrame([("a", 95.0, "kept"), ("b", 3.0, "rejected")], "motion string, physical_score double, status string")
    clips.write_report(rows, f"{tmp_path}/r")
    assert [r.value for r in spark.read.text(f"{tmp_path}/r/filenames").collect()] == ["a"]
    assert spark.read.json(f"{tmp_path}/r/summary").first().kept == 1

"""Manifests and logs of real files: hidden, small, repeated and oddly named ones."""

from spotframe.sources import manifest


def test_manifest_of_a_tree(spark, tmp_path):
    sizes = {"WT/a_001.vsi": 600, "WT/b 002.VSI": 700, "WT/_hidden.vsi": 600, "WT/.dot.vsi": 600, "WT/deep/a_001.vsi": 900, "Sec/c.vsi": 512, "Sec/small.vsi": 511, "Sec/notes.txt": 800, "top.vsi": 600}
    for name, size in sizes.items():
        path = tmp_path / name
        path.parent.mkdir(parents=True, exist_ok=True)
        path.write_bytes(b"x" * size)
    listed = manifest.list_files(spark, str(tmp_path))
    found = {r["path"].removeprefix(f"file:{tmp_path}/"): r["length"] for r in listed.collect()}
    assert found == {n: s for n, s in sizes.items() if not n.split("/")[-1].startswith(("_", "."))}
    whole = manifest.build_manifest(manifest.reject_small(listed), ["vsi"], {"WT": "wild"}, ["Sec"])
    rows = {r["path"].removeprefix(f"file:{tmp_path}/"): (r["condition"], r["sec_only"]) for r in whole.collect()}
    assert rows == {"WT/a_001.vsi": ("wild", False), "WT/b 002.VSI": ("wild", False), "WT/deep/a_001.vsi": ("deep", False), "Sec/c.vsi": ("Sec-Only", True), "top.vsi": (tmp_path.name, False)}
    # a base name picks every file of that name
    subset = manifest.subset_manifest(whole, spark.createDataFrame([("a_001.vsi",), ("missing.vsi",)], "entry string"))
    assert subset.count() == 2
    done = spark.createDataFrame([(f"file:{tmp_path}/Sec/c.vsi",)], "path string")
    assert manifest.pending(whole, done).count() == 4


def test_logs_are_read_whole(spark, tmp_path):
    (tmp_path / "one.log").write_bytes(b"focus a z 1-3\r\nnoise\r\nfocus b z 2-9\r\nfocus a z 4-6\r\n")
    (tmp_path / "two.log").write_bytes(b"")
    lines = manifest.read_log(spark, str(tmp_path))
    assert [(r["line_no"], r["line"]) for r in lines.where("path like '%one.log'").orderBy("line_no").collect()][:3] == [(0, "focus a z 1-3"), (1, "noise"), (2, "focus b z 2-9")]
    assert sorted(tuple(r) for r in manifest.focus_windows(lines, r"focus (\S+) z (\d+)-(\d+)").collect()) == [("a", 4, 6), ("b", 2, 9)]

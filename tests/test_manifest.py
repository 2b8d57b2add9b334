import os

import pytest

from siltbed.sources.manifest import Manifest, list_files, read_listed


def put(folder, **files):
    folder.mkdir(exist_ok=True)
    for name, text in files.items():
        (folder / f"{name}.txt").write_text(text)


def names(rows):
    return sorted(os.path.basename(row["path"]) for row in rows.collect())


@pytest.fixture
def manifest(spark, tmp_path):
    return Manifest(spark, str(tmp_path / "manifest"))


def test_files_are_new_once(spark, tmp_path, manifest):
    landing = tmp_path / "in"
    put(landing, a="1", b="22", none="")
    listing = list_files(spark, str(landing), "*.txt")
    first = manifest.unseen(listing)
    assert names(first) == ["a.txt", "b.txt", "none.txt"]
    manifest.record(first, "r1")
    assert names(manifest.unseen(list_files(spark, str(landing)))) == []
    put(landing, c="3", a="changed")
    new = manifest.unseen(list_files(spark, str(landing)))
    assert names(new) == ["a.txt", "c.txt"]
    read = {os.path.basename(r["path"]): bytes(r["content"]) for r in read_listed(spark, str(landing), new).collect()}
    assert read == {"a.txt": b"changed", "c.txt": b"3"}


def test_ranges_of_paths_give_the_same_files(spark, tmp_path, manifest):
    landing = tmp_path / "in"
    put(landing, **{f"f{n:02d}": str(n) for n in range(23)}, blank="", **{"with+plus and blank": "x"})
    listing = list_files(spark, str(landing))
    for at_once in (1000, 5, 1):
        rows = read_listed(spark, str(landing), listing, names_at_once=at_once).collect()
        contents = sorted(bytes(r["content"]) for r in rows)
        assert contents == sorted([str(n).encode() for n in range(23)] + [b"", b"x"]), at_once


def test_a_run_that_died_is_hidden_and_its_files_stay_new(spark, tmp_path, manifest):
    landing = tmp_path / "in"
    put(landing, a="1")
    rows = spark.createDataFrame([("dead", 1), ("done", 2)], "ingestion_id string, n int")
    listing = list_files(spark, str(landing))
    assert manifest.finished(rows).count() == 0
    manifest.record(listing, "done")
    assert [r["n"] for r in manifest.finished(rows).collect()] == [2]
    manifest.record(listing, "done")
    assert manifest.files().count() == 1


def test_old_files_are_not_opened_and_contents_are_not_shuffled(spark, tmp_path, plan):
    landing = tmp_path / "in"
    put(landing, old="old", new="new")
    os.utime(landing / "old.txt", (1_000_000_000, 1_000_000_000))
    new = list_files(spark, str(landing)).filter("path LIKE '%new.txt'")
    text = plan(read_listed(spark, str(landing), new))
    assert "GreaterThanOrEqual(modificationTime" in text
    assert "SortMergeJoin" not in text and "hashpartitioning" not in text


def test_no_file(spark, tmp_path):
    (tmp_path / "in").mkdir()
    with pytest.raises(FileNotFoundError):
        list_files(spark, str(tmp_path / "in"))

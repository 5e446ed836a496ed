import io
import random
import tarfile

import pytest
from pyspark.sql import functions as F

from pairloom.sources import tar_ranges
from pairloom.sources.tar_ranges import Reader, expand, read_range, read_tar_members, tar_samples


def write_tar(path, members, fmt=tarfile.PAX_FORMAT):
    with tarfile.open(path, "w", format=fmt) as tar:
        for name, data in members:
            info = tarfile.TarInfo(name)
            info.size = len(data)
            tar.addfile(info, io.BytesIO(data))


def content(seed, inner=False):
    rng = random.Random(seed)
    members = []
    for i in range(60):
        name = f"part/{'long' * 40 if i % 9 == 4 else ''}{'é' * (i % 13 == 5)}{i:04d}"
        members.append((f"{name}.JPG", rng.randbytes(rng.choice([0, 1, 511, 512, 513, 3000]))))
        members.append((f"{name}.json", b'{"caption": "%d"}' % i))
    if inner:
        archive = io.BytesIO()
        with tarfile.open(fileobj=archive, mode="w") as tar:
            for i in range(9):
                info = tarfile.TarInfo(f"inner{i}.jpg")
                info.size = 700
                tar.addfile(info, io.BytesIO(bytes(700)))
        members.insert(20, ("part/nested.bin", archive.getvalue()))
    return members


@pytest.mark.parametrize("fmt", [tarfile.PAX_FORMAT, tarfile.GNU_FORMAT])
@pytest.mark.parametrize("size", [512, 1024, 4096, 20_480, 1 << 30])
@pytest.mark.parametrize("inner", [False, True])
def test_ranges_hold_each_member_once(tmp_path, fmt, size, inner):
    path, members = str(tmp_path / "00003.tar"), content(1, inner)
    write_tar(path, members, fmt)
    length = (tmp_path / "00003.tar").stat().st_size
    plain = fmt == tarfile.GNU_FORMAT and not inner
    rows = [r for at in range(0, length, size) for r in read_range(path, at, min(length, at + size), plain)]
    assert [(r[3], r[5]) for r in rows] == members
    assert {r[0] for r in rows} == {"00003"} and rows[0][1:3] == ("part/0000", "jpg")


def test_source_prunes_files_and_reads_samples(spark, tmp_path, monkeypatch):
    for i in range(4):
        write_tar(tmp_path / f"{i:05d}.tar", content(i))
    members = read_tar_members(spark, f"{tmp_path}/{{00000..00002}}.tar", range_bytes=4096)
    assert members.rdd.getNumPartitions() > 20
    assert {r[0] for r in members.select("shard").distinct().collect()} == {"00000", "00001", "00002"}
    one = members.where("shard = '00001' and ext = 'json'")
    assert one.count() == 60 and one.rdd.getNumPartitions() < members.rdd.getNumPartitions() / 2
    whole = tar_samples(read_tar_members(spark, f"{tmp_path}/*.tar", range_bytes=4096), ("jpg", "json"))
    rows = {(r["shard"], r["key"]): (r["jpg"], r["json"]) for r in whole.collect()}
    assert len(rows) == 240
    for name, data in content(2):
        key, ext = name.split(".")
        assert rows["00002", key][ext == "json"] == data
    (tmp_path / "00002.tar").unlink()
    assert members.where(F.col("shard").isin("00000", "00001")).count() == 240


def test_paths_and_options(tmp_path):
    assert expand("a/{08..11}.tar") == ["a/08.tar", "a/09.tar", "a/10.tar", "a/11.tar"]
    with pytest.raises(ValueError):
        expand("{3..1}")
    with pytest.raises(ValueError):
        tar_ranges.TarMembers({"path": "x", "rangeBytes": "1000"}).reader(None)
    with pytest.raises(FileNotFoundError):
        Reader([f"{tmp_path}/none.tar"], 512).partitions()


@pytest.mark.parametrize("size", [512, 4096])
@pytest.mark.parametrize("inner", [False, True])
def test_small_ranges_share_tasks_and_headers(tmp_path, monkeypatch, size, inner):
    monkeypatch.setattr(tar_ranges, "TASKS", 6)
    wanted = []
    for i in range(5):
        members = content(i, inner and i == 2)
        write_tar(tmp_path / f"{i:05d}.tar", members)
        wanted += [(f"{i:05d}", *m) for m in members]
    reader = Reader([f"{tmp_path}/*.tar"], size)
    parts = reader.partitions()
    total = sum(f.stat().st_size for f in tmp_path.glob("*.tar"))
    assert 6 <= len(parts) <= 8 < total // size
    rows = [row for p in parts for batch in reader.read(p) for row in batch.to_pylist()]
    assert [(r["shard"], r["name"], r["data"]) for r in rows] == wanted
    read = []
    monkeypatch.setattr(tar_ranges, "header", lambda block, whole=tar_ranges.header: read.append(1) or whole(block))
    list(tar_ranges.read_ranges(f"{tmp_path}/00000.tar", 0, total // 5, size))
    # Each header is followed once, however many ranges look for their first.
    assert len(read) < 120 * 10

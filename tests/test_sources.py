import io
import json
import tarfile

import pytest
from pyspark.sql import functions as F

from pairloom.schemas import MANIFEST
from pairloom.sources import manifest, shards, tar
from tests.plans import formatted


def rows(spark, start, n):
    return spark.range(start, start + n).select(
        "id", F.concat(F.lit("u"), "id").alias("url"), F.lit("c").alias("caption"), F.lit("s").alias("source")
    )


def test_metadata_shards(spark, tmp_path):
    for i in range(3):
        rows(spark, 10 * i, 10).write.parquet(str(tmp_path / f"metadata.{i:02d}.parquet"))
    assert manifest.load_metadata_shards(spark, str(tmp_path), 2).count() == 20
    assert manifest.load_metadata_shards(spark, str(tmp_path), 3, schema=MANIFEST).count() == 30
    with pytest.raises(ValueError):
        manifest.load_metadata_shards(spark, str(tmp_path), 0)


def test_metadata_schemas_must_agree(spark, tmp_path):
    rows(spark, 0, 5).write.parquet(str(tmp_path / "metadata.00.parquet"))
    rows(spark, 5, 5).drop("source").write.parquet(str(tmp_path / "metadata.01.parquet"))
    with pytest.raises(ValueError, match="schema"):
        manifest.load_metadata_shards(spark, str(tmp_path), 2)


def test_projection_reaches_the_scan(spark, tmp_path):
    path = str(tmp_path / "m")
    rows(spark, 0, 5).withColumn("unused", F.lit(1)).write.parquet(path)
    plan = formatted(manifest.project_manifest(spark.read.parquet(path), extra=("id",)))
    assert "ReadSchema: struct<id:bigint,url:string,caption:string>" in plan


def test_retry_list_is_what_is_not_ok(spark):
    m = rows(spark, 0, 4)
    landed = spark.createDataFrame([(0, b"x", 1.0), (1, b"x", 9.0), (2, None, 1.0)], "id long, data binary, elapsed_s double")
    joined = {r["id"]: (r["status"], r["data"]) for r in manifest.attach_payloads(m, landed).collect()}
    assert joined == {0: ("ok", bytearray(b"x")), 1: ("timeout", None), 2: ("missing", None), 3: ("missing", None)}
    assert sorted(r["id"] for r in manifest.retry_list(m, landed).collect()) == [1, 2, 3]


def test_count_assets(spark, tmp_path):
    for name in ("a.jpg", "b.JPG", "sub/c.png", "sub/plain"):
        target = tmp_path / name
        target.parent.mkdir(exist_ok=True)
        target.write_bytes(b"x")
    listed = manifest.list_assets(spark, str(tmp_path))
    assert "content" not in formatted(listed).split("ReadSchema")[1].splitlines()[0]
    assert {r["ext"]: r["n"] for r in manifest.count_assets(listed).collect()} == {"jpg": 2, "png": 1, "": 1}


def test_shards_roll_and_prune(spark, tmp_path):
    path = str(tmp_path / "s")
    shards.write_sample_shards(rows(spark, 0, 105), path, 20, order_by=["id"], partitions=3)
    sizes = {r["shard"]: r["count"] for r in spark.read.parquet(path).groupBy("shard").count().collect()}
    assert sizes == {0: 20, 1: 20, 2: 20, 3: 20, 4: 20, 5: 5}
    part = shards.read_shard_range(spark, path, "x/{000001..000003}.tar")
    assert sorted(r["id"] for r in part.collect()) == list(range(20, 80))
    assert "PartitionFilters: [isnotnull(shard" in formatted(part)


def test_bad_ranges():
    assert shards.shard_bounds("{000000..000112}") == (0, 112)
    for spec in ("x", "{5..2}"):
        with pytest.raises(ValueError):
            shards.shard_bounds(spec)


def write_tar(path, members):
    with tarfile.open(path, "w") as out:
        for name, data in members:
            info = tarfile.TarInfo(name)
            info.size = len(data)
            out.addfile(info, io.BytesIO(data))


@pytest.fixture()
def tars(tmp_path):
    for shard in range(3):
        members = []
        for i in range(40):
            key = f"d/{shard:02d}{i:03d}"
            members.append((f"{key}.{'jpg' if i % 2 else 'PNG'}", bytes([i]) * (1000 + i)))
            note = json.dumps({"caption": f"c{i}"}).encode() if i != 7 else b'{"caption"'
            members.append((f"{key}.json", note))
        members.append((f"d/{'x' * 120}{shard}.json", b"{}"))
        members.append((".hidden", b"no"))
        write_tar(tmp_path / f"{shard:05d}.tar", members)
    return str(tmp_path / "*.tar")


@pytest.mark.parametrize("partitions", [1, 5])
def test_tar_import(spark, tars, partitions):
    got = tar.import_tar_shards(spark, tars, partitions=partitions).collect()
    assert len(got) == 3 * 41 and len({(r["shard"], r["key"]) for r in got}) == 3 * 41
    for r in got:
        if "x" in r["key"]:
            assert len(r["key"]) == 123 and r["jpg"] is None and bytes(r["json"]) == b"{}"
            continue
        i = int(r["key"][-3:])
        image, other = (r["jpg"], r["png"]) if i % 2 else (r["png"], r["jpg"])
        assert bytes(image) == bytes([i]) * (1000 + i) and other is None


def test_tar_import_in_small_reads(spark, tars, monkeypatch):
    monkeypatch.setattr(tar, "READ_BYTES", 5000)
    assert tar.import_tar_shards(spark, tars).count() == 3 * 41


def test_tar_payloads_are_not_shuffled(spark, tars):
    plan = formatted(tar.import_tar_shards(spark, tars))
    last = plan.rindex("MapInPandas")
    exchanges = [line for line in plan[last:].splitlines() if line.startswith("Input") and "jpg" in line]
    assert not exchanges


def test_decode_members(spark):
    df = spark.createDataFrame([("caption.txt", "é".encode()), ("vae_latent.pth", b"\x80"), ("jpg", b"\xff")], "ext string, data binary")
    out = tar.decode_members(df).collect()
    assert [(r["kind"], r["text"]) for r in out] == [("text", "é"), ("tensor", None), ("raw", None)]


def test_given_schema_is_checked(spark, tmp_path):
    spark.range(2).selectExpr("id", "'x' AS url").write.parquet(f"{tmp_path}/metadata.00.parquet")
    spark.range(2).selectExpr("id", "'x' AS link").write.parquet(f"{tmp_path}/metadata.01.parquet")
    schema = spark.read.parquet(f"{tmp_path}/metadata.00.parquet").schema
    with pytest.raises(ValueError, match="01"):
        manifest.load_metadata_shards(spark, str(tmp_path), 2, schema=schema)
    assert manifest.load_metadata_shards(spark, str(tmp_path), 1, schema=schema).count() == 2


def test_payload_that_landed_twice_counts_once(spark):
    rows = spark.createDataFrame([(1,), (2,)], "id int")
    landed = spark.createDataFrame(
        [(1, b"late", 9.0), (1, b"slow", 3.0), (1, b"fast", 1.0), (2, None, 1.0), (2, b"late", 20.0)],
        "id int, data binary, elapsed_s double",
    )
    got = {r["id"]: (r["data"], r["status"]) for r in manifest.attach_payloads(rows, landed).collect()}
    assert got == {1: (bytearray(b"fast"), "ok"), 2: (None, "timeout")}
    assert [r["id"] for r in manifest.retry_list(rows, landed).collect()] == [2]

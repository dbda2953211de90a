"""Files of any size: their bytes in pieces, and their digests."""

import gzip
import hashlib

import numpy as np

from gleaner.session import stage_path
from gleaner.sources import files
from gleaner.streaming import raw_files

RANDOM = np.random.default_rng(1).integers(0, 256, 300_000, np.uint8).tobytes()
MARK = files.BYTE_ORDER_MARK
FILES = {
    "a.bin": RANDOM, "b.bin": RANDOM[:777] + b"\n", "c.bin": b"\n", "d.bin": b"\n\n", "e.bin": b"no end", "f.bin": b"\r\n\r", "g.bin": b"x\n" * 50_000,
    "h.bin": MARK, "i.bin": MARK + b"text\n", "j.bin": MARK + RANDOM, "k [1]{2}*.bin": b"name", "r%20+ä.bin": b"coded",
    "l.txt.gz": gzip.compress(RANDOM), "m.BZ2": b"not packed\n",
    "n.bin": MARK[:2] + b"\n", "o.bin": b"\x00" * 200_000, "deep/p.bin": b"deep", "deep/kind=3/q.bin": b"\xff\xfe\n\x00",
}


def put(folder, contents):
    for name, content in contents.items():
        (folder / name).parent.mkdir(parents=True, exist_ok=True)
        (folder / name).write_bytes(content)


def test_pieces_are_the_bytes_of_each_file(spark, tmp_path):
    put(tmp_path, FILES)
    paths = [r.path for r in files.scan_files(spark, str(tmp_path)).select("path").collect()]
    assert len(paths) == len(FILES)
    made = files.read_pieces(spark, paths, stage_path(spark, "pieces"), "md5", 1000).collect()
    for path in paths:
        name = path.split(f"{tmp_path}/")[1]
        own = sorted((r for r in made if r.path == path), key=lambda r: r.piece)
        assert b"".join(bytes(r.content) for r in own[:-1]) == FILES[name], name
        assert own[-1].content is None and own[-1].digest == hashlib.md5(FILES[name]).hexdigest() and own[-1].length == len(FILES[name])
    assert max(len(r.content or b"") for r in made) == 1000
    assert spark.conf.get("spark.sql.files.minPartitionNum", None) is None
    told = files.file_digests(spark, files.scan_files(spark, str(tmp_path), "*.bin"))
    assert {r.digest for r in told.collect()} == {hashlib.sha256(v).hexdigest() for k, v in FILES.items() if k.endswith(".bin")}
    assert files.file_digests(spark, files.scan_files(spark, str(tmp_path), "*.none")).count() == 0


def test_files_above_the_longest_row_are_read_and_stored(spark, tmp_path):
    """Spark refuses a binary value above this length, as it does above 2 GB."""
    put(tmp_path, FILES)
    table, checkpoint = stage_path(spark, "raw"), stage_path(spark, "checkpoint")
    spark.conf.set("spark.sql.sources.binaryFile.maxLength", 100_000)
    try:
        told = files.file_digests(spark, files.scan_files(spark, str(tmp_path), "*.bin"), "md5")
        assert {r.digest for r in told.collect()} == {hashlib.md5(v).hexdigest() for k, v in FILES.items() if k.endswith(".bin")}
        found = raw_files.sync_files(spark, str(tmp_path), table, checkpoint, "*.bin")
        assert {r.digest for r in found.collect()} == {hashlib.sha256(v).hexdigest() for k, v in FILES.items() if k.endswith(".bin")}
    finally:
        spark.conf.unset("spark.sql.sources.binaryFile.maxLength")
    assert {bytes(r.content) for r in raw_files.current_files(spark, table).collect()} == {v for k, v in FILES.items() if k.endswith(".bin")}
    put(tmp_path, {"a.bin": RANDOM[::-1] + b"longer"})
    assert raw_files.load_replaced(spark, str(tmp_path), table, "*.bin") == 1
    assert RANDOM[::-1] + b"longer" in {bytes(r.content) for r in raw_files.current_files(spark, table).collect()}

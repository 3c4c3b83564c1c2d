"""Blocks of a source that is read in pieces."""

from sparkmart.plans import zone_queries as Z
from sparkmart.session import scratch_folder


def test_blocks_grow_with_the_source_up_to_those_of_the_session(spark, monkeypatch):
    folder = scratch_folder(spark, "blocks")
    spark.range(20_000).selectExpr("CAST(id AS string)").write.text(folder)
    assert Z.cutting_block_bytes(spark, folder) == Z.SMALL_BLOCK  # as before, for a small source
    monkeypatch.setattr(Z, "SMALL_BLOCK", 1000)
    monkeypatch.setattr(Z, "SMALL_BLOCKS", 10)
    assert 10_000 < Z.cutting_block_bytes(spark, folder) < 12_000
    before = spark.conf.get(Z.BLOCK_BYTES)
    spark.conf.set(Z.BLOCK_BYTES, "4k")
    try:
        assert Z.cutting_block_bytes(spark, folder) == 4096
    finally:
        spark.conf.set(Z.BLOCK_BYTES, before)


def test_records_cut_by_larger_blocks_are_whole(spark, small, monkeypatch):
    want = {tuple(r) for r in Z.csv_line_breaks(small).collect()}
    monkeypatch.setattr(Z, "SMALL_BLOCKS", 3)
    monkeypatch.setattr(Z, "SMALL_BLOCK", 1000)
    assert {tuple(r) for r in Z.csv_line_breaks(small).collect()} == want


def test_records_of_any_batches_equal_those_of_a_reader():
    """Batches that cut records, records of one and of many lines, CRLF, and a block that begins inside quotes."""
    import csv
    import io
    import random

    import pyarrow as pa

    from sparkmart.sources.csv_records import records_of_blocks

    rng = random.Random(5)
    parts = ["a", "", "x\ny", '"', "\r\n", "p\nq\nr\n", "é"]
    records = [[str(i), "".join(rng.choices(parts, k=3))] for i in range(300)]
    out = io.StringIO()
    csv.writer(out, lineterminator="\r\n").writerows(records)
    lines = out.getvalue().split("\n")[:-1]
    for step in (1, 2, 3, 7, 1000):
        for cut in (0, 1, 2, 3, 50):  # lines that lie in the block before
            inside = sum(line.count('"') for line in lines[:cut]) % 2
            own = lines[cut:]
            rows = [pa.RecordBatch.from_pydict({"file": ["f"] * len(b), "block": [0] * len(b), "inside": [inside] * len(b), "opens": [False] * len(b), "offset": [0] * len(b), "value": b})
                    for b in (own[i:i + step] for i in range(0, len(own), step))]
            got = [r for b in records_of_blocks("whole")(iter(rows)) for r in b.to_pylist()]
            pieces = [r for b in records_of_blocks("pieces")(iter(rows)) for r in b.to_pylist()]
            (count,) = [r for b in records_of_blocks("counts")(iter(rows)) for r in b.to_pylist()]
            read = [next(csv.reader(io.StringIO(r["record"], newline=""))) for r in sorted(got, key=lambda r: r["number"])]
            assert read == records[len(records) - len(read):] and count["records"] == len(read)
            assert [r["number"] for r in pieces] == [-1] * inside

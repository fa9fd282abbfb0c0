import base64
import gzip
import hashlib
from pathlib import Path

import pytest
from ebbline.llm import warc
from ebbline.llm.warc import WarcOptions


def odd_pages():
    return [
        (1, "http://a.org/1", "<p>one</p>"), (2, "http://a.org/2", "<p>one</p>"), (3, None, "<p>one</p>"),
        (4, "http://a.org/\r\nWARC-Type: evil é 漢", ""), (5, "u", None), (None, "n", "<p>one</p>"), (None, None, None),
        (None, "x", "only without ids"), (None, "y", "only without ids"), (7, "r", "again"), (7, "r", "again"), (7, "s", "other"),
        (8, "long", "x" * 3_000_000), (-9, "neg", "\r\n\r\nWARC/1.1\r\n"), (2**62, "far", "é漢\U0001f600\x00"), (2**62 + 1, "far", "again"),
    ]


def frame(spark, rows, parts=3):
    full = [(*row, "clash", "clash") for row in rows]
    return spark.createDataFrame(full, "page_id long, url string, html string, shard string, digest string").repartition(parts)


def expected(rows, least=0):
    result = []
    for page_id, _, html in rows:
        data = (html or "").encode()
        same = [p for p, _, h in rows if (h or "") == (html or "") and p is not None]
        original = max(same, default=None) if len([1 for _, _, h in rows if (h or "") == (html or "")]) > 1 else None
        revisit = original is not None and page_id != original and len(data) >= least
        digest = base64.b32encode(hashlib.sha1(data).digest()).decode()
        result.append((page_id, len(data), digest, "revisit" if revisit else "response", original if revisit else None))
    return sortable(result)


def sortable(rows):
    return sorted(tuple("" if v is None else str(v) for v in row) for row in rows)


def read_rows(records):
    names = ("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")
    return sortable(tuple(r[n] for n in names) for r in records)


@pytest.mark.parametrize("options", [WarcOptions(), WarcOptions(shard_bytes=4000, roll_bytes=500, min_revisit_bytes=6)])
def test_odd_pages_there_and_back(spark, options):
    rows = odd_pages()
    records = warc.write_and_read(frame(spark, rows), options).collect()
    assert read_rows(records) == expected(rows, options.min_revisit_bytes)
    texts = sorted((h or "") for _, _, h in rows)
    responses = [bytes(r["payload"]).decode() for r in records if r["record_type"] == "response"]
    assert set(responses) == set(texts)
    assert all(r["payload"] is None for r in records if r["record_type"] == "revisit")


def test_empty_table(spark):
    assert warc.write_and_read(frame(spark, [])).collect() == []


def written(spark, folder, parts):
    rows = [(i * 37 % 1000, f"http://h.org/{i}", f"<p>{i % 400}</p>" * (1 + i % 50)) for i in range(1000)]
    options = WarcOptions(shard_bytes=60_000, roll_bytes=2_000)
    manifest = warc.write(frame(spark, rows, parts), str(folder), options).collect()
    return {path.name: path.read_bytes() for path in Path(folder).glob("*.warc.gz")}, manifest


def test_files_do_not_depend_on_the_partitions(spark, tmp_path):
    first, manifest = written(spark, tmp_path / "a", 2)
    again, _ = written(spark, tmp_path / "b", 7)
    assert first == again
    assert sorted(r["name"] for r in manifest) == sorted(first)
    # Several shards, rolled into several files, in the order of ids; nothing temporary is left.
    assert len({r["shard"] for r in manifest}) > 3 and len(manifest) > 20
    ordered = sorted(manifest, key=lambda r: r["name"])
    assert all(a["last_id"] <= b["first_id"] for a, b in zip(ordered, ordered[1:]))
    assert not (tmp_path / "a" / "_temporary").exists()
    for row in manifest:
        data = first[row["name"]]
        assert (len(data), hashlib.sha256(data).hexdigest()) == (row["bytes"], row["sha256"])
        assert gzip.decompress(data).startswith(b"WARC/1.1\r\nWARC-Type: warcinfo\r\n")


def test_files_outside_the_manifest_are_not_read_and_damage_is_found(spark, tmp_path):
    files, _ = written(spark, tmp_path / "c", 3)
    count = warc.read(spark, str(tmp_path / "c")).count()
    name = sorted(files)[0]
    (tmp_path / "c" / "left-by-a-lost-task.warc.gz").write_bytes(files[name])
    assert warc.read(spark, str(tmp_path / "c")).count() == count == 1000
    (tmp_path / "c" / name).write_bytes(files[name][:-1] + b"x")
    with pytest.raises(Exception, match="not the file that was committed"):
        warc.read(spark, str(tmp_path / "c")).collect()


def test_moving_twice_does_no_harm(spark, tmp_path):
    import pyarrow as pa

    (tmp_path / "_temporary").mkdir()
    (tmp_path / "_temporary" / "t").write_bytes(b"data")
    batch = pa.RecordBatch.from_pylist([{"name": "f", "temporary": "_temporary/t", "bytes": 4}], warc.MANIFEST)
    for _ in range(2):
        list(warc._mover(str(tmp_path))([batch]))
    assert (tmp_path / "f").read_bytes() == b"data"


def test_damaged_records_raise():
    row = {"page_id": 1, "url": "u", "payload": b"some payload", "revisit": False, "refers_to": None}
    record = warc.page_record(row, 0, "2026-01-01T00:00:00Z")
    assert next(warc.parse(gzip.compress(record)))["payload"] == b"some payload"
    with pytest.raises(ValueError, match="damaged"):
        list(warc.parse(gzip.compress(record.replace(b"some payload", b"same payload"))))


def test_crowded_ids_are_cut_further(spark):
    # Nearly all pages lie in a tiny part of the range of ids, and one id has a third of all rows.
    rows = [(i, "u", f"page {i}" * 20) for i in range(600)] + [(2**61, "u", "far")] + [(5, "u", f"copy {i}" * 20) for i in range(300)]
    options = WarcOptions(shard_bytes=40_000)
    records = warc.write_and_read(frame(spark, rows), options).collect()
    assert read_rows(records) == expected(rows)
    placed, slots = shard_sizes(spark, rows, options)
    assert len(placed) > 10 and max(placed.values()) < 200
    assert max(slot for _, _, slot in placed) < slots and len({slot for _, _, slot in placed}) == len(placed)


def shard_sizes(spark, rows, options):
    """Rows by (shard, part, slot), and the number of slots."""
    sized = frame(spark, rows).selectExpr("page_id", "sha1(html) AS digest", "CAST(length(html) AS BIGINT) AS size")
    placed, slots = warc._with_shards(sized, options)
    return {(r["shard"], r["part"], r["slot"]): r["count"] for r in placed.groupBy("shard", "part", "slot").count().collect()}, slots


def test_rows_without_an_id_are_cut_by_digest(spark):
    # A third of all rows has no id.
    rows = [(None if i % 3 == 0 else i, "u", f"page {i} " * 20) for i in range(1800)]
    options = WarcOptions(shard_bytes=60_000)
    sizes, _ = shard_sizes(spark, rows, options)
    ordered = sorted(sizes.values())
    assert max(ordered) <= 2 * ordered[len(ordered) // 2]
    assert sum(n for (shard, _, _), n in sizes.items() if shard == 0) == 600
    assert read_rows(warc.write_and_read(frame(spark, rows), options).collect()) == expected(rows)


@pytest.mark.parametrize("spread", [1, 2**52, -(2**51)])
def test_shards_hold_consecutive_ids_of_even_weight(spark, spread):
    rows = [(i * i * i % 2003 * spread + i % 3, "u", "x" * (i % 700)) for i in range(1500)]
    rows += [(-(2**63), "u", "lowest"), (2**63 - 1, "u", "highest")]
    sized = frame(spark, rows).selectExpr("page_id", "sha1(html) AS digest", "CAST(length(html) AS BIGINT) AS size")
    placed, _ = warc._with_shards(sized, WarcOptions(shard_bytes=50_000))
    found = placed.groupBy("shard").agg({"page_id": "min", "size": "sum", "*": "count"}).collect()
    weights = [r["sum(size)"] + 512 * r["count(1)"] for r in found]
    assert len(weights) == -(-sum(weights) // 50_000) and max(weights) < 1.3 * sum(weights) / len(weights)
    ends = sorted((r["page_id"], r["shard"]) for r in placed.select("page_id", "shard").collect())
    assert [shard for _, shard in ends] == sorted(shard for _, shard in ends)


def test_what_the_driver_gets_does_not_grow(spark, monkeypatch):
    """Counts that reach the driver, for 1 and 100 times the pages."""
    monkeypatch.setattr(warc, "MAX_SHARDS", 12)
    ranges, most = warc._ranges, []

    def counted(*args):
        found = ranges(*args)
        most[-1] = max(most[-1], len(found[0]))
        return found

    monkeypatch.setattr(warc, "_ranges", counted)
    for count in (500, 50_000):
        most.append(0)
        pages = spark.range(count).selectExpr("id * id AS page_id", "sha1(CAST(id AS STRING)) AS digest", "id % 999 AS size")
        cuts = warc.find_cuts(pages, WarcOptions(shard_bytes=1_000))
        assert cuts.shards == 12
    # A few per shard at first, then FANOUT for each of the cuts: a bound that the table is not in.
    assert max(most) <= 64 * 11


def test_heavy_ids_in_a_bounded_number_of_shards(spark, monkeypatch):
    monkeypatch.setattr(warc, "MAX_SHARDS", 5)
    rows = [(7, "u", f"copy {i}" * 30) for i in range(700)] + [(i, "u", f"page {i}") for i in range(300)] + [(None, "u", f"{i}") for i in range(99)]
    sizes, slots = shard_sizes(spark, rows, WarcOptions(shard_bytes=2_000))
    assert len({shard for shard, _, _ in sizes}) <= 6 and max(sizes.values()) < 500
    assert read_rows(warc.write_and_read(frame(spark, rows), WarcOptions(shard_bytes=2_000)).collect()) == expected(rows)

"""WARC archives: exact round trip, same bytes on every run."""

import hashlib
from collections import defaultdict

from claimsieve.llm import warc_writer
from claimsieve.session import scratch_folder
from tests.llm.cases import bag

LONG = "<html>" + "long page " * 200
PAGES = [
    (1, "http://a.example/1", LONG),
    (2, "http://a.example/2 with blank", LONG),
    (2, "http://a.example/2 with blank", LONG),
    (None, "http://a.example/n", LONG),
    (3, None, "short"),
    (4, "http://a.example/4", "short"),
    (5, "", None),
    (None, None, None),
    (6, "http://é.example/日", "é" * 499 + "日"),
    (7, "u", "x" * 1000),
    (8, "u", "x" * 1000),
    (9, "u", "x" * 999),
    (10, "u", "x" * 999),
    (9007199254740993, "u", "big id"),
    (11, "u", "y" * 3_000_000),
]


def pages(spark, rows=PAGES):
    clashing = [(*row, "?", "?") for row in rows]
    return spark.createDataFrame(clashing, "page_id long, url string, html string, payload string, shard string")


def expected(rows):
    kept, out = defaultdict(lambda: None), []
    for page_id, _, html in rows:
        payload = (html or "").encode()
        if len(payload) >= 1000 and page_id is not None:
            kept[payload] = max(page_id, kept[payload] or page_id)
    for page_id, _, html in rows:
        payload = (html or "").encode()
        newest = kept.get(payload) if len(payload) >= 1000 else None
        older = newest is not None and (page_id is None or page_id < newest)
        digest = hashlib.sha1(payload).hexdigest()
        out.append((page_id, len(payload), digest, "revisit" if older else "response", newest if older else None))
    return sorted(out, key=str)


def test_round_trip(spark):
    assert bag(warc_writer.archive_round_trip(pages(spark), scratch_folder(spark))) == expected(PAGES)
    assert warc_writer.archive_round_trip(pages(spark, []), scratch_folder(spark)).count() == 0


def test_same_files_whatever_the_partitioning(spark):
    rows = [(i, f"http://x/{i}", f"page {i} " * (i % 50)) for i in range(300)] + PAGES

    def manifest(df):
        made = warc_writer.write_archives(df, scratch_folder(spark), shard_bytes=20_000, file_bytes=2_000)
        return bag(made)

    first, second = manifest(pages(spark, rows)), manifest(pages(spark, rows[::-1]).repartition(7))
    assert first == second
    assert len({row[1] for row in first}) > 3 and len(first) > len({row[1] for row in first})


def test_files_left_by_a_lost_task_are_not_read(spark, tmp_path):
    folder = f"file://{tmp_path}/archives"
    manifest = warc_writer.write_archives(pages(spark), folder)
    (tmp_path / "archives" / "part-9999999-00000.warc.gz").write_bytes(b"not committed")
    (tmp_path / "archives" / "_part-0000000-00000.warc.gz.abc").write_bytes(b"half")
    assert bag(warc_writer.read_archives(spark, folder, manifest)) == expected(PAGES)
    again = warc_writer.write_archives(pages(spark), folder)
    assert bag(again) == bag(manifest)

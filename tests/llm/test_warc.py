import hashlib
import io
import struct

import zstandard

from tamarack.llm import warc

from .conftest import SF


def plain(rows):
    best = {}
    for i, h in rows:
        b = (h or "").encode()
        if len(b) >= 1000 and i is not None:
            best[b] = max(i, best.get(b, i))
    out = []
    for i, h in rows:
        b = (h or "").encode()
        to = best.get(b) if best.get(b) != i else None
        out.append((i, len(b), hashlib.sha1(b).hexdigest(), "response" if to is None else "revisit", to))
    return sorted(out, key=lambda r: (r[0] is None, r[0] or 0, r[2]))


def read(df):
    return sorted(map(tuple, df.collect()), key=lambda r: (r[0] is None, r[0] or 0, r[2]))


def test_query_equals_brute_force(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SF}/pages.parquet").select("page_id", "html").collect()]
    assert read(warc.op9_warc(spark, SF)) == plain(rows)


def archive(spark, pages, tmp_path):
    folder = f"file://{tmp_path}/out"
    made = warc.write_archives(warc.with_revisits(pages), folder).collect()
    return warc.read_archives(spark, folder, [r["path"] for r in made])


def test_edge_cases(spark, tmp_path):
    big = "x" * 999 + "é"
    rows = [(1, big), (2, big), (5, big), (5, big), (None, big), (3, None), (4, ""), (6, "small"), (7, "small"), (8, "y" * 3_000_000), (None, "z" * 1000), (None, "z" * 1000)]
    pages = spark.createDataFrame([(i, None if i == 1 else f"http://a/{i}\r\nX: y", h, "d") for i, h in rows], "page_id long, url string, html string, digest string").repartition(3)
    assert read(archive(spark, pages, tmp_path)) == plain(rows)
    assert read(archive(spark, pages.where("false"), tmp_path / "none")) == []


def test_archive_carries_its_dictionary(spark, tmp_path):
    pages = spark.createDataFrame([(i, f"u{i}", f"<html><body><p>page {i}</p><div class='footer'>the same words stand on each page</div></body></html>" * 9) for i in range(300)], "page_id long, url string, html string").coalesce(1)
    archive(spark, pages, tmp_path).count()
    data = next((tmp_path / "out").glob("*.warc.zst")).read_bytes()
    magic, size = struct.unpack_from("<II", data)
    assert magic == 0x184D2A5D and 0 < size < 70_000
    first = next(warc.read_archive(io.BytesIO(data)))
    assert first.startswith(b"WARC/1.1\r\nWARC-Type: response")
    alone = sum(len(zstandard.compress(r)) for r in warc.read_archive(io.BytesIO(data)))
    assert len(data) - size - 8 < alone * 0.6

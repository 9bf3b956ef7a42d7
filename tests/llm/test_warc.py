"""WARC archives: the query against SQL, the files themselves, odd rows."""

import hashlib
import io
import os
import random

import duckdb
import pytest
import zstandard
from pyspark.sql import functions as F

from conftest import SF_SMALL
from helpers import rows_of, with_clashes
from starmart.llm.oracles import ORACLE_SQL
from starmart.llm.warc import (DICTIONARY_FRAME, Page, archive_pages, build_dictionary, page_of, page_record,
                               read_archives, records_of, write_archives)

SCHEMA = "page_id long, url string, html string"


def odd_pages():
    rng = random.Random(4)
    shared = "<p>" + " ".join(rng.choice(["alpha", "beta", "gamma"]) for _ in range(60)) + "</p>"
    long_page = "".join(rng.choice("abc <>é") for _ in range(400_000))
    rows = [(None, None, None), (None, "http://a/", shared), (None, "http://a/", shared), (1, None, None), (2, "", ""),
            (3, "http://b/\r\nInjected: yes", shared), (3, "http://b/\r\nInjected: yes", shared), (4, "http://c/", shared),
            (5, "http://d/", "x" * 99), (6, "http://e/", "x" * 99), (7, "http://e/", "x" * 100), (8, None, "x" * 100),
            (9, "http://f/é?q=日本", "é" * 50), (10, "http://f/ ", "é" * 50), (11, "u", "WARC/1.1\r\n\r\nContent-Length: 9\r\n\r\n"),
            (12, "u", "\x00\r\n\r\n\x01 " * 30), (13, "u", long_page), (14, "u", long_page), (-5, "u", "tail " * 40)]
    return rows + [(100 + i, f"http://h/{i}", f"<html><title>{i}</title>{shared[:80]}{rng.random()}</html>") for i in range(40)]


def odd(spark):
    return spark.createDataFrame(odd_pages(), SCHEMA)


def sql_rows(con, df):
    found = con.execute(f"SELECT {', '.join(sorted(df.columns))} FROM ({ORACLE_SQL['op11_warc']})").fetchall()
    return sorted(found, key=lambda r: tuple((x is None, str(x)) for x in r))


def test_odd_rows_match_sql(spark):
    con = duckdb.connect()
    con.execute("CREATE TABLE pages (page_id BIGINT, url VARCHAR, html VARCHAR)")
    con.executemany("INSERT INTO pages VALUES (?, ?, ?)", odd_pages())
    for parts in (1, 5):
        df = archive_pages(with_clashes(odd(spark)).repartition(parts))
        assert rows_of(df) == sql_rows(con, df)


def test_ids_of_another_type(spark):
    pages = odd(spark).withColumn("page_id", F.concat(F.lit("é:%/ \r\n"), F.col("page_id").cast("string")))
    df = archive_pages(pages)
    assert dict(df.dtypes)["page_id"] == "string"
    assert {r["page_id"] for r in df.collect()} == {r["page_id"] for r in pages.collect()}


def test_payloads_come_back(spark, scratch):
    write_archives(odd(spark).repartition(4), scratch)
    rows = read_archives(spark, scratch, "long").collect()
    html = {(p, hashlib.sha256((h or "").encode()).hexdigest()): h or "" for p, _, h in odd_pages()}
    assert len(rows) == len(odd_pages())
    for r in rows:
        if r["record_type"] == "response":
            assert bytes(r["payload"]).decode() == html[r["id"], r["payload_digest"]]
        else:
            assert r["payload"] is None and r["payload_bytes"] == len(html[r["id"], r["payload_digest"]].encode())
        assert not set(r["url"]) & set("\r\n ")


def test_file_layout(spark, scratch):
    """A leading skippable frame with the dictionary, one frame a record."""
    pages = spark.read.parquet(f"{SF_SMALL}/pages.parquet")
    manifest = write_archives(pages.repartition(3), scratch, max_bytes=20_000).collect()
    assert len(manifest) > 3 and sum(m["n_records"] for m in manifest) == pages.count()
    used = set()
    for m in manifest:
        with open(f"{scratch}/{m['path']}", "rb") as f:
            data = f.read()
        assert len(data) == m["n_bytes"] and data[:4] == DICTIONARY_FRAME
        size = int.from_bytes(data[4:8], "little")
        dictionary = data[8:8 + size]
        used.add(dictionary)
        rest, frames = data[8 + size:], 0
        decompressor = zstandard.ZstdDecompressor(dict_data=zstandard.ZstdCompressionDict(dictionary))
        while rest:  # each frame by itself is one whole record
            assert zstandard.get_frame_parameters(rest).dict_id == zstandard.ZstdCompressionDict(dictionary).dict_id()
            one = decompressor.decompressobj()
            record = one.decompress(rest)
            assert record.startswith(b"WARC/1.1\r\n") and record.endswith(b"\r\n\r\n")
            rest, frames = one.unused_data, frames + 1
        assert frames == m["n_records"] + 1  # and the archive's own
        with open(f"{scratch}/{m['path']}", "rb") as f:
            assert len(list(records_of(f))) == frames
    assert len(used) == 1


def test_dictionary_pays(spark):
    html = [r["html"] for r in spark.read.parquet(f"{SF_SMALL}/pages.parquet").collect()]
    records = [page_record(Page(i, str(i), "u", hashlib.sha256(h.encode()).hexdigest(), h.encode(), False, None, None), "d")
               for i, h in enumerate(html)]
    trained = build_dictionary(records[::2], 1 << 14)
    with_it = zstandard.ZstdCompressor(dict_data=zstandard.ZstdCompressionDict(trained))
    plain = zstandard.ZstdCompressor()
    rest = records[1::2]
    assert sum(len(with_it.compress(r)) for r in rest) < 0.9 * sum(len(plain.compress(r)) for r in rest)


def test_revisits_refer_to_the_response(spark, scratch):
    write_archives(odd(spark), scratch)
    ids, refers = {}, []
    for name in os.listdir(scratch):
        if name.endswith(".zst"):
            with open(f"{scratch}/{name}", "rb") as f:
                for headers, _ in records_of(f):
                    if headers["WARC-Type"] == "response":
                        ids[headers["WARC-Record-ID"]] = headers["WARC-Payload-Digest"]
                    elif headers["WARC-Type"] == "revisit":
                        refers.append((headers["WARC-Refers-To"], headers["WARC-Payload-Digest"]))
    assert refers and all(ids[r] == digest for r, digest in refers)


def test_files_outside_the_manifest_are_not_read(spark, scratch):
    write_archives(odd(spark), scratch)
    with open(f"{scratch}/pages-of-a-lost-task.warc.zst", "wb") as f:
        f.write(b"half a frame")
    assert read_archives(spark, scratch).count() == len(odd_pages())


def test_damage_is_an_error():
    page = Page(1, "1", "u", hashlib.sha256(b"right").hexdigest(), b"wrong", False, None, None)
    data = zstandard.ZstdCompressor().compress(page_record(page, "d"))
    [(headers, block)] = records_of(io.BytesIO(data))
    with pytest.raises(ValueError, match="another payload"):
        page_of(headers, block)
    cut = zstandard.ZstdCompressor().compress(page_record(page, "d")[:-8])
    with pytest.raises(ValueError, match="cut off"):
        list(records_of(io.BytesIO(cut)))


def test_empty_table_and_few_records(spark):
    out = archive_pages(odd(spark).limit(0))
    assert out.count() == 0
    few = odd(spark).where("page_id IN (2, 7)")
    assert out.schema == archive_pages(few).schema and archive_pages(few).count() == 2

import hashlib
import io

import pyarrow.fs
import pytest
import zstandard

from snapflow.llm import warc

BIG, OTHER = "<p>same page</p>" * 100, "<p>é another page</p>" * 90


def pages(spark):
    rows = [(1, "u1", BIG), (2, None, BIG), (7, "u7\r\nX: y", BIG), (7, "again", BIG), (3, "u3", "tiny"), (4, "u4", "tiny"), (5, "u5", None), (6, "u6", ""),
            (None, "u", BIG), (None, "v", OTHER), (None, "w", OTHER), (8, "z" * 500, "x" * 300_000), (9, "nine", "é" * 500), (10, "ten", "é" * 500)]
    return spark.createDataFrame([(*r, "clash", 1) for r in rows], "page_id long, url string, html string, digest string, k int"), rows


def test_round_trip(spark):
    df, rows = pages(spark)
    manifest = warc.write(warc.decide(df), warc.fresh_folder(spark))
    got = warc.read(manifest, payloads=True).collect()
    winner = {BIG: 7, "é" * 500: 10}
    wanted = []
    for page, url, html in rows:
        data = (html or "").encode()
        best = winner.get(html)
        again = best is not None and page != best
        wanted.append((page, len(data), hashlib.sha1(data).hexdigest(), "revisit" if again else "response", best if again else None, b"" if again else data))
    key = lambda r: (r[0] is None, r[0] or 0, *map(str, r[1:]))
    assert sorted([(r["page_id"], r["payload_bytes"], r["payload_digest"], r["record_type"], r["refers_to"], bytes(r["payload"])) for r in got], key=key) == sorted(wanted, key=key)
    assert {r["url"] for r in got if r["page_id"] == 7} == {"u7%0D%0AX: y", "again"}
    assert sum(r["records"] for r in manifest.collect()) == len(rows)


def test_dictionary_leads_and_each_record_is_a_frame(spark):
    rows = [(i, f"http://h/{i}", f"<html><head><title>{i * 7919}</title></head><body class='main'>{'word ' * (i % 9)}{i ** 3}</body></html>") for i in range(400)]
    df = spark.createDataFrame(rows, "page_id long, url string, html string").coalesce(1)
    manifest = warc.write(warc.decide(df).coalesce(1), warc.fresh_folder(spark)).collect()
    assert len(manifest) == 1 and manifest[0]["dictionary_bytes"] > 0
    fs, at = pyarrow.fs.FileSystem.from_uri(manifest[0]["path"])
    data = fs.open_input_stream(at, compression=None).read()
    assert data[:4] == warc.DICTIONARY_FRAME and len(data) == manifest[0]["bytes"]
    words = warc.embedded_dictionary(data)
    rest = data[8 + int.from_bytes(data[4:8], "little"):]
    frames = 0
    while rest:
        press = zstandard.ZstdDecompressor(dict_data=words).decompressobj()
        assert press.decompress(rest).startswith(b"WARC/1.1\r\n")
        rest, frames = press.unused_data, frames + 1
    assert frames == 400


def test_damaged_payload_is_an_error(spark, tmp_path):
    good = warc.record(1, "u", b"payload", hashlib.sha1(b"payload").hexdigest(), "response", None, "1970-01-01T00:00:00Z")
    (tmp_path / "bad.warc.zst").write_bytes(zstandard.compress(good.replace(b"\r\n\r\npayload", b"\r\n\r\nPAYLOAD")))
    manifest = spark.createDataFrame([(f"file://{tmp_path}/bad.warc.zst",)], "path string")
    with pytest.raises(Exception, match="does not match its digest"):
        warc.read(manifest).collect()
    assert [h["warc-type"] for h, _, _ in warc.parse(io.BytesIO(good * 2))] == ["response"] * 2


def test_empty_table(spark):
    df, _ = pages(spark)
    manifest = warc.write(warc.decide(df.limit(0)), warc.fresh_folder(spark))
    assert manifest.count() == 0 and warc.read(manifest).count() == 0
